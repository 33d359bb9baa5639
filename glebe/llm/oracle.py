"""DuckDB statements for the queries of this package that SQL can express."""

from __future__ import annotations

from glebe.llm import chat_format, collocations, line_dedup, mixing, vector_codes
from glebe.llm.staging import LOWER_ASCII, UPPER_ASCII


def _hash52(*parts: str) -> str:
    text = " || ':' || ".join(f"coalesce(cast({p} as varchar), '~')" for p in parts)
    return f"cast('0x' || substr(md5({text}), 1, 13) as bigint)"


def _inverse(u: str, knots) -> str:
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
    whole, done, cases = sum(areas), 0.0, []
    for ((t0, w0), (t1, w1)), area in zip(zip(knots, knots[1:]), areas):
        slope = (w1 - w0) / (t1 - t0)
        need = f"({u} * {whole!r}::double - {done!r}::double)"
        if abs(slope) < 1e-12:
            time = f"{t0!r}::double + {need} / {w0!r}::double"
        else:
            time = f"{t0!r}::double + (sqrt(greatest({w0 * w0!r}::double + {2 * slope!r}::double * {need}, 0.0::double)) - {w0!r}::double) / {slope!r}::double"
        done += area
        cases.append(f"when {u} * {whole!r}::double <= {done!r}::double then least(greatest({time}, {t0!r}::double), {t1!r}::double)")
    return "case " + " ".join(cases) + " else 1.0::double end"


def _mix() -> str:
    w = mixing.BASE_WEIGHTS
    weight = "case (rn - 1) % 3 " + " ".join(f"when {i} then {x!r}::double" for i, x in enumerate(w)) + " end"
    position = "case turn " + " ".join(f"when {i} then {_inverse('u', s)}" for i, s in enumerate(mixing.SCHEDULES)) + " end"
    return f"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size from documents
), s as (
  select source, sum(size)::bigint as source_size, row_number() over (order by encode(source) nulls last) as rn from d group by source
), w as (
  select *, (rn - 1) % 3 as turn, {weight} as weight, 2.0::double * source_size as cap from s
), fill as (
  select *, row_number() over (order by cap / weight, rn) as k,
    coalesce(sum(cap) over (order by cap / weight, rn rows between unbounded preceding and 1 preceding), 0) as capped,
    sum(weight) over () - coalesce(sum(weight) over (order by cap / weight, rn rows between unbounded preceding and 1 preceding), 0) as open_weight,
    sum(source_size) over () * {mixing.SHARE!r}::double as wanted
  from w
), level as (
  select coalesce(arg_min((wanted - capped) / open_weight, k) filter (where cap / weight > (wanted - capped) / open_weight),
                  max(cap / weight)) as level from fill
), t as (
  select source, source_size, turn, least(cap, weight * level) as target from w, level
), r as (
  select d.*, t.source_size, t.turn, t.target,
    case when t.source_size > 0 then floor(t.target / t.source_size) else 0 end::bigint as passes
  from d join t on d.source is not distinct from t.source
), q as (
  select *, target - passes * source_size as rest, {_hash52("doc_id", "size")} as h from r
), c as (
  select *, coalesce(sum(size) over (partition by source order by h, doc_id rows between unbounded preceding and 1 preceding), 0) as start from q
), a as (
  select source, any_value(rest) as rest, coalesce(max(start + size) filter (where size > 0 and start + size <= rest), 0) as took1 from c group by source
), e as (
  select c.*, a.took1, sum(size) over (partition by c.source order by h, doc_id rows between unbounded preceding and current row) as upto
  from c join a on c.source is not distinct from a.source where size > 0 and start + size > c.rest and size <= c.rest - took1
), f as (
  select source, start, size, took1 + upto - size as begins from e where upto <= rest - took1
), g as (
  select a.source, took1 + coalesce(sum(size), 0) as took, any_value(rest) - (took1 + coalesce(sum(size), 0)) as gap
  from a left join f on a.source is not distinct from f.source group by a.source, took1
), m as (
  select c.source, c.start, c.size, f.begins, c.start + c.size <= c.rest or f.start is not null as taken, g.took, g.gap
  from c join g on c.source is not distinct from g.source left join f on c.source is not distinct from f.source and c.start = f.start where c.size > 0
), k as (
  select *, row_number() over (partition by source order by start desc) as nth from m where taken
  union all select *, row_number() over (partition by source order by abs(size - gap), start) as nth from m where not taken
), p as (
  select *, row_number() over (partition by source order by not taken, nth) as i
  from (select * from k qualify row_number() over (partition by source order by nth, not taken) <= {mixing.POOL})
), o as (
  select source, list(size order by i) as sizes, any_value(gap) + coalesce(sum(size) filter (where taken), 0) as want from p group by source
), b as (
  select source, list_sort(list_transform(range(1 << len(sizes)), lambda x:
    {{'off': abs(list_sum(list_transform(sizes, lambda s, i: s * ((x >> (i - 1)) & 1))) - want), 'mask': x}}))[1].mask as mask from o
), v as (
  select p.*, (mask >> (i - 1)) & 1 = 1 as stays from p join b on p.source is not distinct from b.source
), x as (
  select source, start, stays, case when taken then begins
    else took - coalesce(sum(size) filter (where taken and not stays) over (partition by source), 0) end as begins from v
  union all select source, start, true, begins from f where not exists (select 1 from v where v.source is not distinct from f.source and v.start = f.start)
), n as (
  select c.*, case when size > 0 then passes + coalesce(x.stays, c.start + size <= rest)::bigint else 0 end as n,
    least(case when passes = 0 then coalesce(x.begins, c.start) else c.start end / target, 1.0::double) as u
  from c left join x on c.size > 0 and c.source is not distinct from x.source and c.start = x.start
)
select doc_id, size, source_size, round(target, 6) as target, (n * size)::bigint as taken, n::int as copies,
  case when n > 0 then round({position}, 6) end as position
from n"""


def _shards() -> str:
    def best(n: int) -> str:
        scores = ", ".join(f"{{'score': -1.0::double / ln(({_hash52('doc_id', str(i))} + 0.5) / {float(1 << 52)!r}::double), 'shard': {i}}}" for i in range(n))
        return f"greatest({scores}).shard"

    return f"""
with t as materialized (
  select list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i:
    case when c & 1 = 1 then xor(3988292384::bigint, c >> 1) else c >> 1 end, n)) as crc
), d as (
  select doc_id, coalesce(text, '') as text from documents
), b as (
  select doc_id, strlen(text)::bigint + 1 as size,
    list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: cast('0x' || h as bigint)) as bytes from d
), c as (
  select doc_id, size, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1]), 4294967295::bigint), 4294967295::bigint) as text_crc32
  from b, t
), s as (
  select *, {best(8)} as shard, {best(9)} as grown_shard, coalesce(cast(doc_id as varchar), '~:' || text_crc32 || ':' || size) as slot_key from c
)
select doc_id, size, text_crc32, 'key' as law, shard, row_number() over (partition by shard order by {_hash52('slot_key')}, slot_key) - 1 as slot, grown_shard
from s"""


_EXACT = f"""
with d as (
  select doc_id, sha256(translate(coalesce(text, ''), '{UPPER_ASCII}', '{LOWER_ASCII}')) as sha from documents
)
select doc_id, max(doc_id) over (partition by sha) as keep_id, count(*) over (partition by sha) as group_size,
  doc_id = max(doc_id) over (partition by sha) as kept, sha as text_sha256
from d"""


def _warc() -> str:
    quintets = " || ".join(
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((cast('0x' || substr(sha, {10 * g + 1}, 10) as bigint)) >> {35 - 5 * i}) & 31)::int + 1, 1)"
        for g in range(4) for i in range(8)
    )
    return f"""
with p as (select page_id, coalesce(html, '') as html from pages),
h as (select page_id, strlen(html)::bigint as payload_bytes, sha1(html) as sha from p),
f as (select *, min(page_id) over (partition by sha) as first_id from h)
select page_id, payload_bytes, {quintets} as payload_digest,
  case when page_id = first_id then 'response' else 'revisit' end as record_type,
  case when page_id <> first_id then first_id end as refers_to
from f"""


_LINES = f"""
with d as (
  select doc_id, row_number() over (order by doc_id nulls first) as uid, text, string_split(text, chr(10)) as split from documents
), l as (
  select uid, unnest(list_filter(list_transform(split, lambda x, i: {{'line': i - 1, 'words': trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13))}}),
    lambda s: s.words <> '')) as l from d
), p as (
  select uid, l.line as line, row_number() over (partition by uid order by l.line) - 1 as seq, l.words as words,
    len(regexp_extract_all(l.words, '[^\\x20\\x09-\\x0D]+')) as n from l
), b as (
  select *, sum(n) over (partition by uid order by seq) - n as before, sum(n) over (partition by uid) as whole from p
), w as (
  select uid, seq, list(words) over (partition by uid order by before range between current row and {line_dedup.MIN_WORDS - 1} following) as win, whole - before as reach from b
), e as (
  select uid, seq, list(words) over (partition by uid order by before + n range between {line_dedup.MIN_WORDS - 1} preceding and current row) as win, before + n as reach from b
), every_window as (
  select uid, seq, win from w where reach >= {line_dedup.MIN_WORDS}
  union select uid, seq - len(win) + 1, win from e where reach >= {line_dedup.MIN_WORDS}
), c as (
  select uid, seq, len(win) as len, row_number() over (partition by win order by uid, seq) as nth from every_window
), gone as (
  select distinct uid, unnest(range(seq, seq + len)) as seq from c where nth > 1
), runs as (
  select uid, count(*) filter (where first) as runs, count(*) as lines
  from (select uid, seq, coalesce(seq <> lag(seq) over (partition by uid order by seq) + 1, true) as first from gone) group by uid
), numbers as (
  select g.uid, list(p.line) as lines from gone g join p using (uid, seq) group by g.uid
), total as (select uid, count(*) as n from p group by uid)
select doc_id, coalesce(total.n, 0)::int as lines, coalesce(runs.lines, 0)::int as removed_lines, coalesce(runs.runs, 0)::int as removed_runs,
  sha256(coalesce(case when runs.uid is null then text
    else array_to_string(list_filter(split, lambda x, i: not list_contains(numbers.lines, i - 1)), chr(10)) end, '')) as text_sha256
from d left join runs using (uid) left join numbers using (uid) left join total using (uid)"""


_CHAT = f"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{chat_format.CLOSE}{chat_format.OPEN}assistant ok'
  union all select -1, 1, 'assistant', '{chat_format.CLOSE}{chat_format.OPEN}assistant ok'
), p as (
  select *, '{chat_format.OPEN}' || replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C') || chr(10)
    || regexp_replace(text, '<(\\\\*)(\\||$)', '<\\1\\\\\\2', 'g') || '{chat_format.CLOSE}' || chr(10) as piece from c
), g as (
  select conv_id, count(*)::bigint as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, piece) as turns,
    coalesce(string_agg(text, '' order by turn nulls first, piece) filter (where role = '{chat_format.TRAINED_ROLE}'), '') as loss,
    sum(length(piece))::bigint as formatted_chars from p group by conv_id
)
select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss)::bigint as loss_chars, sha256(loss) as loss_sha256, formatted_chars from g"""

_COLLOCATIONS = f"""
with p as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER_ASCII}', '{LOWER_ASCII}'), '[.,;:!?\x0A-\x0D]')) as piece from documents
), w as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from p
), g as (
  select lang, unnest(flatten(list_transform(range(1, {collocations.LONGEST + 1}), lambda k:
    list_transform(range(1, greatest(len(ws) - k + 2, 1)), lambda i: array_to_string(ws[i:i + k - 1], ' '))))) as phrase from w
), f as (
  select lang, phrase, count(*)::bigint as f from g group by lang, phrase having count(*) >= {collocations.LEAST}
), t as (
  select lang, sum(len(ws))::bigint as n from w group by lang
), c as (
  select lang, phrase, f as a, string_split(phrase, ' ') as ws from f where contains(phrase, ' ')
), k as (
  select *, unnest(range(1, len(ws))) as k from c
), s as (
  select k.lang, k.phrase, k.a, k.k, x.f as l, y.f as r,
    ({collocations.SCORE_UNIT}::hugeint * k.a * k.a // (x.f::hugeint * y.f))::bigint as score
  from k join f x on k.lang = x.lang and x.phrase = array_to_string(ws[1:k.k], ' ')
    join f y on k.lang = y.lang and y.phrase = array_to_string(ws[k.k + 1:], ' ')
), b as (
  select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1
), i as (
  select lang, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) as phrase, a from c where len(ws) = 3
), m as (
  select lang, phrase, max(a) as most from i group by lang, phrase
), u as (
  select b.* from b left join m using (lang, phrase) where m.most is null or 100 * m.most < {collocations.COVERED} * b.a
)
select lang, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank, phrase, a, l, r, n, score
from u join t using (lang) qualify rank <= {collocations.TOP}"""


def _codes() -> str:
    """The rounds of training one after another, by comparing every part with every entry."""
    v = vector_codes
    part = f"""
with x as materialized (
  select row_number() over (order by vec_id nulls last, embedding) as id, vec_id, label, embedding from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0
), parts as materialized (
  select id, vec_id, label, unnest(range({v.PARTS})) as part,
    list_transform(embedding, lambda e: floor(e::double * {v.SCALE})::hugeint) as whole, len(embedding) // {v.PARTS} as d from x
), p as materialized (
  select id, vec_id, label, part, whole[part * d + 1:(part + 1) * d] as v from parts
), b0 as materialized (
  select part, id - 1 as entry, v as c from p where id <= {v.ENTRIES}
)"""
    assign = """, a{n} as materialized (
  select id, part, arg_min(entry, (off, entry)) as entry, min(off) as off from (
    select p.id, p.part, b.entry, list_sum(list_transform(list_zip(p.v, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::hugeint as off
    from p join b{n} b on p.part = b.part) group by id, part
)"""
    mean = """, m{n} as (
  select part, entry, list((s - ((s % n) + n) % n) // n order by j) as c from (
    select a.part, a.entry, j, sum(p.v[j])::hugeint as s, count(*)::hugeint as n
    from a{n} a join p on a.id = p.id and a.part = p.part, unnest(range(1, len(p.v) + 1)) as q(j) group by a.part, a.entry, j) group by part, entry
), b{next} as materialized (
  select b.part, b.entry, coalesce(m.c, b.c) as c from b{n} b left join m{n} m on b.part = m.part and b.entry = m.entry
)"""
    rounds = "".join(assign.format(n=n) + mean.format(n=n, next=n + 1) for n in range(v.ROUNDS)) + assign.format(n=v.ROUNDS)
    return f"""{part}{rounds}, h as (
  select sha256(string_agg(array_to_string(list_transform(c, lambda e: e::varchar), ','), ',' order by part, entry)) as codebooks_sha256 from b{v.ROUNDS}
), o as (
  select x.vec_id, x.label, string_agg(printf('%02x', entry::int), '' order by part) as code, sum(off)::bigint as error
  from a{v.ROUNDS} a join x on a.id = x.id group by x.id, x.vec_id, x.label
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from o, h"""


SQL = {
    "op4_mix_curriculum": _mix(),
    "op5_rendezvous_shards": _shards(),
    "op6_bloom_exact_dedup": _EXACT,
    "op8_warc_roundtrip": _warc(),
    "op9_suffix_line_dedup": _LINES,
    "op11_chat_format": _CHAT,
    "op12_collocations": _COLLOCATIONS,
    "op13_vector_codes": _codes(),
}
