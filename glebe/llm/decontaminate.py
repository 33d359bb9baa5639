"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of tokens (runs of letters, digits and unit signs), and each token is typed:

  a number, with its decimals and groups of digits (3.5, 1,200, 1 200)
  a unit behind a number, or a currency sign before one
  a name: one capital and small letters, inside a sentence (behind a word or comma and one space)
  else the token itself, lower-cased

A capitalised word that begins a sentence (or stands behind a quote, bracket or line break) may be a name or not:
it is marked, and counts as itself in one form of its windows and as a name in another.

Windows of :data:`WINDOW` template tokens of all documents are hash-joined with those of the benchmark, in both
forms of each side. The benchmark's windows also stand under their names in small letters, so copies in other
letter case are found. A document is a candidate for an item when it holds :data:`COVERAGE` of the item's windows. Then the slots are
checked: along one alignment (document position minus item position), each value of the item's slots must
stand for one value of the document's; windows that hold another value than the most frequent one are taken
out. Items that are still covered by at least COVERAGE are reported. So a question whose numbers and names
were exchanged throughout is caught, and one whose slots contradict each other is not. All of it is DataFrame
operations.

Windows with fewer than :data:`LITERALS` literal tokens say little and do not count, unless an item has no
others. The benchmark's windows are broadcast while they are few (checked); beyond, the join is by sort and
merge. Documents' windows are never shuffled in the first case; what passes is (document, item) matches only.

Defined results:
  null/empty text   no token, never a candidate
  fewer than WINDOW tokens   the whole sequence is the only window, of documents and items alike
  null item text    no window, never found
  null doc_id       reported with doc_id null
  repeated rows     documents with the same doc_id and text are one; repeated items are reported by each item_id
  empty tables      empty result; :func:`drop_contaminated` then keeps every document
  extra columns     kept by :func:`drop_contaminated` whatever their names
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glebe.llm.staging import packed, staged, unpacked
from glebe.operators.broadcast import bounded_broadcast

WINDOW = 5
COVERAGE = 0.8
LITERALS = 2
# Benchmark windows up to which their hashes are broadcast: rows of four numbers, 32 MB of them.
BROADCAST_WINDOWS = 1_000_000
# Fixed list of unit tokens that count behind a number.
UNITS = (
    "%", "°", "€", "$", "£", "mm", "cm", "m", "km", "in", "ft", "mi", "miles", "mile", "mg", "g", "kg", "t", "lb", "lbs", "oz",
    "ml", "l", "litre", "litres", "liter", "liters", "s", "sec", "seconds", "min", "minutes", "h", "hours", "hour", "days", "day",
    "weeks", "months", "years", "c", "f", "k", "w", "kw", "kwh", "v", "hz", "khz", "mhz", "ghz", "b", "kb", "mb", "gb", "tb",
    "mph", "kmh", "eur", "usd", "gbp", "dollars", "dollar", "euros", "euro", "cents", "percent",
)
# Placeholders: private characters, which no token holds.
NUMBER, UNIT, NAME = "\ue001", "\ue002", "\ue003"

# Stands before a capitalised word that may be a name.
MARK = "\ue004"
# Stands for what joins the digits of one number.
INNER = "\ue005"
# Every pattern begins with the character that it is about: what stands before it is looked at only where that one is found.
_INNER = r"[.,](?=\p{N})(?<=\p{N}.)|[ \u00a0\u2009\u202f](?=\p{N}{3}(?!\p{N}))(?<=(?<!\p{N})\p{N}{1,3}.)"
_SEPARATORS = r"[^\p{L}\p{N}%°€$£\ue003-\ue005]+"
_JOINTS = r"(\p{N})(?=[\p{L}%°€$£])|([%°€$£])(?=\p{N})"
_NUMBER = r"\p{N}(?<![^ ]\p{N})[\p{N}\ue005]*(?![^ ])"
_UNIT = r"(?i)\ue001 \ue004?(?:" + "|".join(u if u.isalpha() else "\\" + u for u in UNITS) + r")(?![^ ])"
_SIGN = r"[€$£](?<![^ ][€$£])(?= \ue001)"
_NAME = r"\p{Lu}(?<=[\p{L}\p{N},;] \p{Lu})\p{Ll}+(?![\p{L}\p{N}%°€$£])"
_OPENING = r"\p{Lu}(?<![\p{L}\p{N}%°€$£\ue003].)\p{Ll}+(?![\p{L}\p{N}%°€$£])"


def _has_digits(text: Column) -> Column:
    """Most texts have none, and then only separators and names matter."""
    return text.rlike(r"\p{N}")


def spaced(text: Column, digits: bool) -> Column:
    """The tokens of a text, one space between them."""
    tokens = F.regexp_replace(text, _SEPARATORS, " ")
    return F.trim(F.regexp_replace(tokens, _JOINTS, "$1$2 ") if digits else tokens)


def _clean(text: Column, digits: bool) -> Column:
    """The text without our private characters, its numbers joined."""
    private = F.lit(False)
    for c in (NUMBER, UNIT, NAME, MARK, INNER):
        private = private | F.contains(text, F.lit(c))
    own = F.when(private, F.regexp_replace(text, "[\ue001-\ue005]", " ")).otherwise(text)
    return F.regexp_replace(own, _INNER, INNER) if digits else own


def template(text: Column) -> Column:
    """The template of a text: as many tokens as :func:`spaced` gives, one space between them; those that may be names are marked."""

    def tokens(digits: bool) -> Column:
        named = F.regexp_replace(_clean(text, digits), _NAME, NAME)
        return spaced(F.regexp_replace(named, _OPENING, MARK + "$0"), digits)

    numbers = F.regexp_replace(tokens(True), _NUMBER, NUMBER)
    units = F.regexp_replace(F.regexp_replace(numbers, _UNIT, f"{NUMBER} {UNIT}"), _SIGN, UNIT)
    return F.lower(F.when(_has_digits(text), units).otherwise(tokens(False)))


def _plain(text: Column) -> Column:
    """The raw tokens, in small letters: values of slots are compared without regard to case."""
    return F.lower(F.when(_has_digits(text), spaced(_clean(text, True), True)).otherwise(spaced(_clean(text, False), False)))


def _split(text: Column) -> Column:
    return F.when(F.char_length(text) > 0, F.split(text, " ")).otherwise(F.array().cast("array<string>"))


def _windows(tokens: Column) -> Column:
    """Array of the hashes of all windows, by position, from an array of the tokens' hashes."""
    size = F.size(tokens)
    rolling = F.transform(F.sequence(F.lit(0), size - WINDOW), lambda i: F.xxhash64(*[F.get(tokens, i + j) for j in range(WINDOW)]))
    return F.when(size >= WINDOW, rolling).when(size > 0, F.array(F.xxhash64(tokens, F.lit(WINDOW)))).otherwise(F.array().cast("array<bigint>"))


def _hashes(tokens: Column) -> Column:
    return F.transform(tokens, lambda k: F.xxhash64(k))


def _forms(marked: Column) -> tuple[Column, Column]:
    """The template tokens (one string) with marked words as themselves, and as names."""
    return F.replace(marked, F.lit(MARK), F.lit("")), F.regexp_replace(marked, MARK + "[^ ]*", NAME)


def _literals(kinds: Column) -> Column:
    return F.size(F.filter(kinds, lambda k: ~k.isin(NUMBER, UNIT, NAME)))


def _key(text: Column) -> Column:
    return F.xxhash64(text)


def item_windows(benchmark: DataFrame) -> DataFrame:
    """_item (a number of ours), item_id, _at, _hashes, _raw (the window's raw tokens), _kinds (its template tokens, marked words as names), _all (windows that count)."""
    items = staged(benchmark.select("item_id", "text").withColumn("_item", F.monotonically_increasing_id()), "decontaminate-items")
    tokens = items.select("_item", "item_id", _split(_plain(F.col("text"))).alias("_raw"), template(F.col("text")).alias("_marked"))
    plain, named = _forms(F.col("_marked"))
    tokens = tokens.withColumn("_kinds", _split(plain)).withColumn("_named", _split(named))
    folded = F.zip_with("_kinds", "_raw", lambda k, r: F.when(k == NAME, F.lower(r)).otherwise(k))
    tokens = tokens.withColumn("_h1", _hashes(F.col("_kinds"))).withColumn("_h2", _hashes(folded)).withColumn("_h3", _hashes(F.col("_named")))
    both = F.arrays_zip(_windows(F.col("_h1")).alias("typed"), _windows(F.col("_h2")).alias("folded"), _windows(F.col("_h3")).alias("named"))
    placed = tokens.select("_item", "item_id", "_raw", "_kinds", "_named", F.posexplode(both).alias("_at", "_hash"))
    cut = lambda c: F.slice(c, F.col("_at") + 1, F.lit(WINDOW))
    placed = placed.select("_item", "item_id", "_at", "_hash", cut("_raw").alias("_raw"), cut("_kinds").alias("_kinds"), cut("_named").alias("_named"))
    enough = F.least(F.lit(LITERALS), F.size("_kinds"))
    # The form with more names stands only where it still says enough.
    hashes = F.array_compact(F.array("_hash.typed", "_hash.folded", F.when(_literals(F.col("_named")) >= enough, F.col("_hash.named"))))
    placed = placed.withColumn("_hashes", F.array_distinct(hashes)).withColumn("_literal", _literals(F.col("_kinds")) >= enough)
    placed = placed.withColumn("_kinds", F.col("_named")).drop("_hash", "_named")
    told = placed.groupBy("_item").agg(F.sum(F.col("_literal").cast("int")).alias("_telling"), F.count(F.lit(1)).alias("_every"))
    placed = placed.join(told, "_item").where(F.col("_literal") | (F.col("_telling") == 0))
    every = F.when(F.col("_telling") == 0, F.col("_every")).otherwise(F.col("_telling"))
    return staged(placed.withColumn("_all", every).drop("_literal", "_telling", "_every"), "decontaminate-windows")


def matches(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(_doc, _text, _item, _at, _pos) of the windows that candidates share with their items. ``docs``: _doc, text."""
    tokens = docs.select("_doc", _key(F.col("text")).alias("_text"), template(F.col("text")).alias("_marked"))
    plain, named = _forms(F.col("_marked"))
    # The tokens' hashes are columns before windows are cut from them: inside a lambda an expression runs once for each position.
    tokens = tokens.select("_doc", "_text", _hashes(_split(plain)).alias("_plain_tokens"), _hashes(_split(named)).alias("_named_tokens"))
    tokens = tokens.select("_doc", "_text", _windows(F.col("_plain_tokens")).alias("_plain"), _windows(F.col("_named_tokens")).alias("_named"))
    # Both forms one behind the other: a window that is the same in both is found twice, at one position.
    both = tokens.select("_doc", "_text", F.greatest(F.size("_plain"), F.lit(1)).alias("_many"), F.concat("_plain", "_named").alias("_both"))
    # Outer: a plain generator infers a filter on the array's size, which would be pushed down and cut all windows once more.
    placed = both.select("_doc", "_text", "_many", F.posexplode_outer("_both").alias("_at2", "_hash"))
    few = bounded_broadcast(windows.select(F.explode("_hashes").alias("_hash"), "_item", "_at", "_all"), BROADCAST_WINDOWS)
    found = placed.join(few, "_hash").withColumn("_pos", F.col("_at2") % F.col("_many")).drop("_hash", "_at2", "_many")
    found = staged(found.distinct(), "decontaminate-matches")
    covered = found.groupBy("_doc", "_text", "_item", "_all").agg(F.count_distinct("_at").alias("_n")).where(F.col("_n") >= F.col("_all") * F.lit(COVERAGE))
    pairs = covered.select(F.col("_doc").alias("_d"), F.col("_text").alias("_t"), F.col("_item").alias("_i"))
    same = F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_text") == F.col("_t")) & (F.col("_item") == F.col("_i"))
    return staged(found.join(pairs, same, "left_semi"), "decontaminate-candidates")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per found (document, item): _doc, _text (a hash of its text), item_id, coverage, reparameterised."""
    windows = item_windows(benchmark)
    found = matches(docs, windows)
    # The candidates' texts once more, for the raw tokens in their slots; the list of candidates is small or shuffles.
    wanted = bounded_broadcast(staged(found.select(F.col("_doc").alias("_d"), F.col("_text").alias("_t")).distinct(), "decontaminate-wanted"))
    hashed = docs.select("_doc", _key(F.col("text")).alias("_text"), "text")
    texts = hashed.join(wanted, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_text") == F.col("_t")), "left_semi")
    raw = texts.select(F.col("_doc").alias("_d"), F.col("_text").alias("_t"), _split(_plain(F.col("text"))).alias("_tokens")).dropDuplicates(["_d", "_t"])
    seen = found.join(raw, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_text") == F.col("_t")))
    seen = seen.select("_doc", "_text", "_item", "_at", "_pos", F.slice("_tokens", F.col("_pos") + 1, F.lit(WINDOW)).alias("_values"))
    items = bounded_broadcast(windows.drop("_hashes", "_all"))
    seen = staged(seen.join(items, ["_item", "_at"]), "decontaminate-seen")
    along = ["_doc", "_text", "_item", "_shift"]
    # A slot that several windows hold counts in each of them; the most frequent value stands.
    zipped = F.filter(F.arrays_zip(F.col("_kinds").alias("kind"), F.col("_raw").alias("asked"), F.col("_values").alias("given")),
                      lambda s: s["kind"].isin(NUMBER, UNIT, NAME))
    shifted = seen.withColumn("_shift", F.col("_pos") - F.col("_at"))
    slots = shifted.select(*along, "_at", F.explode(zipped).alias("_slot")).select(*along, "_at", "_slot.kind", "_slot.asked", "_slot.given")
    votes = slots.groupBy(*along, "kind", "asked", "given").agg(F.count(F.lit(1)).alias("_votes"))
    chosen = votes.groupBy(*along, "kind", "asked").agg(F.max(F.struct("_votes", "given"))["given"].alias("_chosen"))

    def on(left: list[str], right: DataFrame, more: list[str]) -> tuple[DataFrame, Column]:
        names = [*left, *more]
        renamed = right.select(*[F.col(c).alias("r" + c) for c in names], *[c for c in right.columns if c not in names])
        condition = F.lit(True)
        for c in names:
            condition = condition & F.col(c).eqNullSafe(F.col("r" + c))
        return renamed, condition

    right, same = on(along, chosen, ["kind", "asked"])
    wrong = slots.join(right, same).where(F.col("given") != F.col("_chosen")).select(*along, "_at").distinct()
    right, same = on(along, wrong, ["_at"])
    good = shifted.join(right, same, "left_anti")
    changed = F.exists(F.arrays_zip(F.col("_raw").alias("asked"), F.col("_values").alias("given")), lambda s: s["asked"] != s["given"])
    total = windows.select("_item", "_all").distinct()
    result = good.withColumn("_changed", changed).groupBy("_doc", "_text", "_item", "item_id").agg(
        F.count_distinct("_at").alias("windows"), F.bool_or("_changed").alias("reparameterised")
    )
    result = result.join(total, "_item").withColumn("coverage", F.round(F.col("windows") / F.col("_all"), 6))
    return result.where(F.col("windows") >= F.col("_all") * F.lit(COVERAGE)).select("_doc", "_text", "item_id", "windows", "coverage", "reparameterised")


def contaminated_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per found pair: doc_id, item_id, windows, coverage, reparameterised."""
    found = contaminated(docs.select(F.col("doc_id").alias("_doc"), "text"), benchmark)
    return found.select(F.col("_doc").alias("doc_id"), "item_id", "windows", "coverage", "reparameterised")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; all columns unchanged."""
    found = contaminated(docs.select(F.col("doc_id").alias("_doc"), "text"), benchmark)
    gone = bounded_broadcast(staged(found.select(F.col("_doc").alias("_d"), F.col("_text").alias("_t")).distinct(), "decontaminate-gone"))
    rows = packed(docs, _doc=F.col("doc_id"), _text=_key(F.col("text")))
    return unpacked(rows.join(gone, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_text") == F.col("_t")), "left_anti"))
