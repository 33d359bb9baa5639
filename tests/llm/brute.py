"""Plain-Python versions of the operators, for small inputs."""

from __future__ import annotations

import math
import re
import hashlib
from collections import defaultdict

import xxhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def simhash(text, k=3):
    words = WORDS.findall(ascii_lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, linked):
    """Smallest index reachable, for each index."""
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def hash52(*parts):
    text = ":".join("~" if p is None else str(p) for p in parts)
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16)


def shard(key, weights):
    def score(i):
        return -weights[i] / math.log((hash52(key, i) + 0.5) / float(1 << 52))

    return max(range(len(weights)), key=lambda i: (score(i), i))


def deleted_lines(docs, least_words):
    """docs: texts in order → per document the lines (by number among the non-blank ones) of every run of ``least_words`` words
    or more that begins earlier too, by comparing all pairs of places."""
    seqs = [[x.strip(" \t\r\x0b\x0c") for x in (t or "").split("\n")] for t in docs]
    seqs = [[x for x in s if x] for s in seqs]
    earlier, gone = defaultdict(dict), defaultdict(set)  # places by what follows them: one of several equal ones is enough
    for d, seq in enumerate(seqs):
        for i, line in enumerate(seq):
            for e, j in earlier[line].values():
                size = 0
                while i + size < len(seq) and j + size < len(seqs[e]) and seq[i + size] == seqs[e][j + size]:
                    size += 1
                if sum(len(WORDS.findall(x)) for x in seq[i:i + size]) >= least_words:
                    gone[d].update(range(i, i + size))
            earlier[line].setdefault(tuple(seq[i:]), (d, i))
    return gone


SIGNS = "%°€$£"
JOINED = "\ue005"


def template(text, units):
    """Raw tokens in small letters and template tokens, character by character instead of by the operator's patterns:
    ``#`` a number, ``~`` a unit, ``@`` a name, ``?word`` a word that may be one."""
    text, tokens, starts = list(text or ""), [], []
    digits = lambda part: len(part) > 0 and all(c.isnumeric() for c in part)

    def joins(i):
        if text[i] in ".,":
            return digits(text[i - 1:i]) and digits(text[i + 1:i + 2])
        if text[i] not in " \u00a0\u2009\u202f":
            return False
        run = 0
        while i - run > 0 and text[i - run - 1].isnumeric():
            run += 1
        return 1 <= run <= 3 and len(text[i + 1:i + 4]) == 3 and digits(text[i + 1:i + 4]) and not digits(text[i + 4:i + 5])

    text = "".join(JOINED if joins(i) else c for i, c in enumerate(text))
    for i, c in enumerate(text):
        if not (c.isalpha() or c.isnumeric() or c in SIGNS or c == JOINED):
            continue
        before = text[i - 1] if i else " "
        fresh = not (before.isalpha() or before.isnumeric() or before in SIGNS or before == JOINED)
        if fresh or (before.isnumeric() and (c.isalpha() or c in SIGNS)) or (before in SIGNS and c.isnumeric()):
            tokens.append("")
            starts.append(i)
        tokens[-1] += c

    def kind(t, i):
        if all(c.isnumeric() or c == JOINED for c in t):
            return "#"
        before = text[i - 1] if i else " "
        if not (len(t) > 1 and t[0].isupper() and t[1:].isalpha() and t[1:].islower()) or before.isnumeric() or before in SIGNS:
            return t.lower()
        inside = i > 1 and before == " " and (text[i - 2].isalpha() or text[i - 2].isnumeric() or text[i - 2] in ",;")
        return "@" if inside else "?" + t.lower()

    kinds = [kind(t, i) for t, i in zip(tokens, starts)]
    for i, t in enumerate(tokens):
        if kinds[i] not in "#@" and i and kinds[i - 1] == "#" and t.lower() in units:
            kinds[i] = "~"
    for i, t in enumerate(tokens):
        if t in "€$£" and kinds[i] != "~" and i + 1 < len(tokens) and kinds[i + 1] == "#":
            kinds[i] = "~"
    return [t.lower() for t in tokens], kinds


def contaminated(docs, items, units, window=5, coverage=0.8, literals=2):
    """{(doc index, item index)} by comparing every document with every item."""
    found = set()
    cut = lambda k: [tuple(k[i:i + window]) for i in range(len(k) - window + 1)] if len(k) >= window else ([tuple(k)] if k else [])
    plain = lambda kinds: [k.lstrip("?") for k in kinds]
    named = lambda kinds: ["@" if k.startswith("?") else k for k in kinds]
    says = lambda w: sum(x not in "#~@" for x in w) >= min(literals, len(w))
    told = []
    for d, t in enumerate(docs):
        tokens, kinds = template(t, units)
        places = defaultdict(set)
        for form in (plain(kinds), named(kinds)):
            for p, w in enumerate(cut(form)):
                places[w].add(p)
        told.append((d, tokens, places))
    for n, text in enumerate(items):
        raw, marked = template(text, units)
        kinds = named(marked)  # a word that may be a name is a slot like a name
        windows = list(enumerate(cut(plain(marked))))
        telling = [(i, w) for i, w in windows if says(w)]
        windows = telling or windows
        if not windows:
            continue
        folded = cut([r if k == "@" else k for r, k in zip(raw, plain(marked))])
        others = cut(kinds)
        for d, tokens, places in told:
            hits = {i: sorted({*places.get(w, ()), *places.get(folded[i], ()), *(places.get(others[i], ()) if says(others[i]) else ())}) for i, w in windows}
            if sum(map(bool, hits.values())) < coverage * len(windows):
                continue
            along = defaultdict(list)
            for i, at in hits.items():
                for p in at:
                    along[p - i].append((i, p))
            good = set()
            for pairs in along.values():
                votes = defaultdict(lambda: defaultdict(int))
                for i, p in pairs:
                    for j in range(len(others[i])):
                        if kinds[i + j] in "#~@":
                            votes[kinds[i + j], raw[i + j]][tokens[p + j]] += 1
                chosen = {k: max((n_, v) for v, n_ in c.items())[1] for k, c in votes.items()}
                for i, p in pairs:
                    size = len(others[i])
                    if all(kinds[i + j] not in "#~@" or chosen[kinds[i + j], raw[i + j]] == tokens[p + j] for j in range(size)):
                        good.add(i)
            if len(good) >= coverage * len(windows):
                found.add((d, n))
    return found
