"""op13 against plain whole numbers, and odd inputs."""

import math
import random

import numpy as np
import pytest

from glebe.llm import vector_codes as vc

ROWS = "vec_id long, embedding array<float>, label int, code int, error string, part int"


def brute(rows, parts=vc.PARTS, entries=vc.ENTRIES, rounds=vc.ROUNDS):
    """rows: (vec_id, vector, label) in order of the ids → [(vec_id, code, error, label)], codebooks."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    d = len(kept[0][1]) // parts
    cut = [[v[p * d:(p + 1) * d] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    off = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    near = lambda x, book: min(range(len(book)), key=lambda k: (off(x, book[k]), k))
    for _ in range(rounds):
        for p in range(parts):
            of = [near(c[p], books[p]) for c in cut]
            for k in range(len(books[p])):
                mine = [c[p] for c, at in zip(cut, of) if at == k]
                if mine:
                    books[p][k] = [sum(x) // len(mine) for x in zip(*mine)]
    out = []
    for (i, _, label), c in zip(kept, cut):
        code = [near(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for k in code), sum(off(c[p], books[p][k]) for p, k in enumerate(code)), label))
    return out, books


def check(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], ROWS)
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    want, books = brute(sorted(rows, key=lambda r: r[0]))
    sums = {}
    for _, _, error, label in want:
        sums[label] = sums.get(label, 0) + error
    got = vc.compress(df.repartition(3)).collect()
    import hashlib
    digest = hashlib.sha256(vc.codebooks_text(books).encode()).hexdigest()
    assert sorted((x.vec_id, x.code, x.error, x.label_error, x.codebooks_sha256) for x in got) == sorted((i, code, error, sums[label], digest) for i, code, error, label in want)


def test_against_plain_numbers(spark):
    r = random.Random(2)
    centres = [[r.uniform(-1, 1) for _ in range(24)] for _ in range(9)]
    rows = [(i, [x + r.gauss(0, 0.1) for x in r.choice(centres)], r.choice([0, 1, None])) for i in range(300)]
    rows += [(300 + i, [round(r.uniform(-2, 2)) / 2 for _ in range(24)], 5) for i in range(80)]  # ties
    rows += [(400, None, 1), (401, [None] * 24, 1), (402, [float("nan")] * 24, 1), (403, [float("-inf")] + [0.0] * 23, 1), (404, [], 1), (405, [3e4] * 24, 1), (406, [-1e9] * 24, 2)]
    r.shuffle(rows)
    check(spark, rows)


def test_few_rows(spark):
    check(spark, [(1, [0.5] * 8, None), (2, [-0.5] * 8, None), (3, [0.25] * 8, 1)])


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, [0.1] * 8, None, 1, "x", 2), (2, [0.2] * 8, 1, 1, "x", 2), (2, [0.2] * 8, 1, 1, "x", 2), (3, [0.1] * 16, 1, 1, "x", 2), (4, [3e38] * 8, 1, 1, "x", 2)], ROWS)
    got = vc.compress(df).collect()
    assert sorted(x.vec_id or -1 for x in got) == [-1, 2, 2] and {x.error for x in got} == {0}
    huge = spark.createDataFrame([(1, [0.0] * 8, 1, 1, "x", 2), *[(2 + i, [1e20] * 8, 1, 1, "x", 2) for i in range(17)], (40, [-1e20] * 8, 1, 1, "x", 2)], ROWS)
    assert max(x.error for x in vc.compress(huge).collect()) == vc.MOST_LONG
    assert vc.compress(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        vc.compress(spark.createDataFrame([(1, [0.1] * 9, 1, 1, "x", 2)], ROWS))


def test_dominated_entries_are_never_nearest_and_most_are_left_out():
    r = np.random.default_rng(3)
    book = r.integers(-4_000, 4_000, (16, 8))
    coder = vc.PartCoder(book.tolist())
    parts = np.concatenate([r.integers(-5_000, 5_000, (4_000, 8)), book, (book[:8] + book[8:]) // 2])
    index, off = coder.nearest(parts)
    index2, off2 = vc.nearest_of_all(parts, book)
    assert (index == index2).all() and (off == off2).all()
    assert coder.near.mean() < 0.5
    again = len(coder.memo)
    coder.nearest(parts)
    assert len(coder.memo) == again  # cells are remembered
