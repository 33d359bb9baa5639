"""op4's last pass over a source: two prefix sums, then the best subset of the documents around its end."""

import random
from itertools import product
from math import floor

from brute import hash52
from glebe.llm import mixing


def last_pass(docs, rest):
    """docs: (id, size) → the ids taken."""
    order = sorted((d for d in docs if d[1]), key=lambda d: (hash52(*d), d[0]))
    taken, left = [], rest
    for limit in (None, "fits"):
        wanted = left
        for d in [d for d in order if d not in taken and (limit is None or d[1] <= wanted)]:
            if d[1] > left:
                break
            taken.append(d)
            left -= d[1]
    latest = [d for d in reversed(order) if d in taken]
    nearest = sorted((d for d in order if d not in taken), key=lambda d: (abs(d[1] - left), order.index(d)))
    by_turn = sorted([(n, 0, d) for n, d in enumerate(latest)] + [(n, 1, d) for n, d in enumerate(nearest)])[:mixing.POOL]
    latest, nearest = [d for _, k, d in by_turn if k == 0], [d for _, k, d in by_turn if k == 1]
    pool = latest + nearest
    want = left + sum(size for _, size in latest)
    ways = [(abs(sum(d[1] for d, x in zip(pool, reversed(bits)) if x) - want), n, bits) for n, bits in enumerate(product((0, 1), repeat=len(pool)))]
    best = [d for d, x in zip(pool, reversed(min(ways)[2])) if x]
    return {i for i, _ in set(taken) - set(latest) | set(best)}


def taken_of(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return docs, {x.doc_id: x for x in mixing.mix_documents(docs).collect()}


def test_last_pass_goes_on_behind_long_documents(spark):
    r = random.Random(17)
    sizes = {"a": [100] * 100 + [12_000], "b": [r.choice([0, 3, 20, 90, 400, 2_500]) for _ in range(120)], None: [r.randrange(1, 900) for _ in range(60)],
             "c": [7_000, 6_000] + [100] * 100, "d": [r.randrange(50, 900) for _ in range(10)]}
    rows = [(n, "w " * size, source) for n, (source, size) in enumerate((s, x) for s, many in sizes.items() for x in many)]
    r.shuffle(rows)
    docs, got = taken_of(spark, rows)
    for source in sizes:
        mine = [(i, got[i].size) for i, _, s in rows if s == source]
        whole, target = sum(size for _, size in mine), got[mine[0][0]].target
        passes = floor(target / whole)
        want = last_pass(mine, target - passes * whole)
        assert {i: got[i].copies for i, size in mine if size} == {i: passes + (i in want) for i, size in mine if size}
        assert all(0 <= got[i].position <= 1 for i, _ in mine if got[i].copies)
        assert abs(sum(got[i].taken for i, _ in mine) - target) <= 0.01 * target, source
    assert mixing.curriculum(docs).count() == sum(x.copies for x in got.values())


def test_small_sources_come_near_their_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = mixing.mix_documents(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg({"taken": "sum", "target": "first"}).collect()
    assert len(rows) >= 20 and all(abs(r["sum(taken)"] - r["first(target)"]) < 0.02 * r["first(target)"] for r in rows)
