"""op9 deletes later copies as far as they reach, to their last line."""

import random

from brute import deleted_lines
from glebe.llm import line_dedup


def line(name, words):
    return " ".join(f"{name}{i}" for i in range(words))


def removed(spark, texts, least=line_dedup.MIN_WORDS):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {x.doc_id: (x.removed_lines, x.removed_runs) for x in line_dedup.deduplicated_lines(docs, least).collect()}


def test_short_closing_lines_of_a_run_go_too(spark):
    runs = [[60, 5], [20, 40, 5], [5, 60, 5, 3], [30, 19], [10, 40]]
    texts = ["\n".join([f"own {copy} {n}", *(line(f"r{n}l{i}w", w) for i, w in enumerate(run)), f"end {copy} {n}"]) for copy in "ab" for n, run in enumerate(runs)]
    got = removed(spark, texts)
    assert [got[5 + n] for n in range(5)] == [(2, 1), (3, 1), (4, 1), (0, 0), (2, 1)]
    assert all(got[n] == (0, 0) for n in range(5))


def test_runs_against_comparing_all_places(spark):
    r = random.Random(21)
    pool = [line(f"p{i}w", r.choice([1, 3, 8, 20, 45, 70])) for i in range(20)]
    texts = []
    for d in range(60):
        lines = [r.choice(pool) if r.random() < 0.5 else f"own {d} {i}" for i in range(r.randrange(10))]
        for _ in range(r.randrange(3)):
            if texts:
                other = r.choice(texts).split("\n")
                at = r.randrange(len(other))
                lines += other[at:at + r.randrange(1, 8)]
        texts.append("\n".join(lines))
    for least in (line_dedup.MIN_WORDS, 9):
        want = deleted_lines(texts, least)
        assert {d: n for d, (n, _) in removed(spark, texts, least).items()} == {d: len(want[d]) for d in range(len(texts))}
