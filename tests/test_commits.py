"""The commit log, key filters, selective deletes, pruned lookups and files with broken lines."""

import csv
import io
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from glebe.functions import constants as C
from glebe.operators import commits, key_filter
from glebe.operators import inspect
from glebe.operators import lookup as LK
from glebe.operators import quality as Q
from glebe.operators import registry as R
from glebe.session import scratch_path, staged
from glebe.sources import fs, landing
from glebe.streaming import ingest

STAGING = "file string, pos long, codigo_incra string, matricula string, municipio string, denominacao string, proprietario string, pct_obtencao string, uf string"
HEADER = ";".join(C.DATA_COLUMNS) + "\n"


def staging(spark, codes, uf="AC", file=None):
    return spark.createDataFrame([(file or f"{uf}_x.csv", i, c, f"M{i}", "town", "", "Ana", "1,5", uf) for i, c in enumerate(codes)], STAGING)


def codes_of(spark, table):
    return sorted(r[0] for r in R.read_registry(spark, table).select(C.KEY).collect())


def test_one_writer_gets_the_name(spark):
    path = scratch_path(spark, "commit-name") + "/7"
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda i: fs.create_if_absent(spark, path, f"writer {i}"), range(8)))
    assert sum(got) == 1 and fs.read_small_text(spark, path) == f"writer {got.index(True)}"
    # the way of stores that cannot link: rename without overwriting
    other = scratch_path(spark, "commit-name")
    fs.write_small_text(spark, f"{other}/a", "a")
    fs.write_small_text(spark, f"{other}/b", "b")
    paths = {n: fs._fs(spark, f"{other}/{n}")[0] for n in "abc"}
    assert fs._renamed(spark, paths["a"], paths["c"]) and not fs._renamed(spark, paths["b"], paths["c"])
    assert fs.read_small_text(spark, f"{other}/c") == "a"


def test_overlapping_loads_bring_a_code_once(spark):
    table = scratch_path(spark, "overlap")
    rows = staging(spark, [f"K{i:03d}" for i in range(60)])
    more = staging(spark, [f"K{i:03d}" for i in range(40, 90)], "AL")
    loads = [R.prepare_load(spark, s, table, f"run{i}") for i, s in enumerate((rows, rows, more))]
    done = [R.finish_load(spark, load, table) for load in loads]
    assert [d.inserted for d in done] == [60, 0, 30]
    assert codes_of(spark, table) == [f"K{i:03d}" for i in range(90)]
    said = {r.run_id: (r.novos, r.ja_existiam) for r in R.read_summaries(spark, table).collect()}
    assert said == {"run0": (60, 0), "run1": (0, 60), "run2": (30, 20)}
    assert len(commits.current(spark, table).parts) == 2  # a load that brings nothing leaves no part


def test_loads_at_the_same_time(spark):
    table = scratch_path(spark, "overlap")
    waves = [staging(spark, [f"K{j:03d}" for j in range(10 * i, 10 * i + 25)], file=f"AC_{i}.csv") for i in range(3)]
    with ThreadPoolExecutor(3) as pool:
        done = list(pool.map(lambda i: R.run_load(spark, waves[i], table, f"r{i}"), range(3)))
    assert codes_of(spark, table) == [f"K{j:03d}" for j in range(45)] and sum(d.inserted for d in done) == 45


def test_a_claimed_folder_counts_only_when_a_version_lists_it(spark):
    table = scratch_path(spark, "claimed")
    R.run_load(spark, staging(spark, ["K1"]), table, "a")
    rows = staging(spark, ["K2"]).select(*C.DATA_COLUMNS[:5], F.lit(None).cast("decimal(12,4)").alias("pct_obtencao"), F.localtimestamp().alias("loaded_at"), "uf")
    part = R._write_part(spark, table, "dead", rows, 1)  # written whole, never committed
    assert codes_of(spark, table) == ["K1"]
    assert R.run_load(spark, staging(spark, ["K1", "K2"]), table, "b").inserted == 1
    assert codes_of(spark, table) == ["K1", "K2"] and part.folder not in {p.folder for p in commits.current(spark, table).parts}


def unreadable(spark, table, folder):
    """Replace the files of a part, so that whoever opens one fails."""
    for d in fs.list_dirs(spark, f"{table}/{folder}"):
        for path, _ in fs.list_files(spark, d):
            if path.endswith(".parquet"):
                fs.delete(spark, path)
                fs.write_small_text(spark, path, "not parquet")


def test_far_off_codes_open_no_old_run(spark):
    table = scratch_path(spark, "filters")
    R.run_load(spark, staging(spark, [f"B{i:04d}" for i in range(0, 2000, 2)]), table, "old")
    unreadable(spark, table, "load_run=old")
    before = commits.current(spark, table).parts
    off = staged(staging(spark, [f"C{i}" for i in range(50)]).select(C.KEY), "test")
    assert R.existing_codes(spark, table, before, off) is None  # outside the range
    between = staged(staging(spark, [f"B{i:04d}" for i in range(1, 2000, 2)]).select(C.KEY), "test")
    maybe = key_filter.possible(between, table, list(before)).count()
    assert maybe < 30  # inside the range, but hardly ever in the filter
    some = [r[0] for r in between.join(key_filter.possible(between, table, list(before)), C.KEY, "left_anti").limit(40).collect()]
    assert R.run_load(spark, staging(spark, some + ["A1", "Z1"]), table, "new").inserted == 42


def test_filters_never_miss_a_code(spark):
    table = scratch_path(spark, "filters")
    for run in range(3):
        R.run_load(spark, staging(spark, [f"K{i}" for i in range(run, 3000, 3)]), table, f"r{run}")
    parts = commits.current(spark, table).parts
    asked = staged(spark.range(6000).select(F.concat(F.lit("K"), "id").alias(C.KEY)), "test")
    got = {(r.codigo_incra, r.folder) for r in key_filter.possible(asked, table, list(parts)).collect()}
    assert {(f"K{i}", f"load_run=r{i % 3}") for i in range(3000)} <= got and len(got) < 3150
    there = R.existing_codes(spark, table, parts, asked)
    assert sorted(r[0] for r in there.collect()) == sorted(f"K{i}" for i in range(3000))
    counted = R.count_existing(spark, table, staging(spark, ["K1", "K1", "K2999", "X"], file="a").unionByName(staging(spark, ["Y"], file="b")))
    assert [(r.file, r.ja_existiam) for r in counted.collect()] == [("a", 2)]


def files_of(spark, table):
    return {r.file for r in R.file_stats(spark, table).collect()}


def test_delete_rewrites_only_states_that_hold_matches(spark):
    table = scratch_path(spark, "delete")
    both = staging(spark, ["T1", "K1"], "AC").unionByName(staging(spark, ["K2", "K3"], "AL"))
    R.run_load(spark, both, table, "a")
    R.run_load(spark, staging(spark, ["T4", "T5"], "AL").unionByName(staging(spark, ["K6"], None, file="x")), table, "b")
    old, before = R.read_registry(spark, table), files_of(spark, table)
    assert R.delete_from(spark, table, F.col(C.KEY).like("T%")) == 3
    assert codes_of(spark, table) == ["K1", "K2", "K3", "K6"]
    after = files_of(spark, table)
    assert {f for f in before if "=a/uf=AL" in f or "=b/uf=__HIVE" in f} <= after and not any("=a/uf=AC" in f for f in after)
    assert sorted(r[0] for r in old.select(C.KEY).collect()) == ["K1", "K2", "K3", "K6", "T1", "T4", "T5"]  # an older read goes on
    assert {r.load_run for r in R.read_registry(spark, table).collect()} == {"a", "b"}
    assert R.delete_from(spark, table, F.col(C.KEY).like("T%")) == 0
    assert R.run_load(spark, staging(spark, ["T1", "K1"]), table, "c").inserted == 1  # a deleted code may come again
    totals = {r.uf: r.total for r in Q.totals_by_uf(R.file_stats(spark, table)).collect()}
    assert totals == {r.uf: r.total for r in Q.count_by_uf(R.read_registry(spark, table)).collect()}


def test_catalog_follows_the_log(spark):
    table, states = scratch_path(spark, "catalog"), scratch_path(spark, "catalog-states")
    R.create_schema(spark, "log_registry", table, "log_states", states)
    R.run_load(spark, staging(spark, ["T1", "K1"]).unionByName(staging(spark, ["K6"], None, file="x")), table, "a")
    R.refresh_schema(spark, "log_registry")
    assert spark.table("log_registry").count() == 3
    R.delete_from(spark, table, F.col(C.KEY) == "T1")
    R.refresh_schema(spark, "log_registry")
    assert sorted(r[0] for r in spark.table("log_registry").select(C.KEY).collect()) == ["K1", "K6"]


def test_pruned_lookup_opens_few_files_and_finds_the_same(spark):
    table = scratch_path(spark, "pruned")
    rows = staging(spark, [f"K{i:05d}" for i in range(0, 6000, 2)])
    R.run_load(spark, rows, table, "a", rows_per_task=100)
    R.run_load(spark, staging(spark, [f"K{i:05d}" for i in range(1, 2000, 2)]), table, "b", rows_per_task=100)
    keys = spark.range(1200).select(F.format_string("K%05d", F.when(F.col("id") < 700, F.col("id")).otherwise(F.col("id") + 4000)).alias("requested"))
    keys = keys.unionByName(spark.createDataFrame([("nope*",), (None,), ("K00001",)], "requested string"))
    got = LK.pruned_lookup(spark, table, keys)
    want = LK.batch_lookup(R.read_registry(spark, table), keys)
    flat = lambda df: sorted(map(repr, LK.flatten_record(df).collect()))
    assert flat(got) == flat(want)
    facts, files = inspect.scan_facts(got, table), R.file_stats(spark, table).count()
    assert facts["rows"] == 1203 and facts["files_opened"] < files / 3 and facts["rows_scanned"] < 1400
    few = LK.pruned_lookup(spark, table, keys.limit(3))
    assert few.where("outcome = 'found'").count() == 3
    none = LK.pruned_lookup(spark, table, spark.createDataFrame([("X1",)], "requested string"), pushed_keys=0)
    assert [r.outcome for r in none.collect()] == ["not_found"]


def test_merged_ranges():
    ranges = [(f"{i:03d}", f"{i + 1:03d}") for i in range(0, 400, 3)]
    random.Random(1).shuffle(ranges)
    out = LK.merged_ranges(ranges, 10)
    assert len(out) <= 10 and all(a[1] < b[0] for a, b in zip(out, out[1:]))
    assert all(any(low <= a and b <= high for low, high in out) for a, b in ranges)
    assert LK.merged_ranges([("a", "c"), ("b", "d"), ("x", "y")]) == [("a", "d"), ("x", "y")] and LK.merged_ranges([]) == []


@pytest.mark.parametrize("size", [64, 1_000, 1 << 27])
def test_broken_lines_in_splits(spark, landing_dir, size):
    d, put = landing_dir
    r = random.Random(size)
    want = {}
    for n in range(3):
        bits = ["a", '"', ";", "\n", "\n\n", "b c", '""', "é"]
        rows = [[f"K{n}.{i}", "m", "".join(r.choice(bits) for _ in range(r.randrange(6))), "x" + "".join(r.choice(bits) for _ in range(r.randrange(40))) + "x", "Ana", "1"] for i in range(120)]
        rows = [[("y" + c + "y") if c.strip() != c or c == "" else c for c in row] for row in rows]
        text = io.StringIO()
        csv.writer(text, delimiter=";", lineterminator="\n").writerows([C.DATA_COLUMNS, *rows[:60], [], *rows[60:]])
        put(f"AC_{n}.csv", "\n" * n + text.getvalue())
        want[f"AC_{n}.csv"] = rows
    with landing.split_bytes(spark, size):
        got = landing.with_row_number(landing.read_landing(spark, d)).collect()
    for name, rows in want.items():
        mine = sorted((x for x in got if x.file == name), key=lambda x: x.row_no)
        assert [[x[c] for c in C.DATA_COLUMNS] for x in mine] == rows
        assert [x.row_no for x in mine] == list(range(1, 121))


def test_splits_share_tasks(spark, landing_dir):
    """Hundreds of splits are read by about as many tasks as shuffle partitions, whatever the input's size."""
    d, put = landing_dir
    put("AC_1.csv", HEADER + "".join(f'K{i};M;"two\n{i}";D;Ana;1\n' for i in range(3_000)))
    sc, group = spark.sparkContext, "splits-share-tasks"
    names = [f"spark.sql.files.{n}" for n in ("maxPartitionBytes", "openCostInBytes", "maxPartitionNum")]
    before = [spark.conf.get(n, None) for n in names]
    sc.setJobGroup(group, "")
    try:
        with landing.split_bytes(spark, 200):
            splits = spark.read.text(d).select("_metadata.file_block_start").distinct().count()
            got = landing.with_row_number(landing.read_landing(spark, d)).collect()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    tasks = [i.numTasks for i in map(tracker.getStageInfo, stages) if i]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert splits >= 40 * partitions and tasks and max(tasks) <= 2 * partitions
    assert sorted((x.row_no, x.codigo_incra, x.municipio) for x in got) == [(i + 1, f"K{i}", f"two\n{i}") for i in range(3_000)]
    assert [spark.conf.get(n, None) for n in names] == before


def test_stream_of_first_seen_codes(spark, landing_dir):
    d, put = landing_dir
    put("AC_1.csv", "pct_obtencao;codigo_incra\n1;K1\n1;K2\n2;K1\n")
    put("AM_1.csv", "codigo_incra;other\nK4;1\n")
    put("AP_1.csv", 'codigo_incra\nK5\n"open\n')
    sink, ck = scratch_path(spark, "seen-sink"), scratch_path(spark, "seen-ck")
    ingest.stream_first_seen(spark, d, sink, ck).awaitTermination()
    put("AL_1.csv", HEADER + 'K2;A;;;;1\nK3;"two\nlines that are longer than the table allows";;;;1\n')
    ingest.stream_first_seen(spark, d, sink, ck, max_files=1).awaitTermination()
    ingest.stream_first_seen(spark, d, sink, scratch_path(spark, "seen-ck")).awaitTermination()  # all of it again
    got = {r.codigo_incra: (r.uf, str(r.pct_obtencao)) for r in R.read_registry(spark, sink).collect()}
    assert got == {"K1": ("AC", "1.0000"), "K2": ("AC", "1.0000"), "K3": ("AL", "1.0000")} and R.read_registry(spark, sink).count() == 3
    refused = {(r.file, r.file_reason) for r in spark.read.parquet(f"{sink}/{ingest.REFUSED_DIR}").collect()}
    assert refused == {("AM_1.csv", "unknown_column"), ("AP_1.csv", "unbalanced_quote")}
