"""Load properties on driver data and stream = batch (layer e)."""

from pyspark.sql import functions as F

from glebe.functions import constants as C
from glebe.operators import load as L
from glebe.operators import registry as R
from glebe.plans import base as B
from glebe.plans import inputs as I
from glebe.session import scratch_path
from glebe.sources import landing
from glebe.streaming import ingest

from conftest import SF_SMALL


def test_run_twice_equals_once_and_counts_balance(spark):
    stg = B.staging_from_base(B.base(spark, SF_SMALL))
    table = scratch_path(spark, "prop-table")
    prior = B.staging_from_base(B.prior_wave(B.base(spark, SF_SMALL)))
    r0 = R.run_load(spark, prior, table)
    before = R.read_registry(spark, table).count()
    r1 = R.run_load(spark, stg, table)
    after = R.read_registry(spark, table).count()
    r2 = R.run_load(spark, stg, table)
    assert r0.inserted == before and r2.inserted == 0
    summ = r1.summary.where(F.col("status") == "loaded").collect()
    assert sum(r.novos for r in summ) == after - before == r1.inserted
    assert all(r.novos + r.ja_existiam == r.codigos_unicos for r in summ)
    once = L.insert_only(stg, None).count()
    assert after == once == stg.select(C.KEY).distinct().count()
    dup = L.duplicate_keys(R.read_registry(spark, table), [C.KEY])
    assert dup.count() == 0


def test_stream_equals_batch(spark):
    d, w1, w2 = I.land_waves(spark, SF_SMALL)
    table, ck = scratch_path(spark, "st-table"), scratch_path(spark, "st-ck")
    landing.land_csv(spark, w1, d)
    ingest.stream_insert_only(spark, d, table, ck).awaitTermination()
    landing.land_csv(spark, w2, d)
    ingest.stream_insert_only(spark, d, table, ck).awaitTermination()
    # rerun with a reset checkpoint: the table refuses every key again
    ingest.stream_insert_only(spark, d, table, scratch_path(spark, "st-ck2")).awaitTermination()
    streamed = R.read_registry(spark, table).select(*C.TABLE_COLUMNS)

    batch_table = scratch_path(spark, "bt-table")
    R.run_load(spark, landing.read_landing(spark, d).where(F.col("file").endswith("_w1.csv")), batch_table)
    R.run_load(spark, landing.read_landing(spark, d), batch_table)
    batch = R.read_registry(spark, batch_table).select(*C.TABLE_COLUMNS)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_stream_one_file_per_batch(spark, landing_dir):
    d, put = landing_dir
    header = "codigo_incra;matricula;municipio;denominacao;proprietario;pct_obtencao\n"
    put("AC_1.csv", header + "K1;A1;;;;1\nK2;A2;;;;1\n")
    table, ck = scratch_path(spark, "st1-table"), scratch_path(spark, "st1-ck")
    ingest.stream_insert_only(spark, d, table, ck, max_files=1).awaitTermination()
    put("AL_1.csv", header + "K2;B2;;;;1\nK3;B3;;;;1\n")
    put("AM_1.csv", header + "K3;C3;;;;1\n" + "K4;" + "X" * 21 + ";;;;1\n")  # refused as a whole
    ingest.stream_insert_only(spark, d, table, ck, max_files=1).awaitTermination()
    got = {r.codigo_incra: r.matricula for r in R.read_registry(spark, table).collect()}
    assert got == {"K1": "A1", "K2": "A2", "K3": "B3"}
    runs = R.read_summaries(spark, table)
    assert runs.select("run_id").distinct().count() == 3  # one micro-batch per file
    st = {r.file: r.status for r in runs.collect()}
    assert st == {"AC_1.csv": "loaded", "AL_1.csv": "loaded", "AM_1.csv": "rejected"}


def test_stream_dedupe_exact_and_within_watermark(spark, landing_dir):
    d, put = landing_dir
    header = "codigo_incra;matricula;municipio;denominacao;proprietario;pct_obtencao\n"
    put("AC_1.csv", header + "K1;A;;;;1\nK1;B;;;;1\nK2;C;;;;1\n")
    for within in [None, "1 hour"]:
        sink, ck = scratch_path(spark, "dd-sink"), scratch_path(spark, "dd-ck")
        ingest.stream_dedupe(spark, d, sink, ck, within=within).awaitTermination()
        got = sorted(r.codigo_incra for r in spark.read.parquet(sink).collect())
        assert got == ["K1", "K2"]


def test_stream_dedupe_binds_by_header_and_reports_refusals(spark, landing_dir):
    d, put = landing_dir
    put("AC_1.csv", "pct_obtencao;codigo_incra\n1;K1\n1;K2\n")
    put("AL_1.csv", "codigo_incra;matricula;municipio;denominacao;proprietario;pct_obtencao;matricula\nK2;A;;;;1;B\nK3;A;;;;1;B\n")
    put("AM_1.csv", "codigo_incra;other\nK4;1\n")
    put("AP_1.csv", 'codigo_incra\nK5\n"' + "x" * 200_000 + "\n")
    sink, ck = scratch_path(spark, "dd-sink"), scratch_path(spark, "dd-ck")
    ingest.stream_dedupe(spark, d, sink, ck).awaitTermination()
    rows = spark.read.parquet(sink).collect()
    assert sorted(r.codigo_incra for r in rows if r.refused_file is None) == ["K1", "K2", "K3"]
    assert {(r.refused_file, r.file_reason) for r in rows if r.refused_file} == {("AM_1.csv", "unknown_column"), ("AP_1.csv", "unreadable")}


def test_compaction_keeps_rows_in_one_run(spark, landing_dir):
    d, put = landing_dir
    header = "codigo_incra;matricula;municipio;denominacao;proprietario;pct_obtencao\n"
    for i, uf in enumerate(["AC", "AL", "AM"]):
        put(f"{uf}_{i}.csv", header + f"K{i};M{i};;;;1\n")
    table, ck = scratch_path(spark, "cmp-table"), scratch_path(spark, "cmp-ck")
    ingest.stream_insert_only(spark, d, table, ck, max_files=1).awaitTermination()
    before = R.read_registry(spark, table)
    assert before.select("load_run").distinct().count() == 3
    after = R.compact(spark, table, scratch_path(spark, "cmp-new"))
    assert after.select("load_run").distinct().count() == 1
    cols = ["codigo_incra", "matricula", "uf"]
    assert sorted(map(tuple, after.select(cols).collect())) == sorted(map(tuple, before.select(cols).collect()))


def test_stream_handles_any_header_layout_and_file_names(spark, landing_dir):
    d, put = landing_dir
    # seven columns (a repeated name), reversed order, a glob-like and a spaced name, a header-only file
    put("AC_[1].csv", "codigo_incra;matricula;municipio;denominacao;proprietario;pct_obtencao;matricula\n"
                      "K1;A;Rio;;Ana;1,5;B\n")
    put("AL - x.csv", "pct_obtencao;proprietario;codigo_incra\n2;Bia;K2\n")
    put("AM_empty.csv", "codigo_incra\n")
    table, ck = scratch_path(spark, "any-table"), scratch_path(spark, "any-ck")
    ingest.stream_insert_only(spark, d, table, ck).awaitTermination()
    got = {r.codigo_incra: (r.matricula, r.proprietario, str(r.pct_obtencao), r.uf) for r in R.read_registry(spark, table).collect()}
    assert got == {"K1": ("B", "Ana", "1.5000", "AC"), "K2": (None, "Bia", "2.0000", None)}
    st = {r.file: r.status for r in R.read_summaries(spark, table).collect()}
    assert st == {"AC_[1].csv": "loaded", "AL - x.csv": "loaded", "AM_empty.csv": "empty"}
