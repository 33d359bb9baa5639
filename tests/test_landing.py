"""Landing files → staging → insert-only load."""

import pytest
from pyspark.sql import functions as F

from glebe.operators import load as L
from glebe.operators import registry as R
from glebe.session import scratch_path, staged
from glebe.sources import landing

HEADER = "codigo_incra;matricula;municipio;denominacao;proprietario;pct_obtencao\n"


def rows_by_code(df):
    return {r.codigo_incra: r.asDict() for r in df.collect()}


def test_reference_idempotent_one_row_twice(spark, landing_dir):
    d, put = landing_dir
    put("SP_again.csv", HEADER + "AGAIN.1;M-7;Vila Alta;Ativo;Rosa Prado 271.828.182-31;100,0\n")
    table = scratch_path(spark, "test-table")
    first = R.run_load(spark, landing.read_landing(spark, d), table)
    second = R.run_load(spark, landing.read_landing(spark, d), table)
    reg = R.read_registry(spark, table)
    assert (first.inserted, second.inserted) == (1, 0)
    assert reg.where(F.col("codigo_incra") == "AGAIN.1").count() == 1
    row = reg.first()
    assert (row.uf, str(row.pct_obtencao), row.matricula) == ("SP", "100.0000", "M-7")


def test_empty_cells_short_rows_quotes_and_bom(spark, landing_dir):
    d, put = landing_dir
    put(
        "AC_a.csv",
        "﻿" + HEADER
        + 'K1;;Rio;"";"Ana; Bia";1,5\n'  # unquoted and quoted empties are ''
        + "K2;M2\n"  # short row: missing trailing cells are NULL
        + '\n'  # blank line skipped
        + 'K3;"M\n3";X;Y;"say ""hi""";2\n',  # embedded newline and doubled quotes
    )
    got = rows_by_code(landing.read_landing(spark, d))
    assert got["K1"]["matricula"] == "" and got["K1"]["denominacao"] == "" and got["K1"]["proprietario"] == "Ana; Bia"
    assert got["K2"]["matricula"] == "M2" and got["K2"]["municipio"] is None and got["K2"]["pct_obtencao"] is None
    assert got["K3"]["matricula"] == "M\n3" and got["K3"]["proprietario"] == 'say "hi"'
    assert {r["uf"] for r in got.values()} == {"AC"}


def test_header_bound_by_name_and_missing_columns(spark, landing_dir):
    d, put = landing_dir
    put("AC_1.csv", "pct_obtencao;proprietario;codigo_incra\n3,5;Ana;K1\n")
    put("AL_1.csv", HEADER + "K2;M;C;D;Bia;1\n")
    got = rows_by_code(landing.read_landing(spark, d))
    assert got["K1"]["pct_obtencao"] == "3,5" and got["K1"]["proprietario"] == "Ana" and got["K1"]["matricula"] is None
    assert got["K2"]["municipio"] == "C"


def test_file_order_decides_winner_and_summary(spark, landing_dir):
    d, put = landing_dir
    put("AL_x.csv", HEADER + "K1;AL1;;;;1\nK2;AL2;;;;1\n")
    put("AC_x.csv", HEADER + "K1;AC1;;;;1\nK1;AC1b;;;;1\n")
    table = scratch_path(spark, "test-table")
    res = R.run_load(spark, landing.read_landing(spark, d), table)
    reg = rows_by_code(R.read_registry(spark, table))
    assert reg["K1"]["matricula"] == "AC1" and reg["K1"]["uf"] == "AC"
    s = {r.file: r for r in res.summary.collect()}
    assert (s["AC_x.csv"].linhas_csv, s["AC_x.csv"].codigos_unicos, s["AC_x.csv"].novos) == (2, 1, 1)
    assert (s["AL_x.csv"].codigos_unicos, s["AL_x.csv"].novos, s["AL_x.csv"].ja_existiam) == (2, 1, 1)
    for r in s.values():
        assert r.novos + r.ja_existiam == r.codigos_unicos


def test_whole_file_rejections(spark, landing_dir):
    d, put = landing_dir
    put("AC_ok.csv", HEADER + "K1;M;;;;1\n")
    put("AL_long.csv", HEADER + "K2;M;;;;1\nK3;" + "M" * 21 + ";;;;1\n")
    put("sp_x.csv", HEADER + "K4;M;;;;1\n")
    put("AM_col.csv", "codigo_incra;extra\nK5;1\n")
    put("AP_uf.csv", "codigo_incra;uf\nK6;AP\n")
    put("BA_wide.csv", "codigo_incra;matricula\nK7;M;surplus\nK8;M\n")
    put("CE_big.csv", HEADER + "K9;M;;;;1_000\n")
    put("DF_nokey.csv", "matricula\nM\n")
    put("ES_empty.csv", HEADER)
    table = scratch_path(spark, "test-table")
    res = R.run_load(spark, landing.read_landing(spark, d), table)
    st = {r.file: (r.status, r.reason) for r in res.summary.collect()}
    assert st["AC_ok.csv"] == ("loaded", None)
    assert st["AL_long.csv"] == ("rejected", "matricula_too_long")
    assert st["sp_x.csv"] == ("rejected", "unknown_uf")
    assert st["AM_col.csv"] == ("rejected", "unknown_column")
    assert st["AP_uf.csv"] == ("rejected", "uf_in_header")
    assert st["BA_wide.csv"] == ("rejected", "surplus_cells_first_row")
    assert st["CE_big.csv"] == ("rejected", "pct_not_storable")
    assert st["DF_nokey.csv"] == ("rejected", "null_key")
    assert "ES_empty.csv" not in st
    assert sorted(r.codigo_incra for r in R.read_registry(spark, table).collect()) == ["K1"]


def test_null_uf_allowed_and_surplus_after_first_row_ok(spark, landing_dir):
    d, put = landing_dir
    put("SP.csv", "codigo_incra;matricula\nK1;M\nK2;M;extra\n")
    table = scratch_path(spark, "test-table")
    R.run_load(spark, landing.read_landing(spark, d), table)
    got = rows_by_code(R.read_registry(spark, table))
    assert set(got) == {"K1", "K2"} and got["K1"]["uf"] is None


def test_manifest_and_line_counts(spark, landing_dir):
    d, put = landing_dir
    put("AC_a.csv", HEADER + "K1;M;;;;1\n" + 'K2;"a\nb";;;;1\n')
    put("AL_a.csv", HEADER)
    put("AM_a.csv", "")
    expected = spark.createDataFrame([(f,) for f in ["AC_a.csv", "AL_a.csv", "AM_a.csv", "AP_a.csv"]], "file string")
    present = {r.file: r.present for r in landing.file_manifest(spark, d, expected).collect()}
    assert present == {"AC_a.csv": True, "AL_a.csv": True, "AM_a.csv": False, "AP_a.csv": False}
    counts = {r.file: r.records for r in landing.file_line_counts(spark, d).collect()}
    assert counts == {"AC_a.csv": 3, "AL_a.csv": 0, "AM_a.csv": 0}


def test_first_row_per_key_plan_is_partial_aggregate(spark):
    df = spark.createDataFrame([("f", i, "K", "x") for i in range(10)], "file string, pos long, codigo_incra string, v string")
    plan = L.first_per_key(df)._jdf.queryExecution().executedPlan().toString()
    # a partial aggregate runs before the exchange: hot keys shrink map-side
    assert plan.count("Aggregate") >= 2 and "Exchange" in plan
    assert L.first_per_key(df).first().pos == 0


def _keyed(spark, rows):
    return staged(spark.createDataFrame(rows, "file string, pos long, codigo_incra string, v string"), "test-keyed")


@pytest.mark.parametrize("max_keys", [L.MOST_REPEATED, 0])
def test_first_rows_of_keys_that_mostly_occur_once(spark, max_keys):
    lone = [("a", i, f"K{i}", f"a{i}") for i in range(3000)]
    again = [("b", i, f"K{i}", "later") for i in range(0, 3000, 7)] + [("a", 9000 + i, "HOT", str(i)) for i in range(300)]
    nulls = [("c", 1, None, "second"), ("b", 5000, None, "first")]
    df = _keyed(spark, lone + again + nulls)
    got = L.first_rows(df, max_keys=max_keys)
    assert got.columns == df.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, L.first_per_key(df).select(*got.columns).collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("Union" in plan) == (max_keys > 0)  # the rows of lone keys go past the exchange


def test_first_rows_where_keys_are_unique_or_all_repeat(spark):
    unique = _keyed(spark, [("a", i, f"K{i}", "x") for i in range(50)])
    assert "Exchange" not in L.first_rows(unique)._jdf.queryExecution().executedPlan().toString()
    assert L.first_rows(unique).count() == 50
    twice = _keyed(spark, [(f, i, f"K{i}", f) for i in range(50) for f in "ab"])
    assert {r.v for r in L.first_rows(twice).collect()} == {"a"} and L.first_rows(twice).count() == 50
    assert L.first_rows(twice.limit(0)).count() == 0


def test_files_are_read_in_splits_and_keep_row_order(spark, landing_dir):
    d, put = landing_dir
    body = "".join(f"K{i % 50};M{i};;;;1\n" for i in range(4000))
    put("AC_big.csv", HEADER + body)
    put("AL_break.csv", HEADER + 'Q1;"two\nlines";;;;1\n' + "".join(f"Q{i};M{i};;;;1\n" for i in range(2, 900)))
    whole = sorted((r.file, r.matricula) for r in landing.read_landing(spark, d).collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        stg = landing.read_landing(spark, d)
        assert stg.rdd.getNumPartitions() > 8
        firsts = {r.codigo_incra: r.matricula for r in L.first_per_key(L.typed(stg).drop("reason")).collect()}
        rows = landing.with_row_number(stg).select("file", "row_no", "matricula").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.file, r.matricula) for r in rows) == whole
    assert {k: v for k, v in firsts.items() if k[0] == "K"} == {f"K{i}": f"M{i}" for i in range(50)}
    assert firsts["Q1"] == "two\nlines"
    assert [r.matricula for r in sorted(rows) if r.file == "AC_big.csv"] == [f"M{i}" for i in range(4000)]
    assert [r.row_no for r in sorted(rows) if r.file == "AC_big.csv"] == list(range(1, 4001))


def put_bytes(spark, path, content):
    from glebe.sources import fs

    fs.write_small_file(spark, path, content)


def test_every_file_is_loaded_or_refused_with_a_reason(spark, landing_dir):
    d, put = landing_dir
    put("SP_a.csv", HEADER + "K1;M;;;;1\n")
    put("AC_cr.csv", HEADER.replace("\n", "\r") + "K2;M;;;;1\rK3;M;;;;1\r")
    put("AL_crlf.csv", HEADER.replace("\n", "\r\n") + "K4;M;;;;1\r\n")
    put_bytes(spark, f"{d}/AM_latin1.csv", HEADER.encode() + "K5;São João;;;José;1\n".encode("latin-1"))
    put_bytes(spark, f"{d}/AM_latin1_header.csv", "codigo_incra;município\nK5;1\n".encode("latin-1"))
    put("AP_quote.csv", HEADER + 'K6;"M;;;;1\n' + "K7;M;;;;1\n" * 5)
    put("BA_open.csv", HEADER + 'K8;"' + "x" * 200_000)
    put("CE_long.csv", HEADER + 'K9;M\nK10;"' + "x" * 1_000_000 + '"\n')
    put("DF_stray.csv", HEADER + 'K11;5" pipe;;;;1\n')
    put("ES_blank.csv", HEADER + "\n" * 300_000 + "K12;M;;;;1\n")
    put("_GO_hidden.csv", HEADER + "K13;M;;;;1\n")
    table = scratch_path(spark, "test-table")
    res = R.load_directory(spark, d, table)
    st = {r.file: (r.status, r.reason) for r in res.summary.collect()}
    assert st == {
        "SP_a.csv": ("loaded", None), "AC_cr.csv": ("loaded", None), "AL_crlf.csv": ("loaded", None),
        "AM_latin1.csv": ("rejected", "invalid_utf8"), "AM_latin1_header.csv": ("rejected", "invalid_utf8"),
        "AP_quote.csv": ("rejected", "unbalanced_quote"), "BA_open.csv": ("rejected", "unreadable"),
        "CE_long.csv": ("rejected", "field_too_long"), "DF_stray.csv": ("loaded", None), "ES_blank.csv": ("loaded", None),
        "_GO_hidden.csv": ("rejected", "unlisted_name"),
    }
    got = rows_by_code(R.read_registry(spark, table))
    assert sorted(got) == ["K1", "K11", "K12", "K2", "K3", "K4"] and got["K11"]["matricula"] == '5" pipe'
    counts = {r.file: r.records for r in landing.file_line_counts(spark, d).collect()}
    assert counts["AM_latin1.csv"] == -1 and counts["AC_cr.csv"] == 2


def test_load_directory_reports_empty_files_and_delete_rewrites(spark, landing_dir):
    d, put = landing_dir
    put("AC_a.csv", HEADER + "TESTE_1;M;;;;1\nK2;M;;;;1\nTESTEX1;M;;;;1\n")
    put("AL_a.csv", HEADER)
    table = scratch_path(spark, "test-table")
    res = R.load_directory(spark, d, table)
    st = {r.file: r.status for r in res.summary.collect()}
    assert st == {"AC_a.csv": "loaded", "AL_a.csv": "empty"}
    newer = R.delete_rows(spark, table, F.col("codigo_incra").like("TESTE_%"), scratch_path(spark, "test-table-v2"))
    # LIKE's "_" matches any one character, so TESTEX1 goes too
    assert sorted(r.codigo_incra for r in newer.collect()) == ["K2"]
    assert R.read_registry(spark, table).count() == 3


def test_catalog_tables_are_created_once_and_show_new_runs(spark, landing_dir):
    d, put = landing_dir
    put("AC_a.csv", HEADER + "".join(f"K{i};M{i};;;;1\n" for i in range(40)))
    tag = scratch_path(spark, "x").rsplit("-", 1)[-1]
    reg, states = f"reg_{tag}", f"states_{tag}"
    location, states_location = scratch_path(spark, "catalog"), scratch_path(spark, "catalog-states")
    R.create_schema(spark, reg, location, states, states_location)
    R.create_schema(spark, reg, location, states, states_location)  # IF NOT EXISTS, and seeded once
    assert spark.table(states).count() == 27 and L.duplicate_state_names(spark.table(states)).count() == 0
    assert spark.table(reg).count() == 0
    R.load_directory(spark, d, location)
    R.refresh_schema(spark, reg)
    assert spark.table(reg).count() == 40 and set(r.uf for r in spark.table(reg).select("uf").distinct().collect()) == {"AC"}
    assert R.read_registry(spark, location).select("loaded_at").where("loaded_at is null").count() == 0


def formatted(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_lookups_reach_the_scan(spark, landing_dir):
    from glebe.operators import lookup as LK

    d, put = landing_dir
    put("AC_a.csv", HEADER + "".join(f"K{i:03d};M{i};C{i % 5};;Ana;1\n" for i in range(200)))
    table = scratch_path(spark, "test-table")
    R.load_directory(spark, d, table)
    reg = R.read_registry(spark, table)
    assert "EqualTo(codigo_incra,K007)" in formatted(LK.point_lookup(reg, "K007"))
    pruned = formatted(LK.point_lookup(reg, "K007", uf="AC"))
    assert "PartitionFilters: [isnotnull(uf" in pruned
    few = LK.batch_lookup(reg, spark.createDataFrame([("K001",), ("K002",), ("nope*",)], "requested string"))
    assert "In(codigo_incra, [" in formatted(few)
    assert sorted(r.outcome for r in few.collect()) == ["found", "found", "invalid"]
    many = LK.batch_lookup(reg, spark.range(5000).selectExpr("format_string('K%03d', id) as requested"))
    assert "GreaterThanOrEqual(codigo_incra,K000), LessThanOrEqual(codigo_incra,K999)" in formatted(many)
    assert many.where("outcome = 'found'").count() == 200
    index = R.write_index(reg, scratch_path(spark, "test-index"), "municipio")
    found = LK.lookup_by(index, "municipio", "C3")
    assert "EqualTo(municipio,C3)" in formatted(found) and found.count() == 40
    owners = LK.lookup_by(R.write_index(reg, scratch_path(spark, "test-index"), "proprietario"), "proprietario", "Ana")
    assert "EqualTo(proprietario,Ana)" in formatted(owners) and owners.count() == 200


def test_registry_schema_fixed_and_obsolete_column_ignored(spark, landing_dir):
    d, put = landing_dir
    put("AC_a.csv", HEADER + "K1;M;;;;1\n")
    table = scratch_path(spark, "test-table")
    R.load_directory(spark, d, table)
    # an older run that still carried a dropped column
    old = spark.createDataFrame([("K9", "M", "", "", "", None, None, "AL", "old.csv")],
                                "codigo_incra string, matricula string, municipio string, denominacao string, "
                                "proprietario string, pct_obtencao decimal(12,4), loaded_at timestamp_ntz, uf string, "
                                "source_file string")
    old.write.partitionBy("uf").parquet(f"{table}/load_run=old")
    reg = R.read_registry(spark, table)
    assert "source_file" not in reg.columns
    assert sorted(r.codigo_incra for r in reg.collect()) == ["K1", "K9"]
    assert dict(reg.dtypes)["pct_obtencao"] == "decimal(12,4)"


def test_load_directory_without_files(spark, landing_dir):
    d, _ = landing_dir
    table = scratch_path(spark, "test-table")
    res = R.load_directory(spark, d, table)
    assert res.inserted == 0 and res.summary.count() == 0
    assert R.load_directory(spark, d + "/missing", table).inserted == 0
    assert R.read_registry(spark, table) is None


def test_land_csv_writes_parts_that_read_as_one_file_in_order(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") < 2500, F.lit("AC_big one+%.csv")).otherwise(F.lit("AL_small.csv")).alias("file"),
        F.col("id").alias("pos"),
        F.format_string("K%d", "id").alias("codigo_incra"),
        *[F.lit("x").alias(c) for c in ["matricula", "municipio", "denominacao", "proprietario", "pct_obtencao"]],
    )
    for parts in (1, 7):
        d = scratch_path(spark, "test-split")
        landing.land_csv(spark, rows, d, parts=parts)
        assert landing.list_csv(spark, d).count() >= parts
        back = landing.with_row_number(landing.read_landing(spark, d))
        ac = sorted(back.where(F.col("uf") == "AC").select("file", "row_no", "codigo_incra").collect())
        assert {r.file for r in ac} == {"AC_big one+%.csv"}
        assert [r.codigo_incra for r in ac] == [f"K{i}" for i in range(2500)] and ac[-1].row_no == 2500
        assert {r.file: r.records for r in landing.file_line_counts(spark, d).collect()} == {"AC_big one+%.csv": 2500, "AL_small.csv": 500}
        expected = spark.createDataFrame([("AC_big one+%.csv",), ("AM_x.csv",)], "file string")
        assert {r.file: r.present for r in landing.file_manifest(spark, d, expected).collect()} == {"AC_big one+%.csv": True, "AM_x.csv": False}


def test_file_names_with_spaces_percent_plus_and_brackets(spark, landing_dir):
    d, put = landing_dir
    names = ["SP - São Paulo.csv", "AC_a%20b.csv", "AL_x+y.csv", "AM_[1].csv"]
    for i, n in enumerate(names):
        put(n, HEADER + f"K{i};M{i};;;;1\n")
    got = {r.file: (r.codigo_incra, r.uf) for r in landing.read_landing(spark, d).collect()}
    assert got == {
        "SP - São Paulo.csv": ("K0", None),  # no "_" in the stem: no state (G1)
        "AC_a%20b.csv": ("K1", "AC"),
        "AL_x+y.csv": ("K2", "AL"),
        "AM_[1].csv": ("K3", "AM"),
    }
    counts = {r.file: r.records for r in landing.file_line_counts(spark, d).collect()}
    assert counts == {n: 1 for n in names}


def test_restart_after_failed_or_half_finished_runs(spark, landing_dir):
    from glebe.sources import fs as FS

    d, put = landing_dir
    put("AC_a.csv", HEADER + "K1;M1;;;;1\nK2;M2;;;;1\n")
    table = scratch_path(spark, "test-table")
    # a run whose write job died: only uncommitted task output under _temporary
    FS.mkdirs(spark, f"{table}/load_run=dead/_temporary/0/task_0")
    FS.write_small_text(spark, f"{table}/load_run=dead/_temporary/0/task_0/part-0.parquet", "not parquet")
    assert R.read_registry(spark, table).count() == 0
    # a run that published K1 but crashed before writing its summary
    crashed = spark.createDataFrame(
        [("K1", "M1", "", "", "", None, "AC")],
        "codigo_incra string, matricula string, municipio string, denominacao string, proprietario string, "
        "pct_obtencao decimal(12,4), uf string",
    ).withColumn("loaded_at", F.localtimestamp())
    R.write_layout(crashed, f"{table}/load_run=crashed", 1)
    first = R.load_directory(spark, d, table)  # the rerun adds only what is missing
    assert first.inserted == 1
    again = R.load_directory(spark, d, table)
    assert again.inserted == 0 and R.read_registry(spark, table).count() == 2
    assert L.duplicate_keys(R.read_registry(spark, table), ["codigo_incra"]).count() == 0


def test_repeated_header_name_takes_last_cell_and_header_only_unknown_is_empty(spark, landing_dir):
    d, put = landing_dir
    put("AC_dup.csv", "codigo_incra;matricula;municipio;matricula\nK1;A;Rio;B\n")
    put("AL_hdr.csv", "codigo_incra;nonsense\n")
    table = scratch_path(spark, "test-table")
    res = R.load_directory(spark, d, table)
    st = {r.file: (r.status, r.reason) for r in res.summary.collect()}
    assert st == {"AC_dup.csv": ("loaded", None), "AL_hdr.csv": ("empty", None)}
    row = R.read_registry(spark, table).first()
    assert (row.codigo_incra, row.matricula, row.municipio) == ("K1", "B", "Rio")
