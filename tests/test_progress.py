"""Acquisition bookkeeping and quality operators on small literal inputs."""

import datetime as dt

import pytest

from glebe.operators import progress as P
from glebe.operators import quality as Q
from glebe.session import scratch_path


@pytest.mark.parametrize(
    "text,expected",
    [(" sp, mg ,,SP", ["MG", "SP"]), ("", []), (" , ", []), ("ba", ["BA"]), ("rj,RJ , rj", ["RJ"])],
)
def test_state_list(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(P.parse_state_list("t").alias("v")).first().v == expected


@pytest.mark.parametrize(
    "choice,expected",
    [("1,2", ["AC", "AL"]), (" 27 ", ["TO"]), ("0, 28, x", None), ("", None), ("3,3, 3", ["AP"]), ("26,1", ["AC", "SP"])],
)
def test_numeric_selection(spark, choice, expected):
    df = spark.createDataFrame([(choice,)], "c string")
    assert df.select(P.parse_numeric_selection("c").alias("v")).first().v == expected


def test_option_filter_and_placeholders(spark):
    opts = spark.createDataFrame(
        [(1, "SP - São Paulo", "SP"), (2, "Selecione", "x"), (3, "MG - Minas Gerais", ""), (4, "sp", "sp"),
         (5, "RJ - Rio de Janeiro", "RJ"), (6, "", "y")],
        "ord long, text string, value string",
    )
    sel = spark.createDataFrame([("SP",), ("MG",)], "code string")
    kept = P.filter_selected_options(P.selectable_options(opts), sel)
    assert sorted(r.ord for r in kept.collect()) == [1, 4]


def test_label_default(spark):
    codes = spark.createDataFrame([("SP",), ("XX",)], "uf string")
    got = {r.uf: r.label for r in P.label_with_default(spark, codes).collect()}
    assert got == {"SP": "SP - São Paulo", "XX": "XX"}


def test_tiered_match_accents_case_and_order(spark):
    wanted = spark.createDataFrame([("SP", "SP - São Paulo"), ("PA", "PA - Pará"), ("GO", "GO - Goiás")], "uf string, label string")
    options = spark.createDataFrame(
        [
            (5, "x1", "sp - anything"),  # tier 1 for SP (prefix "SP -")
            (9, "sp", "whatever"),  # tier 0 for SP (value) wins over tier 1
            (2, "v2", "  PA - PARÁ  "),  # tier 1 for PA
            (1, "v1", "pa - para"),  # tier 1 for PA, earlier option wins
            (7, "v7", "GOIÁS"),  # no tier for GO: text is not the label
            (8, "v8", " go - goiás "),  # tier 1 for GO
        ],
        "ord long, value string, text string",
    )
    got = {r.uf: (r.tier, r.ord) for r in P.tiered_match(wanted, options).collect()}
    assert got == {"SP": (0, 9), "PA": (1, 1), "GO": (1, 8)}


def test_tiered_match_label_tier(spark):
    wanted = spark.createDataFrame([("AM", "AM - Amazonas")], "uf string, label string")
    options = spark.createDataFrame([(3, "x", "am – amazonas"), (4, "y", "AM - AMAZONAS")], "ord long, value string, text string")
    # an en dash is not " -", so option 3 matches nothing; option 4 matches by prefix (tier 1) before label (tier 2)
    assert [(r.tier, r.ord) for r in P.tiered_match(wanted, options).collect()] == [(1, 4)]


def test_retry_rounds(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [
        ("A", t, False, 0, 0.0), ("A", t + dt.timedelta(1), True, 5, 90.0),  # done in round 2
        ("B", t, True, 0, 0.0), ("B", t + dt.timedelta(1), False, 1, 1.0), ("B", t + dt.timedelta(2), False, 1, 1.0),
        ("B", t + dt.timedelta(3), True, 3, 80.0),  # an empty file counts as failure; success in round 4 > 3
        ("C", t, False, 1, 1.0),  # never succeeds
        ("D", t, True, 0, 72.0),  # a header and no record is a file
        ("E", t, True, -1, 72.0),  # records not counted
    ]
    att = spark.createDataFrame(rows, "state string, ts timestamp, success boolean, records int, size double")
    got = {r.state: (r.attempts, r.success_round, r.rounds_used, r.status) for r in P.retry_status(att, 3).collect()}
    assert got == {
        "A": (2, 2, 2, "done"), "B": (4, 4, 3, "failed"), "C": (1, None, 1, "failed"), "D": (1, 1, 1, "done"), "E": (1, 1, 1, "done"),
    }


def test_checkpoint_round_trip_and_pending(spark):
    path = scratch_path(spark, "test-ck")
    done = spark.createDataFrame([("SP - São Paulo",), ("AC - Acre",), ("AC - Acre",)], "state string")
    P.save_checkpoint(done, path)
    back = P.load_checkpoint(spark, path)
    assert [r.state for r in back.orderBy("state").collect()] == ["AC - Acre", "SP - São Paulo"]
    tasks = spark.createDataFrame([("AC - Acre",), ("AL - Alagoas",), ("SP - São Paulo",)], "state string")
    assert [r.state for r in P.pending_tasks(tasks, back).collect()] == ["AL - Alagoas"]
    assert P.load_checkpoint(spark, scratch_path(spark, "missing")).count() == 0


def test_broken_checkpoint_is_an_error_and_resume_drops_lost_files(spark, landing_dir):
    d, put = landing_dir
    put("part-0.parquet", "not parquet")
    with pytest.raises(Exception):
        P.load_checkpoint(spark, d).count()
    done = spark.createDataFrame([("AC", "AC.csv"), ("AL", "AL.csv"), ("AM", "AM.csv")], "state string, file_name string")
    path = scratch_path(spark, "test-ck")
    P.save_checkpoint(done, path)
    files = spark.createDataFrame([("AC.csv", 10), ("AL.csv", 0)], "file_name string, length long")
    new = scratch_path(spark, "test-ck")
    assert [r.state for r in P.resume(spark, path, files, new).collect()] == ["AC"]
    assert [r.state for r in P.load_checkpoint(spark, new).collect()] == ["AC"]
    assert P.resume(spark, scratch_path(spark, "none"), files, scratch_path(spark, "test-ck")).count() == 0


def test_candidate_match_is_exact(spark):
    wanted = spark.createDataFrame([("SP", "sp-1"), ("PA", "x"), ("GO", "go")], "uf string, opt_value string")
    options = spark.createDataFrame(
        [(4, "SP"), (6, "sp-1"), (3, "PA"), (2, "pa"), (1, "GO "), (9, "GO")], "ord long, value string"
    )
    got = {r.uf: (r.tier, r.ord) for r in P.candidate_match(wanted, options).collect()}
    assert got == {"SP": (0, 6), "PA": (1, 3), "GO": (1, 9)}


def test_codes_in_two_states_are_duplicates(spark):
    rows = [("K1", 1.0, "A", "X", "SP"), ("K1", 1.0, "A", "X", "MG"), ("K2", 1.0, "A", "X", "MG"), (None, 1.0, "A", "X", "MG"), (None, 1.0, "A", "X", "MG")]
    reg = spark.createDataFrame(rows, "codigo_incra string, pct_obtencao double, proprietario string, denominacao string, uf string")
    rep = {r.uf: r for r in Q.quality_report(reg).collect()}
    assert (rep["SP"].duplicated_codes, rep["MG"].duplicated_codes, rep["MG"].null_codes, rep["MG"].total) == (1, 1, 2, 4)


def test_placeholders_of_the_live_list(spark):
    opts = spark.createDataFrame([(1, "SELECIONE", "x"), (2, "selecione", "y"), (3, "AC - Acre", "AC")], "ord long, text string, value string")
    assert [r.ord for r in P.selectable_options(opts, ignore_case=True).collect()] == [3]
    assert sorted(r.ord for r in P.selectable_options(opts).collect()) == [1, 2, 3]


def test_count_by_uf_nulls_last_and_quality(spark):
    reg = spark.createDataFrame(
        [("K1", None, "Ana", "", "SP"), ("K2", 1.0, None, "X", None), ("K3", 2.0, "B", "Y", "AC"), ("K3", 2.0, "B", "Y", "AC")],
        "codigo_incra string, pct_obtencao double, proprietario string, denominacao string, uf string",
    )
    assert [r.uf for r in Q.count_by_uf(reg).collect()] == ["AC", "SP", None]
    rep = {r.uf: r.asDict() for r in Q.quality_report(reg).collect()}
    assert rep["SP"]["null_pct"] == 1 and rep["SP"]["no_status"] == 1
    assert rep[None]["no_owner"] == 1 and rep["AC"]["duplicated_codes"] == 1 and rep["AC"]["total"] == 2
    assert Q.count_distinct_codes(reg).first().codigos_unicos == 3


def test_completed_states_need_a_non_empty_output_file(spark):
    completed = spark.createDataFrame(
        [("AC - Acre", "AC_-_Acre.csv"), ("AL - Alagoas", "AL_-_Alagoas.csv"), ("AM - Amazonas", "AM_-_Amazonas.csv")],
        "state string, file_name string",
    )
    listing = spark.createDataFrame([("AC_-_Acre.csv", 120), ("AL_-_Alagoas.csv", 0)], "file_name string, length long")
    assert [r.state for r in P.valid_completed(completed, listing).collect()] == ["AC - Acre"]
