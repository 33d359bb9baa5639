"""Scalar and owner rules: examples of each rule and edge cases (FIXTURES §2)."""

import pytest
from pyspark.sql import functions as F

from glebe.functions import constants as C
from glebe.functions import text as T
from glebe.functions.fold import safe_filename
from glebe.functions.owners import explode_owners, owner_parts, with_owners
from glebe.operators import lookup as LK
from glebe.session import scratch_path


def owners_of(spark, text, pct):
    df = spark.createDataFrame([("k", text, pct)], "codigo_incra string, proprietario string, pct_obtencao double")
    rows = explode_owners(with_owners(df, "proprietario", "pct_obtencao"), ["codigo_incra"]).orderBy("owner_pos").collect()
    return [(r.nome_completo, r.cpf, r.vinculo, r.participacao_pct) for r in rows]


# --- examples ---------------------------------------------------------

def test_single_owner_masked(spark):
    assert owners_of(spark, "Zulmira Tavares Prado 271.828.182-31", 142.5) == [
        ("Zulmira Tavares Prado", "***.***.***-31", "Proprietario", 100.0)
    ]


def test_two_owners_pipe(spark):
    got = owners_of(spark, "Benício Falcão 271.828.182-31 | Iolanda Reis 161.803.398-64", 50.0)
    assert got == [
        ("Benício Falcão", "***.***.***-31", "Proprietario", 50.0),
        ("Iolanda Reis", "***.***.***-64", "Proprietario", 50.0),
    ]


def test_owner_without_cpf(spark):
    assert owners_of(spark, "Quirino Alvão", 100.0) == [("Quirino Alvão", "***.***.***-**", "Proprietario", 100.0)]


def test_text_after_cpf(spark):
    (o,) = owners_of(spark, "Otávio Lemos 314.159.265-58 lote 7", 100.0)
    assert o[1] == "***.***.***-58"


def test_zero_percent_each_owner(spark):
    got = owners_of(spark, "Dona Um 505.505.505-17 | Dono Dois 606.606.606-28", 0.0)
    assert [o[3] for o in got] == [0.0, 0.0] and [o[1][-2:] for o in got] == ["17", "28"]


@pytest.mark.parametrize("pct,expected", [(100.0, 100.0), (150.0, 100.0), (-3.0, 0.0), (None, 100.0), (42.5, 42.5)])
def test_participation_clamp(spark, pct, expected):
    (o,) = owners_of(spark, "Ana", pct)
    assert o[3] == expected


# --- owner edge cases -------------------------------------------------------------------

@pytest.mark.parametrize(
    "text,names",
    [
        ("A / B", ["A", "B"]),
        ("A/B", ["A/B"]),
        ("Ana e Bia E Caio", ["Ana", "Bia", "Caio"]),
        ("a;A; a ", ["a"]),
        ("   ", ["Nao informado"]),
        (";", [";"]),
        ("Ana | Ana 111.222.333-44", ["Ana", "Ana"]),
        ("Ana 111.222.333-44 | ANA 111.222.333-44", ["Ana"]),
    ],
)
def test_owner_split_and_dedupe(spark, text, names):
    assert [o[0] for o in owners_of(spark, text, 10.0)] == names


@pytest.mark.parametrize("text", [None, ""])
def test_no_owner_text_gives_empty_list(spark, text):
    assert owners_of(spark, text, 10.0) == []


def test_company_id_taken_as_cpf(spark):
    assert owners_of(spark, "27182818000155 Ltda", 1.0) == [("155 Ltda", "***.***.***-00", "Proprietario", 1.0)]


def test_owner_parts_fallback_keeps_raw(spark):
    df = spark.createDataFrame([("  ",), (" ; ",)], "v string")
    got = [r.p for r in df.select(owner_parts("v").alias("p")).collect()]
    assert got == [["  "], [" ; "]]


# --- numbers -----------------------------------------------------------------------------

@pytest.mark.parametrize(
    "text,expected",
    [
        ("100,0", "100.0000"), ("1.234,56", None), ("-5", None), ("1e3", "1000.0000"), ("null", None),
        ("NONE", None), ("", None), (None, None), ("  7,5  ", "7.5000"), ("abc", None), ("nan", None),
        ("1_000", None), ("inf", None), ("0", "0.0000"), ("12,34567", "12.3457"),
    ],
)
def test_clean_pct(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    v = df.select(T.clean_pct("t").alias("v")).first().v
    assert (str(v) if v is not None else None) == expected


@pytest.mark.parametrize(
    "text,rejects",
    [("1_000", True), ("inf", True), ("-Infinity", True), ("100000000", True), ("99999999,99", False),
     ("nan", False), ("1.234,56", False), ("abc", False), ("-5", False), ("١٢", True)],
)
def test_pct_values_the_table_refuses(spark, text, rejects):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(T.pct_rejects_file("t").alias("v")).first().v is rejects


# --- small rules --------------------------------------------------------------------------

@pytest.mark.parametrize("x,expected", [(None, "Nao informado"), ("", "Nao informado"), (" ", " "), ("Ativo", "Ativo")])
def test_status_default(spark, x, expected):
    df = spark.createDataFrame([(x,)], "x string")
    assert df.select(T.status_default("x").alias("v")).first().v == expected


@pytest.mark.parametrize(
    "name,uf",
    [("SP_-_Sao_Paulo.csv", "SP"), ("SP.csv", None), ("sp_x.csv", "sp"), ("AC_land.csv", "AC"), ("a.b_c.csv", "a.b")],
)
def test_uf_from_file_name(spark, name, uf):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(T.uf_from_file_name("n").alias("v")).first().v == uf


@pytest.mark.parametrize(
    "key,valid",
    [("TO.42-A/10", True), ("TO*42", False), ("", False), ("a" * 64, True), ("a" * 65, False),
     ("ABC\n", False), ("x./_-9", True), ("ção", False)],
)
def test_lookup_key_rule(spark, key, valid):
    df = spark.createDataFrame([(key,)], "k string")
    assert df.select(T.is_valid_lookup_key("k").alias("v")).first().v is valid


@pytest.mark.parametrize(
    "label,expected",
    [("SP - São Paulo", "SP_-_Sao_Paulo"), ("Ceará", "Ceara"), ("½ ﬁle", "1_2_file"), ("__x__", "x")],
)
def test_safe_filename_exact(spark, label, expected):
    df = spark.createDataFrame([(label,)], "l string")
    assert df.select(safe_filename("l").alias("v")).first().v == expected


def test_mask_free_text(spark):
    df = spark.createDataFrame([("cpf 271.828.182-31 e 16180339864 fim",)], "t string")
    assert df.select(T.mask_cpfs_in_text("t").alias("v")).first().v == "cpf ***.***.***-31 e ***.***.***-64 fim"


def test_unicode_digits_like_python(spark):
    df = spark.createDataFrame([("a١٢3",)], "t string")
    assert df.select(T.digits_only("t").alias("v")).first().v == "١٢3"


# --- record shape and contract ---------------------------------------------------------------

def test_record_json_keeps_null_area(spark):
    df = spark.createDataFrame([("K1", None, None, "Ana")], "codigo_incra string, pct_obtencao decimal(12,4), denominacao string, proprietario string")
    j = LK.record_json(LK.shape_record(df)).first().json
    assert '"area_ha":null' in j and '"situacao":"Nao informado"' in j


def test_contract_holds(spark):
    df = spark.createDataFrame(
        [("K1", 50.0, "Ativo", "Ana 111.222.333-44 | Bia"), ("K2", None, "", None)],
        "codigo_incra string, pct_obtencao double, denominacao string, proprietario string",
    )
    row = LK.contract_violations(LK.shape_record(df)).first().asDict()
    assert row.pop("records") == 2 and set(row.values()) == {0}


def test_status_passthrough(spark):
    df = spark.createDataFrame(
        [("K1", 1.0, s, "Ana") for s in ["Ativo", "Inativo", "Em Processo"]],
        "codigo_incra string, pct_obtencao double, denominacao string, proprietario string",
    )
    assert sorted(r.situacao for r in LK.shape_record(df).collect()) == ["Ativo", "Em Processo", "Inativo"]


def test_batch_lookup_outcomes(spark):
    reg = spark.createDataFrame(
        [("TO.42-A/10", 142.5, "Ativo", "Maria 271.828.182-31")],
        "codigo_incra string, pct_obtencao double, denominacao string, proprietario string",
    )
    keys = spark.createDataFrame([("TO.42-A/10",), ("TO.42-B",), ("TO*42",)], "requested string")
    got = {r.requested: (r.outcome, r.area_ha) for r in LK.batch_lookup(reg, keys).collect()}
    assert got == {"TO.42-A/10": ("found", 142.5), "TO.42-B": ("not_found", None), "TO*42": ("invalid", None)}


def test_point_lookup_pushes_key_filter(spark):
    reg = spark.createDataFrame([(f"K{i:05d}", "x", "", "") for i in range(100)], "codigo_incra string, a string, denominacao string, proprietario string")
    reg = reg.withColumn("pct_obtencao", F.lit(1.0))
    path = scratch_path(spark, "test-point")
    reg.write.parquet(path)
    plan = LK.point_lookup(spark.read.parquet(path), "K00042")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(codigo_incra), EqualTo(codigo_incra,K00042)]" in plan
    assert C.KEY in plan


def test_export_json_and_plan_report(spark):
    import json

    from glebe.operators import inspect
    from glebe.operators import registry as R

    reg = spark.createDataFrame(
        [(f"K{i:04d}", "M", "C", "Ativo" if i % 2 else "", f"Dono {i} 314.159.265-{i % 100:02d}", None, "SP") for i in range(200)],
        "codigo_incra string, matricula string, municipio string, denominacao string, proprietario string, "
        "pct_obtencao decimal(12,4), uf string",
    )
    path = scratch_path(spark, "test-layout")
    R.write_layout(reg, path, reg.count())
    table = spark.read.parquet(path)
    out = scratch_path(spark, "test-json")
    LK.export_json(LK.shape_record(table), out)
    docs = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert len(docs) == 200 and all(d["area_ha"] is None for d in docs)
    assert {d["situacao"] for d in docs} == {"Ativo", "Nao informado"}
    report = inspect.timed_report(LK.point_lookup(table, "K0042"))
    assert report["rows"] == 1 and report["within_sla"]
    assert any("EqualTo(codigo_incra,K0042)" in f for f in report["pushed_filters"])
    assert report["read_schema"] and "matricula" not in report["read_schema"][0]


@pytest.mark.parametrize("raw", ["\u00a0 x\u3000", "\x1cx\x1f", "\tx\n", " x ", "x", "\u2028x\u0085"])
def test_py_strip_matches_python(spark, raw):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(T.py_strip("t").alias("v")).first().v == raw.strip()


def test_point_lookup_with_state_prunes_partitions(spark):
    from glebe.operators import inspect
    from glebe.operators import registry as R

    reg = spark.createDataFrame(
        [(f"K{i:03d}", "M", "C", "", "Ana", None, uf) for i, uf in enumerate(["AC", "AL", "SP"] * 10)],
        "codigo_incra string, matricula string, municipio string, denominacao string, proprietario string, "
        "pct_obtencao decimal(12,4), uf string",
    )
    path = scratch_path(spark, "test-pruned")
    R.write_layout(reg, path, reg.count())
    q = LK.point_lookup(spark.read.parquet(path), "K002", uf="SP")
    facts = inspect.plan_facts(q)
    assert any("uf" in f and "SP" in f for f in facts["partition_filters"])
    assert any("EqualTo(codigo_incra,K002)" in f for f in facts["pushed_filters"])
    assert [r.codigo_incra for r in q.collect()] == ["K002"]
