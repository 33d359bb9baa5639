"""Records, end to end: landing file → load → lookup → JSON record."""

import json

from pyspark.sql import functions as F

from glebe.operators import lookup as LK
from glebe.operators import registry as R
from glebe.session import scratch_path
from glebe.sources import landing

HEADER = "codigo_incra;matricula;municipio;denominacao;proprietario;pct_obtencao\n"
ROWS = (
    "TO.42-A/10;MTR1;Palmas;Ativo;Zulmira Tavares Prado 271.828.182-31;142,5\n"
    "TO.42-A/11;MTR2;Palmas;Inativo;Benício Falcão 271.828.182-31 | Iolanda Reis 161.803.398-64;50\n"
    "TO.42-A/12;MTR3;Palmas;;Quirino Alvão;-5\n"
)


def test_landing_to_json_record(spark, landing_dir):
    d, put = landing_dir
    put("TO_-_Tocantins.csv", HEADER + ROWS)
    table = scratch_path(spark, "e2e-table")
    assert R.load_directory(spark, d, table).inserted == 3
    reg = R.read_registry(spark, table)
    keys = spark.createDataFrame([("TO.42-A/10",), ("TO.42-A/12",), ("TO.42-B",), ("TO*42",)], "requested string")
    recs = LK.batch_lookup(reg, keys)
    outcome = {r.requested: r.outcome for r in recs.collect()}
    assert outcome == {"TO.42-A/10": "found", "TO.42-A/12": "found", "TO.42-B": "not_found", "TO*42": "invalid"}
    docs = {j["codigo_incra"]: j for j in (json.loads(r.json) for r in LK.record_json(recs.where(F.col("outcome") == "found")).collect())}
    assert docs["TO.42-A/10"] == {
        "codigo_incra": "TO.42-A/10", "area_ha": 142.5, "situacao": "Ativo",
        "proprietarios": [{"nome_completo": "Zulmira Tavares Prado", "cpf": "***.***.***-31",
                           "vinculo": "Proprietario", "participacao_pct": 100.0}],
    }
    # a negative source value is dropped by the loader, so the area is null and the share 100
    assert docs["TO.42-A/12"]["area_ha"] is None and docs["TO.42-A/12"]["situacao"] == "Nao informado"
    assert docs["TO.42-A/12"]["proprietarios"][0]["participacao_pct"] == 100.0
    (row,) = LK.point_lookup(reg, "TO.42-A/11").collect()
    assert row.denominacao == "Inativo" and str(row.pct_obtencao) == "50.0000"
    assert reg.where(F.col("uf") == "TO").count() == 3
