"""DuckDB text of the base relations, shared by the oracle statements.

Each oracle statement is ``WITH <ctes> <select>``; the CTEs below mirror
:mod:`glebe.plans.base` line by line.
"""

from __future__ import annotations

from glebe.functions.constants import STATE_LABELS
from glebe.plans import base as B

_VALUES = ", ".join(f"({i}, '{lbl}')" for i, lbl in enumerate(STATE_LABELS))

STATES_CTE = f"""
states_src(pos, label) AS (VALUES {_VALUES}),
states AS (SELECT pos, split_part(label, ' - ', 1) AS uf,
                  substr(label, strpos(label, ' - ') + 3) AS name, label FROM states_src)"""

BASE_CTE = (
    STATES_CTE
    + f""",
base AS (
  SELECT lpad(CAST(o.o_custkey AS VARCHAR), 11, '0') AS codigo_incra,
         concat('MTR', CAST(o.o_orderkey AS VARCHAR)) AS matricula,
         o.o_orderkey AS row_pos,
         n.n_name AS municipio,
         CASE WHEN o.o_orderstatus = 'P' THEN '' ELSE o.o_orderstatus END AS denominacao,
         concat(c.c_name, ' ',
                substr(lpad(CAST(c.c_custkey * 7919 AS VARCHAR), 11, '1'), 1, 3), '.',
                substr(lpad(CAST(c.c_custkey * 7919 AS VARCHAR), 11, '1'), 4, 3), '.',
                substr(lpad(CAST(c.c_custkey * 7919 AS VARCHAR), 11, '1'), 7, 3), '-',
                substr(lpad(CAST(c.c_custkey * 7919 AS VARCHAR), 11, '1'), 10, 2),
                CASE WHEN c.c_custkey % 3 = 0 THEN ' | ' WHEN c.c_custkey % 3 = 1 THEN ' e ' ELSE ';' END,
                n.n_name, ' e ', n.n_name) AS proprietario,
         replace(CAST(CAST(c.c_acctbal AS DECIMAL(12,2)) AS VARCHAR), '.', ',') AS pct_obtencao,
         c.c_nationkey AS uf_key,
         CAST(o.o_orderdate AS DATE) AS landed_on,
         r.r_name AS region,
         o.o_orderpriority AS priority,
         s.uf AS uf,
         concat(s.uf, '_land.csv') AS file
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN states s ON s.pos = c.c_nationkey
),
faulty AS (
  SELECT codigo_incra,
         CASE WHEN region = '{B.LONG_MATRICULA_REGION}' AND priority = '{B.LONG_MATRICULA_PRIORITY}'
              THEN concat('MTR', lpad(CAST(row_pos AS VARCHAR), 12, '0'), '-', priority)
              ELSE matricula END AS matricula,
         row_pos, municipio, denominacao, proprietario,
         CASE WHEN region = '{B.OVERFLOW_REGION}' AND priority = '{B.LONG_MATRICULA_PRIORITY}' THEN '{B.OVERFLOW_PCT}' ELSE pct_obtencao END AS pct_obtencao,
         uf_key, landed_on, region, priority,
         CASE region WHEN '{B.LOWERCASE_UF_REGION}' THEN lower(uf) WHEN '{B.LONG_UF_REGION}' THEN uf || 'X' ELSE uf END AS uf,
         concat(CASE region WHEN '{B.LOWERCASE_UF_REGION}' THEN lower(uf) WHEN '{B.LONG_UF_REGION}' THEN uf || 'X' ELSE uf END, '_land.csv') AS file
  FROM base
),
prior AS (SELECT * FROM base WHERE landed_on < DATE '{B.WAVE_CUTOFF}'),
prior_keys AS (SELECT DISTINCT codigo_incra FROM prior)"""
)

# Cleaned percentage as the loader stores it, for ASCII input of the base shape.
PCT_SQL = """CASE WHEN TRY_CAST(replace(trim(pct_obtencao), ',', '.') AS DECIMAL(12,4)) >= 0
                  THEN TRY_CAST(replace(trim(pct_obtencao), ',', '.') AS DECIMAL(12,4)) END"""

# The registry after loading base into an empty table: first row per code by (file, row_pos).
REGISTRY_CTE = (
    BASE_CTE
    + f""",
registry AS (
  SELECT DISTINCT ON (codigo_incra) codigo_incra, matricula, municipio, denominacao, proprietario,
         {PCT_SQL} AS pct_obtencao, uf
  FROM base ORDER BY codigo_incra, file, row_pos
)"""
)


def with_base(select_sql: str) -> str:
    return f"WITH {BASE_CTE}\n{select_sql}"


def with_registry(select_sql: str) -> str:
    return f"WITH {REGISTRY_CTE}\n{select_sql}"
