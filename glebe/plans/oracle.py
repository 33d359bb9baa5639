"""DuckDB statements equal to each catalogue query (same column names and types).

They run on the driver tables as views; each restates the operator in plain SQL
(``DISTINCT ON``, ``QUALIFY``, list lambdas, ``regexp_*``). Oracles use ASCII
regex classes — the data they run on has ASCII digits and blanks only, where
Java's Unicode classes and RE2's agree.
"""

from __future__ import annotations

from glebe.functions import constants as C
from glebe.plans import base as B
from glebe.plans import inputs as I
from glebe.plans.catalog import MUNICIPIO, POINT_KEY
from glebe.plans.oracle_base import PCT_SQL, with_base, with_registry

CPF = C.CPF_PATTERN
SPLIT = "(?i)" + C.OWNER_SPLIT_PATTERN
TAB = "' -:' || chr(9)"


def _name(x: str) -> str:
    inner = f"trim(regexp_replace(regexp_replace({x}, '{CPF}', '', 'g'), '\\s*-\\s*$', ''), {TAB})"
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN 'Nao informado' ELSE coalesce(nullif({inner}, ''), 'Nao informado') END"


def _cpf(x: str) -> str:
    return f"nullif(regexp_replace(regexp_extract({x}, '{CPF}', 0), '\\D', '', 'g'), '')"


def _mask(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL AND regexp_full_match({x}, '\\d{{11}}') THEN '***.***.***-' || right({x}, 2) ELSE '***.***.***-**' END"


def _clamp(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN CAST(100.0 AS DOUBLE) WHEN {x} < 0 THEN CAST(0.0 AS DOUBLE) "
        f"WHEN {x} > 100 THEN CAST(100.0 AS DOUBLE) ELSE CAST({x} AS DOUBLE) END"
    )


# Owner parts, exploded owners (deduped, positioned) and per-record counts over the registry.
OWNERS_CTES = f""",
p AS (SELECT codigo_incra, proprietario, pct_obtencao,
             list_filter(list_transform(string_split_regex(proprietario, '{SPLIT}'), lambda x: trim(x)), lambda x: x <> '') AS parts
      FROM registry),
q AS (SELECT codigo_incra, pct_obtencao,
             CASE WHEN proprietario IS NULL OR proprietario = '' THEN CAST([] AS VARCHAR[])
                  WHEN len(parts) = 0 THEN [proprietario] ELSE parts END AS parts
      FROM p),
e AS (SELECT codigo_incra, pct_obtencao, unnest(range(len(parts))) AS i, unnest(parts) AS part FROM q),
o AS (SELECT codigo_incra, pct_obtencao, i, {_name('part')} AS nome, {_cpf('part')} AS cpf FROM e),
d AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY codigo_incra, lower(nome), coalesce(cpf, '') ORDER BY i) = 1),
ow AS (SELECT codigo_incra,
              CAST(row_number() OVER (PARTITION BY codigo_incra ORDER BY i) - 1 AS INTEGER) AS owner_pos,
              nome AS nome_completo, {_mask('cpf')} AS cpf, 'Proprietario' AS vinculo,
              {_clamp('pct_obtencao')} AS participacao_pct
       FROM d),
oc AS (SELECT r.codigo_incra, CAST(count(ow.codigo_incra) AS INTEGER) AS n_owners
       FROM registry r LEFT JOIN ow USING (codigo_incra) GROUP BY r.codigo_incra)"""

KEYS_CTES = """,
keys AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS requested FROM customer
         UNION ALL SELECT 'SUP.' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') FROM supplier
         UNION ALL SELECT c_name FROM customer),
kv AS (SELECT requested,
              coalesce(length(requested) BETWEEN 1 AND 64 AND regexp_full_match(requested, '[A-Za-z0-9./_-]+'), false) AS valid
       FROM keys),
lk AS (SELECT kv.requested,
              CASE WHEN NOT kv.valid THEN 'invalid' WHEN r.codigo_incra IS NOT NULL THEN 'found' ELSE 'not_found' END AS outcome,
              r.codigo_incra, CAST(r.pct_obtencao AS DOUBLE) AS area_ha,
              CASE WHEN r.codigo_incra IS NOT NULL THEN coalesce(nullif(r.denominacao, ''), 'Nao informado') END AS situacao
       FROM kv LEFT JOIN registry r ON kv.valid AND r.codigo_incra = kv.requested)"""

FAULT_CTES = """,
fr AS (SELECT *, CASE WHEN codigo_incra IS NULL THEN 'null_key'
                      WHEN length(matricula) > 20 THEN 'matricula_too_long'
                      WHEN length(uf) > 2 THEN 'uf_too_long'
                      WHEN TRY_CAST(replace(trim(pct_obtencao), ',', '.') AS DOUBLE) >= 1e8 THEN 'pct_not_storable'
                      WHEN uf IS NOT NULL AND uf NOT IN (SELECT uf FROM states) THEN 'unknown_uf' END AS reason
       FROM faulty),
rejected AS (SELECT file, arg_min(reason, row_pos) AS reason, count(*) AS bad_rows
             FROM fr WHERE reason IS NOT NULL GROUP BY file),
good AS (SELECT * FROM fr WHERE file NOT IN (SELECT file FROM rejected))"""

ATTEMPT_CTES = f""",
a AS (SELECT user_id AS state, ts, (event_type = '{I.SUCCESS_EVENT}' AND CASE WHEN value < 1 THEN 0 ELSE value + 72 END > 0) AS ok FROM events),
f AS (SELECT state, min(ts) FILTER (WHERE ok) AS first_ok, count(*) AS attempts FROM a GROUP BY state),
u AS (SELECT a.state, count(*) AS n, any_value(f.first_ok) AS first_ok, any_value(f.attempts) AS attempts
      FROM a JOIN f USING (state) WHERE f.first_ok IS NULL OR a.ts <= f.first_ok GROUP BY a.state),
st AS (SELECT state, attempts,
              CASE WHEN first_ok IS NOT NULL THEN n END AS success_round,
              least(coalesce(CASE WHEN first_ok IS NOT NULL THEN n END, n), {I.MAX_ROUNDS}) AS rounds_used,
              CASE WHEN (CASE WHEN first_ok IS NOT NULL THEN n END) <= {I.MAX_ROUNDS} THEN 'done' ELSE 'failed' END AS status
       FROM u)"""

GEO_CTE = """,
cg AS (SELECT c.*, n.n_name, r.r_name, s.uf, s.name, s.label
       FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
       JOIN region r ON n.n_regionkey = r.r_regionkey JOIN states s ON s.pos = n.n_nationkey)"""

STAGING = "file, row_pos AS pos, codigo_incra, matricula, municipio, denominacao, proprietario"
FIRSTS = f"""SELECT DISTINCT ON (codigo_incra) {STAGING}, {PCT_SQL} AS pct_obtencao, uf
             FROM base ORDER BY codigo_incra, file, row_pos"""


# The registry after three waves: a code's row comes from the first wave that has it.
WAVES_SELECT = f"""SELECT codigo_incra, matricula, municipio, denominacao, proprietario, pct_obtencao, uf FROM (
  SELECT DISTINCT ON (codigo_incra) codigo_incra, matricula, municipio, denominacao, proprietario, {PCT_SQL} AS pct_obtencao, uf
  FROM base ORDER BY codigo_incra, landed_on >= DATE '{B.WAVE_CUTOFF}', landed_on >= DATE '{I.SECOND_CUTOFF}', file, row_pos) x"""


def _w(ctes: str, select: str) -> str:
    """Base + registry CTEs, extra CTEs, final select."""
    return with_registry("")[:-1] + ctes + "\n" + select


SQL: dict[str, str] = {
    "csv_scan": with_base(
        "SELECT file, row_number() OVER (PARTITION BY file ORDER BY row_pos) AS row_no, codigo_incra, matricula, municipio, "
        "denominacao, proprietario, pct_obtencao, uf FROM base"
    ),
    "file_refusals": with_base(
        "SELECT DISTINCT file, 'loaded' AS status, CAST(NULL AS VARCHAR) AS reason FROM base"
        + "".join(
            f" UNION ALL SELECT '{name}', '{'rejected' if reason else 'loaded'}', {repr(reason) if reason else 'NULL'}"
            for name, (_, reason) in I.FAULTY_FILES.items()
        )
    ),
    "csv_header_binding": with_base(
        f"SELECT file, codigo_incra, CASE WHEN region = '{I.NO_MATRICULA_REGION}' THEN NULL ELSE matricula END AS matricula, "
        "municipio, denominacao, proprietario, pct_obtencao, uf FROM base"
    ),
    "csv_quoted_splits": with_base(
        """SELECT file, row_number() OVER (PARTITION BY file ORDER BY row_pos) AS row_no, codigo_incra, matricula, 'in' || chr(10) || municipio AS municipio,
       'said "' || denominacao || '";' || chr(10) || chr(10) || row_pos AS denominacao, proprietario, pct_obtencao, uf FROM base"""
    ),
    "load_overlapping": with_base(
        """SELECT (SELECT count(*) FROM prior_keys) AS first_run, count(DISTINCT codigo_incra) - (SELECT count(*) FROM prior_keys) AS second_run,
       count(DISTINCT codigo_incra) AS total_rows, count(DISTINCT codigo_incra) AS codes FROM base"""
    ),
    "registry_delete": with_base(f"{WAVES_SELECT} WHERE NOT coalesce(proprietario LIKE 'Customer#00000_1%', false)"),
    "registry_totals": with_base(
        f"""SELECT uf, count(*) AS total, CAST(0 AS BIGINT) AS null_codes, count(*) FILTER (WHERE pct_obtencao IS NULL) AS null_pct,
       count(*) FILTER (WHERE coalesce(proprietario, '') = '') AS no_owner, count(*) FILTER (WHERE coalesce(denominacao, '') = '') AS no_status
FROM ({WAVES_SELECT}) y GROUP BY uf"""
    ),
    "schema_tables": with_base(
        """SELECT v.table_name, CAST(v.position AS INTEGER) AS position, v.column_name, v.data_type,
       CASE v.table_name WHEN 'states' THEN (SELECT count(*) FROM states) ELSE (SELECT count(DISTINCT codigo_incra) FROM base) END AS table_rows
FROM (VALUES ('registry', 0, 'codigo_incra', 'string'), ('registry', 1, 'matricula', 'string'), ('registry', 2, 'municipio', 'string'),
             ('registry', 3, 'denominacao', 'string'), ('registry', 4, 'proprietario', 'string'), ('registry', 5, 'pct_obtencao', 'decimal(12,4)'),
             ('registry', 6, 'loaded_at', 'timestamp_ntz'), ('registry', 7, 'load_run', 'string'), ('registry', 8, 'uf', 'string'),
             ('states', 0, 'pos', 'int'), ('states', 1, 'uf', 'string'), ('states', 2, 'name', 'string'), ('states', 3, 'label', 'string'))
     v(table_name, position, column_name, data_type)"""
    ),
    "lookup_scan_facts": _w("", """SELECT (SELECT count(*) FROM customer WHERE c_custkey <= (SELECT max(c_custkey) // 8 FROM customer)) AS keys,
       (SELECT count(*) FROM registry WHERE CAST(codigo_incra AS BIGINT) <= (SELECT max(c_custkey) // 8 FROM customer)) AS found,
       (SELECT count(*) FROM registry) AS table_rows, true AS opens_a_minority_of_files, true AS scans_a_minority_of_rows"""),
    "uf_from_filename": with_base(
        r"""SELECT row_pos, CAST(variant AS INTEGER) AS variant, name, regexp_replace(name, '\.[^.]*$', '') AS stem,
       CASE WHEN strpos(regexp_replace(name, '\.[^.]*$', ''), '_') > 0
            THEN split_part(regexp_replace(name, '\.[^.]*$', ''), '_', 1) END AS uf
FROM (SELECT row_pos, 0 AS variant, file AS name FROM base
      UNION ALL SELECT row_pos, 1, uf || '.csv' FROM base
      UNION ALL SELECT row_pos, 2, municipio || '.csv' FROM base
      UNION ALL SELECT row_pos, 3, priority || '.csv' FROM base)"""
    ),
    "file_manifest": with_base(
        f"""SELECT uf || '_land.csv' AS file,
       (uf || '_land.csv' IN (SELECT DISTINCT file FROM base) OR uf || '_land.csv' = '{I.HEADER_ONLY_FILE}') AS present
FROM states"""
    ),
    "file_line_counts": with_base(
        f"SELECT file, count(*) AS records FROM base GROUP BY file "
        f"UNION ALL SELECT '{I.HEADER_ONLY_FILE}', CAST(0 AS BIGINT) UNION ALL SELECT '{I.ZERO_BYTE_FILE}', CAST(0 AS BIGINT)"
    ),
    "states_dim": _w(
        "",
        """SELECT s.pos, s.uf, s.name, s.label, coalesce(c.records, 0) AS records
FROM states s LEFT JOIN (SELECT uf, count(*) AS records FROM registry GROUP BY uf) c USING (uf)""",
    ),
    "insert_only_load": with_base(
        f"SELECT * FROM ({FIRSTS}) x WHERE codigo_incra NOT IN (SELECT codigo_incra FROM prior_keys)"
    ),
    "count_existing": with_base(
        """SELECT file, count(DISTINCT codigo_incra) AS ja_existiam FROM base
WHERE codigo_incra IN (SELECT codigo_incra FROM prior_keys) GROUP BY file"""
    ),
    "distinct_on_first": with_base(FIRSTS),
    "first_rows_sparse": """SELECT DISTINCT ON (code) code, l_orderkey, l_linenumber, l_returnflag
FROM (SELECT l_partkey || '-' || l_suppkey || '-' || strftime(l_shipdate, '%Y-%m-%d') AS code, * FROM lineitem)
ORDER BY code, l_orderkey, l_linenumber""",
    "load_idempotent": with_base(
        "SELECT count(DISTINCT codigo_incra) AS first_run, CAST(0 AS BIGINT) AS second_run, "
        "count(DISTINCT codigo_incra) AS total_rows FROM base"
    ),
    "load_timestamp": with_base(
        "SELECT 'first' AS load_run, count(DISTINCT codigo_incra) AS rows_loaded, count(DISTINCT codigo_incra) AS rows_stamped, "
        "CAST(1 AS BIGINT) AS stamps FROM base"
    ),
    "insert_on_conflict_skip": """SELECT s_suppkey, s_name, l_orderkey, l_linenumber FROM (
  SELECT DISTINCT ON (l.l_suppkey) l.l_suppkey AS s_suppkey, s.s_name, l.l_orderkey, l.l_linenumber
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  ORDER BY l.l_suppkey, l.l_orderkey, l.l_linenumber) f
WHERE s_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)""",
    "seed_if_empty": "SELECT * FROM customer",
    "delete_by_pattern": "SELECT * FROM customer WHERE NOT coalesce(c_name LIKE 'Customer#00000_1%', false)",
    "drop_column_if_exists": with_base(f"SELECT {STAGING}, pct_obtencao, uf FROM base"),
    "load_summary": with_base("")[:-1] + FAULT_CTES + """,
stats AS (SELECT file, count(*) AS linhas_csv, count(DISTINCT codigo_incra) AS codigos_unicos FROM good GROUP BY file),
firsts AS (SELECT DISTINCT ON (codigo_incra) codigo_incra, file FROM good ORDER BY codigo_incra, file, row_pos),
novos AS (SELECT file, count(*) AS novos FROM firsts
          WHERE codigo_incra NOT IN (SELECT codigo_incra FROM prior_keys) GROUP BY file)
SELECT s.file, s.linhas_csv, s.codigos_unicos, coalesce(n.novos, 0) AS novos,
       s.codigos_unicos - coalesce(n.novos, 0) AS ja_existiam, coalesce(n.novos, 0) AS linhas_inseridas, 'loaded' AS status
FROM stats s LEFT JOIN novos n USING (file)""",
    "run_summary": with_base("")[:-1] + FAULT_CTES + """,
manifest AS (SELECT DISTINCT file,
                    CASE WHEN file IN (SELECT file FROM rejected) THEN 'rejected' ELSE 'loaded' END AS status FROM fr)
SELECT status, count(*) AS files, CAST(NULL AS VARCHAR) AS file, CAST(NULL AS VARCHAR) AS reason FROM manifest GROUP BY status
UNION ALL SELECT 'rejected', CAST(1 AS BIGINT), file, reason FROM rejected""",
    "file_quarantine": with_base("")[:-1] + FAULT_CTES + "\nSELECT file, reason, bad_rows FROM rejected",
    "fk_violations": with_base(
        "SELECT file, row_pos AS pos, uf FROM faulty WHERE uf IS NOT NULL AND uf NOT IN (SELECT uf FROM states)"
    ),
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "duplicate_state_names": with_base("")[:-1] + GEO_CTE + """
SELECT name, count(*) AS n FROM (SELECT DISTINCT n_name AS name, c_mktsegment FROM cg) x GROUP BY name HAVING count(*) > 1""",
    "deletable_states": _w("", "SELECT pos, uf, name, label FROM states WHERE uf NOT IN (SELECT uf FROM registry WHERE uf IS NOT NULL)"),
    "count_by_uf": _w("", "SELECT uf, count(*) AS total FROM registry GROUP BY uf"),
    "count_distinct_codes": with_base("SELECT count(DISTINCT codigo_incra) AS codigos_unicos FROM base"),
    "quality_report": with_base("")[:-1] + f""",
landed AS (SELECT codigo_incra, denominacao, proprietario, {PCT_SQL} AS pct_obtencao, uf, row_pos FROM base),
fact AS (SELECT * FROM landed UNION ALL SELECT * REPLACE ('{I.DUPLICATE_STATE}' AS uf) FROM landed WHERE row_pos % {I.DUPLICATE_EVERY} = 0),
dup AS (SELECT codigo_incra FROM fact GROUP BY codigo_incra HAVING count(*) > 1)
SELECT uf, count(*) AS total,
       count(*) FILTER (WHERE codigo_incra IS NULL) AS null_codes,
       count(*) FILTER (WHERE pct_obtencao IS NULL) AS null_pct,
       count(*) FILTER (WHERE proprietario IS NULL OR proprietario = '') AS no_owner,
       count(*) FILTER (WHERE denominacao IS NULL OR denominacao = '') AS no_status,
       count(DISTINCT codigo_incra) FILTER (WHERE codigo_incra IN (SELECT codigo_incra FROM dup)) AS duplicated_codes
FROM fact GROUP BY uf""",
    "clean_pct": with_base(
        """SELECT row_pos, CAST(variant AS INTEGER) AS variant, text,
       CASE WHEN TRY_CAST(replace(trim(text), ',', '.') AS DECIMAL(12,4)) >= 0
            THEN TRY_CAST(replace(trim(text), ',', '.') AS DECIMAL(12,4)) END AS pct
FROM (SELECT row_pos, 0 AS variant, pct_obtencao AS text FROM base
      UNION ALL SELECT row_pos, 1, replace(pct_obtencao, ',', '.') FROM base
      UNION ALL SELECT row_pos, 2, ' ' || pct_obtencao || ' ' FROM base
      UNION ALL SELECT row_pos, 3, '1.' || pct_obtencao FROM base
      UNION ALL SELECT row_pos, 4, pct_obtencao || 'e1' FROM base
      UNION ALL SELECT row_pos, 5, lower(priority) FROM base)"""
    ),
    "cpf_extract": _w("", f"SELECT codigo_incra, sha256({_cpf('proprietario')}) AS cpf_sha256 FROM registry"),
    "cpf_mask": _w("", f"SELECT codigo_incra, {_mask(_cpf('proprietario'))} AS cpf FROM registry"),
    "owner_name": _w("", f"SELECT codigo_incra, {_name('proprietario')} AS nome_completo FROM registry"),
    "owners_split": _w(
        OWNERS_CTES,
        "SELECT codigo_incra, CAST(i AS INTEGER) AS part_pos, part FROM e",
    ),
    "owners_exploded": _w(OWNERS_CTES, "SELECT * FROM ow"),
    "owner_counts": _w(OWNERS_CTES, "SELECT * FROM oc"),
    "mask_documents": f"SELECT doc_id, regexp_replace(text, '{CPF}', '***.***.***-\\4', 'g') AS text FROM documents",
    "digits_only": r"SELECT conv_id, turn, regexp_replace(text, '\D', '', 'g') AS digits FROM conversations",
    "participation_clamp": f"SELECT c_custkey, {_clamp('c_acctbal')} AS participacao_pct FROM customer",
    "status_default": with_base("SELECT row_pos, coalesce(nullif(denominacao, ''), 'Nao informado') AS situacao FROM base"),
    "safe_filename": with_base("")[:-1] + GEO_CTE + """
SELECT c_custkey, trim(regexp_replace(strip_accents(label || ' ' || n_name), '[^A-Za-z0-9_-]', '_', 'g'), '_') AS file_stem FROM cg""",
    "validate_keys": _w(KEYS_CTES, "SELECT requested, valid FROM kv"),
    "lookup_outcomes": _w(KEYS_CTES, "SELECT requested, outcome FROM lk"),
    "point_lookup": _w(
        "",
        f"SELECT codigo_incra, pct_obtencao, denominacao, proprietario FROM registry WHERE codigo_incra = '{POINT_KEY}' LIMIT 1",
    ),
    "record_lookup_flat": _w(
        OWNERS_CTES + KEYS_CTES,
        "SELECT lk.*, oc.n_owners FROM lk LEFT JOIN oc USING (codigo_incra)",
    ),
    "layout_pruned_lookup": _w(KEYS_CTES, "SELECT requested, outcome, codigo_incra, area_ha, situacao FROM lk"),
    "lookup_by_municipio": _w(
        "", f"SELECT codigo_incra, pct_obtencao, denominacao, proprietario, municipio FROM registry WHERE municipio = '{MUNICIPIO}'"
    ),
    "record_json": _w(
        OWNERS_CTES + """,
ol AS (SELECT codigo_incra,
              list(struct_pack(nome_completo := nome_completo, cpf := cpf, vinculo := vinculo,
                               participacao_pct := participacao_pct) ORDER BY owner_pos) AS proprietarios
       FROM ow GROUP BY codigo_incra)""",
        """SELECT r.codigo_incra,
       CAST(to_json(struct_pack(codigo_incra := r.codigo_incra, area_ha := CAST(r.pct_obtencao AS DOUBLE),
                                situacao := coalesce(nullif(r.denominacao, ''), 'Nao informado'),
                                proprietarios := coalesce(ol.proprietarios, []))) AS VARCHAR) AS json
FROM registry r LEFT JOIN ol USING (codigo_incra)""",
    ),
    "contract_violations": _w(
        OWNERS_CTES,
        r"""SELECT (SELECT count(*) FROM registry WHERE coalesce(length(codigo_incra), 0) < 1) AS bad_code,
       (SELECT count(*) FROM registry WHERE pct_obtencao < 0) AS bad_area,
       (SELECT count(*) FROM registry WHERE length(coalesce(nullif(denominacao, ''), 'Nao informado')) < 1) AS bad_status,
       (SELECT count(*) FROM ow WHERE length(nome_completo) < 1) AS bad_owner_name,
       (SELECT count(*) FROM ow WHERE NOT regexp_full_match(cpf, '\*\*\*\.\*\*\*\.\*\*\*-(\d{2}|\*\*)')) AS bad_cpf_mask,
       (SELECT count(*) FROM ow WHERE length(vinculo) < 1) AS bad_link,
       (SELECT count(*) FROM ow WHERE NOT (participacao_pct BETWEEN 0 AND 100)) AS bad_pct,
       (SELECT count(*) FROM registry) AS records""",
    ),
    "state_selection": with_base(
        """SELECT row_pos, array_to_string(list_sort(list_distinct(list_filter(list_transform(
         string_split(' ' || lower(uf) || ' ,, ' || uf || ',' || substr(municipio, 1, 2) || ', ' || lower(substr(priority, 3, 2)), ','),
         lambda x: upper(trim(x))), lambda x: x <> ''))), ',') AS selection
FROM base"""
    ),
    "state_label_filter": with_base("")[:-1] + GEO_CTE + """,
opts AS (SELECT c_custkey AS ord,
                CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Selecione o estado' ELSE uf || ' - ' || n_name END AS text,
                CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE lower(uf) END AS value FROM cg),
sel AS (SELECT s.uf AS code FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
        JOIN states s ON s.pos = n.n_nationkey WHERE r.r_name = 'AMERICA')
SELECT ord, text, value, upper(trim(split_part(text, ' - ', 1))) AS uf FROM opts
WHERE value IS NOT NULL AND value <> '' AND text IS NOT NULL AND NOT contains(text, 'Selecione') AND text <> ''
  AND (upper(text) IN (SELECT code FROM sel) OR upper(split_part(text, ' - ', 1)) IN (SELECT code FROM sel))""",
    "numeric_selection": with_base("")[:-1] + """,
labels AS (SELECT list(label ORDER BY pos) AS arr FROM states),
ch AS (SELECT row_pos, CASE WHEN priority = '5-LOW' THEN 'abc, 0, 99'
              ELSE CAST(uf_key + 1 AS VARCHAR) || ', ' || CAST(uf_key + 3 AS VARCHAR) || ',,x, 0' END AS choice FROM base),
pk AS (SELECT row_pos, list_sort(list_distinct(list_transform(
          list_filter(list_transform(list_filter(list_transform(string_split(choice, ','), lambda x: trim(x)), lambda x: x <> ''),
                                     lambda x: TRY_CAST(x AS INTEGER)), lambda i: i IS NOT NULL AND i BETWEEN 1 AND 27),
          lambda i: upper(split_part(arr[i], ' - ', 1))))) AS codes
       FROM ch, labels)
SELECT row_pos, CASE WHEN len(codes) > 0 THEN array_to_string(codes, ',') ELSE 'ALL' END AS selection FROM pk""",
    "label_lookup_default": with_base("")[:-1] + GEO_CTE + """,
x AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN upper(substr(c_mktsegment, 1, 2)) ELSE uf END AS code FROM cg)
SELECT x.c_custkey, x.code, coalesce(s.label, x.code) AS label FROM x LEFT JOIN states s ON s.uf = x.code""",
    "tiered_match": with_base("")[:-1] + GEO_CTE + """,
opts AS (SELECT c_custkey AS ord, CASE WHEN c_acctbal < 0 THEN lower(uf) ELSE c_mktsegment END AS value,
                CASE WHEN c_mktsegment = 'BUILDING' THEN lower(uf) || ' - ' || n_name ELSE upper(label) END AS text FROM cg),
m AS (SELECT w.uf, 0 AS tier, o.ord, o.value FROM states w JOIN opts o
        ON strip_accents(upper(trim(o.value))) = strip_accents(upper(trim(w.uf)))
      UNION ALL SELECT w.uf, 1, o.ord, o.value FROM states w JOIN opts o
        ON starts_with(strip_accents(upper(trim(o.text))), strip_accents(upper(trim(w.uf))) || ' -')
      UNION ALL SELECT w.uf, 2, o.ord, o.value FROM states w JOIN opts o
        ON strip_accents(upper(trim(o.text))) = strip_accents(upper(trim(w.label))))
SELECT DISTINCT ON (uf) uf, tier, ord, value FROM m ORDER BY uf, tier, ord""",
    "candidate_match": with_base("")[:-1] + GEO_CTE + f""",
opts AS (SELECT c_custkey AS ord, CASE WHEN c_acctbal < 0 THEN lower(uf) ELSE c_mktsegment END AS value FROM cg),
w AS (SELECT uf, CASE WHEN pos % 2 = 0 THEN lower(uf) ELSE '{I.CANDIDATE_SEGMENT}' END AS opt_value FROM states),
m AS (SELECT w.uf, 0 AS tier, o.ord, o.value FROM w JOIN opts o ON o.value = w.opt_value
      UNION ALL SELECT w.uf, 1, o.ord, o.value FROM w JOIN opts o ON o.value = w.uf)
SELECT DISTINCT ON (uf) uf, tier, ord, value FROM m ORDER BY uf, tier, ord""",
    "live_state_list": with_base("")[:-1] + GEO_CTE + """,
opts AS (SELECT c_custkey AS ord,
                CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Selecione o estado' ELSE uf || ' - ' || n_name END AS text,
                CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE lower(uf) END AS value FROM cg),
live AS (SELECT ord, CASE WHEN ord % 2 = 0 THEN upper(text) ELSE text END AS text, value FROM opts)
SELECT ord, upper(trim(split_part(text, ' - ', 1))) AS uf FROM live
WHERE value IS NOT NULL AND value <> '' AND text IS NOT NULL AND NOT contains(lower(text), 'selecione') AND text <> ''""",
    "checkpoint_state": "WITH " + ATTEMPT_CTES.lstrip(",\n") + """
SELECT DISTINCT state FROM a WHERE state NOT IN (SELECT state FROM st WHERE status = 'done' AND state % 7 <> 0 AND state % 5 <> 0)""",
    "retry_status": "WITH " + ATTEMPT_CTES.lstrip(",\n") + "\nSELECT * FROM st",
    "stream_insert_only": with_base(
        f"""SELECT codigo_incra, matricula, municipio, denominacao, proprietario, pct_obtencao, uf FROM (
  SELECT DISTINCT ON (codigo_incra) codigo_incra, matricula, municipio, denominacao, proprietario,
         {PCT_SQL} AS pct_obtencao, uf
  FROM base ORDER BY codigo_incra, landed_on >= DATE '{B.WAVE_CUTOFF}', row_pos) x"""
    ),
    "stream_reset": _w("", "SELECT codigo_incra, matricula, municipio, denominacao, proprietario, pct_obtencao, uf FROM registry"),
    "stream_dedupe": with_base("SELECT DISTINCT codigo_incra FROM base"),
}
