"""Query catalogue: one DataFrame-returning function per operator key.

Every function takes ``(spark, sf_dir)``, reads the driver tables (or data Spark
derives from them) in full and returns a flat DataFrame whose column names match
the oracle statement of the same key in :mod:`glebe.plans.oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glebe.functions import constants as C
from glebe.functions import text as T
from glebe.functions.fold import with_safe_filename
from glebe.functions.owners import explode_owners, owner_parts, with_owners
from glebe.operators import inspect
from glebe.operators import load as L
from glebe.operators import lookup as LK
from glebe.operators import progress as P
from glebe.operators import quality as Q
from glebe.operators import registry as R
from glebe.plans import base as B
from glebe.plans import inputs as I
from glebe.session import scratch_path, staged
from glebe.sources import landing
from glebe.sources.states import states_dim
from glebe.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
STAGING_COLUMNS = ["file", "pos", *C.DATA_COLUMNS, "uf"]
POINT_KEY = "00000000001"
MUNICIPIO = "NATION_2"


def _staging(spark, sf):
    return B.staging_from_base(B.base(spark, sf))


# --- sources ------------------------------------------------------------------------

def csv_scan(spark, sf):
    d = I.land_base(spark, sf)
    return landing.with_row_number(landing.read_landing(spark, d)).select("file", "row_no", *C.DATA_COLUMNS, "uf")


def file_refusals(spark, sf):
    table = scratch_path(spark, "refusals")
    return R.load_directory(spark, I.land_faulty(spark, sf), table).summary.select("file", "status", "reason")


def csv_header_binding(spark, sf):
    d = I.land_base(spark, sf, mixed_headers=True)
    return landing.read_landing(spark, d).select("file", *C.DATA_COLUMNS, "uf")


def csv_quoted_splits(spark, sf):
    """Files whose every row holds line breaks, read in splits of a few rows."""
    d = I.land_broken_lines(spark, sf)
    with landing.split_bytes(spark, I.SMALL_SPLIT):
        rows = staged(landing.with_row_number(landing.read_landing(spark, d)), "broken-lines")
    return rows.select("file", "row_no", *C.DATA_COLUMNS, "uf")


def uf_from_filename(spark, sf):
    b = B.base(spark, sf)
    names = F.array(
        F.col("file"),
        F.concat(F.col("uf"), F.lit(".csv")),
        F.concat(F.col("municipio"), F.lit(".csv")),
        F.concat(F.col("priority"), F.lit(".csv")),
    )
    x = b.select("row_pos", F.posexplode(names).alias("variant", "name"))
    return x.select("row_pos", "variant", "name", T.file_stem("name").alias("stem"), T.uf_from_file_name("name").alias("uf"))


def file_manifest(spark, sf):
    d = I.land_base(spark, sf, extra_files=True)
    expected = states_dim(spark).select(F.concat(F.col("uf"), F.lit("_land.csv")).alias("file"))
    return landing.file_manifest(spark, d, expected)


def file_line_counts(spark, sf):
    d = I.land_base(spark, sf, extra_files=True)
    return landing.file_line_counts(spark, d)


def states_dim_q(spark, sf):
    reg = I.registry(spark, sf)
    counts = reg.groupBy("uf").agg(F.count(F.lit(1)).alias("records"))
    return states_dim(spark).join(counts, "uf", "left").select(
        "pos", "uf", "name", "label", F.coalesce(F.col("records"), F.lit(0)).cast("long").alias("records")
    )


# --- load -----------------------------------------------------------------------------

def insert_only_load(spark, sf):
    return R.insert_only(spark, I.prior_table(spark, sf), _staging(spark, sf), B.MAX_FILES).select(*STAGING_COLUMNS)


def count_existing(spark, sf):
    return R.count_existing(spark, I.prior_table(spark, sf), _staging(spark, sf))


def distinct_on_first(spark, sf):
    t = L.typed(_staging(spark, sf)).drop("reason")
    return L.first_per_key(t).select(*STAGING_COLUMNS)


def first_rows_sparse(spark, sf):
    """First line of every (part, supplier, ship date), which few lines share."""
    lines = B.read_table(spark, sf, "lineitem")
    code = F.concat_ws("-", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyy-MM-dd"))
    keyed = lines.select(code.alias("code"), "l_orderkey", "l_linenumber", "l_returnflag")
    return L.first_rows(keyed, order=["l_orderkey", "l_linenumber"], key="code")


def load_idempotent(spark, sf):
    table = scratch_path(spark, "registry")
    stg = _staging(spark, sf)
    R.run_load(spark, stg, table, run_id="first")
    R.run_load(spark, stg, table, run_id="second")
    summaries = R.read_summaries(spark, table).select("load_run", F.col("linhas_inseridas").alias("v"))
    rows = R.read_registry(spark, table).select(F.lit("table").alias("load_run"), F.lit(1).cast("long").alias("v"))
    u = summaries.unionByName(rows)
    return u.agg(
        F.sum(F.when(F.col("load_run") == "first", F.col("v"))).cast("long").alias("first_run"),
        F.sum(F.when(F.col("load_run") == "second", F.col("v"))).cast("long").alias("second_run"),
        F.sum(F.when(F.col("load_run") == "table", F.col("v"))).cast("long").alias("total_rows"),
    )


def load_overlapping(spark, sf):
    """Two loads that both compared their codes with the empty table before either committed; the second brings all of the first's codes."""
    table = scratch_path(spark, "registry")
    first = R.prepare_load(spark, B.staging_from_base(B.prior_wave(B.base(spark, sf))), table, "first", max_files=B.MAX_FILES)
    second = R.prepare_load(spark, _staging(spark, sf), table, "second", max_files=B.MAX_FILES)
    for load in (first, second):
        R.finish_load(spark, load, table)
    rows = R.read_registry(spark, table)
    return rows.agg(
        F.count_if(F.col("load_run") == "first").alias("first_run"), F.count_if(F.col("load_run") == "second").alias("second_run"),
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct(C.KEY).alias("codes"),
    )


def registry_delete(spark, sf):
    table = I.new_table(spark, *I.three_waves(spark, sf))
    R.delete_from(spark, table, F.col("proprietario").like("Customer#00000_1%"))
    return R.read_registry(spark, table).select(*C.TABLE_COLUMNS)


def registry_totals(spark, sf):
    table = I.new_table(spark, *I.three_waves(spark, sf))
    return Q.totals_by_uf(R.file_stats(spark, table))


def schema_tables(spark, sf):
    """The catalog tables, created twice and refreshed after a load: their columns, types and rows."""
    tag = uuid.uuid4().hex[:8]
    names = {"registry": f"registry_{tag}", "states": f"states_{tag}"}
    location = scratch_path(spark, "catalog")
    states_location = scratch_path(spark, "catalog-states")
    for _ in range(2):
        R.create_schema(spark, names["registry"], location, names["states"], states_location)
    R.run_load(spark, _staging(spark, sf), location, max_files=B.MAX_FILES)
    R.refresh_schema(spark, names["registry"])
    facts = []
    for table, name in names.items():
        rows = spark.table(name)
        n = rows.count()
        facts += [(table, i, column, kind, n) for i, (column, kind) in enumerate(rows.dtypes)]
        spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame(facts, "table_name string, position int, column_name string, data_type string, table_rows long")


def load_timestamp(spark, sf):
    table = scratch_path(spark, "registry")
    R.run_load(spark, _staging(spark, sf), table, run_id="first", max_files=B.MAX_FILES)
    return R.read_registry(spark, table).groupBy("load_run").agg(
        F.count(F.lit(1)).alias("rows_loaded"), F.count("loaded_at").alias("rows_stamped"), F.count_distinct("loaded_at").alias("stamps")
    )


def insert_on_conflict_skip(spark, sf):
    li = B.read_table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), "l_orderkey", "l_linenumber")
    s = B.read_table(spark, sf, "supplier")
    rows = li.join(s.select("s_suppkey", "s_name"), "s_suppkey")
    existing = s.where(F.col("s_acctbal") >= 0).select("s_suppkey")
    got = R.insert_on_conflict_skip(rows, existing, "s_suppkey", ["l_orderkey", "l_linenumber"])
    return got.select("s_suppkey", "s_name", "l_orderkey", "l_linenumber")


def seed_if_empty(spark, sf):
    path = scratch_path(spark, "seed")
    c = B.read_table(spark, sf, "customer")
    R.seed_if_empty(spark, c, path)
    R.seed_if_empty(spark, c, path)  # second call finds rows and does nothing
    return spark.read.parquet(path)


def delete_by_pattern(spark, sf):
    c = B.read_table(spark, sf, "customer")
    return L.delete_where(c, F.col("c_name").like("Customer#00000_1%"))


def drop_column_if_exists(spark, sf):
    written = staged(_staging(spark, sf).withColumn("source_file", F.col("file")), "with-column")
    return L.drop_column_if_exists(L.drop_column_if_exists(written, "source_file"), "source_file")


def _faulty(spark, sf):
    return B.staging_from_base(B.base_with_faults(spark, sf))


def load_summary(spark, sf):
    # the load job itself, into a table that holds the prior wave
    table = scratch_path(spark, "summary")
    R.run_load(spark, B.staging_from_base(B.prior_wave(B.base(spark, sf))), table, max_files=B.MAX_FILES)
    summary = R.run_load(spark, _faulty(spark, sf), table, max_files=B.MAX_FILES).summary
    return summary.where(F.col("status") == "loaded").drop("reason", "run_id")


def run_summary(spark, sf):
    return L.run_summary(L.file_status(_faulty(spark, sf)))


def file_quarantine(spark, sf):
    return L.rejected_files(L.typed(_faulty(spark, sf)))


def fk_violations(spark, sf):
    return L.fk_violations(_faulty(spark, sf), spark).select("file", "pos", "uf")


def duplicate_keys(spark, sf):
    return L.duplicate_keys(B.read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def duplicate_state_names(spark, sf):
    # the states dimension holds no name twice; the nations of the customers' states do
    named = I.customer_geo(spark, sf).select(F.col("n_name").alias("name"), "c_mktsegment").distinct()
    return L.duplicate_state_names(named)


def deletable_states(spark, sf):
    return L.deletable_states(spark, I.registry(spark, sf)).select("pos", "uf", "name", "label")


# --- quality --------------------------------------------------------------------------------

def count_by_uf(spark, sf):
    return Q.count_by_uf(I.registry(spark, sf))


def count_distinct_codes(spark, sf):
    return Q.count_distinct_codes(_staging(spark, sf))


def quality_report(spark, sf):
    return Q.quality_report(staged(I.table_with_duplicates(spark, sf), "with-duplicates"))


# --- scalar functions -------------------------------------------------------------------------

def clean_pct(spark, sf):
    b = B.base(spark, sf)
    v = F.array(
        F.col("pct_obtencao"),
        F.replace(F.col("pct_obtencao"), F.lit(","), F.lit(".")),
        F.concat(F.lit(" "), F.col("pct_obtencao"), F.lit(" ")),
        F.concat(F.lit("1."), F.col("pct_obtencao")),
        F.concat(F.col("pct_obtencao"), F.lit("e1")),
        F.lower(F.col("priority")),
    )
    x = b.select("row_pos", F.posexplode(v).alias("variant", "text"))
    return x.select("row_pos", "variant", "text", T.clean_pct("text").alias("pct"))


def cpf_extract(spark, sf):
    # a digest for comparing results, not a protection: eleven digits can be enumerated
    r = I.registry(spark, sf)
    return r.select(C.KEY, F.sha2(T.cpf_extract("proprietario"), 256).alias("cpf_sha256"))


def cpf_mask(spark, sf):
    r = I.registry(spark, sf)
    return r.select(C.KEY, T.cpf_mask(T.cpf_extract("proprietario")).alias("cpf"))


def owner_name(spark, sf):
    r = I.registry(spark, sf)
    return r.select(C.KEY, T.owner_name("proprietario").alias("nome_completo"))


def owners_split(spark, sf):
    r = I.registry(spark, sf)
    x = r.select(C.KEY, F.posexplode_outer(owner_parts("proprietario")).alias("part_pos", "part"))
    return x.where(F.col("part_pos").isNotNull())


def _owners(spark, sf):
    return with_owners(I.registry(spark, sf), "proprietario", "pct_obtencao")


def owners_exploded(spark, sf):
    return explode_owners(_owners(spark, sf), [C.KEY])


def owner_counts(spark, sf):
    return _owners(spark, sf).select(C.KEY, F.size("proprietarios").cast("int").alias("n_owners"))


def mask_documents(spark, sf):
    d = B.read_table(spark, sf, "documents")
    return d.select("doc_id", T.mask_cpfs_in_text("text").alias("text"))


def digits_only(spark, sf):
    c = B.read_table(spark, sf, "conversations")
    return c.select("conv_id", "turn", T.digits_only("text").alias("digits"))


def participation_clamp(spark, sf):
    c = B.read_table(spark, sf, "customer")
    return c.select("c_custkey", T.participation_pct("c_acctbal").alias("participacao_pct"))


def status_default(spark, sf):
    b = B.base(spark, sf)
    return b.select("row_pos", T.status_default("denominacao").alias("situacao"))


def safe_filename_q(spark, sf):
    g = I.customer_geo(spark, sf)
    labelled = g.select("c_custkey", F.concat(F.col("label"), F.lit(" "), F.col("n_name")).alias("label"))
    return with_safe_filename(labelled, "label", "file_stem").select("c_custkey", "file_stem")


# --- lookups -----------------------------------------------------------------------------------

def validate_keys(spark, sf):
    return LK.validate_keys(I.lookup_keys(spark, sf)).select("requested", "valid")


def lookup_outcomes(spark, sf):
    return LK.batch_lookup(I.registry(spark, sf), I.lookup_keys(spark, sf)).select("requested", "outcome")


def point_lookup(spark, sf):
    return LK.point_lookup(I.registry(spark, sf), POINT_KEY)


def record_lookup_flat(spark, sf):
    recs = LK.batch_lookup(I.registry(spark, sf), I.lookup_keys(spark, sf))
    return LK.flatten_record(recs)


def layout_pruned_lookup(spark, sf):
    recs = LK.pruned_lookup(spark, I.small_file_table(spark, sf), I.lookup_keys(spark, sf), pushed_keys=0)
    return recs.select("requested", "outcome", C.KEY, "area_ha", "situacao")


def lookup_scan_facts(spark, sf):
    """What a lookup of codes that lie together touches: files opened and rows out of the scan, against the table's."""
    table = I.small_file_table(spark, sf)
    keys = I.clustered_keys(spark, sf)
    recs = LK.pruned_lookup(spark, table, keys, pushed_keys=0).where(F.col("outcome") == "found").select("requested", "area_ha")
    facts = inspect.scan_facts(recs, table)
    return R.file_stats(spark, table).agg(
        F.lit(keys.count()).cast("long").alias("keys"), F.lit(facts["rows"]).cast("long").alias("found"), F.sum("rows").cast("long").alias("table_rows"),
        (F.lit(2 * facts["files_opened"]) < F.count(F.lit(1))).alias("opens_a_minority_of_files"),
        (F.lit(2 * facts["rows_scanned"]) < F.sum("rows")).alias("scans_a_minority_of_rows"),
    )


def lookup_by_municipio(spark, sf):
    index = R.write_index(I.registry(spark, sf), scratch_path(spark, "by-municipio"), "municipio")
    return LK.lookup_by(index, "municipio", MUNICIPIO)


def record_json(spark, sf):
    recs = LK.shape_record(I.registry(spark, sf))
    return LK.record_json(recs)


def contract_violations(spark, sf):
    return LK.contract_violations(LK.shape_record(I.registry(spark, sf)))


# --- progress ------------------------------------------------------------------------------------

def state_selection(spark, sf):
    b = B.base(spark, sf)
    text = F.concat(
        F.lit(" "), F.lower("uf"), F.lit(" ,, "), F.col("uf"), F.lit(","), F.substring("municipio", 1, 2),
        F.lit(", "), F.lower(F.substring("priority", 3, 2)),
    )
    return b.select("row_pos", F.array_join(P.parse_state_list(text), ",").alias("selection"))


def state_label_filter(spark, sf):
    opts = P.selectable_options(I.portal_options(spark, sf))
    kept = P.filter_selected_options(opts, I.selected_codes(spark, sf))
    return kept.select("ord", "text", "value", T.uf_from_label("text").alias("uf"))


def numeric_selection(spark, sf):
    b = B.base(spark, sf)
    choice = F.when(F.col("priority") == "5-LOW", F.lit("abc, 0, 99")).otherwise(
        F.concat((F.col("uf_key") + 1).cast("string"), F.lit(", "), (F.col("uf_key") + 3).cast("string"), F.lit(",,x, 0"))
    )
    picks = P.parse_numeric_selection(choice)
    return b.select("row_pos", F.coalesce(F.array_join(picks, ","), F.lit("ALL")).alias("selection"))


def label_lookup_default(spark, sf):
    g = I.customer_geo(spark, sf)
    codes = g.select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, F.upper(F.substring("c_mktsegment", 1, 2))).otherwise(F.col("uf")).alias("code"),
    )
    return P.label_with_default(spark, codes, "code").select("c_custkey", "code", "label")


def tiered_match(spark, sf):
    wanted = states_dim(spark).select("uf", "label")
    return P.tiered_match(wanted, I.match_options(spark, sf))


def candidate_match(spark, sf):
    opt = F.when(F.col("pos") % 2 == 0, F.lower("uf")).otherwise(F.lit(I.CANDIDATE_SEGMENT))
    return P.candidate_match(states_dim(spark).select("uf", opt.alias("opt_value")), I.match_options(spark, sf))


def live_state_list(spark, sf):
    options = I.portal_options(spark, sf)
    shouted = options.withColumn("text", F.when(F.col("ord") % 2 == 0, F.upper("text")).otherwise(F.col("text")))
    return P.selectable_options(shouted, ignore_case=True).select("ord", T.uf_from_label("text").alias("uf"))


def checkpoint_state(spark, sf):
    """Load a saved checkpoint, drop entries whose file is missing or empty, save it again, and list what is left to do."""
    status = P.retry_status(I.attempts(spark, sf), I.MAX_ROUNDS)
    done = status.where(F.col("status") == "done").select("state", F.concat(F.col("state").cast("string"), F.lit(".csv")).alias("file_name"))
    path = scratch_path(spark, "checkpoint")
    P.save_checkpoint(done.withColumn("state", F.col("state").cast("string")), path)
    completed = P.resume(spark, path, I.output_files(spark, sf), scratch_path(spark, "checkpoint"))
    tasks = I.attempts(spark, sf).select(F.col("state").cast("string").alias("state")).distinct()
    return P.pending_tasks(tasks, completed).select(F.col("state").cast("long").alias("state"))


def retry_status(spark, sf):
    return P.retry_status(I.attempts(spark, sf), I.MAX_ROUNDS)


# --- streaming --------------------------------------------------------------------------------------

def stream_insert_only(spark, sf):
    d, w1, w2 = I.land_waves(spark, sf)
    table, ck = scratch_path(spark, "stream-table"), scratch_path(spark, "stream-ck")
    landing.land_csv(spark, w1, d)
    ingest.stream_insert_only(spark, d, table, ck).awaitTermination()
    landing.land_csv(spark, w2, d)
    ingest.stream_insert_only(spark, d, table, ck).awaitTermination()
    return R.read_registry(spark, table).select(*C.TABLE_COLUMNS)


def stream_reset(spark, sf):
    d = I.land_base(spark, sf)
    table = scratch_path(spark, "stream-table")
    for _ in range(2):  # the second stream starts over; the table refuses every code it has
        ingest.stream_insert_only(spark, d, table, scratch_path(spark, "stream-ck")).awaitTermination()
    return R.read_registry(spark, table).select(*C.TABLE_COLUMNS)


def stream_dedupe(spark, sf):
    d, w1, w2 = I.land_waves(spark, sf)
    sink, ck = scratch_path(spark, "dedupe-sink"), scratch_path(spark, "dedupe-ck")
    landing.land_csv(spark, w1, d)
    ingest.stream_first_seen(spark, d, sink, ck).awaitTermination()
    landing.land_csv(spark, w2, d, columns=list(reversed(C.DATA_COLUMNS)))  # another header, the same codes
    ingest.stream_first_seen(spark, d, sink, ck).awaitTermination()
    return R.read_registry(spark, sink).select(C.KEY)


QUERIES: dict[str, Query] = {
    "csv_scan": csv_scan,
    "file_refusals": file_refusals,
    "csv_header_binding": csv_header_binding,
    "csv_quoted_splits": csv_quoted_splits,
    "uf_from_filename": uf_from_filename,
    "file_manifest": file_manifest,
    "file_line_counts": file_line_counts,
    "states_dim": states_dim_q,
    "insert_only_load": insert_only_load,
    "count_existing": count_existing,
    "distinct_on_first": distinct_on_first,
    "first_rows_sparse": first_rows_sparse,
    "load_idempotent": load_idempotent,
    "load_overlapping": load_overlapping,
    "load_timestamp": load_timestamp,
    "insert_on_conflict_skip": insert_on_conflict_skip,
    "seed_if_empty": seed_if_empty,
    "delete_by_pattern": delete_by_pattern,
    "registry_delete": registry_delete,
    "registry_totals": registry_totals,
    "schema_tables": schema_tables,
    "drop_column_if_exists": drop_column_if_exists,
    "load_summary": load_summary,
    "run_summary": run_summary,
    "file_quarantine": file_quarantine,
    "fk_violations": fk_violations,
    "duplicate_keys": duplicate_keys,
    "duplicate_state_names": duplicate_state_names,
    "deletable_states": deletable_states,
    "count_by_uf": count_by_uf,
    "count_distinct_codes": count_distinct_codes,
    "quality_report": quality_report,
    "clean_pct": clean_pct,
    "cpf_extract": cpf_extract,
    "cpf_mask": cpf_mask,
    "owner_name": owner_name,
    "owners_split": owners_split,
    "owners_exploded": owners_exploded,
    "owner_counts": owner_counts,
    "mask_documents": mask_documents,
    "digits_only": digits_only,
    "participation_clamp": participation_clamp,
    "status_default": status_default,
    "safe_filename": safe_filename_q,
    "validate_keys": validate_keys,
    "lookup_outcomes": lookup_outcomes,
    "point_lookup": point_lookup,
    "record_lookup_flat": record_lookup_flat,
    "layout_pruned_lookup": layout_pruned_lookup,
    "lookup_scan_facts": lookup_scan_facts,
    "lookup_by_municipio": lookup_by_municipio,
    "record_json": record_json,
    "contract_violations": contract_violations,
    "state_selection": state_selection,
    "state_label_filter": state_label_filter,
    "numeric_selection": numeric_selection,
    "label_lookup_default": label_lookup_default,
    "tiered_match": tiered_match,
    "candidate_match": candidate_match,
    "live_state_list": live_state_list,
    "checkpoint_state": checkpoint_state,
    "retry_status": retry_status,
    "stream_insert_only": stream_insert_only,
    "stream_reset": stream_reset,
    "stream_dedupe": stream_dedupe,
}
