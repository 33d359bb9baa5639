"""Landing directories of ``;``-separated state files.

A landed file is a plain ``<name>.csv``, or a folder ``file=<name>.csv`` of part files in row order (what
:func:`land_csv` writes, at every size). Both read the same: the logical file name decides state and order.

Every file is loaded right or refused with a reason:

* **Header pass** (``mapInPandas`` over the listing): one streaming CSV reader per file takes the first two
  records and stops; it reads the start of a file only, with universal newlines. What it cannot parse or decode
  is a reason, not an error.
* **Body check** (one JVM scan of the physical lines, map-side counts per file): bytes that are no UTF-8,
  lines that are no whole records, quotes that do not pair up.
* **Body read**: all files are read in many splits. Where a quoted cell runs on over a line's end, the lines' quotes
  say where records begin: counted per split, summed along the file, so every split knows whether it starts inside a
  quote; only lines of broken records move. Cells are bound to column names through each file's own header
  (one row per file). Column order may differ per file; missing columns are NULL; a repeated header name takes
  its last cell (``dict`` semantics).
* ``''`` vs NULL: an empty cell is ``''``; a cell missing at the end of a short row is NULL. Short rows are
  recognised from the parser's corrupt-record text.
* Row order inside a file is ``part · 2^84 + split start · 2^33 + row within the split``, a ``decimal(38,0)``;
  the file name itself is the outer order key.

A refused file has one row, ``pos`` -1, that carries its reason.
"""

from __future__ import annotations

import csv
import io
from contextlib import contextmanager
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from glebe.functions import constants as C
from glebe.functions.text import uf_from_file_name
from glebe.sources import fs

CSV_OPTIONS = {
    "sep": ";",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "encoding": "UTF-8",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt",
    # a value that never occurs, so quoted "" reads as '' (unquoted empties still read as NULL)
    "nullValue": "\u0000\u0001",
}
HEADER_SCHEMA = StructType(
    [
        StructField("fkey", StringType()),
        StructField("header", ArrayType(StringType())),
        StructField("width", IntegerType()),
        StructField("first_row_cells", IntegerType()),
        StructField("error", StringType()),
    ]
)
# FIXED VALUE — longest cell the loader's CSV parser takes; a longer one refuses its file.
MAX_CELL = 131_072
# A cell that is quoted (quotes inside doubled) or does not start with a quote; a physical line of such cells is a whole record.
_CELL = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^;"][^;]*+|)'
_WHOLE_LINE = rf"^{_CELL}(?:;{_CELL})*+$"
# Part files of a folder follow Spark's names: the task number is in row order.
_PART = r"part-(\d+)[^/]*$"
LIST_OPTIONS = {"recursiveFileLookup": "true", "pathGlobFilter": "*.csv"}
# Files whose listing exceeds this are joined to their headers without a broadcast hint
# (one ~250-byte row per file: at most ~25 MB broadcast).
MAX_BROADCAST_FILES = 100_000


def _open(fkey: str):
    """Open a file given Spark's URI-encoded ``_metadata.file_path``."""
    import pyarrow.fs as pafs

    if fkey.startswith("file:"):
        local = unquote(fkey[len("file:"):])
        while local.startswith("//"):
            local = local[1:]
        return pafs.LocalFileSystem().open_input_stream(local)
    filesystem, p = pafs.FileSystem.from_uri(fkey)
    return filesystem.open_input_stream(p)


def _leading_records(fkey: str, n: int = 2) -> list[list[str]]:
    """The first ``n`` non-blank CSV records of a file; reads no further. A cell beyond the field limit of the
    csv module (an open quote, say) raises ``csv.Error``."""
    records: list[list[str]] = []
    with _open(fkey) as raw, io.TextIOWrapper(raw, encoding="utf-8-sig", errors="strict", newline=None) as lines:
        for record in csv.reader(lines, delimiter=";"):
            if record:
                records.append(record)
            if len(records) == n:
                break
    return records


def _headers(batches):
    for pdf in batches:
        out = []
        for fkey in pdf["fkey"]:
            recs, error = [], None
            try:
                recs = _leading_records(fkey)
            except UnicodeDecodeError:
                error = "invalid_utf8"
            except (csv.Error, OSError):
                error = "unreadable"
            header = recs[0] if recs else None
            first = len(recs[1]) if len(recs) > 1 else None
            out.append((fkey, header, len(header) if header else 0, first, error))
        yield pd.DataFrame(out, columns=["fkey", "header", "width", "first_row_cells", "error"])


def _parent(path: F.Column) -> F.Column:
    return F.regexp_replace(path, r"/[^/]+$", "")


def _base_name(path: F.Column) -> F.Column:
    return F.element_at(F.split(path, "/"), -1)


def named(listing: DataFrame) -> DataFrame:
    """``(fkey, file, part, length)`` from a binaryFile listing ``(fkey, path, length)``."""
    folder = _base_name(_parent(F.col("path")))
    in_folder = folder.startswith("file=")
    # the writer escapes a few characters of the folder name as %XX
    logical = F.url_decode(F.replace(F.substring_index(folder, "file=", -1), F.lit("+"), F.lit("%2B")))
    return listing.select(
        "fkey",
        F.when(in_folder, logical).otherwise(_base_name(F.col("path"))).alias("file"),
        F.when(in_folder, F.coalesce(F.regexp_extract("path", _PART, 1).try_cast("long"), F.lit(0))).otherwise(F.lit(0)).alias("part"),
        "length",
    )


# Rows of a batch of bound_rows.
BOUND_ROWS = 10_000


def bound_rows(batches):
    """Rows of whole files, bound to the target columns by each file's header (for row streams): ``(fkey, landed_at)``
    → data columns, landed_at, refused_file, file_reason. A file is parsed as a stream, in batches."""
    for pdf in batches:
        for fkey, landed_at in zip(pdf["fkey"], pdf["landed_at"]):
            yield from _bound_file(fkey, landed_at)


def _bound_file(fkey: str, landed_at):
    columns = [*C.DATA_COLUMNS, "landed_at", "refused_file", "file_reason"]
    refused = lambda why: pd.DataFrame(
        [[None] * len(C.DATA_COLUMNS) + [landed_at, unquote(fkey.rstrip("/").rsplit("/", 1)[-1]), why]], columns=columns)
    try:
        with _open(fkey) as raw, io.TextIOWrapper(raw, encoding="utf-8-sig", errors="strict", newline=None) as lines:
            for _ in csv.reader(lines, delimiter=";"):  # a fault anywhere refuses the file before a row of it is seen
                pass
        with _open(fkey) as raw, io.TextIOWrapper(raw, encoding="utf-8-sig", errors="strict", newline=None) as lines:
            records = (r for r in csv.reader(lines, delimiter=";") if r)
            header = next(records, [])
            if not set(header) <= set(C.DATA_COLUMNS):
                yield refused("unknown_column")
                return
            at = {name: i for i, name in enumerate(header)}
            rows = []
            for r in records:
                rows.append([r[at[c]] if c in at and at[c] < len(r) else None for c in C.DATA_COLUMNS] + [landed_at, None, None])
                if len(rows) == BOUND_ROWS:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=columns)
    except UnicodeDecodeError:
        yield refused("invalid_utf8")
    except (csv.Error, OSError):
        yield refused("unreadable")


@contextmanager
def split_bytes(spark: SparkSession, size: int):
    """Within, files are cut into splits of about this size; the plans must run inside.

    A task reads many splits: there are about as many tasks as shuffle partitions, as each sends its status and metrics to
    the driver, which a task per split would multiply by the input's size."""
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    within = {
        "spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": str(size), "spark.sql.files.maxPartitionNum": tasks,
    }
    before = {n: spark.conf.get(n, None) for n in within}
    for n, v in within.items():
        spark.conf.set(n, v)
    try:
        yield
    finally:
        for n, v in before.items():
            if v is None:
                spark.conf.unset(n)
            else:
                spark.conf.set(n, v)


def list_csv(spark: SparkSession, directory: str) -> DataFrame:
    """``(fkey, file, part, length)`` of the non-empty ``*.csv`` files of a directory and of its ``file=`` folders.

    ``fkey`` is Spark's URI-encoded ``_metadata.file_path`` (the join key every scan of
    the same file produces); ``file`` is the logical file name."""
    root = fs.qualified(spark, directory)
    above = _parent(F.col("path"))
    here = (above == root) | ((_parent(above) == root) & _base_name(above).startswith("file="))
    listed = spark.read.format("binaryFile").options(**LIST_OPTIONS).load(directory)
    return named(listed.where(here).select(F.col("_metadata.file_path").alias("fkey"), "path", "length"))


def unlisted_csv(spark: SparkSession, directory: str) -> list[str]:
    """Names of ``*.csv`` files that Spark's scans never show (names that start with ``_`` or ``.``)."""
    found = [p for pattern in ("_*.csv", ".*.csv") for p in fs.glob_files(spark, f"{directory.rstrip('/')}/{pattern}")]
    return sorted(p.rsplit("/", 1)[-1] for p in found)


def read_headers(listing: DataFrame) -> DataFrame:
    """S3 header pass: ``(fkey, header, width, first_row_cells, error)`` per file."""
    return listing.select("fkey").mapInPandas(_headers, HEADER_SCHEMA)


def header_reason() -> F.Column:
    """Whole-file refusals visible in the header pass; a file without a data row breaks no rule of the table."""
    h = F.col("header")
    known = F.array(*[F.lit(c) for c in C.DATA_COLUMNS])
    return F.coalesce(
        F.col("error"),
        F.when(F.col("first_row_cells").isNotNull(),
               F.when(F.array_contains(h, "uf"), F.lit("uf_in_header"))
               .when(F.size(F.array_except(h, known)) > 0, F.lit("unknown_column"))
               .when(F.col("first_row_cells") > F.col("width"), F.lit("surplus_cells_first_row"))),
    )


def check_bodies(spark: SparkSession, source) -> DataFrame:
    """``(fkey, body_reason, whole_lines)`` per file from one scan of its physical lines.

    ``whole_lines``: every line is a whole record, so the file can be read in splits. In a file where a quoted cell
    runs on over a line's end, all quotes must pair up, or it is refused (so is one that also has an odd number of
    quotes inside unquoted cells). Runs in the JVM on the lines' bytes; counts are combined map-side."""
    line = F.col("value")
    whole = ~line.contains('"') | line.rlike(_WHOLE_LINE)
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    lines = spark.read.options(**LIST_OPTIONS).text(source)
    per_file = lines.groupBy(F.col("_metadata.file_path").alias("fkey")).agg(
        F.bool_and(F.is_valid_utf8(line)).alias("utf8"), F.bool_and(whole).alias("whole_lines"), F.sum(quotes).alias("quotes")
    )
    reason = F.when(~F.col("utf8"), F.lit("invalid_utf8")).when(~F.col("whole_lines") & (F.col("quotes") % 2 == 1), F.lit("unbalanced_quote"))
    return per_file.select("fkey", reason.alias("body_reason"), "whole_lines")


def read_landing(spark: SparkSession, directory: str) -> DataFrame:
    """Staging rows ``file, pos, <six columns>, uf, file_reason`` of a landing directory.

    ``file_reason`` is set on the one row of a file that is refused as a whole."""
    hidden = unlisted_csv(spark, directory)
    rows = _read_listed(spark, list_csv(spark, directory).where(F.col("length") > 0), directory)
    if hidden:
        names = spark.createDataFrame([(n,) for n in hidden], "file string")
        rows = rows.unionByName(_refused(names.withColumn("file_reason", F.lit("unlisted_name"))))
    return rows


def read_files(spark: SparkSession, listing: DataFrame) -> DataFrame:
    """Like :func:`read_landing`, for an explicit set of files: ``listing`` has one row per file with its encoded
    ``fkey``, ``file`` and ``part`` (e.g. the files of one stream micro-batch, which its trigger bounds)."""
    return _read_listed(spark, listing, None)


def _hadoop_path(fkey: str) -> str:
    """Encoded ``_metadata.file_path`` → a path string Spark reads literally (glob characters escaped)."""
    scheme, sep, rest = fkey.partition(":")
    if not sep:
        scheme, rest = "", fkey
    head = ""
    if rest.startswith("//"):
        authority_end = rest.find("/", 2)
        head, rest = (rest[:authority_end], rest[authority_end:]) if authority_end > 0 else (rest, "")
    path = unquote(rest)
    for ch in "\\{}[]*?":
        path = path.replace(ch, "\\" + ch)
    return (scheme + ":" if sep else "") + head + path


def _paths(files: DataFrame) -> list[str]:
    return [_hadoop_path(r["fkey"]) for r in files.select("fkey").collect()]


def _refused(files: DataFrame) -> DataFrame:
    """One staging row per refused file: ``file, file_reason`` and nothing else."""
    return files.select(
        "file", F.lit(-1).cast("decimal(38,0)").alias("pos"), *[F.lit(None).cast("string").alias(c) for c in C.DATA_COLUMNS],
        uf_from_file_name(F.col("file")).alias("uf"), "file_reason",
    )


def _read_listed(spark: SparkSession, listing: DataFrame, directory: str | None) -> DataFrame:
    listing = listing.checkpoint(eager=True)  # one row per file, like all tables below
    source = directory if directory is not None else _paths(listing)
    if not source:
        return _empty_staging(spark)
    headers = read_headers(listing).where((F.col("width") > 0) | F.col("error").isNotNull())
    files = listing.select("fkey", "file", "part").join(headers, "fkey").join(check_bodies(spark, source), "fkey", "left")
    files = files.withColumn("file_reason", F.coalesce(header_reason(), "body_reason")).checkpoint(eager=True)
    good = files.where(F.col("file_reason").isNull())
    stats = good.agg(
        F.max("width").alias("w"), F.count(F.lit(1)).alias("n"), F.count_if(~F.col("whole_lines")).alias("broken")
    ).first()  # one small action
    # a logical file with a refused part is refused: the row that says so sorts first
    out = _refused(files.where(F.col("file_reason").isNotNull()))
    if not stats["n"]:
        return out
    width = int(stats["w"])
    broadcast = F.broadcast if stats["n"] <= MAX_BROADCAST_FILES else (lambda df: df)
    read = [(source, True, good.where("whole_lines"))] if stats["broken"] < stats["n"] else []
    if stats["broken"]:  # quoted line breaks: these files by path
        broken = good.where(~F.col("whole_lines"))
        read.append((_paths(broken), False, broken))
    for paths, splittable, some in read:
        body = _read_body(spark, paths, width) if splittable else _read_broken(spark, paths, width)
        rows = body.join(broadcast(header_table(some)), F.col("fkey") == F.col("__fkey"))
        out = out.unionByName(bind_by_header(rows, width))
    return out


def _row_position() -> F.Column:
    """Order of a row in its logical file: part, start of the split, row within the split's task."""
    wide = "decimal(38,0)"
    in_task = F.pmod(F.monotonically_increasing_id(), F.lit(1 << 33)).cast(wide)
    start = F.col("_metadata.file_block_start").cast(wide)
    return (start * F.lit(1 << 33).cast("decimal(12,0)") + in_task).cast(wide)


def _positional_schema(width: int) -> StructType:
    return StructType([StructField(f"c{i}", StringType()) for i in range(width)] + [StructField("_corrupt", StringType())])


def _cells(rows: DataFrame, pos: F.Column, width: int) -> DataFrame:
    cols = [f"c{i}" for i in range(width)]
    too_long = F.lit(False)
    for c in cols:
        too_long = too_long | F.coalesce(F.length(c) > MAX_CELL, F.lit(False))
    return rows.select("fkey", pos.alias("pos"), *cols, n_cells(width).alias("n_cells"), too_long.alias("too_long"))


def _read_body(spark: SparkSession, source, width: int) -> DataFrame:
    """One positional scan of every ``*.csv`` of the directory (or of the given paths) at the widest header, in splits.

    Narrower files come back as short rows (flagged by the parser), whose true cell
    count is recovered from the raw record; one scan, no per-file path lists (file
    names are never interpreted as glob patterns)."""
    opts = {**CSV_OPTIONS, **LIST_OPTIONS, "multiLine": "false"}
    df = spark.read.schema(_positional_schema(width)).options(header="true", **opts).csv(source)
    return _cells(df.withColumn("fkey", F.col("_metadata.file_path")).withColumn("_pos", _row_position()), F.col("_pos"), width)


def _read_broken(spark: SparkSession, source, width: int) -> DataFrame:
    """The same for files whose quoted cells hold line breaks.

    A line that has an odd number of quotes opens or closes a quote. Their number is summed inside each split and, over
    one row per split, along the file; a line begins a record when an even number stands before it. Lines of one record
    are put together again (only these are grouped); all others are records as they are. A file's first record is its header.
    """
    line = F.col("value")
    odd = ((F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2).cast("long")
    lines = spark.read.options(**LIST_OPTIONS).text(source)
    lines = lines.select(F.col("_metadata.file_path").alias("fkey"), F.col("_metadata.file_block_start").alias("block"),
                         F.monotonically_increasing_id().alias("id"), "value", odd.alias("odd"))
    split = Window.partitionBy("fkey", "block").orderBy("id")
    before = split.rowsBetween(Window.unboundedPreceding, -1)
    upto = split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    along = Window.partitionBy("fkey").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    splits = lines.groupBy("fkey", "block").agg(F.sum("odd").alias("odds"))
    splits = splits.select("fkey", "block", (F.coalesce(F.sum("odds").over(along), F.lit(0)) % 2).alias("inside"))
    lines = lines.withColumn("n", F.row_number().over(split)).withColumn("earlier", F.coalesce(F.sum("odd").over(before), F.lit(0)))
    lines = lines.join(splits, ["fkey", "block"]).withColumn("begins", (F.col("inside") + F.col("earlier")) % 2 == 0)
    whole = lines.where(F.col("begins") & (F.col("odd") == 0)).select("fkey", "block", "n", line.alias("record"))
    # The line at which a line's record begins: in its split, or the last one that began in a split before.
    part = lines.where(~F.col("begins") | (F.col("odd") == 1))
    own = F.last(F.when(F.col("begins"), F.struct("block", "n")), ignorenulls=True).over(upto)
    part = part.withColumn("own", own)
    lasts = part.groupBy("fkey", "block").agg(F.max(F.when(F.col("begins"), F.struct("block", "n"))).alias("last"))
    lasts = lasts.select("fkey", "block", F.last("last", ignorenulls=True).over(along).alias("carried"))
    part = part.join(lasts, ["fkey", "block"]).withColumn("at", F.coalesce("own", "carried"))
    grouped = part.groupBy("fkey", "at").agg(F.sort_array(F.collect_list(F.struct("block", "n", "value"))).alias("l"))
    together = F.array_join(F.transform("l", lambda x: x["value"]), "\n")
    records = whole.unionByName(grouped.select("fkey", "at.block", "at.n", together.alias("record"))).where(F.col("record") != "")
    headers = records.groupBy(F.col("fkey").alias("__f")).agg(F.min(F.struct("block", "n")).alias("__header"))  # one row per file
    body = records.join(headers, F.col("fkey") == F.col("__f")).where(F.struct("block", "n") != F.col("__header"))
    options = {k: v for k, v in CSV_OPTIONS.items() if k not in ("multiLine", "encoding")}
    parsed = body.withColumn("c", F.from_csv("record", _positional_schema(width).simpleString()[len("struct<"):-1].replace(":", " "), options))
    pos = (F.col("block").cast("decimal(38,0)") * F.lit(1 << 33).cast("decimal(12,0)") + F.col("n")).cast("decimal(38,0)")
    return _cells(parsed.select("fkey", pos.alias("_pos"), "c.*"), F.col("_pos"), width)


def n_cells(width: int) -> F.Column:
    """Cells of the physical record: the schema width, or counted from the corrupt-record
    text (quoted sections removed) when the parser flagged a short or long row."""
    quoted = r'"[^"]*+(?:""[^"]*+)*+"'  # no backtracking, no recursion: cells of any length
    return F.when(F.col("_corrupt").isNull(), F.lit(width)).otherwise(
        F.size(F.split(F.regexp_replace(F.col("_corrupt"), quoted, ""), ";", -1))
    )


def header_table(headers: DataFrame) -> DataFrame:
    """One row per file: the 1-based cell index of every target column (last occurrence of
    the name, ``dict`` semantics; 0 when absent)."""
    def idx(name: str) -> F.Column:
        pos = F.array_position(F.reverse(F.col("header")), F.lit(name))
        return F.when(pos > 0, F.size(F.col("header")) - pos + 1).otherwise(F.lit(0)).cast("int")

    return headers.select(
        F.col("fkey").alias("__fkey"),
        "file",
        "part",
        *[idx(c).alias(f"__i_{c}") for c in C.DATA_COLUMNS],
    )


def bind_by_header(rows: DataFrame, width: int) -> DataFrame:
    """Map positional cells ``c0..`` to the target columns through the row's header indices.

    An empty cell is ``''``; a cell beyond the record's own cell count is NULL.
    """
    def cell(name: str) -> F.Column:
        i = F.col(f"__i_{name}")
        out = F.lit(None).cast("string")
        for k in range(width, 0, -1):
            out = F.when(i == k, F.when(F.col("n_cells") >= k, F.coalesce(F.col(f"c{k - 1}"), F.lit("")))).otherwise(out)
        return out

    part = F.col("part").cast("decimal(8,0)") * F.lit(str(1 << 84)).cast("decimal(26,0)")
    return rows.select(
        "file",
        (part + F.col("pos")).cast("decimal(38,0)").alias("pos"),
        *[cell(c).alias(c) for c in C.DATA_COLUMNS],
        uf_from_file_name(F.col("file")).alias("uf"),
        F.when(F.col("too_long"), F.lit("field_too_long")).alias("file_reason"),
    )


def _empty_staging(spark: SparkSession) -> DataFrame:
    fields = ", ".join(f"{c} string" for c in C.DATA_COLUMNS)
    return spark.createDataFrame([], f"file string, pos decimal(38,0), {fields}, uf string, file_reason string")


def with_row_number(rows: DataFrame) -> DataFrame:
    """Add ``row_no``, the 1-based number of the row in its file, from ``pos``.

    Rows are ranked inside a split (bounded by its size) and the splits' row counts accumulated, so no
    task sees a whole file."""
    split = F.floor(F.col("pos") / F.lit(1 << 33).cast("decimal(12,0)")).cast("decimal(38,0)")
    placed = rows.withColumn("__split", split)
    counts = placed.groupBy("file", "__split").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("file").orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("file", "__split", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    rank = F.row_number().over(Window.partitionBy("file", "__split").orderBy("pos"))
    return placed.join(starts, ["file", "__split"]).withColumn("row_no", (F.col("__before") + rank).cast("long")).drop("__split", "__before")


def file_line_counts(spark: SparkSession, directory: str) -> DataFrame:
    """Records per file as physical lines − 1 (floor 0); embedded newlines count as lines; −1 for a file
    that cannot be decoded.

    Counted per encoded file path and named from the listing; zero-byte files (which
    Spark's scan never lists) come from the directory listing with 0."""
    lines = spark.read.options(**LIST_OPTIONS).text(directory)
    per_key = lines.groupBy(F.col("_metadata.file_path").alias("fkey")).agg(
        F.greatest(F.count(F.lit(1)) - 1, F.lit(0)).alias("n"), F.bool_and(F.is_valid_utf8("value")).alias("utf8")
    )
    named = per_key.join(list_csv(spark, directory).select("fkey", "file"), "fkey").groupBy("file")
    counts = named.agg(F.when(F.bool_and("utf8"), F.sum("n")).otherwise(F.lit(-1)).cast("long").alias("records"))
    names = [(p.rsplit("/", 1)[-1],) for p, n in fs.list_files(spark, directory) if n == 0 and p.endswith(".csv")]
    if not names:
        return counts
    empty = spark.createDataFrame(names, "file string").select("file", F.lit(0).cast("long").alias("records"))
    return counts.unionByName(empty)


def file_manifest(spark: SparkSession, directory: str, expected: DataFrame) -> DataFrame:
    """Expected file names with ``present`` — false when missing *or* zero-byte
    (Spark's file listing skips zero-byte files, so both fall out of the semi-join)."""
    listed = list_csv(spark, directory).where(F.col("length") > 0).select(F.col("file").alias("__f")).distinct()
    return expected.join(listed, F.col("file") == F.col("__f"), "left").select(
        "file", F.col("__f").isNotNull().alias("present")
    )


# --- landing writer (fixtures and exports) ------------------------------------------

def land_csv(
    spark: SparkSession,
    rows: DataFrame,
    directory: str,
    columns: list[str] | None = None,
    file_col: str = "file",
    order_col: str = "pos",
    parts: int | None = None,
) -> None:
    """Add one ``;`` CSV per distinct ``file_col`` value to ``directory``: a folder ``file=<name>`` of part files in
    ``order_col`` order, each with the header, quoting like Python's ``csv`` (``""`` escape).

    One rule at every size: rows are range-partitioned on (file, order) into ``parts`` tasks (default: the
    shuffle partitions), so a state that holds a third of the rows is written by a third of the tasks.
    """
    columns = columns or C.DATA_COLUMNS
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        rows.select(F.col(file_col).alias("file"), F.col(order_col).alias("__order"), *columns)
        .repartitionByRange(n, "file", "__order")
        .sortWithinPartitions("file", "__order")
        .select("file", *columns)
        .write.mode("append").partitionBy("file")
        .options(sep=";", quote='"', escape='"', header="true", quoteAll="false")
        .csv(directory)
    )


def land_header_only(spark: SparkSession, directory: str, name: str, columns: list[str] | None = None) -> None:
    """A header-only landing file (a state with no records)."""
    fs.write_small_text(spark, f"{directory.rstrip('/')}/{name}", ";".join(columns or C.DATA_COLUMNS) + "\n")
