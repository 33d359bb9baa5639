"""Owner list of a registry record (R1–R5, D3) as array expressions.

The whole owner pipeline stays inside one row: split → per-part name/CPF →
ordered dedupe → struct. No shuffle, no Python; a record's owners never leave
the task that read the record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glebe.functions import constants as C
from glebe.functions.text import cpf_extract, cpf_mask, owner_name, participation_pct, py_strip

OWNER_FIELDS = ["nome_completo", "cpf", "vinculo", "participacao_pct"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def split_parts(x) -> Column:
    """Stripped, non-empty pieces of the text split on the owner separators."""
    return F.filter(F.transform(F.split(_c(x), C.OWNER_SPLIT_REGEX, -1), lambda p: py_strip(p)), lambda p: p != "")


def parts_with_fallback(x, parts) -> Column:
    """Text with no non-blank part falls back to ``[text]``; NULL and '' give ``[]``."""
    x, parts = _c(x), _c(parts)
    return (
        F.when(x.isNull() | (x == ""), F.array().cast("array<string>"))
        .when(F.size(parts) == 0, F.array(x))
        .otherwise(parts)
    )


def owner_parts(x) -> Column:
    """Split free text on ``;``, ``|``, `` / ``, `` e `` into stripped, non-empty parts,
    with the fallback of :func:`parts_with_fallback`. (Single-expression form; inside
    :func:`with_owners` the split is staged as its own column so it runs once.)"""
    return parts_with_fallback(x, split_parts(x))


def with_owners(df: DataFrame, text_col: str, pct_col: str | None, out_col: str = "proprietarios") -> DataFrame:
    """Add ``out_col``: ``array<struct<nome_completo, cpf, vinculo, participacao_pct>>`` (R2, D3).

    Intermediate arrays are separate projections so each regex runs once per part.
    Dedupe key is ``(lower(name), raw cpf or '')``, first occurrence kept, order kept.
    """
    pct = participation_pct(F.col(pct_col)) if pct_col else F.lit(C.PCT_DEFAULT)
    tmp_parts, tmp_raw, tmp_keys = "__owner_parts", "__owner_raw", "__owner_keys"
    df = df.withColumn(tmp_parts, split_parts(text_col))
    df = df.withColumn(tmp_parts, parts_with_fallback(text_col, tmp_parts))
    df = df.withColumn(
        tmp_raw,
        F.transform(F.col(tmp_parts), lambda p: F.struct(owner_name(p).alias("n"), cpf_extract(p).alias("c"))),
    )
    df = df.withColumn(
        tmp_keys,
        F.transform(F.col(tmp_raw), lambda o: F.struct(F.lower(o["n"]).alias("n"), F.coalesce(o["c"], F.lit("")).alias("c"))),
    )
    kept = F.filter(F.col(tmp_raw), lambda o, i: F.array_position(F.col(tmp_keys), F.col(tmp_keys)[i]) == i + 1)
    owners = F.transform(
        kept,
        lambda o: F.struct(
            o["n"].alias("nome_completo"),
            cpf_mask(o["c"]).alias("cpf"),
            F.lit(C.OWNER_LINK).alias("vinculo"),
            pct.alias("participacao_pct"),
        ),
    )
    return df.withColumn(out_col, owners).drop(tmp_parts, tmp_raw, tmp_keys)


def explode_owners(df: DataFrame, keep: list[str], owners_col: str = "proprietarios") -> DataFrame:
    """One row per owner with its 0-based position in the deduped list.

    ``posexplode_outer`` + a filter on the generated position: for the plain generator
    Spark infers a ``size(owners) > 0`` filter and pushes it below the projections,
    which would evaluate the whole owner pipeline twice per record.
    """
    return (
        df.select(*keep, F.posexplode_outer(owners_col).alias("owner_pos", "o"))
        .where(F.col("owner_pos").isNotNull())
        .select(*keep, "owner_pos", *[F.col("o")[f].alias(f) for f in OWNER_FIELDS])
    )
