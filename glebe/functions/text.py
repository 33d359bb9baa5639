"""Scalar column functions (JVM-side built-in expressions only).

Every function takes and returns a ``Column`` so it composes inside one
whole-stage-codegen span; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glebe.functions import constants as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Python's whitespace set (``str.isspace``), derived by rule; all of it lies below U+3001.
PY_WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def py_strip(x) -> Column:
    """Python ``str.strip()``: Python's whitespace on both ends (SQL ``trim`` strips blanks only).

    ``btrim`` with an explicit character set: no regex, and exactly Python's set
    (Java's ``\\s`` differs on U+001C–U+001F)."""
    return F.btrim(_c(x), F.lit(PY_WHITESPACE))


# --- numbers (loader) --------------------------------------------------------

# Python ``float()`` grammar after ``,``→``.``: sign, digits with single ``_`` between
# digits, optional point and exponent, or inf/infinity/nan.
_PY_DIGITS = r"\d(?:_?\d)*"
_PY_FLOAT = (
    r"(?iU)^[+-]?(?:(?:(?:" + _PY_DIGITS + r")?\." + _PY_DIGITS + r"|" + _PY_DIGITS + r"\.?)"
    r"(?:e[+-]?" + _PY_DIGITS + r")?|inf|infinity|nan)$"
)


def pct_text_normalized(x) -> Column:
    """The loader's client-side step: strip, null markers → NULL, every ``,`` → ``.``."""
    s = py_strip(x)
    return F.when(
        s.isNotNull() & ~F.lower(s).isin(*C.NULL_NUMBER_TEXTS),
        F.replace(s, F.lit(","), F.lit(".")),
    )


def _pct_decimal(n: Column) -> Column:
    return n.try_cast(f"decimal({C.PCT_PRECISION},{C.PCT_SCALE})")


def pct_rejects_file(x) -> Column:
    """True when the loader would pass the text on but the table type refuses it.

    Python's ``float`` accepts it, yet ``NUMERIC(12,4)`` does not: underscores,
    infinities, non-ASCII digits, or a value outside ``|x| < 10^8``. In the
    reference such a value aborts the whole file. The Python-grammar regex runs
    only on the rare rows the decimal cast refused.
    """
    n = pct_text_normalized(x)
    d = _pct_decimal(n)
    is_nan = F.lower(F.regexp_replace(n, "^[+-]", "")) == "nan"
    refused = (
        F.when(n.isNull(), F.lit(False))
        .when(d.isNotNull(), n.rlike(r"[^\x00-\x7F]"))
        .otherwise(n.rlike(_PY_FLOAT) & ~is_nan)
    )
    return F.coalesce(refused, F.lit(False))


def clean_pct(x) -> Column:
    """Text → ``decimal(12,4)`` exactly as the loader stores it (F1 + F2 + F3).

    NULL/blank/none/null → NULL; decimal comma becomes a point (``1.234,56`` → NULL);
    unparsable → NULL; negative and NaN → NULL (the ``^\\d+([.,]\\d+)?$`` gate).
    Every text the decimal cast accepts is one Python's ``float`` accepts too.
    """
    d = _pct_decimal(pct_text_normalized(x))
    return F.when(d >= 0, d)


# --- CPF and names (lookup) --------------------------------------------------

def cpf_extract(x) -> Column:
    """First CPF-shaped match, digits only; NULL when none."""
    m = F.regexp_extract(_c(x), C.CPF_REGEX, 0)
    return F.nullif(F.regexp_replace(m, r"(?U)\D", ""), F.lit(""))


def owner_name(x) -> Column:
    """Name without any CPF, one trailing ``-`` and edge `` -:\\t``."""
    x = _c(x)
    no_cpf = F.regexp_replace(x, C.CPF_REGEX, "")
    no_dash = F.regexp_replace(no_cpf, r"(?dU)\s*-\s*$", "")
    name = F.btrim(no_dash, F.lit(C.NAME_STRIP_CHARS))
    return F.when(x.isNull() | (x == ""), F.lit(C.NOT_INFORMED)).otherwise(
        F.coalesce(F.nullif(name, F.lit("")), F.lit(C.NOT_INFORMED))
    )


def cpf_mask(cpf) -> Column:
    """``***.***.***-NN`` keeping the last two digits; anything else fully masked."""
    cpf = _c(cpf)
    return F.when(cpf.rlike(r"(?U)^\d{11}\z"), F.concat(F.lit(C.CPF_MASK_PREFIX), F.right(cpf, F.lit(2)))).otherwise(
        F.lit(C.CPF_MASK_UNKNOWN)
    )


def mask_cpfs_in_text(x) -> Column:
    """Mask every CPF-shaped number inside free text, keeping its last two digits."""
    return F.regexp_replace(_c(x), C.CPF_REGEX, C.CPF_MASK_PREFIX.replace("$", "\\$") + "$4")


# --- numbers (lookup) --------------------------------------------------------

def to_float(x) -> Column:
    """Python ``float(value)`` on a stored number; NULL stays NULL (F8)."""
    return _c(x).cast("double")


def participation_pct(x) -> Column:
    """NULL → 100, < 0 → 0, > 100 → 100, else the value (F9). NaN passes through as in Python."""
    d = to_float(x)
    return (
        F.when(d.isNull(), F.lit(C.PCT_DEFAULT))
        .when(F.isnan(d), d)
        .when(d < C.PCT_MIN, F.lit(C.PCT_MIN))
        .when(d > C.PCT_MAX, F.lit(C.PCT_MAX))
        .otherwise(d)
    )


def status_default(x) -> Column:
    """``value or "Nao informado"``: NULL and '' get the default, blanks are kept."""
    return F.coalesce(F.nullif(_c(x), F.lit("")), F.lit(C.NOT_INFORMED))


# --- file names and labels ---------------------------------------------------

def file_stem(name) -> Column:
    """``Path(name).stem``."""
    return F.regexp_replace(_c(name), r"(?<=.)\.[^.]*$", "")


def uf_from_file_name(name) -> Column:
    """Text before the first ``_`` of the stem; NULL when the stem has no ``_``."""
    stem = file_stem(name)
    return F.when(F.instr(stem, "_") > 0, F.substring_index(stem, "_", 1))


def uf_from_label(label) -> Column:
    """``label.split(' - ')[0].strip().upper()``."""
    return F.upper(py_strip(F.substring_index(_c(label), C.LABEL_SEPARATOR, 1)))


def digits_only(x) -> Column:
    """``re.sub(r"\\D", "", text)`` with Python's Unicode digits."""
    return F.regexp_replace(_c(x), r"(?U)\D", "")


def fold_ci_ai(x) -> Column:
    """Accent- and case-insensitive comparable form of trimmed text (F14), as a collation.

    Good for comparisons; for join keys prefer :func:`norm_key` (a collated key cannot be
    hash-joined, so Spark would sort-merge and shuffle both sides)."""
    return F.collate(F.trim(_c(x)), "UNICODE_CI_AI")


def _fold_table() -> tuple[str, str]:
    """Precomposed letters → base letter, derived by rule from Unicode decompositions
    (a letter whose NFD is one base character plus combining marks U+0300–U+036F);
    the combining marks themselves map to nothing."""
    import unicodedata

    src, dst = [], []
    for i in range(0xC0, 0x2000):
        ch = chr(i)
        d = unicodedata.normalize("NFD", ch)
        if len(d) > 1 and all(0x300 <= ord(m) <= 0x36F for m in d[1:]):
            src.append(ch)
            dst.append(d[0])
    marks = "".join(chr(i) for i in range(0x300, 0x370))
    return "".join(src) + marks, "".join(dst)


_FOLD_FROM, _FOLD_TO = _fold_table()


def _js_whitespace() -> str:
    """ECMAScript ``trim`` set: WhiteSpace (TAB, VT, FF, ZWNBSP and every ``Zs`` character)
    plus LineTerminator (LF, CR, LS, PS), derived from the Unicode categories."""
    import unicodedata

    zs = "".join(chr(i) for i in range(0x10000) if unicodedata.category(chr(i)) == "Zs")
    return "\t\x0b\x0c\ufeff\n\r\u2028\u2029" + zs


JS_WHITESPACE = _js_whitespace()


def norm_key(x) -> Column:
    """Binary join key for accent- and case-insensitive matching, as the portal script
    normalises: strip combining marks (NFD-style, by table), upper-case, trim with the
    JavaScript whitespace set (F14, as a hashable string)."""
    return F.btrim(F.upper(F.translate(_c(x), _FOLD_FROM, _FOLD_TO)), F.lit(JS_WHITESPACE))


# --- lookup keys ----------------------------------------------------------------

def is_valid_lookup_key(k) -> Column:
    """Path-parameter rule: 1..64 chars of ``[A-Za-z0-9./_-]``."""
    k = _c(k)
    return F.coalesce(
        F.length(k).between(1, C.LOOKUP_KEY_MAX_LEN) & k.rlike(C.LOOKUP_KEY_REGEX),
        F.lit(False),
    )
