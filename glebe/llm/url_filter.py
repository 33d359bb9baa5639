"""URL filter: host and path rules, and gradient-boosted trees for the rest.

A rule is a host and a path prefix; it fits its host and all subdomains, if the path starts with the rule's.
The longest fitting rule decides. Where none fits, boosted regression trees on lexical features decide
(length, depth, digit ratio, entropy, counts, suffix statistics), trained from the URLs that the rules label.

Training uses at most :data:`TRAIN_ROWS` URLs of each verdict, chosen by a hash. Statistics of the suffix (the last
host label) and of the first folder of the path are shares of blocked URLs among all labelled URLs that have the same,
shrunk to the whole share, and broadcast as long as they are few, like every other small table. The share that a
labelled URL gets leaves out its own part of :data:`FOLDS` parts of the URLs, so it does not repeat its label.

Defined results:
  null url, no ``://``   host and path empty, no rule, features of the empty text
  no labelled URL, or one verdict only   that verdict (allow when there is none) for every URL without a rule
  null page_id, repeated rows   each row is judged by itself
  empty table            empty result
  extra columns          not read
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glebe.llm.samples import per_label
from glebe.llm.staging import LOWER_ASCII, UPPER_ASCII, staged
from glebe.operators.broadcast import bounded_broadcast

# (verdict, host, path)
RULES: tuple[tuple[str, str, str], ...] = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
TRAIN_ROWS = 5_000
TREES = 15
DEPTH = 4
SEED = 11
SHRINK = 20.0  # rows of the whole share that every suffix is given
FOLDS = 5
BLOCK_FROM = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no ``://``."""
    after = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(after, r"(?s)^([^/?#]*)", 1), UPPER_ASCII, LOWER_ASCII)
    return host, F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule as text, verdict) of the longest rule that fits; nulls if none does."""
    rule = verdict = None
    for says, of, prefix in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(prefix)
        rule = F.when(fits, F.lit(of + prefix)) if rule is None else rule.when(fits, F.lit(of + prefix))
        verdict = F.when(fits, F.lit(says)) if verdict is None else verdict.when(fits, F.lit(says))
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _entropy(text: Column) -> Column:
    """Bits of Shannon entropy per character."""
    whole = F.greatest(F.char_length(text), F.lit(1)).cast("double")

    def bits(characters: Column) -> Column:  # one split of the text, whatever the number of its different characters
        counts = F.transform(F.array_distinct(characters), lambda c: F.size(F.filter(characters, lambda x: x == c)).cast("double"))
        return -F.aggregate(counts, F.lit(0.0), lambda total, n: total + n / whole * F.log2(n / whole))

    return F.transform(F.array(F.split(text, "")), bits)[0]


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    text = F.coalesce(url, F.lit(""))
    whole = F.greatest(F.char_length(text), F.lit(1)).cast("double")
    query = F.coalesce(F.regexp_extract(text, r"(?s)\?([^#]*)", 1), F.lit(""))
    return {
        "length": F.char_length(text).cast("double"),
        "host_length": F.char_length(host).cast("double"),
        "host_labels": _count(host, r"[^.]+"),
        "host_hyphens": _count(host, "-"),
        "host_digits": _count(host, "[0-9]"),
        "host_entropy": _entropy(host),
        "depth": _count(path, "/[^/]+"),
        "path_length": F.char_length(path).cast("double"),
        "digit_ratio": _count(text, "[0-9]") / whole,
        "entropy": _entropy(text),
        "parameters": _count(query, "[^&]+"),
        "fragment": text.contains("#").cast("double"),
        "secure": text.startswith("https://").cast("double"),
        "file_name": path.rlike(r"\.[A-Za-z0-9]{1,5}$").cast("double"),
    }


def parsed(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, url, host, path, rule, ruled, and what shares are counted of: suffix, folder, and the URL's fold."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    return rows.select(
        "*", rule.alias("rule"), verdict.alias("ruled"), F.regexp_extract("host", r"([^.]*)$", 1).alias("suffix"),
        F.regexp_extract("path", r"(?s)^/([^/]*)", 1).alias("folder"), F.pmod(F.xxhash64(F.coalesce("url", F.lit(""))), F.lit(FOLDS)).alias("fold"),
    )


@dataclass
class Model:
    trees: GBTClassificationModel | None  # none where the rules know one verdict only
    shares: dict[str, DataFrame]  # of suffix and folder: for every fold (blocked, every) among the labelled URLs
    share: float


def _with_features(rows: DataFrame, model: Model) -> DataFrame:
    features = lexical_features(F.col("url"), F.col("host"), F.col("path"))
    out = rows
    for of, counts in model.shares.items():
        out = out.join(counts, of, "left")
        others = F.filter("folds", lambda x: F.col("ruled").isNull() | (x["fold"] != F.col("fold")))
        blocked = F.aggregate(others, F.lit(SHRINK * model.share), lambda n, x: n + x["blocked"])
        every = F.aggregate(others, F.lit(SHRINK), lambda n, x: n + x["every"])
        out = out.withColumn(f"{of}_share", F.coalesce(blocked / every, F.lit(model.share))).drop("folds")
    out = out.withColumns(features)
    return VectorAssembler(inputCols=[*features, *[f"{of}_share" for of in model.shares]], outputCol="features").transform(out)


def fit(labelled: DataFrame) -> Model:
    """The trees and shares of URLs that rules have labelled (staged rows of :func:`parsed`, ``ruled`` not null)."""
    labelled = labelled.withColumn("label", (F.col("ruled") == "block").cast("double"))
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    total = sum(counts.values())
    model = Model(None, {}, counts.get(1.0, 0) / total if total else 0.0)
    if len(counts) < 2:
        return model
    for of in ("suffix", "folder"):
        folds = labelled.groupBy(of, "fold").agg(F.sum("label").alias("blocked"), F.count(F.lit(1)).cast("double").alias("every"))
        shares = folds.groupBy(of).agg(F.collect_list(F.struct("fold", "blocked", "every")).alias("folds"))  # FOLDS entries
        model.shares[of] = bounded_broadcast(staged(shares, f"url-{of}"))
    # Equal URLs share a hash: a distinct sample keeps one hot URL from filling it.
    sample = per_label(labelled.drop("page_id").distinct(), "label", ["url"], TRAIN_ROWS)
    train = staged(_with_features(sample, model).select("features", "label"), "url-train")
    model.trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=1.0).fit(train)
    return model


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with ``score``, the probability of block."""
    if model.trees is None:
        return rows.withColumn("score", F.lit(model.share))
    return model.trees.transform(_with_features(rows, model)).withColumn("score", vector_to_array("probability")[1])


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score (probability of block where no rule fits)."""
    rows = staged(parsed(pages, rules), "urls")
    out = scored(rows, fit(rows.where(F.col("ruled").isNotNull())))
    method = F.when(F.col("score") >= BLOCK_FROM, F.lit("block")).otherwise(F.lit("allow"))
    return out.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), F.when(F.col("ruled").isNull(), F.col("score")).alias("score")
    )
