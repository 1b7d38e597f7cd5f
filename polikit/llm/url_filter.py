"""URL filtering: rules where they fit, gradient-boosted trees on lexical features elsewhere.

A rule is an action (block or allow) for a host with all its subdomains and a path prefix;
of the rules that fit, the longest wins. The URLs that rules judge are the labelled ones:
the trees learn from them how blocked URLs look, and judge the rest. Features: lengths of
URL, host, path and query; depth; share of digits; entropy of the characters; number of
parameters; subdomains, hyphens, longest label, fragment and scheme; and, for the last
label of the host, its domain (last two) and the domain with the first path segment, how
many labelled URLs it has and their smoothed share of blocked ones (without the row itself
while training).

The trees (Spark ML) are fitted on at most ``sample_rows`` labelled URLs, the first by hash;
the suffix statistics count all labelled URLs. Scale: only the URL column is read;
statistics are grouped with map-side combine and counted before they are broadcast, else
joined by shuffle, where Spark splits a hot domain.

A null URL, or one without ``://``, has an empty host and path, fits no rule and is judged by
the trees like any other. Null ids and repeated rows stay. If the labelled URLs have
fewer than two kinds there is nothing to learn and all other URLs get ``default``.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, stage

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
SAMPLE_ROWS = 10_000
TREES = 20
DEPTH = 4
PRIOR_ROWS = 10.0
SUFFIXES = ("last_label", "domain", "section")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"\A[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct<length, rule, action> of the longest rule that fits; null if none does."""
    found = []
    for action, rule in rules:
        own, _, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        found.append(F.when(fits, F.struct(F.lit(len(rule)).alias("length"), F.lit(rule).alias("rule"),
                                           F.lit(action).alias("action"))))
    return F.array_max(F.array(*found)) if found else F.lit(None).cast("struct<length:int,rule:string,action:string>")


def _entropy(text: Column) -> Column:
    """Bits a character."""
    n = F.length(text)
    chars = F.array_remove(F.array_distinct(F.split(text, "")), "")
    each = F.aggregate(F.transform(chars, lambda c: F.length(text) - F.length(F.replace(text, c, F.lit("")))),
                       F.lit(0.0), lambda s, k: s + k * F.log2(k.cast("double")))
    return F.when(n > 0, F.log2(n.cast("double")) - each / n).otherwise(0.0)


def _features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    text = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    n = F.length(text)
    labels = F.split(host, r"\.")
    double = {
        "url_length": n, "host_length": F.length(host), "path_length": F.length(path), "query_length": F.length(query),
        "depth": F.size(F.array_remove(F.split(path, "/"), "")),
        "digits": F.when(n > 0, F.regexp_count(text, F.lit("[0-9]")) / n).otherwise(0.0),
        "entropy": _entropy(text),
        "parameters": F.size(F.array_remove(F.split(query, "&"), "")),
        "labels": F.size(labels), "longest_label": F.array_max(F.transform(labels, F.length)),
        "hyphens": F.regexp_count(host, F.lit("-")), "fragment": F.when(F.instr(text, "#") > 0, 1).otherwise(0),
        "secure": F.when(text.startswith("https://"), 1).otherwise(0),
    }
    return {k: c.cast("double") for k, c in double.items()}


def _described(urls: DataFrame, url_col: str, rules) -> DataFrame:
    """``urls`` (url_col and whatever names its rows) with host, path, fit, suffixes and features."""
    host, path = host_and_path(F.col(url_col))
    out = urls.withColumns({"host": host, "path": path})
    h, p = F.col("host"), F.col("path")
    domain = F.substring_index(h, ".", -2)
    return out.withColumns({
        "fit": fitting_rule(h, p, rules), "last_label": F.substring_index(h, ".", -1), "domain": domain,
        "section": F.concat(domain, F.lit("/"), F.get(F.array_remove(F.split(p, "/"), ""), 0)),
        **_features(F.col(url_col), h, p)})


def _suffix_statistics(labelled: DataFrame) -> dict[str, DataFrame]:
    blocked = F.sum(F.when(F.col("fit.action") == "block", 1).otherwise(0))
    return {s: stage(labelled.groupBy(F.col(s).alias(f"{s}_")).agg(
        F.count("*").alias(f"{s}_n"), blocked.alias(f"{s}_blocked")), f"url-{s}") for s in SUFFIXES}


def _with_statistics(rows: DataFrame, statistics: dict[str, DataFrame], share: float, without_own: bool) -> DataFrame:
    own = F.lit(1 if without_own else 0)
    own_blocked = F.when(F.col("fit.action") == "block", own).otherwise(0)
    for s, side in statistics.items():
        rows = rows.join(broadcast_if_small(side), F.col(s).eqNullSafe(F.col(f"{s}_")), "left")
        n = F.coalesce(f"{s}_n", F.lit(0)) - own
        blocked = F.coalesce(f"{s}_blocked", F.lit(0)) - own_blocked
        rows = rows.withColumns({f"{s}_seen": F.log1p(n.cast("double")),
                                 f"{s}_share": (blocked + PRIOR_ROWS * share) / (n + PRIOR_ROWS)})
        rows = rows.drop(f"{s}_", f"{s}_n", f"{s}_blocked")
    return rows


def _names() -> list[str]:
    return [*_features(F.lit(""), F.lit(""), F.lit("")), *[f"{s}_{k}" for s in SUFFIXES for k in ("seen", "share")]]


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=_names(), outputCol="features").transform(rows)


class UrlModel:
    """Trees and suffix statistics; ``trees`` is None where there was nothing to learn."""

    def __init__(self, trees: GBTClassificationModel | None, statistics: dict[str, DataFrame], share: float):
        self.trees, self.statistics, self.share = trees, statistics, share


def fit(urls: DataFrame, url_col: str = "url", rules=RULES, sample_rows: int = SAMPLE_ROWS,
        trees: int = TREES, depth: int = DEPTH) -> UrlModel:
    rows = _described(urls.select(F.col(url_col).alias("url")), "url", rules).filter("fit IS NOT NULL")
    n, blocked = rows.agg(F.count("*"), F.sum(F.when(F.col("fit.action") == "block", 1).otherwise(0))).first()
    if not n or blocked in (0, n):
        return UrlModel(None, {}, 0.0)
    statistics, share = _suffix_statistics(rows), blocked / n
    # different addresses: one that a third of all rows have is one row of the sample
    different = _described(urls.select(F.col(url_col).alias("url")).distinct(), "url", rules).filter("fit IS NOT NULL")
    sample = different.orderBy(F.xxhash64("url"), "url").limit(sample_rows)
    label = F.when(F.col("fit.action") == "block", 1.0).otherwise(0.0).alias("label")
    sample = _with_statistics(sample, statistics, share, True).select(*_names(), label).orderBy(*_names(), "label")
    sample = _assembled(stage(sample.coalesce(1), "url-sample"))  # one file in a fixed order: the same trees every time
    kinds = sample.select("label").distinct().count()
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=1).fit(sample) if kinds == 2 else None
    return UrlModel(model, statistics, share)


def judge(urls: DataFrame, model: UrlModel, id_col: str = "page_id", url_col: str = "url", rules=RULES,
          default: str = "allow") -> DataFrame:
    """id_col, host, path, rule (null: none fits), verdict, block_score (the trees' probability) of every row."""
    rows = _described(urls.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")), "url", rules)
    score = F.lit(None).cast("double")
    if model.trees is not None:
        rows = model.trees.transform(_assembled(_with_statistics(rows, model.statistics, model.share, False)))
        score = F.round(F.get(vector_to_array("probability"), 1), 9)
    rows = rows.withColumn("block_score", score)
    own = F.when(F.col("block_score") >= 0.5, "block").when(F.col("block_score").isNotNull(), "allow").otherwise(default)
    return rows.select(F.col("id").alias(id_col), "host", "path", F.col("fit.rule").alias("rule"),
                       F.coalesce("fit.action", own).alias("verdict"), "block_score")
