"""URL filter: host and path rules, and gradient-boosted trees for what no rule decides.

All of it are DataFrame expressions and Spark's own tree learner.  Features are
lexical: length, depth, digit ratio, entropy, parameter counts, and statistics of
host suffixes and of first path segments (the share of blocked URLs among the labelled
ones, smoothed).  The URLs that a rule decides are the labelled ones.

The trees are fitted on a bounded sample of labelled rows (``max_rows`` of each
verdict, by a hash of the URL); suffix statistics count all labelled rows, and every
URL is judged.

Defined results: a null URL, or one without ``://``, has an empty host and path.
Without labelled rows everything that no rule decides is allowed; with only one verdict
among them, it gets that verdict.  Repeated rows are judged alike.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.functions.stage import stage

MAX_ROWS = 5000


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parse_rules(lines: Sequence[str]) -> list[Rule]:
    """Rules from lines like ``block example.com/en/``; the longest come first."""
    rules = []
    for line in lines:
        verdict, rule = line.split()
        host, slash, path = rule.partition("/")
        rules.append(Rule(verdict, host, slash + path))
    return sorted(rules, key=lambda r: (-len(r.text), r.text))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, else null.  ``rules`` is a short list, a parameter of the run."""
    chosen = F.lit(None).cast("string")
    for r in reversed(rules):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        chosen = F.when(fits, F.lit(r.text)).otherwise(chosen)
    return chosen


def verdict_of(rule: Column, rules: Sequence[Rule]) -> Column:
    verdict = F.lit(None).cast("string")
    for r in rules:
        verdict = F.when(rule == r.text, F.lit(r.verdict)).otherwise(verdict)
    return verdict


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Features of the text alone."""
    text = F.coalesce(url, F.lit(""))
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    entropy = F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), lambda total, c: total - F.when(c == "", F.lit(0.0)).otherwise(share(c) * F.log2(share(c))))
    return {
        "url_length": F.length(text),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "host_depth": _count(host, "."),
        "path_depth": _count(path, "/"),
        "digit_ratio": _count(text, string.digits) / n,
        "entropy": F.round(entropy, 9),
        "parameters": F.when(F.instr(text, "?") > 0, 1 + _count(F.substring_index(text, "?", -1), "&")).otherwise(0),
        "fragment": (F.instr(text, "#") > 0).cast("int"),
        "secure": text.startswith("https:").cast("int"),
    }


SUFFIXES = {"top_label": lambda host, path: F.substring_index(host, ".", -1), "segment": lambda host, path: F.split_part(F.concat(path, F.lit("/")), F.lit("/"), F.lit(2))}


def _with_features(pages: DataFrame) -> DataFrame:
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    return pages.select("*", *[c.cast("double").alias(k) for k, c in lexical(url, host, path).items()], *[f(host, path).alias(k) for k, f in SUFFIXES.items()])


def _with_statistics(pages: DataFrame, statistics: dict[str, DataFrame], prior: float) -> DataFrame:
    """Joins each suffix's share of blocked URLs; the key side is left to Spark's size check and skew handling."""
    for k, table in statistics.items():
        pages = pages.join(table, k, "left").withColumn(f"{k}_blocked", F.coalesce(f"{k}_blocked", F.lit(prior)))
    return pages


def judge(pages: DataFrame, rule_lines: Sequence[str], max_rows: int = MAX_ROWS, rounds: int = 20, depth: int = 3) -> DataFrame:
    """page_id, host, path, rule, verdict and score (the trees' probability to block; null where a rule decides)."""
    rules = parse_rules(rule_lines)
    parts = pages.select("page_id", "url").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    ruled = parts.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("verdict", verdict_of(F.col("rule"), rules))
    full = _with_features(ruled)
    known = full.where(F.col("verdict").isNotNull()).withColumn("label", (F.col("verdict") == "block").cast("double"))
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # two rows at most
    out = ["page_id", "host", "path", "rule", "verdict"]
    if len(totals) < 2:
        other = "block" if 1.0 in totals else "allow"
        return ruled.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(other)).alias("verdict"), F.lit(None).cast("double").alias("score"))
    prior = totals[1.0] / (totals[0.0] + totals[1.0])
    statistics = {k: known.groupBy(k).agg(((F.sum("label") + prior) / (F.count("*") + 1)).alias(f"{k}_blocked")) for k in SUFFIXES}
    inputs = [*lexical(F.col("url"), F.col("host"), F.col("path")), *[f"{k}_blocked" for k in SUFFIXES]]
    vectors = VectorAssembler(inputCols=inputs, outputCol="features")
    columns = ["label", *inputs]
    named = _with_statistics(known, statistics, prior).select("url", *columns)
    order = [F.xxhash64("url"), F.col("url")]
    sample = stage(named.where("label = 0").orderBy(*order).limit(max_rows).unionByName(named.where("label = 1").orderBy(*order).limit(max_rows)).drop("url"), "urls").coalesce(8)
    model = GBTClassifier(featuresCol="features", labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=0.2, seed=1).fit(vectors.transform(sample))
    # Only what no rule decides goes through the trees.
    rest = _with_statistics(full.where(F.col("verdict").isNull()), statistics, prior)
    scored = model.transform(vectors.transform(rest)).withColumn("score", probability(F.col("probability")))
    judged = scored.select("page_id", "host", "path", "rule", F.when(F.col("score") > 0.5, "block").otherwise("allow").alias("verdict"), "score")
    return ruled.where(F.col("verdict").isNotNull()).select(*out, F.lit(None).cast("double").alias("score")).unionByName(judged)


def probability(vector: Column) -> Column:
    """The second entry of a vector of two."""
    from pyspark.ml.functions import vector_to_array

    return F.element_at(vector_to_array(vector), 2)
