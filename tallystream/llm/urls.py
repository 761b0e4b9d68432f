"""URL filters: host and path rules, and gradient-boosted trees on lexical features.

Expressions and the trees of Spark ML only; no Python runs on the executors.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.llm.tables import store, table

#: Labelled rows that the trees are fitted on, chosen by hash.
TRAINING_ROWS = 20_000
TREES = 20
DEPTH = 4
SMOOTHING = 5.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def by_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The rule that fits (host and path joined) and its verdict; the longest wins, null if none does."""
    which, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host + r.path), r)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        which = F.when(fits, rule.host + rule.path).otherwise(which)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return which, verdict


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _entropy(text: Column) -> Column:
    """Bits a character of ``text``; 0 if empty."""
    characters = F.split(text, "")
    size = F.greatest(F.length(text), F.lit(1)).cast("double")

    def add(total, c):
        p = F.size(F.filter(characters, lambda x: x == c)) / size
        return total - F.when(p > 0, p * F.log2(p)).otherwise(0.0)

    return F.when(F.length(text) == 0, 0.0).otherwise(
        F.aggregate(F.array_distinct(characters), F.lit(0.0), add)
    )


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Features of the url's own characters."""
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    size = F.greatest(F.length(url), F.lit(1)).cast("double")
    return {
        "length": F.length(url).cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "depth": _count(path, "/[^/]"),
        "host_labels": _count(host, r"[^.]+"),
        "digit_ratio": _count(url, "[0-9]") / size,
        "hyphens": _count(url, "[-_]"),
        "entropy": _entropy(url),
        "host_entropy": _entropy(host),
        "parameters": _count(query, "[^&]+"),
        "fragment": _count(url, "#"),
        "secure": url.startswith("https:").cast("double"),
        "dated": _count(path, "/(19|20)[0-9]{2}/"),
        "extension": _count(path, r"\.[A-Za-z0-9]{1,5}$"),
    }


_SUFFIXES = {"suffix_1": 1, "suffix_2": 2, "head": 0}


def suffixes(host: Column, path: Column) -> dict[str, Column]:
    """The last label of the host, the last two, and the first part of the path."""
    labels = F.split(host, r"\.")
    return {
        "suffix_1": F.substring_index(host, ".", -1),
        "suffix_2": F.when(F.size(labels) > 1, F.substring_index(host, ".", -2)).otherwise(host),
        "head": F.regexp_extract(path, "^/([^/]*)/", 1),
    }


def described(urls: DataFrame, rules=RULES) -> DataFrame:
    """``urls`` (id, url) with host, path, rule, rule_verdict, suffixes and lexical features."""
    base = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    host, path = F.col("host"), F.col("path")
    rule, verdict = by_rules(host, path, rules)
    return base.withColumns(
        {"rule": rule, "rule_verdict": verdict, **suffixes(host, path), **lexical(F.col("url"), host, path)}
    )


def with_suffix_statistics(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """Smoothed share of blocked urls for each suffix, counted over all labelled rows."""
    overall = labelled.agg(F.avg("label").alias("share")).first()["share"] or 0.5
    for name in _SUFFIXES:
        known = store(
            labelled.groupBy(name).agg(
                ((F.sum("label") + SMOOTHING * overall) / (F.count("*") + SMOOTHING)).alias(f"{name}_share")
            ),
            name,
        )
        rows = rows.join(known, name, "left").withColumn(
            f"{name}_share", F.coalesce(f"{name}_share", F.lit(overall))
        )
    return rows


def judge(urls: DataFrame, rules=RULES, rows: int = TRAINING_ROWS, seed: int = 7) -> DataFrame:
    """id, host, path, rule and verdict (allow or block) of every row of ``urls`` (id, url).

    A rule's verdict stands. The other urls get that of boosted trees, trained on the urls that
    rules decide: suffix statistics count all of them, the trees see about ``rows`` (those with
    the smallest hash of the url). A null url, or one without ``://``, has an empty host and
    path and no rule. If rules decide no url, or all alike, every other url gets the one verdict
    seen, or allow. Repeated rows are judged alike.
    """
    all_rows = store(described(urls, rules), "urls")
    labelled = all_rows.filter("rule IS NOT NULL").withColumn(
        "label", (F.col("rule_verdict") == "block").cast("double")
    )
    tally = labelled.agg(F.count("*").alias("n"), F.sum("label").alias("blocked")).first()
    columns = ["id", "host", "path", "rule"]
    if not tally["n"] or tally["blocked"] in (0, tally["n"]):
        other = "block" if tally["blocked"] else "allow"
        return all_rows.select(*columns, F.coalesce("rule_verdict", F.lit(other)).alias("verdict"))
    inputs = [*lexical(F.col("url"), F.col("host"), F.col("path")), *(f"{n}_share" for n in _SUFFIXES)]
    featured = with_suffix_statistics(all_rows, labelled)
    assembled = VectorAssembler(inputCols=inputs, outputCol="features").transform(featured)
    near = F.pmod(F.xxhash64("url"), F.lit(1 << 32)) < int((1 << 32) * min(1.0, rows / tally["n"]))
    # A bounded sample, in one order, so that the trees do not depend on how rows are spread.
    sample = store(
        assembled.filter("rule IS NOT NULL").filter(near)
        .select((F.col("rule_verdict") == "block").cast("double").alias("label"), "url", "features")
        .repartitionByRange(1, "url"),
        "sample",
    ).select("label", "features")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=seed, minInstancesPerNode=5)
    scored = trees.fit(sample).transform(assembled)
    blocked = vector_to_array("probability")[1]
    verdict = F.coalesce("rule_verdict", F.when(blocked >= 0.5, "block").otherwise("allow"))
    return scored.select(*columns, verdict.alias("verdict"), blocked.alias("p_block"))


def op5_url_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url")
    return judge(pages).select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")
