"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.functions import (
    clean_strings,
    locale_numbers,
    parse_envelope,
    register_clean_functions,
    to_envelope,
)
from tallystream.operators import clean_biography, gold_counts, preview, require_columns
from tallystream.schemas import RESULT_EVENT
from tallystream.workload import domain
from tallystream.workload.domain import clean_sql, table


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_strings(table(spark, sf_dir, "documents"))


def clean_excluding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_strings(domain.results(spark, sf_dir), exclude=["result_id", "pos"])


def clean_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    register_clean_functions(spark, part)
    return part.selectExpr(
        "p_partkey", "clean_p_name(p_name) AS p_name", "clean_p_brand(p_brand) AS p_brand"
    )


def count_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_counts(clean_strings(domain.results(spark, sf_dir))).drop("timestamp")


def count_gold_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts with whether each row has its time."""
    counts = gold_counts(clean_strings(domain.results(spark, sf_dir)))
    return counts.withColumn("stamped", F.col("timestamp").isNotNull()).drop("timestamp")


def count_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = clean_strings(table(spark, sf_dir, "part").select("p_brand", "p_type", "p_size"))
    return gold_counts(part, ["p_brand", "p_type", "p_size"]).drop("timestamp")


def type_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locale_numbers(domain.biographies(spark, sf_dir))


def guard_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = domain.biographies(spark, sf_dir)
    return require_columns(raw, ["athlete_id", "height", "weight", "sex", "country_noc"])


def clean_bios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_biography(domain.biographies(spark, sf_dir))


def parse_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    envelope = to_envelope(domain.results(spark, sf_dir), ["athlete_id"])
    return parse_envelope(envelope, RESULT_EVENT)


def _malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh record quotes its id, every eleventh is no object at all."""
    quoted = F.format_string('{"athlete_id":"%d"}', "user_id")
    sound = F.format_string('{"extra":{},"sport":{"k":1},"athlete_id":%d}', "user_id")
    broken = (
        F.when(F.col("event_id") % 11 == 0, F.lit("[1, 2]"))
        .when(F.col("event_id") % 7 == 0, quoted)
        .otherwise(sound)
    )
    records = table(spark, sf_dir, "events").select("event_id", broken.alias("value"))
    return parse_envelope(records, RESULT_EVENT, ["athlete_id", "sport"], keep=["event_id"])


def parse_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _malformed(spark, sf_dir)
    return parsed.withColumn("athlete_id", F.col("athlete_id").cast("string"))


def parse_malformed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of the same records in their own type."""
    return _malformed(spark, sf_dir).select("event_id", "athlete_id")


def parse_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


def preview_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a default preview shows of each table."""
    parts = [
        preview(table(spark, sf_dir, name)).agg(F.lit(name).alias("name"), F.count("*").alias("n"))
        for name in ("events", "orders", "documents", "nation", "region")
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def preview_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many different rows of a preview are rows of its table."""
    parts = []
    for name in ("orders", "nation"):
        rows = table(spark, sf_dir, name)
        found = preview(rows).intersect(rows)
        parts.append(found.agg(F.lit(name).alias("name"), F.count("*").alias("n")))
    return parts[0].unionAll(parts[1])


QUERIES = {
    "clean_strings": clean_documents,
    "clean_strings_exclude": clean_excluding,
    "clean_sql_functions": clean_functions,
    "gold_counts": count_gold,
    "gold_counts_stamped": count_gold_stamped,
    "gold_counts_part": count_parts,
    "locale_number": type_numbers,
    "require_columns": guard_columns,
    "clean_biography": clean_bios,
    "json_parse": parse_results,
    "json_parse_malformed": parse_malformed,
    "json_parse_malformed_ids": parse_malformed_ids,
    "json_props": parse_props,
    "preview": preview_sizes,
    "preview_members": preview_members,
}

_PLAIN_RESULTS = f"SELECT {', '.join(domain.RESULTS)} FROM ({domain.RESULTS_SQL})"
_CLEANED_RESULTS = ", ".join(
    c if c in ("result_id", "pos", "edition_id", "athlete_id") else f"{clean_sql(c)} AS {c}"
    for c in domain.RESULTS
)

ORACLES = {
    "clean_strings": (
        f"SELECT doc_id, {clean_sql('text')} AS text, {clean_sql('lang')} AS lang, "
        f"{clean_sql('source')} AS source, n_chars FROM documents"
    ),
    "clean_strings_exclude": f"SELECT {_CLEANED_RESULTS} FROM ({domain.RESULTS_SQL})",
    "clean_sql_functions": (
        f"SELECT p_partkey, {clean_sql('p_name')} AS p_name, {clean_sql('p_brand')} AS p_brand "
        "FROM part"
    ),
    "gold_counts": (
        f"SELECT {clean_sql('sport')} AS sport, {clean_sql('country_noc')} AS country_noc, "
        f"{clean_sql('medal')} AS medal, count(*) AS medal_count "
        f"FROM ({domain.RESULTS_SQL}) GROUP BY 1, 2, 3"
    ),
    "gold_counts_stamped": (
        f"SELECT {clean_sql('sport')} AS sport, {clean_sql('country_noc')} AS country_noc, "
        f"{clean_sql('medal')} AS medal, count(*) AS medal_count, true AS stamped "
        f"FROM ({domain.RESULTS_SQL}) GROUP BY 1, 2, 3"
    ),
    "gold_counts_part": (
        f"SELECT {clean_sql('p_brand')} AS p_brand, {clean_sql('p_type')} AS p_type, p_size, "
        "count(*) AS medal_count FROM part GROUP BY 1, 2, 3"
    ),
    "locale_number": (
        "SELECT TRY_CAST(athlete_id AS INTEGER) AS athlete_id, name, sex, country_noc, "
        "TRY_CAST(replace(height, ',', '.') AS FLOAT) AS height, "
        "TRY_CAST(replace(weight, ',', '.') AS FLOAT) AS weight "
        f"FROM ({domain.BIOGRAPHIES_SQL}) "
        "WHERE TRY_CAST(replace(height, ',', '.') AS FLOAT) IS NOT NULL "
        "AND TRY_CAST(replace(weight, ',', '.') AS FLOAT) IS NOT NULL"
    ),
    "require_columns": domain.BIOGRAPHIES_SQL,
    "clean_biography": domain.CLEAN_BIO_SQL,
    "json_parse": _PLAIN_RESULTS,
    "json_parse_malformed": (
        "SELECT event_id, CASE WHEN event_id % 11 <> 0 AND event_id % 7 <> 0 "
        "THEN CAST(user_id AS VARCHAR) END AS athlete_id, "
        "CASE WHEN event_id % 11 <> 0 AND event_id % 7 <> 0 THEN '{\"k\":1}' END AS sport "
        "FROM events"
    ),
    "json_parse_malformed_ids": (
        "SELECT event_id, CASE WHEN event_id % 11 <> 0 AND event_id % 7 <> 0 "
        "THEN CAST(user_id AS INTEGER) END AS athlete_id FROM events"
    ),
    "json_props": (
        "SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events"
    ),
    "preview": " UNION ALL ".join(
        f"SELECT '{name}' AS name, least(count(*), 20) AS n FROM {name}"
        for name in ("events", "orders", "documents", "nation", "region")
    ),
    "preview_members": " UNION ALL ".join(
        f"SELECT '{name}' AS name, least(count(*), 20) AS n FROM {name}"
        for name in ("orders", "nation")
    ),
}
