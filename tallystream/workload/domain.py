"""Competition results and biographies derived from the driver's tables.

``events`` stands in for the results and ``customer`` for the biographies. The
derivations are SQL that Spark and DuckDB understand alike, so a query and its SQL
twin start from the same rows and differ only in the operator under test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Column -> expression over `events`; k is the number in its props.
_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"
RESULTS = {
    "edition": f"concat('Games ', CAST({_K} % 6 AS STRING))",
    "edition_id": f"{_K} % 6",
    "country_noc": "concat('NOC ', CAST(user_id % 25 AS STRING))",
    "sport": "event_type",
    "event": f"concat(CAST(100 * (1 + {_K} % 7) AS STRING), ' metres, ', "
    "CASE WHEN user_id % 2 = 0 THEN 'Men' ELSE 'Women' END)",
    "result_id": "CAST(event_id AS STRING)",
    "athlete": "concat('Éva-', CAST(user_id AS STRING), ' O''Neil')",
    "athlete_id": "CAST(user_id AS INT)",
    "pos": f"CAST({_K} AS STRING)",
    "medal": f"CASE {_K} % 4 WHEN 0 THEN 'Gold' WHEN 1 THEN 'Silver' WHEN 2 THEN 'Bronze' END",
    "isTeamSport": f"CASE WHEN {_K} % 2 = 0 THEN 'True' ELSE 'False' END",
}

# Column -> expression over `customer`; heights and weights are text as it arrives,
# with commas or dots, and some of it is not a number.
BIOGRAPHIES = {
    "athlete_id": "CAST(c_custkey AS STRING)",
    "name": "c_name",
    "sex": "CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END",
    "country_noc": "concat('NOC ', CAST(c_nationkey AS STRING))",
    "height": "CASE WHEN c_custkey % 11 = 3 THEN '' WHEN c_custkey % 13 = 3 THEN NULL "
    "WHEN c_custkey % 17 = 3 THEN '1,234,5' "
    "ELSE concat(CAST(150 + c_custkey % 60 AS STRING), ',', CAST(c_custkey % 10 AS STRING)) END",
    "weight": "CASE WHEN c_custkey % 19 = 3 THEN '63-66' WHEN c_custkey % 23 = 3 THEN 'NA' "
    "ELSE concat(' ', CAST(45 + c_custkey % 70 AS STRING), "
    "CASE WHEN c_custkey % 3 = 0 THEN ',' ELSE '.' END, CAST(c_custkey % 10 AS STRING)) END",
}

# Every 29th athlete has a second biography row.
DUPLICATED = "c_custkey % 29 = 1"

WAVES = 3
WAVE = f"event_id % {WAVES}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{expression} AS {name}" for name, expression in columns.items())


def results(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Typed result rows; ``extra`` are further expressions over ``events``."""
    columns = [f"{expression} AS {name}" for name, expression in RESULTS.items()]
    return table(spark, sf_dir, "events").selectExpr(*extra, *columns)


def biographies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw biography rows, with duplicates."""
    copies = f"explode(CASE WHEN {DUPLICATED} THEN array(1, 2) ELSE array(1) END) AS copy"
    columns = {
        **BIOGRAPHIES,
        "height": f"CASE copy WHEN 2 THEN '170,5' ELSE {BIOGRAPHIES['height']} END",
    }
    customer = table(spark, sf_dir, "customer").selectExpr("*", copies)
    return customer.selectExpr(*[f"{expression} AS {name}" for name, expression in columns.items()])


# A third of the results go to one athlete, whose biography is valid.
HOT_ATHLETE = 2
_SKEWED_ID = f"CASE WHEN event_id % 3 = 0 THEN {HOT_ATHLETE} ELSE athlete_id END"


def skewed_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    skewed = results(spark, sf_dir, "event_id")
    return skewed.selectExpr(*[
        f"{_SKEWED_ID} AS athlete_id" if c == "athlete_id" else c for c in skewed.columns if c != "event_id"
    ])


def skewed_records(rows: DataFrame) -> DataFrame:
    """The same for rows that know their event as ``offset``."""
    return rows.withColumn("athlete_id", F.expr(_SKEWED_ID.replace("event_id", "offset")))


RESULTS_SQL = f"SELECT event_id, {WAVE} AS wave, {_select(RESULTS)} FROM events"

SKEWED_RESULTS_SQL = (
    f"SELECT * REPLACE ({_SKEWED_ID} AS athlete_id) FROM (SELECT event_id, {WAVE} AS wave, {_select(RESULTS)} FROM events)"
)

BIOGRAPHIES_SQL = (
    f"SELECT {_select(BIOGRAPHIES)} FROM customer UNION ALL "
    f"SELECT {_select({**BIOGRAPHIES, 'height': repr('170,5')})} FROM customer WHERE {DUPLICATED}"
)

CLEAN_BIO_SQL = f"""
    SELECT TRY_CAST(athlete_id AS INTEGER) AS athlete_id, sex, country_noc,
           TRY_CAST(replace(height, ',', '.') AS FLOAT) AS height,
           TRY_CAST(replace(weight, ',', '.') AS FLOAT) AS weight
    FROM ({BIOGRAPHIES_SQL})
    WHERE TRY_CAST(replace(height, ',', '.') AS FLOAT) IS NOT NULL
      AND TRY_CAST(replace(weight, ',', '.') AS FLOAT) IS NOT NULL
"""

JOINED_SQL = f"""
    SELECT r.wave, r.result_id, r.sport, r.medal, b.sex, b.country_noc AS bio_country_noc,
           b.height, b.weight
    FROM ({RESULTS_SQL}) r JOIN ({CLEAN_BIO_SQL}) b ON r.athlete_id = b.athlete_id
"""

TALLY_COLUMNS_SQL = """sport, medal, sex, bio_country_noc,
    round(avg(CAST(height AS DOUBLE)), 6) AS avg_height,
    round(avg(CAST(weight AS DOUBLE)), 6) AS avg_weight,
    count(*) AS athlete_count"""

TALLY_SQL = f"""
    SELECT {TALLY_COLUMNS_SQL} FROM ({JOINED_SQL}) GROUP BY sport, medal, sex, bio_country_noc
"""

SKEWED_TALLY_SQL = TALLY_SQL.replace(RESULTS_SQL, SKEWED_RESULTS_SQL)

# White space as the cleaning expression sees it, spelled out for an ASCII-only \s.
_SPACE = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def clean_sql(expression: str) -> str:
    return f"regexp_replace(lower(coalesce({expression}, '')), '[^a-z0-9{_SPACE}]', '', 'g')"
