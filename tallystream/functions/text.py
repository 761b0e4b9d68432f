"""Text cleaning as one native expression."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Everything but ASCII letters, ASCII digits and Unicode white space. (?U) makes
# \s Unicode-aware; the four separators U+001C..U+001F count as white space in
# Python but not in Java, hence the explicit range.
UNWANTED = r"(?U)[^a-z0-9\s\x{1c}-\x{1f}]"


def clean_text(column: Column | str) -> Column:
    """NULL to '', lower case, unwanted characters deleted; spaces stay as they are."""
    text = F.col(column) if isinstance(column, str) else column
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), UNWANTED, "")


def _string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def clean_strings(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    exclude: Iterable[str] = (),
) -> DataFrame:
    """Clean every string column, or only ``columns``, but never ``exclude``.

    Numbers held as text are text too: '1.5' becomes '15' and '-3' becomes '3'.
    Name such columns in ``exclude`` if that is not wanted.
    """
    chosen = set(_string_columns(df) if columns is None else columns) - set(exclude)
    return df.select(
        [
            clean_text(F.col(_quoted(name))).alias(name) if name in chosen else F.col(_quoted(name))
            for name in df.columns
        ]
    )


def register_clean_functions(spark: SparkSession, df: DataFrame) -> list[str]:
    """Make ``clean_<column>`` callable from SQL for each string column of ``df``.

    The functions are SQL functions over the native expression, so a query using
    them is planned like one that spells the expression out.
    """
    names = [f"clean_{name}" for name in _string_columns(df)]
    for name in names:
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {_quoted(name)}(input STRING) RETURNS STRING "
            f"RETURN regexp_replace(lower(coalesce(input, '')), r'{UNWANTED}', '')"
        )
    return names
