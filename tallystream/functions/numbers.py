"""Numbers that arrive as text, with a comma or a dot as decimal mark."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def locale_float(column: Column | str) -> Column:
    """Text to 32-bit float; every comma counts as a dot, unparsable text is NULL.

    ``try_cast`` keeps the NULL result with ANSI mode on or off.
    """
    value = F.col(column) if isinstance(column, str) else column
    return F.translate(value.cast("string"), ",", ".").try_cast("float")


def to_int(column: Column | str) -> Column:
    """To 32-bit integer; text that is not an integer, '12.7' included, is NULL.

    A number with a fraction would be cut off: see ``locale_numbers``.
    """
    value = F.col(column) if isinstance(column, str) else column
    return value.try_cast("int")


def _identifier(df: DataFrame, name: str) -> Column:
    """Fractions are NULL in columns of numbers too, which a database may hold."""
    if isinstance(df.schema[name].dataType, T.FractionalType):
        return F.when(F.col(name) == F.floor(name), to_int(name))
    return to_int(name)


def drop_unparsed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the rows in which all ``columns`` hold a value. NaN is a value."""
    return df.filter(reduce(Column.__and__, [F.col(c).isNotNull() for c in columns]))


def locale_numbers(
    df: DataFrame,
    measures: Sequence[str] = ("height", "weight"),
    identifiers: Sequence[str] = ("athlete_id",),
) -> DataFrame:
    """Type ``measures`` and ``identifiers`` in place, drop rows without all measures."""
    typed = {name: locale_float(name) for name in measures}
    typed.update({name: _identifier(df, name) for name in identifiers})
    return drop_unparsed(df.withColumns(typed), measures)
