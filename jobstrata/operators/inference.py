"""Types of text columns, told by all their values.

For each column one aggregate counts the values that are not null and, of these, those that fit
each type, so it combines before its one shuffle and merges over any parts of a table. A
column has the narrowest type that every value fits: int, bigint, double, boolean, date,
timestamp, or else string, as has one without values. Empty texts count as null, as they do when
such text is read with a schema.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^(NaN|[+-]?(Infinity|Inf))$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}:[0-9]{2})?$"


def _both(pattern: str, kind: str) -> Callable[[Column], Column]:
    return lambda c: c.rlike(pattern) & c.try_cast(kind).isNotNull()


# From narrow to wide. Types after double do not hold the ones before it.
FITS: dict[str, Callable[[Column], Column]] = {
    "int": _both(_WHOLE, "int"),
    "bigint": _both(_WHOLE, "bigint"),
    "double": lambda c: c.rlike(_NUMBER),
    "boolean": lambda c: F.lower(c).isin("true", "false"),
    "date": _both(_DATE, "date"),
    "timestamp": _both(_TIME, "timestamp"),
}


def infer_types(df: DataFrame) -> DataFrame:
    """position, column, type and filled, the number of values, of every text column."""
    counts = []
    for at, name in enumerate(df.columns):
        value = F.trim(F.col(f"`{name}`"))
        filled = F.nullif(value, F.lit(""))
        counts.append(F.count(filled).alias(f"n_{at}"))
        counts += [
            F.count(F.when(fits(filled), 1)).alias(f"{kind}_{at}") for kind, fits in FITS.items()
        ]
    rows = []
    for at, name in enumerate(df.columns):
        filled = F.col(f"n_{at}")
        told = F.when(filled == 0, "string")
        for kind in FITS:
            told = told.when(F.col(f"{kind}_{at}") == filled, kind)
        rows.append(
            F.struct(
                F.lit(at + 1).alias("position"),
                F.lit(name).alias("column_name"),
                told.otherwise("string").alias("type"),
                filled.alias("filled"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def inferred_schema(df: DataFrame) -> T.StructType:
    """The same as a schema; one row per column reaches the driver."""
    told = {row["column_name"]: row["type"] for row in infer_types(df).collect()}
    return T.StructType(
        [T.StructField(name, T._parse_datatype_string(told[name])) for name in df.columns]
    )
