"""Missing-value words and type inference over text columns.

Inference is one aggregate over the whole table followed by one projection of
casts, so the number of jobs does not depend on the number of columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.functions.columns import column

# Words that mean "missing" in a delimited file (public
# pandas.read_csv documentation).
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Spellings of a boolean.
BOOLEAN_WORDS = ("True", "TRUE", "true", "False", "FALSE", "false")

_INTEGER = r"^\s*[+-]?[0-9]+\s*$"
_DECIMAL = r"(?i)^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity)\s*$"


#: What is counted of a column to choose its type.
_COUNTED = ("filled", "boolean", "integer", "fitting", "decimal")


@dataclass(frozen=True)
class ColumnTypes:
    """Chosen type per column plus what the same pass counted."""

    types: dict[str, str]
    rows: int
    extra_counts: dict[str, int]


def na_normalise(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Turn the missing-value words of text columns into nulls."""
    text = set(_text_columns(df))
    chosen = text if columns is None else text.intersection(columns)
    return df.select(
        *[
            F.when(~column(c).isin(*NA_TOKENS), column(c)).alias(c) if c in chosen else column(c)
            for c in df.columns
        ]
    )


def _integer_like(c: Column) -> Column:
    return c.rlike(_INTEGER)


def _as_bigint(c: Column) -> Column:
    return c.try_cast("bigint")


def _choose(rows: int, filled: int, boolean: int, integer: int, fitting: int, decimal: int) -> str:
    if rows == 0:
        return "string"
    if filled == 0:
        return "double"
    if boolean == filled:
        return "boolean"
    if fitting < integer:
        return "string"
    if integer == filled:
        return "bigint"
    if decimal == filled:
        return "double"
    return "string"


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _column_counts(c: Column) -> Column:
    integer = _integer_like(c)
    return F.struct(
        F.count(c).alias("filled"),
        F.count_if(c.isin(*BOOLEAN_WORDS)).alias("boolean"),
        F.count_if(integer).alias("integer"),
        F.count_if(integer & _as_bigint(c).isNotNull()).alias("fitting"),
        F.count_if(c.rlike(_DECIMAL)).alias("decimal"),
    )


def type_counts(names: list[str], extra_counts: dict[str, Column] | None = None) -> list[Column]:
    """Aggregates that :func:`types_from_counts` chooses from, of one shape for any columns.

    ``extra_counts`` are conditions counted in the same pass.
    """
    return [
        F.count(F.lit(1)).alias("rows"),
        F.array(*[_column_counts(column(name)) for name in names]).alias("columns"),
        *[F.count_if(cond).alias(f"extra_{n}") for n, cond in (extra_counts or {}).items()],
    ]


def types_from_counts(names: list[str], counted: list[tuple[list[str], Row]]) -> dict[str, str]:
    """Types of columns from the counts of several parts, each with its own order of columns."""
    rows = sum(row["rows"] for _, row in counted)
    sums = {name: dict.fromkeys(_COUNTED, 0) for name in names}
    for order, row in counted:
        for name, counts in zip(order, row["columns"], strict=True):
            for kind in _COUNTED:
                sums[name][kind] += counts[kind]
    return {name: _choose(rows, *sums[name].values()) for name in names}


def infer_schema(df: DataFrame, extra_counts: dict[str, Column] | None = None) -> ColumnTypes:
    """Narrowest type that holds every value of each text column.

    Order: boolean, bigint, double, string. ``extra_counts`` are conditions
    counted in the same pass. Columns that are not text keep their type.
    """
    text = _text_columns(df)
    seen = df.agg(*type_counts(text, extra_counts)).first()
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    types |= types_from_counts(text, [(text, seen)])
    return ColumnTypes(types, seen["rows"], {n: seen[f"extra_{n}"] for n in extra_counts or {}})


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast text columns to the types chosen by :func:`infer_schema`."""

    def typed(name: str, kind: str) -> Column:
        c = column(name)
        if kind == "bigint":
            return _as_bigint(c).alias(name)
        if kind == "double":
            return c.try_cast("double").alias(name)
        if kind == "boolean":
            return (F.lower(c) == "true").alias(name)
        return c

    text = set(_text_columns(df))
    return df.select(*[typed(c, types[c]) if c in text else column(c) for c in df.columns])


def infer_types(df: DataFrame) -> DataFrame:
    """Typed copy of a table of text columns."""
    return apply_types(df, infer_schema(df).types)
