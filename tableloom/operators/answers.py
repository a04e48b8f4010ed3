"""Shaping an answer: text, table, or the data behind a chart."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.functions.columns import column
from tableloom.functions.names import free_name

DATE_UNITS = ("day", "week", "month", "quarter", "year")


@dataclass(frozen=True)
class Answer:
    kind: str
    value: DataFrame


def answer_string(df: DataFrame, order_by: list[str], separator: str = ", ") -> DataFrame:
    """A text of any length: the order columns and a ``line`` for every row.

    A line joins the values by ``separator`` and leaves nulls out. The text is the
    lines in the order of the other columns; it is never gathered in one place. If
    an order column is itself called ``line``, the text is ``line_1``.
    """
    line = F.concat_ws(separator, *[column(c).cast("string") for c in df.columns])
    name = free_name("line", set(order_by), "_")
    return df.select(*[column(c) for c in order_by], line.alias(name))


def answer_table(df: DataFrame) -> DataFrame:
    """A table answer is the result as it is."""
    return df


def answer_auto(df: DataFrame, order_by: list[str], output_type: str | None = None) -> Answer:
    """Answer of the requested kind; without one, a single value becomes a text.

    An unknown kind gives a text of lines. A single value is read once, as the one
    ``answer``; two rows at most reach the driver.
    """
    if output_type is None:
        text = column(df.columns[0]).cast("string").alias("answer")
        seen = df.select(text).take(2) if len(df.columns) == 1 else []
        if len(seen) == 1:
            return Answer("string", df.sparkSession.createDataFrame(seen, "answer string"))
        output_type = "dataframe"
    if output_type in ("dataframe", "chart"):
        return Answer(output_type, answer_table(df))
    return Answer("string", answer_string(df, order_by))


def chart_bars(df: DataFrame, category: str, measure: Column, k: int) -> DataFrame:
    """The ``k`` categories with the highest measure, largest first."""
    return (
        df.groupBy(column(category).alias("category"))
        .agg(measure.alias("measure"))
        .orderBy(F.col("measure").desc_nulls_last(), F.col("category").asc())
        .limit(k)
    )


def chart_histogram(df: DataFrame, name: str, bins: int) -> DataFrame:
    """Rows per equal-width bin between the smallest and the largest value.

    The largest value belongs to the last bin. Empty bins are listed with 0.
    Nulls, NaN and infinite values belong to no bin.
    """
    values = df.select(column(name).cast("double").alias("x")).where(
        F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") < float("inf"))
    )
    low, high = values.agg(F.min("x"), F.max("x")).first()
    spark = df.sparkSession
    schema = "bin bigint, bin_start double, bin_end double, n_rows bigint"
    if low is None:
        return spark.createDataFrame([], schema)
    width = (high - low) / bins
    at = F.lit(1) if width == 0 else F.least(F.floor((F.col("x") - low) / width), F.lit(bins - 1)) + 1
    counts = values.groupBy(at.cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = spark.range(1, bins + 1).select(
        F.col("id").alias("bin"),
        (F.lit(low) + (F.col("id") - 1) * width).alias("bin_start"),
        (F.lit(low) + F.col("id") * width).alias("bin_end"),
    )
    # Both sides have at most ``bins`` rows.
    return edges.join(F.broadcast(counts), "bin", "left").select(
        "bin", "bin_start", "bin_end", F.coalesce("n", F.lit(0)).alias("n_rows")
    )


def chart_series(df: DataFrame, time: str, measure: Column, unit: str = "month") -> DataFrame:
    """Measure per period; from a day upwards the period is a date."""
    period = F.date_trunc(unit, column(time))
    if unit.lower() in DATE_UNITS:
        period = period.cast("date")
    return (
        df.where(column(time).isNotNull())
        .groupBy(period.alias("period"))
        .agg(measure.alias("measure"))
    )
