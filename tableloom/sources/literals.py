"""Tables from literal columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def from_columns(
    spark: SparkSession, columns: dict[str, list], schema: str | None = None
) -> DataFrame:
    """Table from a mapping of column name to values, all of one length."""
    if len({len(values) for values in columns.values()}) > 1:
        raise ValueError("All columns must be of the same length")
    rows = list(zip(*columns.values(), strict=True))
    return spark.createDataFrame(rows, schema or list(columns))
