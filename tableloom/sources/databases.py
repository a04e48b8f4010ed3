"""Tables of a SQL database, read by many tasks in ranges of one column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def partition_options(
    partition_column: str, lower: object, upper: object, partitions: int
) -> dict[str, str]:
    """Reader options for ``partitions`` parallel range queries.

    Rows outside the bounds are read by the first and the last range.
    """
    if partitions < 1:
        raise ValueError("partitions must be positive")
    return {
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: object,
    upper: object,
    partitions: int,
    fetch_rows: int = 10_000,
    **properties: str,
) -> DataFrame:
    """Read ``table`` in parallel; filters and column choice reach the database.

    A partition column is required: without one a single task would read the
    whole table.
    """
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, fetchsize=str(fetch_rows), **properties)
        .options(**partition_options(partition_column, lower, upper, partitions))
        .load()
    )
