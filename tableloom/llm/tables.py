"""Column access and order shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.functions.columns import column
from tableloom.llm.words import in_pieces

#: Words of the contracts: runs of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns only, so that others neither travel nor clash."""
    return docs.select(*[column(name).alias(name) for name in names])


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def whole(value: object) -> str:
    """A text, with null as the empty text."""
    return value if isinstance(value, str) else ""


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_range(df: DataFrame, key: str, ranges: int, name: str = "_range") -> DataFrame:
    """Number consecutive ranges of ``key`` from 0, with about as many rows each.

    The borders come from approximate quantiles of the key alone, so nothing
    else is read twice. Null keys come first. Equal keys share a range.
    """
    number = F.coalesce(F.col(key).cast("double"), F.lit(float("-inf")))
    steps = [i / ranges for i in range(1, ranges)]
    found = df.select(F.col(key).cast("double").alias("v")).approxQuantile(
        "v", steps, 0.2 / max(ranges, 1)
    )
    borders = sorted({*found, *([] if found else [0.0])})
    splits = [float("-inf"), *borders, float("inf")]
    made = Bucketizer(splits=splits, inputCol="_number", outputCol="_bucket").transform(
        df.withColumn("_number", number)
    )
    return made.withColumn(name, F.col("_bucket").cast("int")).drop("_number", "_bucket")


def keep_rows(docs: DataFrame, verdict: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """Whole rows of ``docs`` whose text gets True from ``verdict``, which sees pieces of a batch."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "text"):
            yield batch.filter(pa.array(verdict(batch.column("text")), pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
