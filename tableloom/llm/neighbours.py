"""Rows of a table together with the row that follows in the order of a key."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.llm.tables import partitions, texts, with_range

#: Stands for a null key, which comes first.
FIRST = -(2**63)
#: Ranges of the key for every partition, so that partitions are alike.
RANGES_PER_PARTITION = 4
READ = ("doc_id", "text", "_range", "_donated")


def with_donors(docs: DataFrame, ranges: int) -> DataFrame:
    """Texts numbered by range, and each range's first row once more for the range before.

    A row that stands for another range's first has ``_donated`` set.
    """
    rows = texts(docs, "doc_id", "text").withColumn("_order", F.xxhash64("text"))
    ranged = with_range(rows, "doc_id", ranges)
    key = F.coalesce("doc_id", F.lit(FIRST))
    firsts = (
        ranged.groupBy("_range")
        .agg(F.min(F.struct(key.alias("id"), "_order")).alias("first"))
        .orderBy("_range")
        .collect()
    )
    # one row per range, so bounded by the number of partitions
    listed = docs.sparkSession.createDataFrame(
        [
            (row["_range"], row["first"]["id"], row["first"]["_order"], firsts[i - 1]["_range"])
            for i, row in enumerate(firsts)
        ],
        "_range int, _first_id long, _first_order long, _taker int",
    )
    is_first = (key == F.col("_first_id")) & (F.col("_order") == F.col("_first_order"))
    targets = F.when(is_first, F.array("_range", "_taker")).otherwise(F.array("_range"))
    spread = ranged.join(F.broadcast(listed), "_range").select(
        "doc_id", "text", "_order", F.posexplode(targets).alias("_place", "_target")
    )
    return spread.select(
        "doc_id",
        "text",
        "_order",
        F.col("_target").alias("_range"),
        (F.col("_place") == 1).alias("_donated"),
    )


def map_with_next(
    docs: DataFrame,
    made: Callable[[str, str], tuple],
    names: list[str],
    schema: str,
) -> DataFrame:
    """``made(text, text of the next row)`` for every row, in the order of ``doc_id``.

    The row after the last is the first. Rows of equal ``doc_id`` follow by the
    hash of their text, null keys come first. Each text is shuffled once, and a
    worker holds the rows of one batch.
    """
    n = partitions(docs.sparkSession)
    rows = with_donors(docs, RANGES_PER_PARTITION * n)
    dealt = rows.repartition(n, "_range").sortWithinPartitions(
        "_range", "_donated", F.col("doc_id").asc_nulls_first(), "_order"
    )

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple | None = None
        for batch in batches:
            ids, results = [], []
            columns = [batch.column(name).to_pylist() for name in READ]
            for doc_id, text, place, donated in zip(*columns, strict=True):
                text = text or ""
                if waiting and waiting[2] == place:
                    ids.append(waiting[0])
                    results.append(made(waiting[1], text))
                waiting = None if donated else (doc_id, text, place)
            if ids:
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": pa.array(ids, pa.int64())}
                    | dict(zip(names, map(list, zip(*results, strict=True)), strict=True))
                )

    return dealt.mapInArrow(paired, f"doc_id long, {schema}")
