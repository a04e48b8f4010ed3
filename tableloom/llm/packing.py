"""Best-fit packing of documents into sequences, with conflicts.

A document's size and the capacity count words. No sequence holds two documents
of one source or of one cluster of duplicates.
Bins are ordered by what they have left and carry bitmaps of their sources and
clusters. A piece goes to the fullest bin that has room and no conflict: the
search starts at the first bin with enough left and goes on to its successors
until a compatible one is found. Documents are dealt to shards of bounded size,
and every shard packs its own bins.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.session import cut_lineage

#: Words of a sequence.
CAPACITY = 2_048
#: Pieces of a shard on average; bounds what a task holds.
SHARD_PIECES = 4_096


def bit_of(values: Sequence) -> list[int]:
    """A bit for each value that occurs more than once; null and single ones get none."""
    often = Counter(value for value in values if value is not None)
    bits = {value: 1 << i for i, value in enumerate(v for v, n in often.items() if n > 1)}
    return [bits.get(value, 0) for value in values]


def best_fit(
    sizes: Sequence[int], sources: Sequence, clusters: Sequence, capacity: int
) -> list[tuple[int, int]]:
    """Bin and offset of every piece, the largest placed first."""
    source_bits, cluster_bits = bit_of(sources), bit_of(clusters)
    placed: list[tuple[int, int]] = [(-1, -1)] * len(sizes)
    order: list[tuple[int, int]] = []
    held: list[tuple[int, int]] = []
    for piece in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size, mine = sizes[piece], (source_bits[piece], cluster_bits[piece])
        at = bisect_left(order, (size, -1))
        while at < len(order):
            has = held[order[at][1]]
            if not (has[0] & mine[0] or has[1] & mine[1]):
                break
            at += 1
        if at < len(order):
            left, number = order.pop(at)
        else:
            left, number = capacity, len(held)
            held.append((0, 0))
        placed[piece] = (number, capacity - left)
        held[number] = (held[number][0] | mine[0], held[number][1] | mine[1])
        insort(order, (left - size, number))
    return placed


def pieces(docs: DataFrame, capacity: int) -> DataFrame:
    """Documents cut into pieces of at most ``capacity``; an empty one is one empty piece."""
    parts = F.greatest(F.ceil(F.col("_size") / capacity), F.lit(1))
    cut = docs.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    first = F.col("piece") * capacity
    return cut.withColumn("first_word", first).withColumn(
        "n_words", F.least(F.lit(capacity), F.col("_size") - first)
    )


def pack(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Place of every document, or of every piece of those longer than ``capacity``.

    ``docs`` has ``doc_id``, ``_size``, ``_source`` and ``_cluster``. A null source
    or cluster conflicts with nothing. Pieces of a document share its
    cluster, so they never meet; repeated rows are packed like any others. Returns
    ``doc_id``, ``piece``, ``first_word``, ``n_words``, ``bin`` and ``offset``.

    Rows are dealt evenly whatever their keys are, so a hot source or
    cluster spreads over all shards.
    """
    rows = cut_lineage(
        pieces(docs, capacity).select(
            F.col("doc_id").cast("long"),
            "piece",
            "first_word",
            F.col("n_words").cast("long"),
            "_source",
            "_cluster",
        )
    )
    shards = max(1, -(-rows.count() // SHARD_PIECES))

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        listed = list(frames)
        if not listed:
            return
        frame = pd.concat(listed, ignore_index=True)
        named = ["n_words", "_cluster", "_source", "doc_id", "piece"]
        frame = frame.sort_values(named, ignore_index=True)
        keys = [
            [None if pd.isna(value) else value for value in frame[name]]
            for name in ("_source", "_cluster")
        ]
        placed = best_fit(frame["n_words"].tolist(), *keys, capacity)
        shard = TaskContext.get().partitionId()
        frame["bin"] = [(shard << 32) | number for number, _ in placed]
        frame["offset"] = [offset for _, offset in placed]
        yield frame[["doc_id", "piece", "first_word", "n_words", "bin", "offset"]].astype(
            {"doc_id": "Int64"}
        )

    return rows.repartition(shards).mapInPandas(
        packed,
        "doc_id long, piece long, first_word long, n_words long, bin long, offset long",
    )
