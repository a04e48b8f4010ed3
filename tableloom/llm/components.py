"""Connected components of a graph given as edges, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.session import cut_lineage


def _lowest(edges: DataFrame) -> DataFrame:
    """Each node with its smallest neighbour, written out so that joins on hot nodes can split."""
    return cut_lineage(edges.groupBy("a").agg(F.min("b").alias("low")))


def _content(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of the edges ``a``, ``b`` that is not its own root.

    The root is the smallest node of the component. Loops, repeated edges and
    both directions are allowed; edges with a null end are no edges. Every step
    is a grouping and a join written to the shared folder; the number of steps
    grows with the logarithm of the size of a component.
    """
    known = edges.where("a is not null and b is not null and a <> b")
    now = cut_lineage(
        known.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    seen = _content(now)
    while seen[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _lowest(both).withColumnRenamed("a", "u")
        # every larger neighbour of u meets the smallest node around u
        large = (
            both.join(low, both["a"] == low["u"])
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("u", "low").alias("b"))
            .distinct()
        )
        large = cut_lineage(large)
        low = _lowest(large).withColumnRenamed("a", "u")
        # the smaller neighbours of u meet the smallest of them, and so does u
        small = (
            large.join(low, large["a"] == low["u"])
            .where("b <> low")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .union(low.select(F.col("u").alias("a"), F.col("low").alias("b")))
            .distinct()
        )
        now = cut_lineage(small)
        content = _content(now)
        if content == seen:
            break
        seen = content
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
