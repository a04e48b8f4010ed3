"""Exact top-k inner products over an impact-ordered index, a score at a time.

Components become integers. The vectors are dealt to blocks; a block keeps, for
every dimension, its rows in segments of equal quantised impact. A query walks
the segments of all dimensions by descending gain, which is what a segment adds
at most above the least that its dimension adds to any row. Rows gather gains;
what a row has not met yet is less than the gain reached. The walk ends only
when the rows whose bound still reaches the ``k``-th best exact score are fewer
than the postings left would cost; those rows are scored exactly.

Blocks of candidates and slices of queries form a grid of cells. A task keeps
one block and streams the queries of its cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.functions.columns import column
from tableloom.llm.tables import partitions
from tableloom.session import cut_lineage

#: Components are multiplied by this and rounded down.
SCALE = 256.0
#: Integer components that share a quantised impact.
LEVEL = 4
#: Candidates of a block and queries of a slice, on average.
BLOCK_ROWS = 4096
SLICE_ROWS = 4096
#: Shares of the postings after which the walk may end.
CHECKPOINTS = (0.5, 0.65, 0.75, 0.85, 0.93)
#: Sums up to here are exact as doubles.
EXACT = 2**53
#: A row's gains and the number of its dimensions met are kept in one double.
MET = 2.0**40

CELLS = "query long, query_row long, vec long, score long"


class ImpactIndex:
    """Segments of equal quantised impact, by dimension, over the rows of a block.

    The segments of all dimensions stand one after the other, by dimension and rising
    impact, and so do their rows in ``postings``.
    """

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        n, width = rows.shape
        levels = rows // LEVEL
        order = np.argsort(levels, axis=0, kind="stable")
        sorted_levels = np.take_along_axis(levels, order, 0).T
        values = np.ascontiguousarray(np.take_along_axis(rows, order, 0).T).ravel()
        self.postings = np.ascontiguousarray(order.T).ravel()
        new = np.ones((width, n), bool)
        new[:, 1:] = sorted_levels[:, 1:] != sorted_levels[:, :-1]
        begins = np.flatnonzero(new)
        self.ends = np.append(begins, n * width)
        self.sizes = np.diff(self.ends)
        self.dimension = begins // max(n, 1)
        self.first = np.searchsorted(begins, np.arange(width) * n)
        self.low = np.minimum.reduceat(values, begins).astype(float) if n * width else np.empty(0)
        self.high = np.maximum.reduceat(values, begins).astype(float) if n * width else np.empty(0)
        self.exact = rows.astype(float)

    def _scores(self, found: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact: sums of components stay below ``EXACT``."""
        return (self.exact[found] @ query).astype(np.int64)

    def top(self, query: np.ndarray, k: int, barred: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Rows that may be among the ``k`` best, and their exact scores.

        All rows that reach the ``k``-th best score are among them, so ties are
        whole. The row ``barred`` is left out.
        """
        n, width = self.rows.shape
        used = np.count_nonzero(query)
        if not n or not used:
            found = np.flatnonzero(np.arange(n) != barred)
            return found, np.zeros(len(found), np.int64)
        query = query.astype(float)
        weights = query[self.dimension]
        reached = weights * np.where(weights > 0, self.high, self.low)
        floors = np.minimum.reduceat(reached, self.first)
        gains = reached - floors[self.dimension]
        most = np.maximum.reduceat(gains, self.first)
        # segments of dimensions that the query lacks add nothing and are not walked
        ready = weights != 0
        falling = np.argsort(np.where(ready, -gains, 1.0), kind="stable")
        walked = np.cumsum(self.sizes[falling])
        floor, left, done = floors.sum(), n * used, 0
        gathered, best = np.zeros(n), -np.inf
        for share in (*CHECKPOINTS, 1.0):
            at = min(int(np.searchsorted(walked, share * left)), len(falling) - 1)
            reach = gains[falling[at]] if share < 1 else 0.0
            now = np.flatnonzero(ready & (gains >= reach))
            if now.size:
                ready[now] = False
                sizes = self.sizes[now]
                done += int(sizes.sum())
                # the segments in reach are one run for each dimension, or few
                gaps = np.flatnonzero(np.diff(now) != 1)
                begins = self.ends[now[np.append(0, gaps + 1)]].tolist()
                ends = self.ends[now[np.append(gaps, len(now) - 1)] + 1].tolist()
                met = [self.postings[a:b] for a, b in zip(begins, ends, strict=True)]
                gathered += np.bincount(np.concatenate(met), np.repeat(gains[now] + MET, sizes), n)
            dimensions = np.floor(gathered / MET)
            bound = gathered - dimensions * (MET + reach)
            bound += floor + np.minimum(most, reach).sum()
            if 0 <= barred < n:
                bound[barred] = -np.inf
            if n > k:
                likely = np.argpartition(-bound, k - 1)[:k]
                if not 0 <= barred < n or barred not in likely:
                    best = max(best, float(self._scores(likely, query).min()))
            possible = np.flatnonzero(bound >= best) if best > -np.inf else np.flatnonzero(bound > -np.inf)
            if len(possible) * width <= left - done or share == 1:
                return possible, self._scores(possible, query)
        raise AssertionError("the last share walks all postings")


def plain_scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of components too large for doubles, held at the ends of 64 bits."""
    sums = rows.astype(object) @ query.astype(object)
    return np.array([min(max(int(x), -(2**63)), 2**63 - 1) for x in sums], np.int64)


def matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Lists of integers as rows, filled up with zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    made = np.zeros((len(lists), width), np.int64)
    made[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
    return made


def integer_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec`` (long), ``parts`` (array of long) and a row number, without rows that take no part."""
    given = column(vector)
    finite = F.forall(
        given,
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)),
    )
    return df.where(given.isNotNull() & finite).select(
        column(key).cast("long").alias("vec"),
        F.transform(given, lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("parts"),
        F.monotonically_increasing_id().alias("row"),
    )


def _cells(width: int, k: int, wide: bool):
    """Cells of a task: first the candidates of a cell, then its queries."""

    def best_of(rows, index, vecs, query, own) -> tuple[np.ndarray, np.ndarray]:
        if wide:
            found = np.arange(len(rows))
            scores = plain_scores(rows, query)
            found, scores = (found[found != own], scores[found != own])
        else:
            found, scores = index.top(query, k, own)
        keys, null = vecs
        if len(found) > k:
            reach = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            found, scores = found[reach], scores[reach]
        first = np.lexsort((keys[found], null[found], ~scores))[:k]
        return found[first], scores[first]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, rows, index = None, [], None, None
        vecs = place = ids = None
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            asked = batch.column("asked").to_numpy(zero_copy_only=False)
            change = np.flatnonzero((np.diff(cells) != 0) | (np.diff(asked.astype(int)) != 0)) + 1
            for begin, end in zip([0, *change], [*change, batch.num_rows], strict=True):
                if begin == end:
                    continue
                part = batch.slice(begin, end - begin)
                if cells[begin] != cell:
                    cell, held, rows = cells[begin], [], None
                if not asked[begin]:
                    held.append(part)
                    continue
                if not held:
                    continue
                if rows is None:
                    table = pa.Table.from_batches(held)
                    rows = np.concatenate([matrix(b.column("parts"), width) for b in held])
                    ids = table.column("vec")
                    vecs = (ids.fill_null(0).to_numpy(), ids.is_null().to_numpy())
                    place = {row: i for i, row in enumerate(table.column("row").to_pylist())}
                    index = None if wide else ImpactIndex(rows)
                made = []
                for query, key, number in zip(
                    matrix(part.column("parts"), width),
                    part.column("vec").to_pylist(),
                    part.column("row").to_pylist(),
                    strict=True,
                ):
                    found, scores = best_of(rows, index, vecs, query, place.get(number, -1))
                    made.append((key, number, found, scores))
                sizes = [len(found) for _, _, found, _ in made]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat([m[0] for m in made], sizes), pa.int64()),
                        pa.array(np.repeat([m[1] for m in made], sizes), pa.int64()),
                        ids.take(pa.array(np.concatenate([m[2] for m in made]))).combine_chunks(),
                        pa.array(np.concatenate([m[3] for m in made]), pa.int64()),
                    ],
                    ["query", "query_row", "vec", "score"],
                )

    return run


def top_products(
    df: DataFrame,
    key: str,
    vector: str,
    asked: Column,
    k: int,
    block_rows: int = BLOCK_ROWS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The ``k`` best scores of every query row against all other rows.

    ``asked`` picks the queries by the column ``vec``, the key as long. Score:
    inner product of ``floor(256 * x)`` of the components; shorter vectors count
    as filled up with zeros. Ties go to the smaller key, a null key last. Vectors
    that are null or hold null or non-finite components take no part. Repeated
    rows are rows of their own: each is a candidate for the others and, if asked,
    a query. Empty tables give no rows. Scores beyond 64 bits stay at their ends.
    """
    spark = df.sparkSession
    vectors = cut_lineage(integer_vectors(df, key, vector))
    size = F.aggregate(
        "parts", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x.cast("double")))
    )
    n, n_asked, width, largest = vectors.agg(
        F.count(F.lit(1)), F.count_if(asked), F.max(F.size("parts")), F.max(size)
    ).first()
    blocks = max(1, -(-n // block_rows))
    slices = max(1, -(-n_asked // slice_rows))
    width = width or 0
    largest = largest or 0.0
    wide = width * largest * (largest + LEVEL) >= min(EXACT // max(width, 1), MET / 4)
    mixed = F.xxhash64("row")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    candidates = vectors.select(
        "vec", "parts", "row", F.pmod(mixed, F.lit(blocks)).alias("block"), every(slices).alias("slice")
    ).withColumn("asked", F.lit(False))
    queries = vectors.where(asked).select(
        "vec", "parts", "row", every(blocks).alias("block"), F.pmod(mixed, F.lit(slices)).alias("slice")
    ).withColumn("asked", F.lit(True))
    cell = (F.col("block").cast("long") * slices + F.col("slice")).alias("cell")
    columns = [cell, "asked", "vec", "parts", "row"]
    grid = (
        candidates.select(*columns)
        .unionAll(queries.select(*columns))
        .repartitionByRange(min(blocks * slices, 8 * partitions(spark)), "cell")
        .sortWithinPartitions("cell", "asked")
    )
    found = grid.mapInArrow(_cells(width, k, wide), CELLS)
    rank = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec"))
    return (
        found.withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= k)
        .select(
            F.col("query").alias("query_id"), "rank", F.col("vec").alias("vec_id"), "score"
        )
    )
