"""Unique table names in upload order, for any number of files.

The rule, file by file: take the base name if it is free, else the first free
``base_v1``, ``base_v2``, ... A base can itself look like a generated name
(``data_v1.csv``), so it may find its own name taken, or take a number its
parent would have used.

``unique_names`` gives the same names without visiting the files one by one,
and without gathering the files of one base in one task:

* The n-th file of a base that does not get the base itself gets the n-th
  number that no other base took before. For most bases no number is taken, so
  the position within the base is the answer.
* A base ``x_v<k>`` that is present together with ``x`` is a rival for number
  ``k`` of ``x``. It wins if it arrives before ``x`` needs that number. With
  ``b`` lower numbers won by rivals and ``g`` files of ``x`` that already needed
  a number when the rival arrives, it wins exactly if ``b < k - g``.
* So a rival turns ``b`` into ``b + 1`` below a threshold and leaves it from there
  on. Maps of this kind compose: rivals in a row add to ``b`` one for each of a
  list of thresholds above it. Blocks of rivals are composed side by side, the
  maps are run through block by block, and then every block knows its ``b``.
* ``g`` depends on whether ``x`` itself lost its name to its own parent. Rivals
  are settled for both cases. A chain ``x``, ``x_v1``, ``x_v1_v1``, ... is then a
  chain of maps from "parent lost" to "lost", composed along the parts of the
  name. So neither long chains nor many rivals add jobs.
* Unions are written out before a running count reads them twice. This spares
  their joins a second run, and Spark 4.1 was seen to lose rows of a union whose
  parts are partitioned alike when both uses share an exchange.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.functions.columns import column
from tableloom.operators.ordered_groups import BLOCK_ROWS, OrderedGroups
from tableloom.session import cut_lineage, keep_matching

_SUFFIX = "_v[1-9][0-9]*"
_SUFFIXES = f"{_SUFFIX}(?=({_SUFFIX})*$)"
_GENERATED = r"(?s)^(.*)_v([1-9][0-9]*)$"
#: Rivals of one parent that a task composes at once.
_BLOCK_RIVALS = 4_096


def _numbered(base: Column, number: str, out: str) -> Column:
    return (
        F.when(F.col(number) == 0, base)
        .otherwise(F.concat(base, F.lit("_v"), F.col(number)))
        .alias(out)
    )


def _candidates(bases: DataFrame) -> DataFrame:
    """Bases that look like a generated name, as (parent, k, base, arrival)."""
    return bases.select(
        F.regexp_extract("base", _GENERATED, 1).alias("parent"),
        F.regexp_extract("base", _GENERATED, 2).try_cast("bigint").alias("k"),
        "base",
        "arrival",
    ).where(F.col("k").isNotNull())


def _rivals(bases: DataFrame) -> DataFrame:
    """Candidates whose parent is present and could reach their number at all.

    A parent needs no number above its number of files plus the numbers that
    rivals took; candidates above that win unopposed.
    """
    candidates = _candidates(bases)
    most = candidates.count()
    parents = bases.select(F.col("base").alias("parent"), F.col("files").alias("parent_files"))
    return (
        candidates.join(parents, "parent")
        .where(F.col("k") <= F.col("parent_files") + most)
        .drop("parent_files")
    )


def _needed_at_arrival(
    rivals: DataFrame, occurrences: DataFrame, groups: OrderedGroups
) -> DataFrame:
    """Add ``files_before``: files of the parent that came before a rival."""
    files = keep_matching(occurrences, "base", rivals, "parent").select(
        F.col("base").alias("parent"),
        "position",
        F.lit(1).cast("bigint").alias("is_file"),
        F.lit(None).cast("string").alias("base"),
    )
    arrivals = rivals.select(
        "parent",
        F.col("arrival").alias("position"),
        F.lit(0).cast("bigint").alias("is_file"),
        "base",
    )
    line = cut_lineage(files.unionByName(arrivals))
    by_parent = OrderedGroups(("parent",), "position", groups.levels, groups.block_rows)
    before = (
        by_parent.running_sum(line, F.col("is_file"), "files_before")
        .where(F.col("is_file") == 0)
        .select("base", "files_before")
    )
    return rivals.join(before, "base")


class _Won:
    """Map from the numbers won before a row of rivals to those won after it.

    The rivals win one more for every threshold above the numbers won before.
    """

    def __init__(self):
        self.thresholds: list[int] = []

    def after(self, before: int) -> int:
        return before + len(self.thresholds) - bisect_right(self.thresholds, before)

    def add(self, limit: int) -> None:
        """A further rival, which wins if less than ``limit`` numbers are won."""
        low, high = min(limit, 0) - len(self.thresholds) - 1, limit
        while low < high:
            middle = (low + high) // 2
            if self.after(middle) >= limit:
                high = middle
            else:
                low = middle + 1
        insort(self.thresholds, low)


def _groups_of(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows of sorted batches by key; only one group is held."""
    key, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            own = tuple(row[name] for name in keys)
            if own != key:
                if held:
                    yield key, held
                key, held = own, []
            held.append(row)
    if held:
        yield key, held


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    while made := list(islice(rows, size)):
        yield pa.RecordBatch.from_pylist(made, schema)


_MAPS = pa.schema(
    [("parent", pa.string()), ("block", pa.int64())]
    + [(f"{name}{case}", kind) for case in (0, 1) for name, kind in
       (("always", pa.int64()), ("above", pa.list_(pa.int64())))]
)
_MAPS_DDL = (
    "parent string, block bigint, always0 bigint, above0 array<bigint>, "
    "always1 bigint, above1 array<bigint>"
)
_STARTS = pa.schema(
    [("parent", pa.string()), ("block", pa.int64()), ("won0", pa.int64()), ("won1", pa.int64())]
)
_SETTLED = pa.schema(
    [("parent", pa.string()), ("k", pa.int64()), ("base", pa.string())]
    + [(f"wins{case}", pa.bool_()) for case in (0, 1)]
)


def _block_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The map of every block. Before it at most as many numbers are won as it has rivals before it,
    so higher thresholds are only counted and those that no number is below are left out."""

    def rows():
        for (parent, block), rivals in _groups_of(batches, "parent", "block"):
            made = {"parent": parent, "block": block}
            earlier = rivals[0]["rank"] - 1
            for case in (0, 1):
                won = _Won()
                for rival in rivals:
                    won.add(rival[f"limit{case}"])
                made[f"always{case}"] = sum(t > earlier for t in won.thresholds)
                made[f"above{case}"] = [t for t in won.thresholds if 0 < t <= earlier]
            yield made

    return _batches(rows(), _MAPS, 100)


def _block_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers won before each block; a parent's blocks come in order and pass one by one."""

    def rows():
        parent, won = None, [0, 0]
        for batch in batches:
            for row in batch.to_pylist():
                if row["parent"] != parent:
                    parent, won = row["parent"], [0, 0]
                yield {"parent": parent, "block": row["block"], "won0": won[0], "won1": won[1]}
                for case in (0, 1):
                    above = row[f"above{case}"]
                    won[case] += row[f"always{case}"] + len(above) - bisect_right(above, won[case])

    return _batches(rows(), _STARTS, 10_000)


def _wins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which rivals of a block win, in either case of their parent."""

    def rows():
        for _, rivals in _groups_of(batches, "parent", "block"):
            won = [rivals[0]["won0"], rivals[0]["won1"]]
            for rival in rivals:
                made = {name: rival[name] for name in ("parent", "k", "base")}
                for case in (0, 1):
                    made[f"wins{case}"] = won[case] < rival[f"limit{case}"]
                    won[case] += made[f"wins{case}"]
                yield made

    return _batches(rows(), _SETTLED, 10_000)


def _settle(rivals: DataFrame, block_rows: int) -> DataFrame:
    """``parent, k, base`` and who wins if the parent kept its name (0) or lost it (1)."""
    numbers = OrderedGroups.measure(rivals, ["parent"], "k", block_rows)
    limit = lambda lost: F.col("k") - F.greatest(
        F.lit(0), F.col("files_before") + lost - 1
    )
    size = min(block_rows, _BLOCK_RIVALS)
    ranked = cut_lineage(
        numbers.positions(rivals, "rank").select(
            "parent",
            "k",
            "base",
            "rank",
            F.expr(f"(rank - 1) div {size}L").alias("block"),
            limit(0).alias("limit0"),
            limit(1).alias("limit1"),
        )
    )
    blocks = lambda df: df.repartition("parent", "block").sortWithinPartitions(
        "parent", "block", "k"
    )
    maps = blocks(ranked).mapInArrow(_block_maps, _MAPS_DDL)
    starts = (
        maps.repartition("parent")
        .sortWithinPartitions("parent", "block")
        .mapInArrow(_block_starts, "parent string, block bigint, won0 bigint, won1 bigint")
    )
    started = ranked.join(starts, ["parent", "block"])
    return blocks(started).mapInArrow(
        _wins, "parent string, k bigint, base string, wins0 boolean, wins1 boolean"
    )


def _settle_all(
    rivals: DataFrame, occurrences: DataFrame, groups: OrderedGroups
) -> tuple[DataFrame, DataFrame]:
    """Settle all rivals.

    Returns the numbers won, as (base, k), and the bases whose own name was
    handed out before their first file arrived.
    """
    settled = cut_lineage(
        _settle(_needed_at_arrival(rivals, occurrences, groups), groups.block_rows)
    )
    # a name with all its parents: as many rows as it has suffixes
    steps = F.sequence(F.lit(0), F.regexp_count("base", F.lit(_SUFFIXES)) - 1)
    parts = settled.select("base", F.explode(steps).alias("step")).withColumn(
        "ancestor",
        F.expr(f"regexp_extract(base, concat('(?s)^(.*?)(?:{_SUFFIX}){{', step, '}}$'), 1)"),
    )
    known = settled.select(F.col("base").alias("ancestor"), "wins0", "wins1")
    chain = F.sort_array(F.collect_list(F.struct("step", "wins0", "wins1")))
    # parents above one that is no rival do not matter
    unbroken = F.filter(chain, lambda link, i: link["step"] == i)
    lost = F.aggregate(
        F.reverse(unbroken),
        F.lit(False),
        lambda parent_lost, link: ~F.when(parent_lost, link["wins1"]).otherwise(link["wins0"]),
    )
    outcomes = parts.join(known, "ancestor").groupBy("base").agg(lost.alias("lost"))
    decided = cut_lineage(settled.join(outcomes, "base").select("parent", "k", "base", "lost"))
    taken = decided.where("lost").select("base")
    won = decided.where("NOT lost").select(F.col("parent").alias("base"), "k")
    return won, taken


def _numbers(
    occurrences: DataFrame, won: DataFrame, taken: DataFrame, block_rows: int
) -> DataFrame:
    """(base, position, number) of every file; number 0 is the base itself.

    The n-th file in need of a number gets n plus the numbers won by rivals below
    it. The c-th free number lies above a won number k of rank j exactly if c > k - j.
    """
    ranks = OrderedGroups.measure(won, ["base"], "k", block_rows).positions(won, "rank")
    gaps = ranks.groupBy("base", (F.col("k") - F.col("rank")).alias("free_below")).agg(
        F.count(F.lit(1)).alias("won")
    )
    need = F.col("occurrence") - 1 + F.coalesce("shift", F.lit(0))
    needs = occurrences.join(taken.withColumn("shift", F.lit(1)), "base", "left").select(
        "base", "position", need.alias("need")
    )
    line = cut_lineage(
        needs.select(
            "base",
            "position",
            "need",
            (F.col("need") * 2).alias("slot"),
            F.lit(0).cast("bigint").alias("won"),
        ).unionByName(
            gaps.select(
                "base",
                F.lit(None).cast("bigint").alias("position"),
                F.lit(None).cast("bigint").alias("need"),
                (F.col("free_below") * 2 + 1).alias("slot"),
                "won",
            )
        )
    )
    slots = OrderedGroups.measure(line, ["base"], "slot", block_rows)
    number = F.when(F.col("need") == 0, 0).otherwise(F.col("need") + F.col("skipped"))
    return (
        slots.running_sum(line, F.col("won"), "skipped")
        .where(F.col("position").isNotNull())
        .select("base", "position", number.alias("number"))
    )


def unique_names(
    files: DataFrame,
    base: str,
    position: str,
    out: str = "table_name",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``out``, the unique name of each file.

    ``position`` is a unique integer giving the upload order.
    """
    arrivals = files.select(column(base).alias("base"), column(position).alias("position"))
    groups = OrderedGroups.measure(arrivals, ["base"], "position", block_rows)
    bases = arrivals.groupBy("base").agg(
        F.min("position").alias("arrival"), F.count(F.lit(1)).alias("files")
    )
    rivals = None
    if not _candidates(bases).isEmpty():
        # Written out, so that adaptive execution can split the join at a hot parent.
        rivals = cut_lineage(_rivals(cut_lineage(bases)))
    if rivals is None or rivals.isEmpty():
        keyed = files.withColumns({"_base": column(base), "_position": column(position)})
        by_base = OrderedGroups(("_base",), "_position", groups.levels, block_rows)
        return (
            by_base.positions(keyed, "_number")
            .withColumn("_number", F.col("_number") - 1)
            .withColumn(out, _numbered(F.col("_base"), "_number", out))
            .drop("_base", "_position", "_number")
        )
    occurrences = cut_lineage(groups.positions(arrivals, "occurrence"))
    won, taken = _settle_all(rivals, occurrences, groups)
    numbered = _numbers(occurrences, won, taken, block_rows).select(
        F.col("position").alias("_position"), _numbered(F.col("base"), "number", out)
    )
    return files.join(numbered, column(position) == F.col("_position")).drop("_position")
