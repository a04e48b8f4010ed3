"""Running sums and neighbour lookups inside ordered groups of any size.

A plain window puts a whole group into one task. Here a group (for example one
conversation) may hold a third of all rows, so a group is cut into blocks of
consecutive order values. A block holds at most ``block_rows`` rows as long as
``(keys, order)`` is unique. Only one small summary row per block travels
between blocks.

The span of the order column is measured once (one aggregate over a single
column). If it fits one block, no group can exceed a block and the plain window
is the cheapest right plan. Otherwise the blocked plan runs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tableloom.functions.columns import column, quoted

#: A window over this many rows is comfortable for one task; it can spill.
BLOCK_ROWS = 262_144


def _blocked(df: DataFrame, order: str, block_rows: int, out: str) -> DataFrame:
    return df.withColumn(out, F.expr(f"{quoted(order)} div {block_rows}L"))


def _running_sum(
    df: DataFrame,
    keys: list[str],
    order: str,
    value: Column,
    out: str,
    descending: bool,
    block_rows: int,
    levels: int,
    sums_of: DataFrame | None = None,
) -> DataFrame:
    direction = F.desc if descending else F.asc
    if levels == 0:
        rows = Window.partitionBy(*keys).orderBy(direction(quoted(order)))
        return df.withColumn(out, F.sum(value).over(rows.rowsBetween(Window.unboundedPreceding, 0)))

    block, carry = f"_block_{levels}", f"_carry_{levels}"
    blocked = _blocked(df, order, block_rows, block)
    summed = blocked if sums_of is None else _blocked(sums_of, order, block_rows, block)
    per_block = summed.groupBy(*keys, block).agg(F.sum(value).alias("_sum"))
    # Sum of all earlier blocks: the same scan, one level up, minus the own sum.
    carries = (
        _running_sum(
            per_block, keys, block, F.col("_sum"), carry, descending, block_rows, levels - 1
        )
        .withColumn(carry, F.col(carry) - F.col("_sum"))
        .where(F.col(carry) != 0)
        .select(*keys, block, carry)
    )
    rows = Window.partitionBy(*keys, block).orderBy(direction(quoted(order)))
    inside = F.sum(value).over(rows.rowsBetween(Window.unboundedPreceding, 0))
    # Hashing the few carries spares the rows a sort; each task holds only its share.
    return (
        blocked.join(carries.hint("shuffle_hash"), [*keys, block], "left")
        .withColumn(out, inside + F.coalesce(F.col(carry), F.lit(0)))
        .drop(block, carry)
    )


@dataclass(frozen=True)
class OrderedGroups:
    """Groups of rows ordered by an integer column, unique within each group."""

    keys: tuple[str, ...]
    order: str
    levels: int
    block_rows: int = BLOCK_ROWS

    @classmethod
    def measure(
        cls, df: DataFrame, keys: list[str], order: str, block_rows: int = BLOCK_ROWS
    ) -> OrderedGroups:
        """Derive the number of block levels from the span of ``order``."""
        low, high = df.agg(F.min(column(order)), F.max(column(order))).first()
        levels = 0
        while low is not None and high - low >= block_rows:
            low, high, levels = low // block_rows, high // block_rows, levels + 1
        return cls(tuple(keys), order, levels, block_rows)

    @property
    def bounded(self) -> bool:
        """True if every group is proven to fit one block."""
        return self.levels == 0

    def running_sum(
        self,
        df: DataFrame,
        value: Column,
        out: str,
        descending: bool = False,
        sums_of: DataFrame | None = None,
    ) -> DataFrame:
        """Add ``out``: sum of a non-null integer ``value`` up to and with each row.

        ``sums_of`` may name a cheaper frame with the same keys, order and
        values, from which the sums of the blocks are taken.
        """
        return _running_sum(
            df,
            list(self.keys),
            self.order,
            value,
            out,
            descending,
            self.block_rows,
            self.levels,
            sums_of,
        )

    def positions(self, df: DataFrame, out: str) -> DataFrame:
        """Add ``out``: 1-based position of each row in its group."""
        if self.bounded:
            rows = Window.partitionBy(*self.keys).orderBy(quoted(self.order))
            return df.withColumn(out, F.row_number().over(rows).cast("bigint"))
        return self.running_sum(df, F.lit(1).cast("bigint"), out)

    def with_neighbours(
        self,
        df: DataFrame,
        columns: dict[str, Callable[[WindowSpec], Column]],
        before: int = 0,
        after: int = 0,
    ) -> DataFrame:
        """Add window columns that look at most ``before``/``after`` rows away.

        ``columns`` maps a name to a function from the ordered window to a
        column. In the blocked plan the rows next to a block edge are sent to
        the blocks they reach as well, and these copies are dropped afterwards.
        """
        if self.bounded:
            window = Window.partitionBy(*self.keys).orderBy(quoted(self.order))
            return df.withColumns({name: make(window) for name, make in columns.items()})
        size = self.block_rows
        placed = self.positions(df, "_position").withColumn("_position", F.col("_position") - 1)
        own = F.expr(f"_position div {size}L")
        # every block with a row that may look at this one
        homes = F.expr(
            f"sequence(greatest(_position - {after}L, 0L) div {size}L, "
            f"(_position + {before}L) div {size}L)"
        )
        copies = placed.withColumn("_home", F.explode(homes))
        window = Window.partitionBy(*self.keys, "_home").orderBy("_position")
        return (
            copies.withColumns({name: make(window) for name, make in columns.items()})
            .where(F.col("_home") == own)
            .drop("_home", "_position")
        )
