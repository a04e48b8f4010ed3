"""Preview, column facts and exact statistics of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.functions.columns import column, quoted

#: Values that are sorted in one task; a range with more of them is narrowed first.
EXACT_VALUES = 20_000
_QUARTILES = (0.25, 0.5, 0.75)
#: Items of a quantile sketch, and three times the error of its ranks (its
#: published bound, 2.296 / k ** 0.9723, holds in 99 of 100 cases).
_SKETCH_ITEMS = 4_096
_MARGIN = 3 * 2.296 / _SKETCH_ITEMS**0.9723


def preview(df: DataFrame, order_by: list[str], rows: int = 5) -> DataFrame:
    """First rows in a stated order: each task keeps only ``rows`` candidates."""
    return df.orderBy(*[column(c) for c in order_by]).limit(rows)


def column_info(df: DataFrame) -> DataFrame:
    """Position, name, type, non-null and null count of each column; one pass."""
    counts = [F.count(column(f.name)) for f in df.schema.fields]
    # The pass yields one row; its counts are spread over one row per column.
    facts = [
        F.struct(
            F.lit(i).cast("bigint").alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            counts[i].alias("non_null"),
            (F.count(F.lit(1)) - counts[i]).alias("nulls"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(F.array(*facts).alias("facts")).select(F.inline("facts"))


def _numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _value(name: str) -> Column:
    c = column(name).cast("double")
    return F.when(~F.isnan(c), c)


def _around(share: float) -> list[float]:
    return [max(0.0, share - _MARGIN), min(1.0, share + _MARGIN)]


def _number(value: float) -> str:
    """A double as SQL, infinite ones included."""
    return f"double('{value!r}')"


def _sketch(values: Column) -> Column:
    """Mergeable sketch of the values, or null if there are none."""
    made = F.kll_sketch_agg_double(values, F.lit(_SKETCH_ITEMS))
    return F.when(F.count(values) > 0, made)


def _quantiles(sketch: Column, shares: list[float]) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(share) for share in shares]))


class _Target:
    """One order statistic (0-based rank) of a column, narrowed to a value range.

    The bounds are exclusive; None is no bound. ``below`` values lie under the
    range and ``inside`` values in it. ``proposal`` are two values between which
    the rank is likely to lie, and ``sketch`` is one of the values of the range.
    """

    def __init__(self, name: str, rank: int, values: int, proposal: list[float]):
        self.name, self.rank = name, rank
        self.low: float | None = None
        self.high: float | None = None
        self.below, self.inside = 0, values
        self.proposal = tuple(proposal)
        self.sketch: bytes | None = None
        self.value: float | None = None

    @property
    def text(self) -> str:
        return quoted(self.name)

    @property
    def range_id(self) -> tuple:
        return self.name, self.low, self.high

    @property
    def narrowed_id(self) -> tuple:
        return self.name, *self.proposal

    def _where(self, *conditions: str) -> str:
        bounds = [f"{self.text} > {_number(self.low)}"] if self.low is not None else []
        bounds += [f"{self.text} < {_number(self.high)}"] if self.high is not None else []
        return " AND ".join([*bounds, *conditions])

    def in_range(self) -> Column:
        return F.expr(f"CASE WHEN {self._where() or 'true'} THEN {self.text} END")

    def between(self) -> Column:
        low, high = map(_number, self.proposal)
        inside = self._where(f"{self.text} > {low}", f"{self.text} < {high}")
        return F.expr(f"CASE WHEN {inside} THEN {self.text} END")

    def places(self) -> Column:
        """Values of the range under and up to each proposal; equal proposals are counted once."""
        counts = [
            f"count_if({self._where(f'{self.text} {sign} {_number(value)}')})"
            for value in dict.fromkeys(self.proposal)
            for sign in ("<", "<=")
        ]
        return F.expr(f"array({', '.join(counts)})")

    def expected_between(self) -> float:
        return 3 * _MARGIN * self.inside

    def move(self, places: list[int]) -> bool:
        """Keep the part of the range that holds the rank; tells if it lies between the proposals."""
        low, high = self.proposal
        under_low, to_low, under_high, to_high = places * (4 // len(places))
        local = self.rank - self.below
        if under_low <= local < to_low:
            self.value = low
        elif under_high <= local < to_high:
            self.value = high
        elif local < under_low:
            self.high, self.inside = low, under_low
        elif local < under_high:
            self.low, self.high = low, high
            self.below += to_low
            self.inside = under_high - to_low
            return True
        else:
            self.low = high
            self.below += to_high
            self.inside -= to_high
        return False

    def pick(self, values: list[float]) -> None:
        self.value = values[self.rank - self.below]

    def shares(self) -> list[float]:
        return _around((self.rank - self.below) / max(1, self.inside - 1))


def _one_pass(df: DataFrame, wanted: dict) -> dict:
    """Aggregates by key, all computed in one pass over the table."""
    seen = df.agg(*[expr.alias(f"a{i}") for i, expr in enumerate(wanted.values())]).first()
    return dict(zip(wanted, seen, strict=True))


def _refine(df: DataFrame, targets: list[_Target], bound: int) -> None:
    """One pass: find the value of every target or shrink its range.

    The proposals come from sketches. Exact counts decide where the rank lies: at
    one of them, below, between or above, so no error of a sketch can enter. What
    lies between them is brought along: the values if they are few, else a sketch.
    """
    wanted: dict[tuple, Column] = {}
    for t in targets:
        if t.inside <= bound:
            # counted, so the list has a proven bound
            wanted["values", t.range_id] = F.sort_array(F.collect_list(t.in_range()))
            continue
        wanted["places", t.range_id, t.narrowed_id] = t.places()
        if t.proposal[0] == t.proposal[1]:
            continue
        if t.expected_between() <= bound:
            wanted["values", t.narrowed_id] = F.sort_array(F.collect_list(t.between()))
        else:
            wanted["sketch", t.narrowed_id] = _sketch(t.between())
    seen = _one_pass(df, wanted)
    for t in targets:
        narrowed = t.narrowed_id
        if t.inside <= bound:
            t.pick(seen["values", t.range_id])
            continue
        between = t.move(seen["places", t.range_id, narrowed])
        t.sketch = seen.get(("sketch", narrowed)) if between else None
        if between and ("values", narrowed) in seen:
            t.pick(seen["values", narrowed])


def _propose(df: DataFrame, targets: list[_Target]) -> None:
    """New proposals from the sketches at hand; a pass over the table only where one is missing."""
    missing = {t.range_id: _sketch(t.in_range()) for t in targets if t.sketch is None}
    made = _one_pass(df, missing) if missing else {}
    sketches = [t.sketch if t.sketch is not None else made[t.range_id] for t in targets]
    held = df.sparkSession.createDataFrame(
        [tuple(sketches)], ", ".join(f"s{i} binary" for i in range(len(targets)))
    )
    found = held.select(*[_quantiles(F.col(f"s{i}"), t.shares()) for i, t in enumerate(targets)])
    for t, proposal in zip(targets, found.first(), strict=True):
        t.proposal = tuple(proposal)


def _order_statistics(
    df: DataFrame, targets: list[_Target], bound: int
) -> dict[tuple[str, int], float]:
    """Values at the targets' ranks; a task sorts at most about ``bound`` values per rank."""
    still = targets
    while still:
        _refine(df, still, bound)
        still = [t for t in still if t.value is None]
        wide = [t for t in still if t.inside > bound]
        if wide:
            _propose(df, wide)
    return {(t.name, t.rank): t.value for t in targets}


def _between(low: float, high: float, share: float) -> float:
    """Linear interpolation that leaves equal and infinite neighbours as they are."""
    return low if low == high or share == 0 else low + (high - low) * share


def _quartiles(
    df: DataFrame, names: list[str], basics: dict, exact_values: int
) -> dict[str, list[float]]:
    spots = {n: [q * (basics[n]["count"] - 1) for q in _QUARTILES] for n in names}
    targets = []
    for n in names:
        seen = basics[n]
        for q, spot in enumerate(spots[n]):
            for rank in (int(spot), min(int(spot) + 1, seen["count"] - 1)):
                proposal = seen["around"][2 * q : 2 * q + 2]
                targets.append(_Target(n, rank, seen["count"], proposal))
    at = _order_statistics(df, targets, exact_values)
    result = {}
    for n in names:
        last = basics[n]["count"] - 1
        result[n] = [
            _between(at[n, int(s)], at[n, min(int(s) + 1, last)], s - int(s)) for s in spots[n]
        ]
    return result


def table_stats(
    df: DataFrame, columns: list[str] | None = None, exact_values: int = EXACT_VALUES
) -> DataFrame:
    """count, mean, std, min, quartiles and max of numeric columns.

    Quartiles are exact and interpolate linearly. ``percentile`` would gather all
    distinct values in one task. Here the pass for the other figures also builds a
    mergeable sketch per column, and a second one counts around the values that the
    sketches propose. Only if more than about ``exact_values`` values lie that close
    to a quartile, further passes narrow them by the same means.
    """
    names = columns if columns is not None else _numeric_columns(df)
    spark = df.sparkSession
    df = df.select(*[_value(n).alias(n) for n in names])
    around = [share for q in _QUARTILES for share in _around(q)]
    basics = {}
    if names:
        wanted = {
            n: F.struct(
                F.count(column(n)).alias("count"),
                F.avg(column(n)).alias("mean"),
                F.stddev_samp(column(n)).alias("std"),
                F.min(column(n)).alias("min"),
                F.max(column(n)).alias("max"),
                F.when(F.count(column(n)) > 0, _quantiles(_sketch(column(n)), around)).alias("around"),
            )
            for n in names
        }
        basics = _one_pass(df, wanted)
    quartiles: dict[str, list[float | None]] = {n: [None] * len(_QUARTILES) for n in names}
    filled = [n for n in names if basics[n]["count"]]
    if filled:
        quartiles.update(_quartiles(df, filled, basics, exact_values))
    rows = [
        (
            n,
            basics[n]["count"],
            basics[n]["mean"],
            basics[n]["std"],
            basics[n]["min"],
            *quartiles[n],
            basics[n]["max"],
        )
        for n in names
    ]
    return spark.createDataFrame(
        rows,
        "column_name string, count bigint, mean double, std double, min double, "
        "q25 double, q50 double, q75 double, max double",
    )
