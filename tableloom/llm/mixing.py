"""Mixing overlapping sources to target weights by a flow of least cost.

Documents are summed by the set of sources that they belong to. The capacity of
each such pattern is routed to the quotas of its sources; taking a pattern a
second time costs more than the first. Patterns that share no source with another
have no choice and get their source's quota by a grouped job. A pattern's share is
then filled with whole documents in a seeded order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tableloom.llm.flow import route
from tableloom.llm.tables import partitions
from tableloom.session import cut_lineage

#: Weights of the sources in their order, repeating.
WEIGHTS = (3, 1, 2)
#: Size of the mixture by that of all documents, and the most a document is taken.
TOTAL, REPEATS = 1.5, 2
SEED = 17
#: Rows out of the order that may fill what the last whole row in the order leaves.
FILLING_ROWS = 3
#: Bits of a digit of the seeded order.
DIGIT_BITS = 10


@dataclass(frozen=True)
class Plan:
    """``sources``: source, source_size, target; ``patterns``: _pattern, size, amount (words taken)."""

    sources: DataFrame
    patterns: DataFrame


def numbered(sources: DataFrame) -> DataFrame:
    """``source`` with its place ``n`` from 0 in the order of code points, null last.

    Ranges are sorted side by side; one row per range tells how many stand before it.
    """
    parts = partitions(sources.sparkSession)
    ranges = cut_lineage(
        sources.repartitionByRange(parts, F.asc_nulls_last("source"))
        .sortWithinPartitions(F.asc_nulls_last("source"))
        .withColumn("at", F.monotonically_increasing_id())
    )
    # the id of a row is its partition's number times 2 ** 33 and its place there
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    counts = ranges.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return (
        ranges.withColumn("part", part)
        .join(F.broadcast(starts), "part")
        .withColumn("n", F.col("start") + place)
        .drop("at", "part", "start")
    )


def shared_out(sources: DataFrame, weights: Sequence[float], total: float, most: float) -> DataFrame:
    """``source``, ``source_size`` and ``target``: shares of ``total`` by weight.

    A share stops at ``most`` times its size and the rest is shared again, until none
    is above; a round is one sum over the table.
    """
    cycled = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("n") % len(weights) + 1).cast("int")
    )
    cap = F.col("source_size") * F.lit(float(most))
    state = cut_lineage(
        sources.select("source", "source_size", cycled.alias("weight"), F.lit(False).alias("full"))
    )
    while True:
        row = state.agg(
            F.sum(F.when(~F.col("full"), F.col("weight"))).alias("weights"),
            F.sum(F.when(F.col("full"), cap)).alias("given"),
        ).first()
        if row["weights"] is None:
            break
        unit = (total - (row["given"] or 0.0)) / row["weights"]
        over = ~F.col("full") & (F.col("weight") * unit > cap)
        if state.where(over).isEmpty():
            break
        state = cut_lineage(state.withColumn("full", F.col("full") | over))
    share = cap if row["weights"] is None else F.when(F.col("full"), cap).otherwise(F.col("weight") * unit)
    return cut_lineage(state.select("source", "source_size", share.alias("target")))


def routed(
    patterns: DataFrame, members: DataFrame, sources: DataFrame, repeats: int
) -> DataFrame:
    """``_pattern`` and ``amount`` of the patterns that share a source with an overlapping one.

    Only these have a choice. They, and the quotas of their sources, reach the driver,
    where the flow is found.
    """
    spark = patterns.sparkSession
    several = members.where("n > 1")
    tied = cut_lineage(several.select(F.col("source").alias("tied")).distinct())
    same = F.col("source").eqNullSafe(F.col("tied"))
    listed = members.join(tied, same, "left_semi").collect()
    quotas = sources.join(tied, same, "left_semi").collect()
    place = {row["source"]: i for i, row in enumerate(in_order(quotas))}
    held: dict[str, list[int]] = {}
    sizes: dict[str, int] = {}
    for row in sorted(listed, key=lambda row: (row["_pattern"], place[row["source"]])):
        held.setdefault(row["_pattern"], []).append(place[row["source"]])
        sizes[row["_pattern"]] = row["size"]
    flows = route(
        list(sizes.values()),
        list(held.values()),
        [round(row["target"]) for row in in_order(quotas)],
        repeats,
    )
    made = [(pattern, sum(flow.values())) for pattern, flow in zip(sizes, flows, strict=True)]
    return spark.createDataFrame(made, "_pattern string, amount long")


def in_order(rows: Sequence[Row]) -> list[Row]:
    return sorted(rows, key=lambda row: (row["source"] is None, row["source"] or ""))


def planned(
    sized: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    total: float = TOTAL,
    repeats: int = REPEATS,
) -> Plan:
    """Targets of the sources and words taken of the patterns (``_pattern``, ``size``).

    A pattern of one source that no other pattern has goes to that source's target;
    this is a grouped job, however many sources there are.
    """
    patterns = cut_lineage(sized)
    listed = F.from_json("_pattern", "array<string>")
    members = cut_lineage(
        patterns.select("_pattern", "size", F.size(listed).alias("n"), F.explode(listed).alias("source"))
    )
    sources = members.groupBy("source").agg(F.sum("size").alias("source_size"))
    words = patterns.agg(F.sum("size")).first()[0] or 0
    targets = shared_out(numbered(sources), weights, total * words, repeats)
    flows = cut_lineage(routed(patterns, members, targets, repeats))
    target = targets.select(F.col("source").alias("of"), F.bround("target").cast("long").alias("alone"))
    single = (
        members.where("n = 1")
        .join(flows, "_pattern", "left_anti")
        .join(target, F.col("source").eqNullSafe(F.col("of")))
        .select("_pattern", F.col("alone").alias("amount"))
    )
    amounts = cut_lineage(patterns.join(single.unionByName(flows), "_pattern"))
    return Plan(targets, amounts)


def pattern_of(sources: Column) -> Column:
    return F.to_json(F.array_sort(F.array_distinct(sources)), {"ignoreNullFields": "false"})


def digit(level: int) -> Column:
    return F.shiftrightunsigned("_u", 64 - DIGIT_BITS * level).bitwiseAND(2**DIGIT_BITS - 1)


def borders(rows: DataFrame, plan: DataFrame, key: Column) -> DataFrame:
    """Per pattern the first ``key`` at which the sizes sum up beyond ``rest``.

    Returns the plan with ``at`` (that key), ``rest`` less what comes before it,
    and the rows and size of that key.
    """
    summed = rows.groupBy("_pattern", key.alias("at")).agg(
        F.sum("_size").alias("size"), F.count("*").alias("rows")
    )
    before = Window.partitionBy("_pattern").orderBy("at")
    running = summed.withColumn("sum", F.sum("size").over(before))
    first = (
        running.join(plan.select("_pattern", "rest"), "_pattern")
        .where(F.col("sum") > F.col("rest"))
        .groupBy("_pattern")
        .agg(F.min(F.struct("at", "sum", "size", "rows")).alias("met"))
    )
    return (
        plan.drop("at", "size", "rows")
        .join(first, "_pattern")
        .withColumn("rest", F.col("rest") - (F.col("met.sum") - F.col("met.size")))
        .select("*", "met.at", "met.size", "met.rows")
        .drop("met")
    )


def chosen(rows: DataFrame, plan: Plan) -> DataFrame:
    """``rows`` with ``copies``: how often the mixture takes each.

    Rows come in the order of a seeded hash ``_u``. The last one that fits is found
    digit by digit from sums, so a pattern is never sorted in one task. What is
    missing then is filled with the rows left whose sizes come nearest. Equal
    rows have equal places; if the share ends among them, each is taken with the
    probability that fits, by its row number.
    """
    spark = rows.sparkSession
    # the tables of the plan have one row per pattern; Spark broadcasts them if they are small
    start = cut_lineage(
        plan.patterns.select(
            "_pattern",
            F.when(F.col("size") > 0, F.expr("amount div size")).otherwise(0).cast("long").alias("full"),
            F.when(F.col("size") > 0, F.expr("amount % size")).otherwise(0).cast("long").alias("rest"),
        )
    )
    first = cut_lineage(borders(rows, start, digit(1)).withColumnRenamed("at", "at1"))
    inside = rows.join(first.select("_pattern", "at1"), "_pattern").where(
        digit(1) == F.col("at1")
    )
    second = cut_lineage(borders(inside, first, digit(2)).withColumnRenamed("at", "at2"))
    inside = inside.join(second.select("_pattern", "at2"), "_pattern").where(
        digit(2) == F.col("at2")
    )
    last = cut_lineage(borders(inside, second, F.col("_u")))
    known = cut_lineage(start.drop("rest").join(last.drop("full"), "_pattern", "left"))
    among_equals = (F.col("rows") > 1) & (
        F.pmod(F.xxhash64("_row"), F.lit(1 << 20)) * F.col("size") < F.col("rest") * (1 << 20)
    )
    more = (
        F.when(F.col("at1").isNull() | (digit(1) > F.col("at1")), False)
        .when(digit(1) < F.col("at1"), True)
        .when(digit(2) != F.col("at2"), digit(2) < F.col("at2"))
        .when(F.col("_u") != F.col("at"), F.col("_u") < F.col("at"))
        .otherwise(among_equals)
    )
    marked = rows.join(known, "_pattern").withColumn("more", more)
    # size still missing per pattern; None where the share ended among equal rows
    gap = known.select("_pattern", F.when(F.col("rows") == 1, F.col("rest")).alias("gap"))
    filling = spark.createDataFrame([], "filling long")
    for _ in range(FILLING_ROWS):
        gap, met = filled(marked.where(~F.col("more")), gap, filling)
        # written out, so that its size is known and the rows need not move to meet it
        filling = cut_lineage(filling.union(met))
    taken = F.col("more") | F.col("filling").isNotNull()
    copies = F.when(F.col("_size") > 0, F.col("full") + taken.cast("long")).otherwise(F.lit(0))
    return marked.join(filling, F.col("_row") == F.col("filling"), "left").withColumn("copies", copies.cast("long"))


def filled(left: DataFrame, gap: DataFrame, used: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The gaps after one more row for each pattern, and those rows: the nearest in size."""
    off = F.abs(F.col("_size") - F.col("gap"))
    met = cut_lineage(
        left.join(gap, "_pattern")
        .join(used, F.col("_row") == F.col("filling"), "left_anti")
        .where(off < F.col("gap"))
        .groupBy("_pattern")
        .agg(F.min(F.struct(off, "_u", "_row", "_size")).alias("met"))
    )
    after = gap.join(met, "_pattern").select(
        "_pattern", (F.col("gap") - F.col("met._size")).alias("gap")
    )
    return cut_lineage(after), met.select(F.col("met._row").alias("filling"))


def mix(sized: DataFrame) -> tuple[DataFrame, Plan]:
    """Copies that the mixture takes of every row, and its plan.

    ``sized`` has ``_size`` (words), ``_sources`` (array, null is a source too)
    and ``_id`` (what the seeded order depends on); its other columns are kept
    next to ``_pattern`` and ``copies``. Rows of size 0 are taken 0 times; without
    rows there are no sources. Equal seeds give equal mixtures.
    """
    rows = cut_lineage(
        sized.withColumn("_pattern", pattern_of(F.col("_sources")))
        .withColumn("_u", F.xxhash64(F.lit(SEED), "_id"))
        .withColumn("_row", F.monotonically_increasing_id())
        .drop("_sources")
    )
    plan = planned(rows.groupBy("_pattern").agg(F.sum("_size").alias("size")))
    made = chosen(rows, plan)
    return made.select(*[c for c in rows.columns if c not in ("_u", "_row")], "copies"), plan


def source_table(plan: Plan) -> DataFrame:
    """``_pattern`` of single sources with ``source_size`` and ``target``."""
    return plan.sources.select(pattern_of(F.array("source")).alias("_pattern"), "source_size", "target")
