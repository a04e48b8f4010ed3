"""Blocked scans equal plain windows, whatever the block size."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tableloom.operators import OrderedGroups


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(7)
    made = [(0, o) for o in rnd.sample(range(400), 200)]
    made += [(k, o) for k in range(1, 6) for o in rnd.sample(range(0, 90, 3), 12)]
    made += [(9, 3_000), (9, -5)]
    return spark.createDataFrame(
        [(k, o, rnd.randint(0, 4)) for k, o in made], "k bigint, o bigint, v bigint"
    ).cache()


def ordered(df):
    return [tuple(row) for row in df.orderBy("k", "o").collect()]


@pytest.mark.parametrize("block", [5, 64])
@pytest.mark.parametrize("descending", [False, True])
def test_running_sum(rows, block, descending):
    groups = OrderedGroups.measure(rows, ["k"], "o", block)
    assert not groups.bounded
    order = F.desc("o") if descending else F.asc("o")
    plain = Window.partitionBy("k").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    got = groups.running_sum(rows, F.col("v"), "s", descending)
    assert got.columns == ["k", "o", "v", "s"]
    assert ordered(got) == ordered(rows.withColumn("s", F.sum("v").over(plain)))


@pytest.mark.parametrize("block", [5, 64])
def test_positions_and_neighbours(rows, block):
    groups = OrderedGroups.measure(rows, ["k"], "o", block)
    plain = Window.partitionBy("k").orderBy("o")
    expected = rows.withColumn("p", F.row_number().over(plain).cast("bigint"))
    assert ordered(groups.positions(rows, "p")) == ordered(expected)
    columns = {
        "lead": lambda w: F.lead("v", 2).over(w),
        "lag": lambda w: F.lag("v").over(w),
        "near": lambda w: F.collect_list("o").over(w.rowsBetween(-4, -1)),
    }
    got = groups.with_neighbours(rows, columns, before=4, after=2)
    assert ordered(got) == ordered(rows.withColumns({n: f(plain) for n, f in columns.items()}))


def test_short_span_needs_no_blocks(rows):
    groups = OrderedGroups.measure(rows.where("k = 0"), ["k"], "o", 400)
    assert groups.bounded
    assert OrderedGroups.measure(rows.limit(0), ["k"], "o", 400).bounded


@pytest.mark.parametrize("reach", [6, 23])
def test_neighbours_beyond_a_block(rows, reach):
    def seen(block):
        columns = {
            "before": lambda w: F.collect_list("v").over(w.rowsBetween(-reach, -1)),
            "after": lambda w: F.collect_list("v").over(w.rowsBetween(1, reach)),
        }
        groups = OrderedGroups.measure(rows, ["k"], "o", block)
        return ordered(groups.with_neighbours(rows, columns, before=reach, after=reach))

    assert seen(5) == seen(10_000)
