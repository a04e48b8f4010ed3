"""Table names: derivation, collisions, view names."""

import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableloom.functions import file_extension, file_stem, table_name, view_name
from tableloom.operators import unique_names
from tableloom.functions.names import free_name
from tableloom.operators.catalog import safe_view_name
from tableloom.operators.unique_names import _Won

FILES = [
    "My Data.csv",
    "archive.tar.gz",
    "noext",
    ".hidden",
    "..csv",
    "a..CSV",
    ".a.b",
    "Ends.",
    "UPPER CASE NAME.XLSX",
    "x y  z.v1.csv",
]


def test_stem_extension_and_name(spark):
    df = spark.createDataFrame([(f,) for f in FILES], "f string")
    got = df.select(
        "f", file_stem(F.col("f")).alias("s"), file_extension(F.col("f")).alias("e"),
        table_name(F.col("f")).alias("n"),
    ).collect()
    for row in got:
        stem, extension = os.path.splitext(row.f)
        assert (row.s, row.e) == (stem, extension.lower()), row.f
        assert row.n == stem.lower().replace(" ", "_")


def test_view_names(spark):
    names = ["archive.tar", "2024-q1", "a-b", "plain", "ünï"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [row.v for row in df.select(view_name(F.col("n")).alias("v")).collect()]
    assert got == ["archive_tar", "t_2024_q1", "a_b", "plain", "_n_"]
    assert got == [safe_view_name(n) for n in names]


def name_all(spark, bases, **options):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bases)], "pos bigint, base string")
    named = unique_names(df, "base", "pos", **options)
    assert named.columns == ["pos", "base", "table_name"]
    return [row.table_name for row in named.orderBy("pos").collect()]


def loop(bases):
    used = set()
    return [free_name(b, used) for b in bases]


@pytest.mark.parametrize(
    ("bases", "expected"),
    [
        (["data", "data", "data"], ["data", "data_v1", "data_v2"]),
        (["data", "data_v1", "data"], ["data", "data_v1", "data_v2"]),
        (["data", "data", "data_v1"], ["data", "data_v1", "data_v1_v1"]),
        (["data_v2", "data", "data", "data"], ["data_v2", "data", "data_v1", "data_v3"]),
        (["a_v01", "a", "a", "a_v0"], ["a_v01", "a", "a_v1", "a_v0"]),
    ],
)
def test_stated_collisions(spark, bases, expected):
    assert loop(bases) == expected
    assert name_all(spark, bases) == expected
    assert name_all(spark, bases, block_rows=2) == expected


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    bases=st.lists(
        st.sampled_from(
            ["d", "d", "d", "d_v1", "d_v2", "d_v3", "d_v1_v1", "d_v1_v2", "e", "e_v2", "_v1", "d_v01"]
        ),
        min_size=1,
        max_size=60,
    ),
    block_rows=st.sampled_from([4, 65_536]),
)
def test_same_names_as_a_plain_loop(spark, bases, block_rows):
    assert name_all(spark, bases, block_rows=block_rows) == loop(bases)


@pytest.mark.parametrize("block_rows", [3, 65_536])
def test_long_chains_and_many_rivals(spark, block_rows):
    rnd = random.Random(block_rows)
    chain = ["c" + "_v1" * depth for depth in range(12)]
    rivals = [f"x_v{k}" for k in range(1, 60)] + [f"x_v2_v{k}" for k in range(1, 9)]
    bases = chain * 3 + rivals + ["x"] * 40 + ["x_v2"] * 6 + ["c"] * 5 + ["x_v5_v1_v1", "_v1", "_v1_v1"]
    for _ in range(2):
        rnd.shuffle(bases)
        assert name_all(spark, bases, block_rows=block_rows) == loop(bases)


def test_the_jobs_do_not_grow_with_the_chain(spark):
    def jobs(name, depth):
        bases = ["c" + "_v1" * d for d in range(depth)] * 2
        spark.sparkContext.setJobGroup(name, "")
        try:
            assert name_all(spark, bases) == loop(bases)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    assert jobs("short", 3) == jobs("long", 30)


@given(limits=st.lists(st.integers(-5, 40), max_size=60), start=st.integers(0, 30))
def test_numbers_won_compose(limits, start):
    won, number = _Won(), start
    for limit in limits:
        won.add(limit)
        number += number < limit
    assert won.after(start) == number


def test_one_name_for_most_files(spark):
    bases = ["hot"] * 3_000 + [f"cold_{i % 50}" for i in range(1_000)] + ["hot_v7", "hot_v2999"]
    assert name_all(spark, bases, block_rows=128) == loop(bases)
