"""Physical plans: pruning, pre-aggregation, no Python in the data path."""

import pytest

import __spark_entry__ as contract
from tableloom import operators as ops
from tableloom.operators.relationships import Relationship, comparable_columns, value_index
from tableloom.plans.queries import QUERIES
from tableloom.plans.tables import DESCRIPTIONS, load
from tableloom.session import keep_matching, scratch_path


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_cross_join(spark, folder, name):
    plan = plan_of(QUERIES[name](spark, folder))
    for word in ("ArrowEvalPython", "BatchEvalPython", "InPandas", "CartesianProduct", "NestedLoop"):
        assert word not in plan, word


def test_last_messages_are_limited_before_the_shuffle(spark, folder):
    plan = plan_of(contract.queries()["memory_last_n"](spark, folder))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_orders_are_summed_before_the_join(spark, folder):
    plan = plan_of(contract.queries()["spend_per_customer"](spark, folder))
    assert plan.index("BroadcastHashJoin") < plan.index("partial_sum(cast(o_totalprice")
    assert "o_orderdate" not in plan and "c_acctbal" not in plan


def test_filters_reach_the_scan(spark, folder):
    plan = plan_of(contract.queries()["filtered_count"](spark, folder))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan


def test_contexts_read_only_what_they_show(spark):
    log = scratch_path(spark, "log")
    spark.createDataFrame(
        [(1, 0, "user", "q", "text", "x")],
        "conv_id bigint, turn bigint, role string, text string, type string, extra string",
    ).write.parquet(log)
    plan = plan_of(ops.context_per_question(spark.read.parquet(log), 3, with_text=True))
    assert "ReadSchema: struct<conv_id:bigint,turn:bigint,role:string,text:string>" in plan


def test_first_question_shuffles_once(spark, folder):
    plan = plan_of(contract.queries()["first_question"](spark, folder))
    assert plan.count("Exchange") == 1


@pytest.fixture
def small_thresholds(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture
def hot_children(spark):
    """A third of the rows refer to one parent and a tenth to none."""
    key = "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 10 = 1 THEN NULL ELSE id END"
    return spark.range(0, 60_000, 1, 8).selectExpr("id AS child_id", f"{key} AS ref")


def test_hot_key_is_split_in_auto_join(spark, small_thresholds, hot_children):
    parents = spark.range(60_000).selectExpr("id AS parent_id", "concat('p', id) AS name")
    joined = ops.auto_join(
        {"child": hot_children, "parent": parents},
        "child",
        [Relationship("child", "ref", "parent", "parent_id")],
    )
    assert len(joined.collect()) == 60_000
    assert "skew=true" in plan_of(joined)


def test_hot_key_is_split_when_keys_are_too_many_to_broadcast(
    spark, small_thresholds, hot_children
):
    keys = spark.range(30_000).withColumnRenamed("id", "k")
    kept = keep_matching(hot_children, "ref", keys, "k", rows=10)
    expected = hot_children.where("ref < 30000").count()
    assert len(kept.collect()) == expected
    assert "skew=true" in plan_of(kept)


def test_branches_are_joined_before_the_fact(spark, folder, small_thresholds):
    plan = plan_of(QUERIES["auto_join"](spark, folder))
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "l_orderkey" in line)
    # what stands above the scan is less and less indented
    depth, above = lines[scan].index("FileScan"), 0
    for line in reversed(lines[:scan]):
        at = len(line) - len(line.lstrip(" :+-"))
        if at < depth:
            depth, above = at, above + ("Exchange hashpartitioning" in line)
    assert above == 3


def test_values_of_relationships_move_once_and_as_hashes(spark, folder):
    tables = {t: load(spark, folder, t) for t in DESCRIPTIONS}
    index, _ = value_index(tables, comparable_columns(tables))
    plan = plan_of(index)
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanges) == 1 and "hash_a" in exchanges[0]
    assert "partial_bit_or" in plan and plan.count("FileScan") == len({c.table for c in comparable_columns(tables)})
