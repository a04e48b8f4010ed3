"""Questions, answers, profiling, catalog and relationships on small tables."""

import random

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tableloom import create_analyzer
from tableloom import operators as ops
from tableloom.functions import money_sum
from tableloom.operators.relationships import Relationship
from tableloom.plans.tables import DESCRIPTIONS, load
from tableloom.session import keep_matching


def values(df):
    return [tuple(row) for row in df.collect()]


# Questions


def test_average(sample):
    assert values(ops.column_average(sample, "A")) == [(3.0,)]


def test_spend_per_customer(customers, orders):
    result = ops.spend_per_customer(
        customers, orders, "customer_id", "customer_id", "amount", ["name", "country"]
    )
    assert sorted(values(result)) == [
        (1, "John Doe", "USA", 150.75),
        (2, "Jane Smith", "Canada", 200.75),
        (3, "Bob Johnson", "UK", 300.00),
    ]


def test_two_customers_of_one_name_stay_apart(spark, orders):
    twins = spark.createDataFrame([(1, "John"), (2, "John")], "customer_id bigint, name string")
    result = ops.spend_per_customer(twins, orders, "customer_id", "customer_id", "amount", ["name"])
    assert sorted(values(result)) == [(1, "John", 150.75), (2, "John", 200.75)]


@pytest.mark.parametrize(("name", "count"), [("John Doe", 2), ("Bob Johnson", 1), ("Nobody", 0)])
def test_orders_of_customer(customers, orders, name, count):
    result = ops.orders_of_customer(customers, orders, "customer_id", "customer_id", "name", name)
    assert values(result) == [(name, count)]


def test_keep_matching_with_and_without_broadcast(customers, orders):
    for bound in (0, 100):
        kept = keep_matching(orders, "customer_id", customers.where("name like 'J%'"), "customer_id", bound)
        assert kept.count() == 3


@pytest.fixture
def sales(spark):
    rows = [("US", 5000), ("UK", 3200), ("FR", 2900), ("DE", 4100), ("IT", 2300)]
    return spark.createDataFrame(rows, "country string, sales bigint")


@pytest.fixture
def population(spark):
    rows = [("us", 3000000), ("uk", 6000000), ("fr", 2100000), ("de", 3500000), ("it", 2000000)]
    return spark.createDataFrame(rows, "country string, population bigint")


def test_keys_that_differ_in_case(sales, population):
    right = population.withColumnRenamed("country", "code")
    joined = ops.case_insensitive_join(sales, right, "country", "code")
    assert sorted(values(joined))[0] == ("DE", 4100, "de", 3500000)
    best = ops.rank_by_ratio(joined, "country", "sales", "population", 2)
    assert [(r.country, r["rank"]) for r in best.orderBy("rank").collect()] == [("US", 1), ("FR", 2)]


def test_zero_denominator_ranks_last(spark):
    df = spark.createDataFrame([("a", 1, 0), ("b", 1, 4)], "k string, n int, d int")
    ranked = ops.rank_by_ratio(df, "k", "n", "d", 5).orderBy("rank").collect()
    assert [(r.k, r.ratio) for r in ranked] == [("b", 0.25), ("a", None)]


def test_filtered_count_and_projection(customers):
    assert values(ops.filtered_count(customers, F.col("country") == "USA")) == [(1,)]
    assert values(ops.filtered_count(customers, F.col("country") == "Mars")) == [(0,)]
    shown = ops.project_rows(customers, ["name"], ["customer_id"], 2)
    assert values(shown) == [("John Doe",), ("Jane Smith",)]


# Answers


def test_text_answer(sample, customers):
    text = ops.answer_string(sample.select("A", "C").where("A < 3"), ["A"])
    assert [r.line for r in text.orderBy("A").collect()] == ["1, a", "2, b"]
    many = ops.answer_string(sample.sparkSession.range(1_001), ["id"])
    assert many.columns == ["id", "line"] and many.count() == 1_001


def test_answer_kind(sample):
    one = sample.agg(F.avg("A").alias("average"))
    assert ops.answer_auto(one, ["average"]).kind == "string"
    assert ops.answer_auto(one, ["average"]).value.first().answer == "3.0"
    assert ops.answer_auto(sample, ["A"]).kind == "dataframe"
    assert ops.answer_auto(sample.limit(0).select("A"), ["A"]).kind == "dataframe"
    assert ops.answer_auto(sample, ["A"], "chart").kind == "chart"
    assert ops.answer_auto(sample, ["A"], "string").kind == "string"
    assert ops.answer_auto(sample, ["A"], "hologram").kind == "string"


def test_bars(orders):
    bars = ops.chart_bars(orders, "product", F.sum("amount"), 2)
    assert values(bars) == [("shelf", 300.0), ("desk", 200.75)]


def test_amounts_small_and_large_add_up(spark):
    small = spark.range(1_000).select(F.lit("s").alias("k"), F.lit(0.004).alias("x"))
    large = spark.range(10).select(F.lit("l").alias("k"), F.lit(1e17).alias("x"))
    df = small.unionByName(large)
    assert values(ops.chart_bars(df, "k", money_sum("x"), 2)) == [("l", 1e18), ("s", 4.0)]
    assert values(ops.column_average(small, "x", scale=3)) == [(0.004,)]
    dated = df.withColumn("day", F.to_date(F.lit("2024-05-06")))
    assert values(ops.chart_series(dated.where("k = 's'"), "day", money_sum("x")))[0][1] == 4.0


def test_an_order_column_called_line(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "line int, x string")
    assert values(ops.answer_string(df, ["line"]).orderBy("line")) == [(1, "1, a"), (2, "2, b")]


def test_long_keys_are_not_broadcast(spark):
    keys = spark.range(3).select(F.repeat(F.lit("x"), 4 << 20).alias("k"), "id")
    keys = keys.select(F.concat("k", F.col("id").cast("string")).alias("k"))
    kept = keep_matching(spark.createDataFrame([("x",)], "t string"), "t", keys, "k")
    logical = kept._jdf.queryExecution().analyzed().toString()
    assert "hint" not in logical.lower() and kept.count() == 0


def test_histogram_edges(spark):
    numbers = [0.0, 1.0, 2.0, 2.5, 4.0, 10.0, None, float("nan")]
    df = spark.createDataFrame([(n,) for n in numbers], "x double")
    bins = ops.chart_histogram(df, "x", 5).orderBy("bin").collect()
    assert [(b.bin, b.bin_start, b.n_rows) for b in bins] == [
        (1, 0.0, 2), (2, 2.0, 2), (3, 4.0, 1), (4, 6.0, 0), (5, 8.0, 1),
    ]
    same = ops.chart_histogram(df.where("x = 4.0"), "x", 3).orderBy("bin").collect()
    assert [b.n_rows for b in same] == [1, 0, 0]
    assert ops.chart_histogram(df.where("x > 99 AND NOT isnan(x)"), "x", 3).count() == 0


def test_series(orders):
    dated = orders.withColumn("day", F.to_date("date"))
    series = ops.chart_series(dated, "day", F.sum("amount"), "month").orderBy("period").collect()
    assert [(str(r.period), r.measure) for r in series] == [
        ("2021-05-01", 301.25), ("2021-06-01", 350.25),
    ]


# Profiling


def test_preview_and_info(sample):
    assert values(ops.preview(sample, ["A"], 2)) == [(1, 10, "a"), (2, 20, "b")]
    with_null = sample.withColumn("C", F.when(F.col("A") > 2, F.col("C")))
    assert values(ops.column_info(with_null)) == [
        (0, "A", "bigint", 5, 0), (1, "B", "bigint", 5, 0), (2, "C", "string", 3, 2),
    ]
    empty = ops.column_info(sample.limit(0))
    assert [(r.non_null, r.nulls) for r in empty.collect()] == [(0, 0)] * 3


def skewed(kind):
    rnd = random.Random(3)
    if kind == "uniform":
        return [rnd.uniform(-5, 5) for _ in range(5_000)]
    if kind == "two values":
        return [0.0] * 2_500 + [1.0] * 2_500
    if kind == "one hot value":
        return [7.0] * 3_000 + [rnd.random() * 20 for _ in range(2_001)]
    return [10.0 ** rnd.uniform(-300, 300) for _ in range(3_000)]


@pytest.mark.parametrize("kind", ["uniform", "two values", "one hot value", "wide range"])
def test_exact_quartiles_of_large_columns(spark, kind):
    numbers = skewed(kind)
    df = spark.createDataFrame([(n,) for n in numbers], "x double").repartition(4)
    got = ops.table_stats(df, exact_values=10).first()
    expected = np.percentile(numbers, [25, 50, 75])
    assert got["count"] == len(numbers)
    assert [got.q25, got.q50, got.q75] == pytest.approx(list(expected), rel=1e-12)
    direct = ops.table_stats(df).first()
    assert [direct.q25, direct.q50, direct.q75] == pytest.approx(list(expected), rel=1e-12)


def test_stats_of_empty_and_missing(spark):
    df = spark.createDataFrame([(None, 1), (float("nan"), 2)], "x double, y int")
    x, y = ops.table_stats(df).collect()
    assert (x["count"], x["mean"], x.q50) == (0, None, None)
    assert (y["count"], y["mean"], y.q50, y["max"]) == (2, 1.5, 1.5, 2.0)


# Catalog and relationships


def test_catalog_names_views_and_collections(spark, sample, customers, orders):
    analyzer = create_analyzer(spark)
    assert not analyzer.has_data()
    analyzer.load_dataframe(sample, "2024-q1", "first quarter")
    analyzer.load_dataframe(sample, "2024_q1")
    analyzer.load_dataframe(customers, "My Customers")
    analyzer.load_dataframe(orders, "orders")
    assert analyzer.catalog.names == ["2024-q1", "2024_q1", "my_customers", "orders"]
    assert [t.view for t in analyzer.catalog.tables] == [
        "t_2024_q1", "t_2024_q1_v1", "my_customers", "orders",
    ]
    answer = analyzer.ask_sql(
        "SELECT name, count(*) AS n FROM my_customers JOIN orders USING (customer_id) "
        "WHERE name = :who GROUP BY name",
        who="John Doe",
    )
    assert values(answer) == [("John Doe", 2)]
    pair = analyzer.create_collection(["my_customers", "orders"], "shop", "customers and orders")
    assert pair.names == ["my_customers", "orders"]
    assert values(ops.tables_used(pair, "a1", answer)) == [("a1", "my_customers"), ("a1", "orders")]
    described = ops.describe_catalog(analyzer.catalog).orderBy("position").collect()
    assert (described[0].description, described[0].n_rows) == ("first quarter", 5)
    empty = create_analyzer(spark)
    empty.load_dataframe(sample.limit(0), "nothing")
    assert values(ops.list_tables(empty.catalog)) == [(0, "nothing", False)]
    analyzer.clear()
    assert not analyzer.has_data()
    assert "orders" not in [t.name for t in spark.catalog.listTables()]
    assert analyzer.overview().count() == 0


def test_two_analyzers_with_one_table_name(spark):
    first, second = create_analyzer(spark), create_analyzer(spark)
    first.load_dataframe(spark.range(3), "t")
    second.load_dataframe(spark.range(7), "t")
    count = "SELECT count(*) AS n FROM t"
    answers = [made.ask_sql(count) for made in (first, second)]
    assert [answer.first().n for answer in answers] == [3, 7]
    second.clear()
    assert first.ask_sql(count).first().n == 3
    with pytest.raises(AnalysisException):
        second.ask_sql(count)
    assert "t" not in [view.name for view in spark.catalog.listTables()]


def test_a_collection_is_a_scope_of_its_own(spark, customers, orders):
    analyzer = create_analyzer(spark)
    analyzer.load_dataframe(customers, "customers")
    analyzer.load_dataframe(orders, "orders")
    shop = analyzer.create_collection(["Orders"], "shop")
    count = "SELECT count(*) AS n FROM orders"
    assert analyzer.ask_collection("shop", count).first().n == 4
    with pytest.raises(AnalysisException):
        analyzer.ask_collection("shop", "SELECT * FROM customers")
    shop.clear()
    assert not shop.has_data() and analyzer.ask_sql(count).first().n == 4
    analyzer.create_collection(["customers"], "people")
    analyzer.clear()
    with pytest.raises(AnalysisException):
        analyzer.ask_sql(count)


def test_answers_of_two_scopes_meet_and_settings_carry_over(spark, orders):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        first, second = create_analyzer(spark), create_analyzer(spark)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert first.catalog.scope.conf.get("spark.sql.shuffle.partitions") == "5"
    first.load_dataframe(orders, "orders")
    second.load_dataframe(orders.where("amount > 100"), "orders")
    asked = "SELECT order_id FROM orders"
    assert first.ask_sql(asked).join(second.ask_sql(asked), "order_id").count() == 3


def test_tables_used_by_an_answer(spark, customers, orders, sample):
    analyzer, other = create_analyzer(spark), create_analyzer(spark)
    analyzer.load_dataframe(customers, "customers")
    analyzer.load_dataframe(orders, "2024 orders")
    analyzer.load_dataframe(sample, "sample")
    other.load_dataframe(sample.select("A", "B"), "sample")

    def used(answer):
        return [r.table_name for r in analyzer.tables_used("x", answer).collect()]

    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("tables-used", "")
    nested = analyzer.ask_sql(
        "SELECT (SELECT max(A) FROM sample) AS a FROM customers WHERE EXISTS "
        "(SELECT 1 FROM t_2024_orders o WHERE o.customer_id = customers.customer_id)"
    )
    rows = analyzer.tables_used("x", nested)
    assert not jobs.getJobIdsForGroup("tables-used")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [r.table_name for r in rows.collect()] == ["customers", "2024_orders", "sample"]
    assert used(analyzer.ask_sql("WITH sample AS (SELECT 1 AS c) SELECT 'customers' FROM sample")) == []
    by_hand = analyzer.get_dataframe("customers").join(customers.limit(0), "customer_id")
    assert used(by_hand) == ["customers"]
    twice = analyzer.ask_sql("SELECT a.A FROM sample a JOIN sample b ON a.A = b.B")
    assert used(twice) == ["sample"]
    assert used(other.ask_sql("SELECT A FROM sample")) == ["sample"]
    apart = spark.createDataFrame([(1,)], "A bigint")
    other.load_dataframe(apart, "sample")
    assert used(other.ask_sql("SELECT A FROM sample_v1")) == []


def test_counts_come_from_footers(spark, folder):
    analyzer = create_analyzer(spark)
    analyzer.load_parquet(f"{folder}/orders.parquet", "orders")
    for made in (analyzer.overview(), analyzer.describe(), ops.list_tables(analyzer.catalog)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [COUNT(*)]" in plan and "FileScan" not in plan
    analyzer.load_dataframe(analyzer.get_dataframe("orders").limit(5), "five")
    analyzer.load_dataframe(spark.range(0), "none")
    assert [(r.table_name, r.n_rows) for r in analyzer.overview().orderBy("position").collect()] == [
        ("orders", 15_000), ("five", 5), ("none", 0),
    ]
    listed = ops.list_tables(analyzer.catalog).orderBy("position").collect()
    assert [r.has_data for r in listed] == [True, True, False]


def test_check_relationship(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (None,)], "k bigint")
    parent = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "k bigint")
    row = ops.check_relationship(child, "k", parent, "k").first()
    assert row.asDict() == {
        "matched_rows": 3,
        "orphan_rows": 2,
        "null_rows": 1,
        "orphan_keys": 1,
        "duplicate_parent_keys": 1,
        "unused_parent_keys": 1,
    }


def test_suggestions_on_the_fixtures(customers, orders):
    found = ops.suggest_relationships({"customers": customers, "orders": orders}).collect()
    assert [(r.child_table, r.child_column, r.parent_table, r.containment) for r in found] == [
        ("orders", "customer_id", "customers", 1.0)
    ]


def test_suggestions_allow_some_orphans(spark, customers, orders):
    extra = orders.unionByName(orders.where("order_id = 101").withColumn("customer_id", F.lit(77)))
    tables = {"customers": customers, "orders": extra}
    assert ops.suggest_relationships(tables).count() == 0
    assert ops.suggest_relationships(tables, 0.7).first().containment == 0.75


def test_only_true_keys_of_all_shared_tables(spark, folder):
    tables = {name: load(spark, folder, name) for name in DESCRIPTIONS}
    found = {(r.child_table, r.parent_table) for r in ops.suggest_relationships(tables).collect()}
    assert {
        ("orders", "customer"), ("customer", "nation"), ("supplier", "nation"),
        ("lineitem", "orders"), ("lineitem", "part"), ("lineitem", "supplier"),
        ("nation", "region"), ("labels", "documents"),
    } == found


def test_many_columns_need_several_words(spark):
    wide = 70
    parent = spark.createDataFrame(
        [tuple(range(r, r + wide)) for r in range(3)], [f"k{i}" for i in range(wide)]
    )
    child = parent.limit(1).unionByName(parent.limit(1))
    found = ops.suggest_relationships({"parent": parent, "child": child}).collect()
    assert {(r.child_table, r.child_column, r.parent_column) for r in found} == {
        ("child", f"k{i}", f"k{i}") for i in range(wide)
    }
    assert {(r.child_distinct, r.matched) for r in found} == {(1, 1)}


def test_long_and_hot_values_of_a_relationship(spark):
    long_text = "x" * 100_000
    parent = spark.createDataFrame([(long_text,), ("b",), ("",), (None,)], "note string")
    child = spark.createDataFrame([(long_text,), ("b",), ("",), ("c",), (None,)] * 500, "note string")
    empty = parent.limit(0)
    other = spark.createDataFrame([(1,), (2,)], "note bigint")
    found = ops.suggest_relationships(
        {"p": parent, "c": child, "e": empty, "o": other}, 0.5
    ).collect()
    assert [tuple(r) for r in found] == [("c", "note", "p", "note", 4, 3, 0.75)]


def test_auto_join_keeps_children_and_refuses_fan_out(spark, customers, orders):
    lonely = orders.unionByName(
        spark.createDataFrame([(105, 42, "shelf", 1.0, "2021-07-01")], orders.schema)
    )
    tables = {"orders": lonely, "customers": customers}
    links = [Relationship("orders", "customer_id", "customers", "customer_id")]
    joined = ops.auto_join(tables, "orders", links)
    assert joined.count() == 5
    assert joined.where("order_id = 105").first().name is None
    assert "customers_customer_id" in joined.columns
    doubled = {"orders": lonely, "customers": customers.unionByName(customers)}
    with pytest.raises(ops.FanOutError):
        ops.auto_join(doubled, "orders", links)
    assert ops.auto_join(doubled, "orders", links, allow_fan_out=True).count() == 9
    with pytest.raises(ValueError):
        ops.auto_join({**tables, "x": customers}, "orders", [Relationship("x", "name", "orders", "order_id")])


def test_auto_join_reaches_a_parent_twice(spark, folder):
    tables = {t: load(spark, folder, t) for t in ("customer", "supplier", "nation", "lineitem", "orders")}
    links = [
        Relationship("lineitem", "l_orderkey", "orders", "o_orderkey"),
        Relationship("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        Relationship("orders", "o_custkey", "customer", "c_custkey"),
        Relationship("customer", "c_nationkey", "nation", "n_nationkey"),
        Relationship("supplier", "s_nationkey", "nation", "n_nationkey"),
    ]
    joined = ops.auto_join(tables, "lineitem", links)
    assert joined.count() == tables["lineitem"].count()
    wrong = joined.where(
        "c_nationkey != n_nationkey OR s_nationkey != supplier_s_nationkey_n_nationkey"
    )
    assert wrong.count() == 0


def test_relationships_through_the_analyzer(spark, customers, orders):
    analyzer = create_analyzer(spark)
    analyzer.load_dataframe(customers, "customers")
    analyzer.load_dataframe(orders, "orders")
    link = analyzer.add_relationship("orders", "customer_id", "customers", "customer_id")
    assert analyzer.check_relationship(link).first().matched_rows == 4
    assert analyzer.auto_join("orders").count() == 4
    assert analyzer.suggest_relationships().count() == 1
    assert analyzer.get_dataframe_preview("orders", 2).count() == 2
    assert analyzer.get_dataframe_stats("orders").count() == 3
    assert analyzer.get_dataframe_info("orders").count() == 5
    with pytest.raises(KeyError):
        analyzer.add_relationship("orders", "nope", "customers", "customer_id")
    with pytest.raises(KeyError):
        analyzer.get_dataframe("nope")
