"""The front door: loading under names, storing, collections."""

import pytest
from pyspark.sql import functions as F

from tableloom import create_analyzer
from tableloom import operators as ops
from tableloom.sources import LoadError


@pytest.fixture
def analyzer(spark):
    made = create_analyzer(spark)
    yield made
    made.clear()


def test_load_store_and_ask(analyzer, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text('country,sales,note\nUS,5000,"a\nb"\nUK,3200,NA\n')
    for store in (False, True):
        name = f"Sales {store}"
        df = analyzer.load_csv(str(path), name, "Sales per country", store=store)
        assert df.dtypes == [("country", "string"), ("sales", "bigint"), ("note", "string")]
        assert analyzer.get_dataframe(name).count() == 2
        # A stored table is read from Parquet, so filters and columns are pushed down.
        plan = df.where("sales > 4000").select("country")._jdf.queryExecution().executedPlan()
        assert ("GreaterThan(sales,4000)" in plan.toString()) is store
    total = analyzer.ask_sql("SELECT sum(sales) AS total FROM sales_true").first().total
    assert total == 8200
    assert analyzer.get_dataframe_preview("sales_true", 1).first().country == "UK"
    assert [t.description for t in analyzer.catalog.tables] == ["Sales per country"] * 2


def test_load_files(analyzer, tmp_path):
    (tmp_path / "My Data.csv").write_text("a\n1\n")
    (tmp_path / "notes.txt").write_text("x")
    paths = [str(tmp_path / "My Data.csv"), str(tmp_path / "notes.txt")]
    assert analyzer.load_files(paths) == ["Error loading notes.txt: Unsupported file format"]
    assert analyzer.catalog.names == ["my_data"]
    assert analyzer.has_data() and "My Data" in analyzer.catalog
    with pytest.raises(LoadError):
        analyzer.load_files(paths, on_error="fail")


def test_literal_and_parquet_tables(analyzer, folder):
    analyzer.load_columns({"a": [1, 2]}, "literal", schema="a bigint")
    analyzer.load_parquet(f"{folder}/nation.parquet", "nation")
    overview = analyzer.overview().orderBy("position").collect()
    assert [(r.table_name, r.n_rows, r.n_columns) for r in overview] == [
        ("literal", 2, 1), ("nation", 25, 3),
    ]
    collection = analyzer.create_collection(["nation"], "geo", "places")
    assert analyzer.collections["geo"] == (collection, "places")
    answer = analyzer.answer(analyzer.get_dataframe("literal"), ["a"], "string")
    assert [r.line for r in answer.value.orderBy("a").collect()] == ["1", "2"]


def test_series_finer_than_a_day(spark):
    df = spark.createDataFrame([("2024-01-01 10:20:00",), ("2024-01-01 10:50:00",)], "t string")
    hours = ops.chart_series(df.withColumn("t", F.to_timestamp("t")), "t", F.count("t"), "hour")
    assert [(str(r.period), r.measure) for r in hours.collect()] == [("2024-01-01 10:00:00", 2)]
