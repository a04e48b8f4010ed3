"""Type inference against pandas, apart from the documented differences."""

import io

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tableloom.functions import NA_TOKENS, infer_schema, infer_types, na_normalise

KINDS = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string"}

CELLS = ["1", "-7", "+3", " 4 ", "007", "1.5", ".5", "2.", "1e5", "-1E-3", "inf", "-Infinity"]
CELLS += ["True", "FALSE", "true", "yes", "1d", "1_000", "0x1F", "2023-01-15", "abc", "1 2", "e5"]


@settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.sampled_from(CELLS), min_size=1, max_size=6))
def test_same_kind_and_values_as_pandas(spark, cells):
    theirs = pd.read_csv(io.StringIO("x\n" + "\n".join(cells) + "\n"))["x"]
    mine = infer_types(spark.createDataFrame([(c,) for c in cells], "x string"))
    expected = KINDS[str(theirs.dtype)]
    assert dict(mine.dtypes)["x"] == expected
    if expected != "string":
        assert [row.x for row in mine.collect()] == theirs.tolist()


def chosen(spark, *cells):
    return infer_schema(spark.createDataFrame([(c,) for c in cells], "x string")).types["x"]


def test_rules(spark):
    assert chosen(spark, "1", None) == "bigint"
    assert chosen(spark, "True", None) == "boolean"
    assert chosen(spark, None, None) == "double"
    assert chosen(spark) == "string"
    assert chosen(spark, "9223372036854775807") == "bigint"
    assert chosen(spark, "9223372036854775808") == "string"
    assert chosen(spark, "9223372036854775808", "1.5") == "string"
    assert chosen(spark, "True", "1") == "string"


def test_missing_words(spark):
    df = spark.createDataFrame([(t, t, 1) for t in (*NA_TOKENS, "ok", "Na")], "x string, y string, z int")
    cleaned = na_normalise(df, ["x"]).collect()
    assert [row.x for row in cleaned] == [None] * len(NA_TOKENS) + ["ok", "Na"]
    assert [row.y for row in cleaned] == [*NA_TOKENS, "ok", "Na"]
    assert [row.z for row in na_normalise(df).collect()] == [1] * len(cleaned)


def test_other_types_are_kept(spark):
    df = spark.createDataFrame([(1, "2")], "a int, b string")
    assert infer_types(df).dtypes == [("a", "int"), ("b", "bigint")]


def test_one_job_per_table(spark):
    df = spark.createDataFrame([tuple("123456789")], ", ".join(f"c{i} string" for i in range(9)))
    assert infer_schema(df).rows == 1
    assert set(infer_schema(df).types.values()) == {"bigint"}
