"""Keyed hash against the standard library."""

import hashlib
import hmac

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableloom.functions import keyed_hash, matches_hash


def expected(text, salt):
    return hmac.new(salt.encode(), text.encode(), hashlib.sha256).hexdigest()


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    texts=st.lists(
        st.text(st.characters(blacklist_categories=["Cs"]), max_size=200), min_size=1, max_size=20
    ),
    salt=st.text(st.characters(blacklist_categories=["Cs"]), max_size=100),
)
def test_equals_hmac(spark, texts, salt):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [row.h for row in df.select(keyed_hash(F.col("t"), salt).alias("h")).collect()]
    assert got == [expected(t, salt) for t in texts]


def test_verify(spark):
    df = spark.createDataFrame([("password123",), ("Password123",), ("",), (None,)], "t string")
    stored = expected("password123", "s")
    got = df.select(matches_hash(F.col("t"), stored, "s").alias("ok")).collect()
    assert [row.ok for row in got] == [True, False, False, None]
