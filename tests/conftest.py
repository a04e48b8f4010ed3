import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tableloom.session import build_session  # noqa: E402

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session(8, "tableloom-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


# The inputs of the three stated answers (average of A is 3.0; what each
# customer spent, by name and country; two orders of the first customer).


@pytest.fixture
def sample(spark):
    rows = [(1, 10, "a"), (2, 20, "b"), (3, 30, "c"), (4, 40, "d"), (5, 50, "e")]
    return spark.createDataFrame(rows, "A bigint, B bigint, C string")


@pytest.fixture
def customers(spark):
    return spark.createDataFrame(
        [
            (1, "John Doe", "new", "USA"),
            (2, "Jane Smith", "old", "Canada"),
            (3, "Bob Johnson", "old", "UK"),
        ],
        "customer_id bigint, name string, since string, country string",
    )


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(
        [
            (101, 1, "lamp", 100.50, "2021-05-03"),
            (102, 2, "desk", 200.75, "2021-05-30"),
            (103, 1, "lamp", 50.25, "2021-06-11"),
            (104, 3, "shelf", 300.00, "2021-06-12"),
        ],
        "order_id bigint, customer_id bigint, product string, amount double, date string",
    )
