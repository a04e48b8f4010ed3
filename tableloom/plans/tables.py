"""The shared test tables and the relationships between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tableloom.analyzer import Analyzer
from tableloom.operators.relationships import Relationship

DESCRIPTIONS = {
    "region": "Regions of the world",
    "nation": "Nations and their region",
    "customer": "Customers with balance and market segment",
    "supplier": "Suppliers with balance",
    "part": "Parts with brand, type and price",
    "orders": "Orders of customers",
    "lineitem": "Lines of orders",
    "events": "User events over time",
    "documents": "Texts with language and source",
    "embeddings": "Vectors with a label",
    "pages": "Web pages",
    "benchmark": "Benchmark texts",
    "labels": "Quality labels of documents",
    "conversations": "Messages of conversations",
}

RELATIONSHIPS = [
    Relationship("lineitem", "l_orderkey", "orders", "o_orderkey"),
    Relationship("lineitem", "l_partkey", "part", "p_partkey"),
    Relationship("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    Relationship("orders", "o_custkey", "customer", "c_custkey"),
    Relationship("customer", "c_nationkey", "nation", "n_nationkey"),
    Relationship("nation", "n_regionkey", "region", "r_regionkey"),
    Relationship("supplier", "s_nationkey", "nation", "n_nationkey"),
]


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def analyzer(spark: SparkSession, folder: str, names: list[str] | None = None) -> Analyzer:
    """Analyzer over the shared tables; ``names`` limits which are registered."""
    made = Analyzer(spark)
    for name in names or list(DESCRIPTIONS):
        made.load_parquet(f"{folder}/{name}.parquet", name, DESCRIPTIONS[name])
    return made
