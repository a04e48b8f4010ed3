"""Named tables: registering, listing and describing them.

Every catalog, and every collection cut from one, answers SQL in a Spark session of
its own, which shares the context but has its own temporary views. So equal names
in two catalogs never meet, and a collection's questions see its tables only.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.functions.names import free_name
from tableloom.sources.footers import footer_counts


@dataclass(frozen=True)
class Table:
    """A registered table; ``files`` is the path of its Parquet files if it is all they hold.

    ``mark`` tells the table from all others in the plan of an answer.
    """

    name: str
    df: DataFrame
    view: str
    description: str = ""
    source: str = ""
    files: str | None = None
    mark: str = field(default_factory=lambda: f"table_{uuid.uuid4().hex}")


def safe_view_name(name: str) -> str:
    """View name for a table name; the column form is ``functions.view_name``."""
    safe = re.sub("[^a-z0-9_]", "_", name.lower())
    return f"t_{safe}" if safe[:1].isdigit() else safe


def _plain(name: str) -> str:
    return name.lower().replace(" ", "_")


def scoped_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` and no temporary views."""
    scope = spark.newSession()
    known = scope.conf.getAll
    for key, value in spark.conf.getAll.items():
        if known.get(key) != value and scope.conf.isModifiable(key):
            scope.conf.set(key, value)
    return scope


def register_view(scope: SparkSession, table: Table) -> None:
    """Name a table, of any session of the context, as a view of ``scope`` alone."""
    table.df.createOrReplaceGlobalTempView(table.mark)
    scope.table(f"global_temp.{table.mark}").createOrReplaceTempView(table.view)
    scope.catalog.dropGlobalTempView(table.mark)


class Catalog:
    """Insertion-ordered tables, each also a temporary view of the catalog's own session."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.scope = scoped_session(spark)
        self._tables: dict[str, Table] = {}
        self._names: set[str] = set()
        self._views: set[str] = set()

    def add(
        self,
        name: str,
        df: DataFrame,
        description: str = "",
        source: str = "",
        files: str | None = None,
    ) -> str:
        """Register a table and return the unique name it got."""
        unique = free_name(_plain(name), self._names)
        view = free_name(safe_view_name(unique), self._views)
        self._enter(Table(unique, df, view, description, source, files))
        return unique

    def _enter(self, table: Table) -> None:
        register_view(self.scope, table)
        self._tables[table.name] = table
        self._names.add(table.name)
        self._views.add(table.view)

    def __getitem__(self, name: str) -> Table:
        if name not in self:
            raise KeyError(f"no table named '{name}'; known: {', '.join(self._tables)}")
        return self._tables[_plain(name)]

    def __contains__(self, name: str) -> bool:
        return _plain(name) in self._tables

    def __len__(self) -> int:
        return len(self._tables)

    @property
    def tables(self) -> list[Table]:
        return list(self._tables.values())

    @property
    def names(self) -> list[str]:
        return list(self._tables)

    def has_data(self) -> bool:
        return bool(self._tables)

    def subset(self, names: list[str]) -> Catalog:
        """Collection of some tables, with a session and views of its own."""
        chosen = Catalog(self.spark)
        for name in dict.fromkeys(_plain(name) for name in names):
            chosen._enter(self[name])
        return chosen

    def clear(self) -> None:
        """Forget all tables and drop their views; other catalogs keep theirs."""
        for table in self._tables.values():
            self.scope.catalog.dropTempView(table.view)
        self._tables.clear()
        self._names.clear()
        self._views.clear()


_OVERVIEW_FACTS = "position int, table_name string, description string, columns array<string>"


def _union(parts: list[DataFrame], spark: SparkSession, schema: str) -> DataFrame:
    joined = None
    for part in parts:
        joined = part if joined is None else joined.unionAll(part)
    return spark.createDataFrame([], schema) if joined is None else joined


def row_counts(catalog: Catalog) -> DataFrame:
    """``position`` and ``n_rows`` of each table.

    Parquet tables are counted from the footers of their files. Other tables are
    scanned without reading a column.
    """
    parts, marks = [], []
    for i, table in enumerate(catalog.tables):
        place = F.lit(i).alias("position")
        if table.files is None:
            marks.append(table.df.select(place))
        else:
            parts.append(footer_counts(catalog.spark, table.files).select(place, "n_rows"))
    if marks:
        scanned = _union(marks, catalog.spark, "position int")
        parts.append(scanned.groupBy("position").agg(F.count(F.lit(1)).alias("n_rows")))
    return _union(parts, catalog.spark, "position int, n_rows bigint")


def _facts(catalog: Catalog) -> DataFrame:
    return catalog.spark.createDataFrame(
        [(i, t.name, t.description, t.df.columns) for i, t in enumerate(catalog.tables)],
        _OVERVIEW_FACTS,
    )


def table_overview(catalog: Catalog) -> DataFrame:
    """Rows, number of columns and column names of each table."""
    # Both sides have at most one row per registered table.
    return (
        _facts(catalog)
        .join(F.broadcast(row_counts(catalog)), "position", "left")
        .select(
            F.col("position").cast("bigint").alias("position"),
            "table_name",
            "description",
            F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
            F.size("columns").cast("bigint").alias("n_columns"),
            F.array_join("columns", ", ").alias("column_names"),
        )
    )


def describe_catalog(catalog: Catalog) -> DataFrame:
    """Name and description of each table, in insertion order, with its size."""
    return table_overview(catalog).select(
        "position", "table_name", "description", "n_rows", "n_columns"
    )


def list_tables(catalog: Catalog) -> DataFrame:
    """Table names in insertion order and whether each holds any row.

    Footers tell for Parquet tables; of any other table one row is asked for.
    """
    parts = []
    for i, table in enumerate(catalog.tables):
        place = F.lit(i).alias("position")
        if table.files is None:
            parts.append(table.df.select(place).limit(1))
        else:
            counted = footer_counts(catalog.spark, table.files)
            parts.append(counted.where("n_rows > 0").select(place))
    filled = _union(parts, catalog.spark, "position int").withColumn("has_data", F.lit(True))
    # at most one row per registered table
    return _facts(catalog).join(F.broadcast(filled), "position", "left").select(
        F.col("position").cast("bigint").alias("position"),
        "table_name",
        F.coalesce("has_data", F.lit(False)).alias("has_data"),
    )
