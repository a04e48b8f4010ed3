"""The library's front door: named tables and everything one can ask of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tableloom.operators import catalog as catalogs
from tableloom.operators import profile, questions, relationships
from tableloom.operators.answers import Answer, answer_auto
from tableloom.operators.catalog import Catalog
from tableloom.operators.relationships import Relationship
from tableloom.session import cut_lineage
from tableloom.sources import (
    from_columns,
    load_multiple_dataframes,
    read_csv,
    read_excel,
    read_jdbc,
    read_parquet,
)


class Analyzer:
    """Loads tables under names, relates them, and answers questions over them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.catalog = Catalog(spark)
        self.collections: dict[str, tuple[Catalog, str]] = {}
        self.relationships: list[Relationship] = []

    def _add(
        self, df: DataFrame, name: str, description: str, source: str, files: str | None = None
    ) -> DataFrame:
        self.catalog.add(name, df, description, source, files)
        return df

    def load_csv(
        self, path: str, name: str, description: str = "", store: bool = False, **options
    ) -> DataFrame:
        """Register a delimited file.

        With ``store`` the typed table is written to the shared folder as
        Parquet first. Later questions then read only the columns and row
        groups they need, while the text would be parsed whole each time.
        """
        df = read_csv(self.spark, path, **options)
        return self._add(cut_lineage(df) if store else df, name, description, path)

    def load_excel(self, path: str, name: str, description: str = "") -> DataFrame:
        return self._add(read_excel(self.spark, path), name, description, path)

    def load_parquet(self, path: str, name: str, description: str = "") -> DataFrame:
        return self._add(read_parquet(self.spark, path), name, description, path, files=path)

    def load_jdbc(self, url: str, table: str, name: str, description: str = "", **options) -> DataFrame:
        return self._add(
            read_jdbc(self.spark, url, table, **options), name, description, f"{url}/{table}"
        )

    def load_columns(
        self, columns: dict[str, list], name: str, description: str = "", schema: str | None = None
    ) -> DataFrame:
        return self._add(from_columns(self.spark, columns, schema), name, description, "literal")

    def load_dataframe(self, df: DataFrame, name: str, description: str = "") -> DataFrame:
        return self._add(df, name, description, "dataframe")

    def load_files(self, paths: list[str], on_error: str = "partial") -> list[str]:
        """Load files under names made from the file names; returns the errors."""
        tables, errors = load_multiple_dataframes(self.spark, paths, on_error)
        for name, df in tables.items():
            self.catalog.add(name, df)
        return errors

    def get_dataframe(self, name: str) -> DataFrame:
        return self.catalog[name].df

    def get_dataframe_preview(
        self, name: str, rows: int = 5, order_by: list[str] | None = None
    ) -> DataFrame:
        df = self.get_dataframe(name)
        return profile.preview(df, order_by or df.columns[:1], rows)

    def get_dataframe_stats(self, name: str) -> DataFrame:
        return profile.table_stats(self.get_dataframe(name))

    def get_dataframe_info(self, name: str) -> DataFrame:
        return profile.column_info(self.get_dataframe(name))

    def overview(self) -> DataFrame:
        return catalogs.table_overview(self.catalog)

    def describe(self) -> DataFrame:
        return catalogs.describe_catalog(self.catalog)

    def create_collection(self, names: list[str], name: str, description: str = "") -> Catalog:
        """Bundle some tables; questions to the collection see these tables only."""
        collection = self.catalog.subset(names)
        self.collections[name] = (collection, description)
        return collection

    def add_relationship(
        self, child_table: str, child_column: str, parent_table: str, parent_column: str
    ) -> Relationship:
        for table, col in ((child_table, child_column), (parent_table, parent_column)):
            if col not in self.get_dataframe(table).columns:
                raise KeyError(f"'{table}' has no column '{col}'")
        link = Relationship(child_table, child_column, parent_table, parent_column)
        self.relationships.append(link)
        return link

    def check_relationship(self, link: Relationship) -> DataFrame:
        return relationships.check_relationship(
            self.get_dataframe(link.child_table),
            link.child_column,
            self.get_dataframe(link.parent_table),
            link.parent_column,
        )

    def suggest_relationships(self, min_containment: float = 1.0) -> DataFrame:
        tables = {t.name: t.df for t in self.catalog.tables}
        return relationships.suggest_relationships(tables, min_containment)

    def auto_join(self, start: str, allow_fan_out: bool = False) -> DataFrame:
        tables = {t.name: t.df for t in self.catalog.tables}
        return relationships.auto_join(tables, start, self.relationships, allow_fan_out)

    def ask_sql(self, query: str, **arguments: object) -> DataFrame:
        return questions.ask_sql(self.catalog, query, **arguments)

    def ask_collection(self, name: str, query: str, **arguments: object) -> DataFrame:
        """Result of a SQL text over the tables of a collection."""
        return questions.ask_sql(self.collections[name][0], query, **arguments)

    def tables_used(self, answer_id: str, answer: DataFrame) -> DataFrame:
        return questions.tables_used(self.catalog, answer_id, answer)

    def answer(self, df: DataFrame, order_by: list[str], output_type: str | None = None) -> Answer:
        return answer_auto(df, order_by, output_type)

    def has_data(self) -> bool:
        return self.catalog.has_data()

    def clear(self) -> None:
        """Start over: no tables, collections or relationships."""
        for collection, _ in self.collections.values():
            collection.clear()
        self.catalog.clear()
        self.collections.clear()
        self.relationships.clear()


def create_analyzer(spark: SparkSession) -> Analyzer:
    return Analyzer(spark)

