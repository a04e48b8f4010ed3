"""Questions over tables: averages, totals, counts, joins, rankings and SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.functions.columns import column, money_sum
from tableloom.operators.catalog import Catalog
from tableloom.operators.profile import preview
from tableloom.session import keep_matching


def column_average(df: DataFrame, name: str, scale: int | None = None) -> DataFrame:
    """Average of one column; with ``scale`` the sum is exact to that many decimals."""
    total = F.sum(column(name)) if scale is None else money_sum(name, scale)
    return df.agg((total / F.count(column(name))).alias("average"))


def spend_per_customer(
    customers: DataFrame,
    orders: DataFrame,
    customer_key: str,
    order_key: str,
    amount: str,
    describe: list[str],
    scale: int | None = None,
) -> DataFrame:
    """Total amount of each customer that placed an order, with describing columns.

    With ``scale`` amounts are summed exactly to that many decimals.

    Orders are summed per customer before the join: the join sees one row per
    customer, however many orders one of them placed.
    """
    exact = f"decimal(38,{scale})"
    summed = column(amount) if scale is None else column(amount).cast(exact)
    totals = (
        orders.where(column(order_key).isNotNull())
        .groupBy(column(order_key).alias("_key"))
        .agg(F.sum(summed).alias("_total"))
    )
    return (
        customers.join(totals, column(customer_key) == F.col("_key"))
        .groupBy(column(customer_key), *[column(c) for c in describe])
        .agg(F.sum("_total").cast("double").alias("total_amount"))
    )


def orders_of_customer(
    customers: DataFrame,
    orders: DataFrame,
    customer_key: str,
    order_key: str,
    name_column: str,
    name: str,
) -> DataFrame:
    """How many orders the customers of one name placed; 0 if none.

    The keys of one name are few. They are broadcast if a bounded probe proves
    it, so the orders are filtered where they are read and not shuffled.
    """
    named = customers.where(column(name_column) == name)
    matching = keep_matching(orders, order_key, named, customer_key)
    return matching.agg(F.count(F.lit(1)).alias("n_orders")).select(
        F.lit(name).alias("customer_name"), "n_orders"
    )


def case_insensitive_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner"
) -> DataFrame:
    """Equi-join on lower-cased keys; columns of both sides are kept."""
    return left.join(right, F.lower(left[left_key]) == F.lower(right[right_key]), how)


def rank_by_ratio(
    df: DataFrame, label: str, numerator: str, denominator: str, k: int
) -> DataFrame:
    """The ``k`` labels with the highest ratio; a zero denominator ranks last.

    Rows are reduced to ``k`` before they are numbered, so the single window
    task never sees more than ``k`` rows.
    """
    ratio = F.try_divide(column(numerator), column(denominator))
    order = [F.col("ratio").desc_nulls_last(), column(label).asc()]
    top = (
        df.select(column(label), column(numerator), column(denominator), ratio.alias("ratio"))
        .orderBy(*order)
        .limit(k)
    )
    rank = F.row_number().over(Window.orderBy(*order)).cast("bigint")
    return top.withColumn("rank", rank)


def filtered_count(df: DataFrame, condition: Column, out: str = "n_rows") -> DataFrame:
    """Number of rows for which ``condition`` holds."""
    return df.where(condition).agg(F.count(F.lit(1)).alias(out))


def project_rows(df: DataFrame, columns: list[str], order_by: list[str], rows: int) -> DataFrame:
    """Chosen columns of the first rows."""
    wanted = list(dict.fromkeys([*columns, *order_by]))
    return preview(df.select(*[column(c) for c in wanted]), order_by, rows).select(
        *[column(c) for c in columns]
    )


def ask_sql(catalog: Catalog, query: str, **arguments: object) -> DataFrame:
    """Result of a SQL text over the tables of one catalog or collection.

    ``:name`` markers in the text are filled from ``arguments``. Views of other
    catalogs, equal in name or not, are out of reach.
    """
    return catalog.scope.sql(query, args=arguments or None)


def _marks(plan, known: dict[str, str], same: list[tuple[str, object]]) -> set[str]:
    """Tables below a node of an analysed plan, subqueries included."""
    if plan.nodeName() == "View":
        found = known.get(plan.desc().identifier().table())
        if found is not None:
            return {found}
    else:
        for name, table in same:
            if plan.sameResult(table):
                return {name}
    below: set[str] = set()
    for nodes in (plan.children(), plan.subqueries()):
        for i in range(nodes.size()):
            below |= _marks(nodes.apply(i), known, same)
    return below


def tables_used(catalog: Catalog, answer_id: str, answer: DataFrame) -> DataFrame:
    """One row per table of the catalog that an answer reads, in the catalog's order.

    The analysed plan tells: it holds a view for every table that a SQL text names,
    and a table's own plan where an answer was made from its DataFrame. Names that
    a text uses for anything else do not count. Nothing is run.
    """
    plan = answer._jdf.queryExecution().analyzed()
    known = {table.mark: table.name for table in catalog.tables}
    same = [(t.name, t.df._jdf.queryExecution().analyzed()) for t in catalog.tables]
    used = _marks(plan, known, same)
    return catalog.spark.createDataFrame(
        [(answer_id, name) for name in catalog.names if name in used],
        "answer_id string, table_name string",
    )
