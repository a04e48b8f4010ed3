"""Declaring, checking, suggesting and following relationships between tables."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.functions.columns import column, quoted
from tableloom.session import cut_lineage


class FanOutError(ValueError):
    """Joining to the parent would multiply child rows."""


@dataclass(frozen=True)
class Relationship:
    """``child_table.child_column`` refers to ``parent_table.parent_column``."""

    child_table: str
    child_column: str
    parent_table: str
    parent_column: str


def check_relationship(
    child: DataFrame, child_column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """One row: matched, orphan and null child rows, duplicate parent keys.

    Both sides are counted per key first, so a key that holds a third of all
    rows is one row when the sides meet.
    """
    children = child.groupBy(column(child_column).alias("key")).agg(
        F.count(F.lit(1)).alias("child_rows")
    )
    parents = parent.groupBy(column(parent_column).alias("key")).agg(
        F.count(F.lit(1)).alias("parent_rows")
    )
    both = children.join(parents, "key", "full")
    rows, keyed = F.col("child_rows"), F.col("key").isNotNull()
    found, known = F.col("parent_rows").isNotNull(), F.col("child_rows").isNotNull()

    def total(condition, value):
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("bigint")

    return both.agg(
        total(keyed & known & found, rows).alias("matched_rows"),
        total(keyed & known & ~found, rows).alias("orphan_rows"),
        total(~keyed & known, rows).alias("null_rows"),
        F.count_if(keyed & known & ~found).alias("orphan_keys"),
        F.count_if(keyed & (F.col("parent_rows") > 1)).alias("duplicate_parent_keys"),
        F.count_if(keyed & found & ~known).alias("unused_parent_keys"),
    )


@dataclass(frozen=True)
class Candidate:
    """A column that may take part in a relationship; ``plain`` is its name after the prefix."""

    table: str
    name: str
    plain: str
    kind: str

    @property
    def agrees_on(self) -> tuple[str, str]:
        return self.plain, self.kind

    def may_refer_to(self, other: Candidate) -> bool:
        return self.table != other.table and self.agrees_on == other.agrees_on


def _table_prefix(columns: list[str]) -> str:
    """Common start of all column names up to an underscore, such as ``c_``."""
    if len(columns) < 2:
        return ""
    shared = os.path.commonprefix(columns)
    return shared[: shared.rfind("_") + 1]


def _plain_names(df: DataFrame) -> dict[str, str]:
    cut = len(_table_prefix(df.columns))
    return {c: c[cut:].lower() for c in df.columns}


#: Columns whose ids share one word of a value's bitmap.
_WORD = 63


def comparable_columns(tables: dict[str, DataFrame]) -> list[Candidate]:
    """Columns of simple types that agree with a column of another table in name and type."""
    columns = []
    for table, df in tables.items():
        plain = _plain_names(df)
        for field in df.schema.fields:
            kind = field.dataType.simpleString()
            if "<" not in kind:
                columns.append(Candidate(table, field.name, plain[field.name], kind))
    homes: dict[tuple[str, str], set[str]] = {}
    for one in columns:
        homes.setdefault(one.agrees_on, set()).add(one.table)
    return [one for one in columns if len(homes[one.agrees_on]) > 1]


def value_index(tables: dict[str, DataFrame], columns: list[Candidate]) -> tuple[DataFrame, DataFrame]:
    """Inverted index of all values, and ``col_id, filled`` of the columns.

    A value stands as a 128-bit hash of its type and text, with a bitmap of the
    columns that hold it: ``word_0``, ``word_1``, ... of 63 columns each. Every
    table is read once, and bitmaps are combined inside each task, so a value is
    moved once per task that met it, whatever its length and its partners.
    """
    words = range(-(-len(columns) // _WORD))
    parts, filled = None, None
    for table in dict.fromkeys(one.table for one in columns):
        cells = []
        for i, one in enumerate(columns):
            if one.table != table:
                continue
            text = column(one.name).cast("string")
            mask = [F.lit(1 << i % _WORD if i // _WORD == w else 0).cast("long") for w in words]
            cells.append(
                F.struct(
                    F.when(text.isNotNull(), F.xxhash64(F.lit(one.kind), text)).alias("hash_a"),
                    F.xxhash64(text, F.lit(one.kind)).alias("hash_b"),
                    *[m.alias(f"word_{w}") for w, m in zip(words, mask, strict=True)],
                )
            )
        part = tables[table].select(F.inline(F.array(*cells))).where("hash_a IS NOT NULL")
        parts = part if parts is None else parts.unionAll(part)
        counts = tables[table].agg(
            F.map_from_arrays(
                F.array(*[F.lit(i) for i, one in enumerate(columns) if one.table == table]),
                F.array(*[F.count(column(one.name)) for one in columns if one.table == table]),
            ).alias("counts")
        )
        count = counts.select(F.explode("counts").alias("col_id", "filled"))
        filled = count if filled is None else filled.unionAll(count)
    index = parts.groupBy("hash_a", "hash_b").agg(
        *[F.bit_or(f"word_{w}").alias(f"word_{w}") for w in words]
    )
    return index, filled


def suggest_relationships(
    tables: dict[str, DataFrame], min_containment: float = 1.0
) -> DataFrame:
    """Pairs of columns that look like a foreign key and its key.

    A pair qualifies if the names agree after the table prefix, the types are
    equal, the parent column is unique, and at least ``min_containment`` of the
    distinct child values occur in the parent. All values count; none is sampled.

    An inverted index tells for every value which columns hold it. Values with the
    same columns are counted together, and only these counts meet in pairs.
    """
    spark = next(iter(tables.values())).sparkSession
    result = (
        "child_table string, child_column string, parent_table string, parent_column string, "
        "child_distinct bigint, matched bigint, containment double"
    )
    columns = comparable_columns(tables)
    if not columns:
        return spark.createDataFrame([], result)
    index, filled = value_index(tables, columns)
    words = [c for c in index.columns if c.startswith("word_")]
    patterns = index.groupBy(*words).agg(F.count(F.lit(1)).alias("n_values"))
    held = F.array_compact(
        F.array(
            *[
                F.when(F.col(words[i // _WORD]).bitwiseAND(F.lit(1 << i % _WORD)) != 0, F.lit(i))
                for i in range(len(columns))
            ]
        )
    )
    # Pairs of one pattern: as many as columns agree, for each set of columns that has a value.
    partners = F.create_map(
        *[
            part
            for i, one in enumerate(columns)
            for part in (
                F.lit(i),
                F.array(*[F.lit(j) for j, other in enumerate(columns) if one.may_refer_to(other)]),
            )
        ]
    )
    listed = patterns.select("n_values", held.alias("held"))
    pairs = (
        listed.select("n_values", "held", F.explode("held").alias("child"))
        .select(
            "n_values",
            "child",
            F.explode(
                F.concat(F.array(F.col("child")), F.array_intersect("held", partners[F.col("child")]))
            ).alias("parent"),
        )
        .groupBy("child", "parent")
        .agg(F.sum("n_values").alias("matched"))
    )
    # One row per pair of agreeing columns, and per column: bounded by the schemas.
    met = cut_lineage(pairs)
    distinct = met.where("child = parent").select("child", F.col("matched").alias("child_distinct"))
    unique = (
        distinct.withColumnRenamed("child", "parent")
        .join(F.broadcast(filled.withColumnRenamed("col_id", "parent")), "parent")
        .where("filled = child_distinct")
        .select("parent")
    )
    names = spark.createDataFrame(
        [(i, one.table, one.name) for i, one in enumerate(columns)],
        "col_id int, table_name string, column_name string",
    )
    side = lambda role: F.broadcast(
        names.select(
            F.col("col_id").alias(role),
            F.col("table_name").alias(f"{role}_table"),
            F.col("column_name").alias(f"{role}_column"),
        )
    )
    return (
        met.where("child <> parent")
        .join(F.broadcast(unique), "parent", "left_semi")
        .join(F.broadcast(distinct), "child")
        .withColumn("containment", F.col("matched") / F.col("child_distinct"))
        .where(F.col("containment") >= min_containment)
        .join(side("child"), "child")
        .join(side("parent"), "parent")
        .select(*[part.strip().split(" ")[0] for part in result.split(",")])
    )


def duplicated_keys(keys: list[tuple[DataFrame, str]]) -> list[int]:
    """Indexes of the keys that hold some non-null value more than once; one job."""
    found = None
    for i, (df, key) in enumerate(keys):
        repeated = (
            df.where(column(key).isNotNull())
            .groupBy(column(key).alias("key"))
            .agg(F.count(F.lit(1)).alias("rows"))
            .where("rows > 1")
            .select(F.lit(i).alias("key_id"))
        )
        found = repeated if found is None else found.unionAll(repeated)
    # At most one row per key reaches the driver.
    return [] if found is None else [row.key_id for row in found.distinct().collect()]


@dataclass
class _Branch:
    """A table of the join tree, its column names in the result, and the parents it refers to."""

    table: str
    renamed: dict[str, str]
    links: list[tuple[str, str, _Branch]]


def _join_tree(
    columns: dict[str, list[str]], start: str, relationships: list[Relationship]
) -> _Branch:
    """Tree of the tables reached from ``start``, with the names of all their columns.

    A table reached a second time is a leaf: its parents were followed once.
    """
    root = _Branch(start, {c: c for c in columns[start]}, [])
    first = {start: root}
    taken = set(columns[start])
    pending = list(relationships)
    while any(link.child_table in first for link in pending):
        for link in list(pending):
            if link.child_table not in first:
                continue
            again = link.parent_table in first
            prefix = f"{link.child_table}_{link.child_column}" if again else link.parent_table
            renamed = {
                c: f"{prefix}_{c}" if again or c in taken else c for c in columns[link.parent_table]
            }
            taken |= set(renamed.values())
            branch = _Branch(link.parent_table, renamed, [])
            first[link.child_table].links.append((link.child_column, link.parent_column, branch))
            first.setdefault(link.parent_table, branch)
            pending.remove(link)
    if pending:
        loose = ", ".join(f"{r.child_table}.{r.child_column}" for r in pending)
        raise ValueError(f"not connected to '{start}': {loose}")
    return root


def _contracted(tables: dict[str, DataFrame], branch: _Branch) -> DataFrame:
    """A table with all its parents, each joined with its own parents first."""
    joined = tables[branch.table].select(
        *[column(c).alias(name) for c, name in branch.renamed.items()]
    )
    for child_column, parent_column, parent in branch.links:
        side = _contracted(tables, parent)
        joined = joined.join(
            side,
            joined[quoted(branch.renamed[child_column])] == side[quoted(parent.renamed[parent_column])],
            "left",
        )
    return joined


def auto_join(
    tables: dict[str, DataFrame],
    start: str,
    relationships: list[Relationship],
    allow_fan_out: bool = False,
) -> DataFrame:
    """Left-join ``start`` with its parents, their parents, and so on.

    Every row of ``start`` stays. A parent whose key is not unique would
    multiply rows and is refused unless ``allow_fan_out``. A parent reached a
    second time gets its columns prefixed with the child's table and column.
    Columns of a parent whose names are already present are prefixed with the
    parent's name.

    Branches are joined before the table they hang on, so the rows of ``start`` move
    once for each parent of its own and not for each ancestor. Spark broadcasts
    a branch by its measured size and splits skewed partitions of larger joins.
    """
    if not allow_fan_out:
        keys = list(dict.fromkeys((r.parent_table, r.parent_column) for r in relationships))
        repeated = duplicated_keys([(tables[table], name) for table, name in keys])
        if repeated:
            listed = ", ".join(f"'{keys[i][0]}.{keys[i][1]}'" for i in repeated)
            raise FanOutError(f"not unique: {listed}")
    tree = _join_tree({name: df.columns for name, df in tables.items()}, start, relationships)
    return _contracted(tables, tree)
