"""Delimited text: one header row, types inferred, malformed rows rejected.

One parallel pass over the lines of all files finds each file's header and
whether its rows keep to their lines. Files of one layout (the same columns in the
same order, and rows that span lines or not) are then scanned and typed together,
so the number of jobs follows the layouts and not the files.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tableloom.functions.columns import column, quoted
from tableloom.functions.names import free_name
from tableloom.functions.typing import (
    apply_types,
    infer_schema,
    na_normalise,
    type_counts,
    types_from_counts,
)

_OVERFLOW = "_overflow"
_FILE = "_file"


class EmptyFileError(ValueError):
    """The file holds not even a header row."""


class RaggedRowError(ValueError):
    """A row has more fields than the header."""


class LineEndError(ValueError):
    """A quoted line feed in the header hides that rows end with CR LF."""


class HeaderMismatchError(ValueError):
    """Files that are read as one table have different columns."""


def header_names(cells: list[str | None]) -> list[str]:
    """Column names of a header row.

    A blank cell becomes ``unnamed_<index>``. A repeat, compared without case,
    gets the first free suffix ``_1``, ``_2``, ...
    """
    first, *others = [cell or "" for cell in cells] or [""]
    bases = [first.removeprefix("﻿"), *others][: len(cells)]
    used: set[str] = set()
    return [
        free_name(base or f"unnamed_{index}", used, "_", str.lower)
        for index, base in enumerate(bases)
    ]


def _options(multiline: bool) -> dict[str, object]:
    return {
        "multiLine": multiline,
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }


@dataclass(frozen=True)
class FileFacts:
    """What the pass over the lines tells about one file."""

    uri: str
    names: tuple[str, ...]
    #: No quoted field spans lines, so the file may be split anywhere between lines.
    complete: bool

    @property
    def path(self) -> str:
        """Path that names exactly this file, though its name may look like a pattern."""
        return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(self.uri))


def _leftover(text: Column) -> Column:
    """What stays of a text when doubled quotes and then whole quoted fields are removed.

    No quote stays if every field is either free of quotes or quoted as a whole.
    """
    without_doubled = F.replace(text, F.lit('""'), F.lit(""))
    return F.regexp_replace(without_doubled, r'(?<=^|,)"[^"]*"(?=,|$)', "")


def _first_record(spark: SparkSession, path: str) -> list[str | None]:
    head = spark.read.options(**_options(True)).csv(path, header=False).take(1)
    cells = list(head[0]) if head else []
    if cells and cells[-1] is not None:
        cells[-1] = cells[-1].removesuffix("\r")
    return cells


def survey_files(spark: SparkSession, path: str | list[str]) -> list[FileFacts]:
    """Header and line facts of every file that holds a row; one row per file is collected.

    A doubtful line only costs speed, never a right result. Only a header that
    itself spans lines costs its file a job of its own; it must break its lines as
    its file does, since a reader takes the first break for the end of all rows.
    """
    line = F.regexp_replace("value", "\r$", "")
    seen = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("at"),
            line.alias("line"),
            F.endswith("value", F.lit("\r")).alias("returns"),
        )
        .where("line NOT IN ('', '﻿')")
        .groupBy("file")
        .agg(
            F.min_by(F.regexp_extract("line", "^[^\r]*", 0), "at").alias("header"),
            F.min_by("returns", "at").alias("header_returns"),
            F.bool_or("returns").alias("returns"),
            F.bool_or(_leftover(F.col("line")).rlike('["\r]')).alias("doubtful"),
        )
        .collect()
    )
    facts = []
    for row in sorted(seen, key=lambda row: row.file):
        one = FileFacts(row.file, (), not row.doubtful)
        if row.header.count('"') % 2:
            if row.returns and not row.header_returns:
                raise LineEndError(f"{one.path}: the header breaks lines otherwise than its file")
            cells = _first_record(spark, one.path)
        else:
            cells = next(csv.reader(io.StringIO(row.header)))
        facts.append(replace(one, names=tuple(header_names(cells))))
    return facts


def _scan(
    spark: SparkSession, paths: str | list[str], names: Iterable[str], multiline: bool
) -> DataFrame:
    """Text of files of one layout, with the file and what overflows of a row."""
    schema = ", ".join(f"{quoted(n)} string" for n in [*names, _OVERFLOW])
    rows = spark.read.options(**_options(multiline)).schema(schema).csv(paths, header=True)
    return na_normalise(rows, list(names)).select(
        "*", F.col("_metadata.file_path").alias(_FILE)
    )


def _layouts(facts: list[FileFacts], multiline: bool | None) -> dict[tuple, list[FileFacts]]:
    """Files by (columns in order, whether rows span lines)."""
    found: dict[tuple, list[FileFacts]] = {}
    for one in facts:
        spans = not one.complete if multiline is None else multiline
        found.setdefault((one.names, spans), []).append(one)
    return found


def _same_columns(facts: list[FileFacts]) -> list[str]:
    """Columns of files that are read as one table, in the order of the first one."""
    if not facts:
        raise EmptyFileError("No columns to parse from file")
    first = facts[0]
    for one in facts:
        if sorted(one.names) != sorted(first.names):
            raise HeaderMismatchError(
                f"{one.path} has the columns {', '.join(one.names)}, "
                f"{first.path} has {', '.join(first.names)}"
            )
    return list(first.names)


def _one_table(
    spark: SparkSession,
    facts: list[FileFacts],
    multiline: bool | None = None,
    path: str | list[str] | None = None,
) -> DataFrame:
    """Text of files as one table, with columns put together by name; ``path`` names all files."""
    columns = [column(name) for name in (*_same_columns(facts), _OVERFLOW)]
    layouts = _layouts(facts, multiline)
    parts = []
    for (names, spans), files in layouts.items():
        whole = path if path and len(layouts) == 1 else [one.path for one in files]
        parts.append(_scan(spark, whole, names, spans).select(*columns))
    return reduce(DataFrame.unionAll, parts)


def _refuse_long_rows(rows: int) -> None:
    if rows:
        raise RaggedRowError(f"{rows} rows have more fields than the header")


def _long_rows() -> dict[str, Column]:
    return {"long_rows": F.col(_OVERFLOW).isNotNull()}


def scan_csv(
    spark: SparkSession, path: str | list[str], multiline: bool | None = None
) -> DataFrame:
    """Rows as text, missing words as nulls, and an overflow column filled for a too long row."""
    return _one_table(spark, survey_files(spark, path), multiline, path)


def read_csv(
    spark: SparkSession, path: str | list[str], multiline: bool | None = None
) -> DataFrame:
    """Typed table from a delimited file or a folder of such files.

    Columns of several files are put together by name, in the order of the first
    file; files with other columns raise. Short rows are filled with nulls, long
    rows raise. Typing is one pass over the files and runs here, so a malformed
    file fails now and not at a later action. With ``multiline=None`` only files
    in which some row spans lines are read by one task each; all others are split.
    """
    text = scan_csv(spark, path, multiline)
    chosen = infer_schema(text, _long_rows())
    _refuse_long_rows(chosen.extra_counts["long_rows"])
    return apply_types(text.drop(_OVERFLOW), chosen.types)


def _plain(path: str) -> str:
    """A path without its scheme, with one slash in front."""
    return "/" + re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:", "", path).strip("/")


def _by_path(facts: list[FileFacts], paths: list[str]) -> dict[str, list[FileFacts]]:
    """Files of each path; a path is a file or a folder of files."""
    given: dict[str, list[str]] = {}
    for path in paths:
        given.setdefault(_plain(path), []).append(path)
    found: dict[str, list[FileFacts]] = {path: [] for path in paths}
    for one in facts:
        parts = _plain(unquote(one.uri)).split("/")[1:]
        # the first part may be the host of a store that the paths leave out
        for begin in (0, 1):
            folders = ["/" + "/".join(parts[begin:end]) for end in range(len(parts), begin, -1)]
            owners = next((given[folder] for folder in folders if folder in given), None)
            if owners is not None:
                for owner in owners:
                    found[owner].append(one)
                break
    return found


def read_csv_files(
    spark: SparkSession, paths: list[str]
) -> dict[str, DataFrame | ValueError]:
    """Each path as a typed table of its own, or the error that keeps it from being one.

    All files are surveyed in one pass and typed in one pass per layout, so the
    jobs do not grow with the files.
    """
    files = _by_path(survey_files(spark, paths), paths)
    usable: dict[str, list[FileFacts]] = {}
    made: dict[str, DataFrame | ValueError] = {}
    for path, facts in files.items():
        try:
            _same_columns(facts)
            usable[path] = facts
        except ValueError as error:
            made[path] = error
    layouts = _layouts([one for facts in usable.values() for one in facts], None)
    counted = [
        _scan(spark, [one.path for one in group], names, spans)
        .groupBy(_FILE)
        .agg(*type_counts(list(names), _long_rows()))
        for (names, spans), group in layouts.items()
    ]
    # one row per file
    rows = reduce(DataFrame.unionAll, counted).collect() if counted else []
    seen = {row[_FILE]: row for row in rows}
    for path, facts in usable.items():
        try:
            made[path] = _from_counts(spark, facts, seen)
        except ValueError as error:
            made[path] = error
    return made


def _from_counts(spark: SparkSession, facts: list[FileFacts], seen: dict[str, Row]) -> DataFrame:
    counted = [(list(one.names), seen[one.uri]) for one in facts if one.uri in seen]
    _refuse_long_rows(sum(row["extra_long_rows"] for _, row in counted))
    types = types_from_counts(_same_columns(facts), counted)
    return apply_types(_one_table(spark, facts).drop(_OVERFLOW), types)


def write_csv(df: DataFrame, path: str) -> None:
    """Write a table as a folder of delimited files, each with a header row."""
    options = _options(multiline=False)
    options.pop("multiLine")
    df.write.options(header=True, **options).csv(path)
