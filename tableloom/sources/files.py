"""Choosing a reader, loading many files, and the inventory of files."""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from pathlib import PurePath

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PythonException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.functions.names import file_extension, free_name
from tableloom.sources.delimited import read_csv, read_csv_files
from tableloom.sources.workbooks import read_excel

# Messages of a failed load.
NO_FILE = "No file uploaded"
UNSUPPORTED = "Unsupported file format"
NOTHING_LOADED = "No valid data files were uploaded"

#: Files that one call loads side by side.
LOADS_AT_ONCE = 8


class LoadError(ValueError):
    """An upload was rejected; ``errors`` lists one message per failed file."""

    def __init__(self, errors: list[str]):
        super().__init__("; ".join(errors))
        self.errors = errors


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


#: Reader per lower-cased extension.
READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    ".csv": read_csv,
    ".xlsx": read_excel,
    ".parquet": read_parquet,
}


#: Errors of a file itself; anything else, such as a lost cluster, is not caught.
FILE_ERRORS = (ValueError, AnalysisException, PythonException)


def _extension(path: str) -> str:
    return os.path.splitext(path)[1].lower()


def load_dataframe(spark: SparkSession, path: str | None) -> tuple[DataFrame | None, str | None]:
    """``(table, None)``, or ``(None, message)`` if the file cannot be loaded.

    Typing runs here, so errors inside the file are reported here as well.
    """
    if not path:
        return None, NO_FILE
    reader = READERS.get(_extension(path))
    if reader is None:
        return None, UNSUPPORTED
    try:
        return reader(spark, path), None
    except FILE_ERRORS as error:
        return None, str(error)
    except Py4JJavaError as error:
        found = re.search(r"\[FAILED_READ_FILE[^\n]*", str(error))
        if found is None:
            raise
        return None, found[0]


def _missing_path(error: AnalysisException, paths: list[str]) -> str | None:
    """The one of ``paths`` that an analysis did not find."""
    if error.getCondition() != "PATH_NOT_FOUND":
        return None
    named = error.getMessageParameters()["path"]
    return next((p for p in paths if named == p or named.split(":", 1)[-1] == p), None)


def _load_delimited(
    spark: SparkSession, paths: list[str]
) -> dict[str, tuple[DataFrame | None, str | None]]:
    """Outcomes of delimited files that are loaded together; others are left to be loaded alone."""
    outcomes: dict[str, tuple[DataFrame | None, str | None]] = {}
    together = [path for path in dict.fromkeys(paths) if not re.search(r"[*?\[{\\]", path)]
    while together:
        try:
            tables = read_csv_files(spark, together)
        except AnalysisException as error:
            missing = _missing_path(error, together)
            if missing is None:
                raise
            outcomes[missing] = None, str(error)
            together.remove(missing)
            continue
        for path, table in tables.items():
            failed = isinstance(table, ValueError)
            outcomes[path] = (None, str(table)) if failed else (table, None)
        break
    return outcomes


def load_multiple_dataframes(
    spark: SparkSession, paths: list[str], on_error: str = "partial"
) -> tuple[dict[str, DataFrame], list[str]]:
    """Load files under unique table names.

    Delimited files are surveyed and typed together. ``on_error="partial"`` keeps
    the good tables and returns the errors. ``on_error="fail"`` raises on any
    error, and when nothing was loaded.
    """
    if on_error not in ("partial", "fail"):
        raise ValueError("on_error must be 'partial' or 'fail'")
    known = _load_delimited(spark, [p for p in paths if p and _extension(p) == ".csv"])
    alone = [path for path in dict.fromkeys(paths) if path not in known]
    # each load plans and types by itself, so they may wait for the cluster together
    with ThreadPoolExecutor(LOADS_AT_ONCE) as pool:
        known |= zip(alone, pool.map(lambda path: load_dataframe(spark, path), alone), strict=True)
    outcomes = [known[path] for path in paths]
    names = [PurePath(path or "").name for path in paths]
    errors = [
        f"Error loading {name}: {error}"
        for name, (_, error) in zip(names, outcomes, strict=True)
        if error is not None
    ]
    used: set[str] = set()
    tables = {
        free_name("_".join(PurePath(name).stem.lower().split(" ")), used): df
        for name, (df, error) in zip(names, outcomes, strict=True)
        if error is None
    }
    if on_error == "fail":
        if errors:
            raise LoadError(errors)
        if not tables:
            raise LoadError([NOTHING_LOADED])
    return tables, errors


def file_inventory(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Name, extension and size in KB of each file; the contents are not read.

    Ties at the second decimal go to the even digit.
    """
    name = F.regexp_extract("path", "[^/]*$", 0)
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select("path", "length")
        .select(
            name.alias("file_name"),
            file_extension(name).alias("extension"),
            F.bround(F.col("length") / 1024, 2).alias("size_kb"),
        )
    )
