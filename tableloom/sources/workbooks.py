"""First sheet of ``.xlsx`` workbooks.

Spark lists and distributes the files, one row per workbook, so this reads a
folder of workbooks in parallel from any file system Spark can reach. Inside a
task one workbook is streamed cell by cell; the format itself limits a sheet to
1,048,576 rows.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tableloom.functions.typing import infer_types, na_normalise
from tableloom.sources.delimited import EmptyFileError, RaggedRowError, header_names

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINKS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
# Built-in number formats that show a date or a time.
_DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
_BATCH_ROWS = 5_000


def _text(node: ElementTree.Element) -> str:
    # Phonetic hints (rPh) are not part of the value.
    direct = [t.text or "" for t in node.findall(f"{_MAIN}t")]
    runs = [t.text or "" for t in node.findall(f"{_MAIN}r/{_MAIN}t")]
    return "".join(direct + runs)


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match("[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def _first_sheet(book: zipfile.ZipFile) -> tuple[str, bool]:
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    link = root.find(f"{_MAIN}sheets/{_MAIN}sheet").get(f"{_LINKS}id")
    settings = root.find(f"{_MAIN}workbookPr")
    from_1904 = settings is not None and settings.get("date1904") in ("1", "true")
    for relation in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        if relation.get("Id") == link:
            target = posixpath.normpath(posixpath.join("/xl", relation.get("Target")))
            return target.lstrip("/"), from_1904
    raise ValueError("workbook has no first sheet")


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    return [_text(item) for item in root.findall(f"{_MAIN}si")]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    dates = set(_DATE_FORMATS)
    for custom in root.findall(f"{_MAIN}numFmts/{_MAIN}numFmt"):
        pattern = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", custom.get("formatCode", ""))
        if re.search("[dmyhs]", pattern, re.IGNORECASE):
            dates.add(int(custom.get("numFmtId")))
    styles = root.findall(f"{_MAIN}cellXfs/{_MAIN}xf")
    return {i for i, xf in enumerate(styles) if int(xf.get("numFmtId", 0)) in dates}


def _cell_value(
    cell: ElementTree.Element, strings: list[str], dates: set[int], from_1904: bool
) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return _text(cell.find(f"{_MAIN}is"))
    raw = cell.findtext(f"{_MAIN}v")
    if raw is None:
        return None
    if kind == "s":
        return strings[int(raw)]
    if kind == "b":
        return "True" if raw == "1" else "False"
    if kind == "e":
        return None
    if kind == "n" and int(cell.get("s", 0)) in dates:
        start = datetime(1904, 1, 1) if from_1904 else datetime(1899, 12, 30)
        moment = start + timedelta(milliseconds=round(float(raw) * 86_400_000))
        return moment.isoformat(sep=" ", timespec="seconds")
    return raw


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet of one workbook as text; blank rows inside are kept."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        sheet, from_1904 = _first_sheet(book)
        strings, dates = _shared_strings(book), _date_styles(book)
        expected = 1
        with book.open(sheet) as stream:
            for _, row in ElementTree.iterparse(stream):
                if row.tag != f"{_MAIN}row":
                    continue
                number = int(row.get("r", expected))
                yield from ([] for _ in range(number - expected))
                expected = number + 1
                cells: list[str | None] = []
                for cell in row.findall(f"{_MAIN}c"):
                    at = _column_index(cell.get("r")) if cell.get("r") else len(cells)
                    cells.extend([None] * (at - len(cells)))
                    cells.append(_cell_value(cell, strings, dates, from_1904))
                yield cells
                row.clear()


def _header_frames(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for content in frame["content"]:
            yield pd.DataFrame({"cells": [next(sheet_rows(content), [])]})


def _row_frames(width: int):
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labels = [f"c{i}" for i in range(width)]
        for frame in frames:
            for content in frame["content"]:
                rows = sheet_rows(content)
                next(rows, None)
                batch: list[list[str | None]] = []
                for cells in rows:
                    extra = [c for c in cells[width:] if c is not None]
                    if extra:
                        raise RaggedRowError("a row has more cells than the header")
                    batch.append((cells + [None] * width)[:width])
                    if len(batch) == _BATCH_ROWS:
                        yield pd.DataFrame(batch, columns=labels, dtype=object)
                        batch = []
                if batch:
                    yield pd.DataFrame(batch, columns=labels, dtype=object)

    return read


def read_excel(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Typed table from one workbook or a folder of workbooks with equal headers.

    Cells of a date format come as ISO text, like dates in delimited files.
    """
    books = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.[xX][lL][sS][xX]")
        .load(path)
        .select("content")
    )
    head = books.limit(1).mapInPandas(_header_frames, "cells array<string>").take(1)
    if not head or not head[0].cells:
        raise EmptyFileError("No columns to parse from file")
    names = header_names(list(head[0].cells))
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    text = books.mapInPandas(_row_frames(len(names)), schema).toDF(*names)
    return infer_types(na_normalise(text))
