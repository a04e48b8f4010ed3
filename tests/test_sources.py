"""Reading and writing files: fidelity, errors, dispatch."""

import math
import random
import zipfile

import pandas as pd
import pytest

from tableloom.session import scratch_path
from tableloom.sources import (
    EmptyFileError,
    HeaderMismatchError,
    LoadError,
    RaggedRowError,
    file_inventory,
    from_columns,
    header_names,
    load_dataframe,
    load_multiple_dataframes,
    partition_options,
    read_csv,
    read_excel,
    read_parquet,
    survey_files,
    write_csv,
)
from tableloom.sources.delimited import LineEndError, scan_csv
from tableloom.sources.files import READERS


def put(folder, name, text):
    path = folder / name
    path.write_bytes(text.encode() if isinstance(text, str) else text)
    return str(path)


def values(df):
    return [tuple(row) for row in df.collect()]


PANDAS_KINDS = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string"}

SAME_AS_PANDAS = {
    "plain": "A,B,C\n1,10,a\n2,20,b\n3,30,c\n4,40,d\n5,50,e",
    "decimals": "a,b\n1.5,2\n.5,3\n5.,4\n1e3,5\n-2E-2,6",
    "booleans": "a,b,c\nTrue,TRUE,true\nFalse,FALSE,false",
    "mixed boolean": "a\nTrue\n1\n",
    "yes and one-d are text": "a,b\nyes,1d\nno,2d",
    "dates stay text": "d,t\n2023-01-15,2023-01-15 10:00:00",
    "missing words": "a,b\n1.5,x\nNA,null\nnan,N/A\n,<NA>\n#N/A,-nan",
    "blank column": "a,b\n1,\n2,\n",
    "leading zeros": "a\n00123\n007\n",
    "signs and blanks": "a,b\n +5 ,-1\n-6, 2",
    "infinite": "a\ninf\n-Infinity\n1.5",
    "short row": "a,b,c\n1,2\n3,4,5.5\n",
    "quoted line break": 'a,b\n"x\ny",1\n"say ""hi""",2\n',
    "spaces kept": "a, b\nq, x\nr,y \n",
    "quoted number": 'a,b\n"1","x,y"\n"2","z"\n',
    "huge integer": "a\n99999999999999999999999\n1\n",
    "huge integer with decimal": "a,b\n99999999999999999999999,1\nx,2\n",
    "blank lines skipped": "a,b\n1,2\n\n3,4\n",
    "windows line ends": "a,b\r\n1,x\r\n2,y\r\n",
    "header only": "a,b\n",
}


@pytest.mark.parametrize("case", sorted(SAME_AS_PANDAS))
def test_csv_like_pandas(spark, tmp_path, case):
    path = put(tmp_path, "t.csv", SAME_AS_PANDAS[case])
    mine, theirs = read_csv(spark, path), pd.read_csv(path)
    assert mine.columns == list(theirs.columns)
    kinds = [f.dataType.simpleString() for f in mine.schema.fields]
    assert kinds == [PANDAS_KINDS[str(kind)] for kind in theirs.dtypes]
    expected = [
        tuple(None if isinstance(v, float) and math.isnan(v) else v for v in row)
        for row in theirs.itertuples(index=False)
    ]
    if case in ("mixed boolean", "huge integer"):
        expected = [tuple(str(v) for v in row) for row in expected]
    assert values(mine) == expected


def test_documented_differences_from_pandas(spark, tmp_path):
    path = put(tmp_path, "t.csv", "i,b,a,a,A,,n\n1,True,1,2,3,x,1\n,,4,5,6,y,99999999999999999999\n")
    df = read_csv(spark, path)
    assert df.dtypes == [
        ("i", "bigint"),
        ("b", "boolean"),
        ("a", "bigint"),
        ("a_1", "bigint"),
        ("A_2", "bigint"),
        ("unnamed_5", "string"),
        ("n", "string"),
    ]
    assert values(df)[1] == (None, None, 4, 5, 6, "y", "99999999999999999999")


def test_huge_integer_next_to_a_decimal_is_text(spark, tmp_path):
    path = put(tmp_path, "t.csv", "a\n99999999999999999999\n1.5\n")
    assert read_csv(spark, path).dtypes == [("a", "string")]


def test_long_row_is_refused_short_row_is_not(spark, tmp_path):
    with pytest.raises(RaggedRowError):
        read_csv(spark, put(tmp_path, "long.csv", "a,b\n1,2\n3,4,5\n"))
    with pytest.raises(RaggedRowError):
        read_csv(spark, put(tmp_path, "index.csv", "a,b\n1,2,3\n4,5,6\n"))
    assert values(read_csv(spark, put(tmp_path, "short.csv", "a,b\n1,2\n3\n"))) == [(1, 2), (3, None)]
    trailing = read_csv(spark, put(tmp_path, "comma.csv", "a,b\n1,2,\n"))
    assert values(trailing) == [(1, 2)]


def test_empty_file_is_refused(spark, tmp_path):
    with pytest.raises(EmptyFileError):
        read_csv(spark, put(tmp_path, "empty.csv", ""))


def test_header_names():
    assert header_names(["a", "a", "A", None, "a_1"]) == ["a", "a_1", "A_2", "unnamed_3", "a_1_1"]
    assert header_names(["﻿a", "b.c"]) == ["a", "b.c"]


def test_columns_with_dots_and_backticks(spark, tmp_path):
    df = read_csv(spark, put(tmp_path, "t.csv", "a.b,c`d\n1,x\n"))
    assert df.dtypes == [("a.b", "bigint"), ("c`d", "string")]
    assert values(df) == [(1, "x")]


@pytest.mark.parametrize(
    ("text", "fits"),
    [
        ("a,b\n1,2\n", True),
        ('a,b\n"x, y","say ""hi"""\n"",""\n', True),
        ('a,b\n"x\ny",1\n', False),
        ('a,b\n5" pipe,"abc\ndef"\n', False),
        ('a,b\n5" pipe,1\n', False),
        ('a,b\r\n"x",1\r\n', True),
        ('a,b\r\n"x\r\ny",1\r\n', False),
        ("a,b\r1,2\r", False),
    ],
)
def test_files_whose_rows_keep_to_their_lines(spark, tmp_path, text, fits):
    facts = survey_files(spark, put(tmp_path, "t.csv", text))
    assert [(one.names, one.complete) for one in facts] == [(("a", "b"), fits)]


@pytest.fixture
def tiny_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for name, value in zip(names, ("300", "10"), strict=True):
        spark.conf.set(name, value)
    yield
    for name, value in zip(names, before, strict=True):
        spark.conf.set(name, value)


def random_cell(rnd, breaks):
    kind = rnd.random()
    if kind < 0.3:
        return str(rnd.randint(0, 99))
    if kind < 0.5:
        return ""
    parts = ["a", "b", *breaks, '""', ",", " ", "é"]
    return '"' + "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 15))) + '"'


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
@pytest.mark.parametrize("breaks", [[], ["\n"]])
@pytest.mark.parametrize("header", ["x,y,z", 'x,"y\ny",z', '"x""",y,"z,z"'])
def test_random_files_in_small_splits(spark, tmp_path, tiny_splits, line_end, breaks, header):
    rnd = random.Random(len(line_end + header))
    expected = []
    for name in ("one.csv", "two.csv"):
        lines = [header] + [
            ",".join(random_cell(rnd, breaks) for _ in range(rnd.choice([2, 3, 3])))
            for _ in range(80)
        ]
        text = "".join(r + line_end * rnd.choice([1, 1, 2]) for r in lines)
        theirs = pd.read_csv(put(tmp_path, name, text), dtype=str, keep_default_na=False)
        expected += [tuple(v if isinstance(v, str) else "" for v in r) for r in theirs.values]
    if line_end == "\r\n" and "\n" in header:
        with pytest.raises(LineEndError):
            scan_csv(spark, str(tmp_path))
        return
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
    rows = scan_csv(spark, str(tmp_path))
    assert rows.columns[:-1] == list(theirs.columns)
    assert all(row._overflow is None for row in rows.collect())
    got = [tuple(v or "" for v in row) for row in values(rows.drop("_overflow"))]
    assert sorted(got) == sorted(expected)


def test_a_stray_quote_keeps_to_its_own_file(spark, tmp_path):
    put(tmp_path, "good.csv", "a,b\n1,2\n")
    put(tmp_path, "stray.csv", 'a,b\n5" pipe,1\nx,"y\nz"\n')
    facts = survey_files(spark, str(tmp_path))
    assert [one.complete for one in facts] == [True, False]
    assert sorted(values(read_csv(spark, str(tmp_path)))) == [
        ("1", "2"), ('5" pipe', "1"), ("x", "y\nz"),
    ]


def test_columns_of_several_files_meet_by_name(spark, tmp_path):
    put(tmp_path, "1.csv", "a,b\n1,x\n2,y\n")
    put(tmp_path, "2.csv", 'b,a\n"u\nv",20\n')
    put(tmp_path, "3[x].csv", "b,a\nw,30\n")
    put(tmp_path, "4.csv", "")
    df = read_csv(spark, str(tmp_path))
    assert df.dtypes == [("a", "bigint"), ("b", "string")]
    assert sorted(values(df)) == [(1, "x"), (2, "y"), (20, "u\nv"), (30, "w")]
    put(tmp_path, "5.csv", "a,c\n1,2\n")
    with pytest.raises(HeaderMismatchError, match="a, c"):
        read_csv(spark, str(tmp_path))


def jobs_of(spark, group, work):
    spark.sparkContext.setJobGroup(group, "")
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_the_jobs_do_not_grow_with_the_files(spark, tmp_path):
    headers = ["a,b", "b,a", "a,b,c d"]
    paths = [put(tmp_path, f"t {i}.csv", f"{headers[i % 3]}\n{i},x\n") for i in range(144)]
    few = jobs_of(spark, "few", lambda: load_multiple_dataframes(spark, paths[:-24]))
    made = {}
    many = jobs_of(spark, "many", lambda: made.update(load_multiple_dataframes(spark, paths)[0]))
    assert few == many <= 10 and len(made) == 144
    assert made["t_7"].dtypes == [("b", "bigint"), ("a", "string")]
    assert values(made["t_7"]) == [(7, "x")]
    assert values(made["t_8"]) == [(8, "x", None)]


def test_many_paths_with_their_own_errors(spark, tmp_path):
    (tmp_path / "folder.csv").mkdir()
    put(tmp_path / "folder.csv", "p1.csv", "a,b\n1,2\n")
    put(tmp_path / "folder.csv", "p2.csv", "b,a\nx,3\n")
    (tmp_path / "other.csv").mkdir()
    put(tmp_path / "other.csv", "p1.csv", "a\n1\n")
    put(tmp_path / "other.csv", "p2.csv", "b\n1\n")
    paths = [str(tmp_path / name) for name in ("folder.csv", "missing.csv", "other.csv")]
    paths += [put(tmp_path, "a b%20.csv", "n\n1\n"), put(tmp_path, "long.csv", "n\n1,2\n")]
    paths += [paths[3], f"file:{paths[3]}", put(tmp_path, "[x].csv", "n\n1\n"), None]
    tables, errors = load_multiple_dataframes(spark, paths)
    assert list(tables) == ["folder", "a_b%20", "a_b%20_v1", "a_b%20_v2"]
    assert sorted(values(tables["folder"])) == [(1, "2"), (3, "x")]
    assert [e.split(": ")[0] for e in errors] == [
        f"Error loading {name}" for name in ("missing.csv", "other.csv", "long.csv", "[x].csv", "")
    ]


def test_a_file_that_is_no_parquet(spark, tmp_path):
    df, error = load_dataframe(spark, put(tmp_path, "t.parquet", "no parquet"))
    assert df is None and error


def test_other_errors_are_not_taken_for_a_bad_file(spark, monkeypatch):
    def lost(*_):
        raise ConnectionError("cluster lost")

    monkeypatch.setitem(READERS, ".parquet", lost)
    with pytest.raises(ConnectionError):
        load_dataframe(spark, "t.parquet")


def test_csv_round_trip_keeps_awkward_text(spark):
    rows = [(1, "line\nbreak", 1.5), (2, ' "quoted" , comma ', -0.25), (3, None, None), (4, "x", 1e20)]
    df = spark.createDataFrame(rows, "i bigint, t string, x double")
    path = scratch_path(spark, "csv")
    write_csv(df, path)
    assert sorted(values(read_csv(spark, path))) == rows


def test_literal_columns(spark):
    df = from_columns(spark, {"country": ["US", "UK"], "sales": [5000, 3200]})
    assert df.dtypes == [("country", "string"), ("sales", "bigint")]
    assert values(df) == [("US", 5000), ("UK", 3200)]
    with pytest.raises(ValueError):
        from_columns(spark, {"a": [1], "b": [1, 2]})


def test_dispatch(spark, tmp_path):
    assert load_dataframe(spark, None) == (None, "No file uploaded")
    assert load_dataframe(spark, "") == (None, "No file uploaded")
    assert load_dataframe(spark, "notes.txt") == (None, "Unsupported file format")
    df, error = load_dataframe(spark, put(tmp_path, "UPPER.CSV", "a,b\n1,2\n3,4"))
    assert error is None
    assert values(df) == [(1, 2), (3, 4)]
    df, error = load_dataframe(spark, str(tmp_path / "missing.csv"))
    assert df is None and error


def test_many_files(spark, tmp_path):
    first = put(tmp_path, "My Data.csv", "col1,col2\n1,a\n2,b")
    (tmp_path / "other").mkdir()
    second = put(tmp_path / "other", "my data.csv", "col3,col4\n3,c\n4,d")
    bad = put(tmp_path, "error.csv", "a\n1,2\n")
    tables, errors = load_multiple_dataframes(spark, [first, bad, second])
    assert list(tables) == ["my_data", "my_data_v1"]
    assert values(tables["my_data_v1"]) == [(3, "c"), (4, "d")]
    assert len(errors) == 1 and errors[0].startswith("Error loading error.csv: ")
    with pytest.raises(LoadError):
        load_multiple_dataframes(spark, [first, bad], on_error="fail")
    with pytest.raises(LoadError):
        load_multiple_dataframes(spark, [], on_error="fail")
    assert load_multiple_dataframes(spark, []) == ({}, [])


def test_a_failed_file_takes_no_name(spark, tmp_path):
    (tmp_path / "x").mkdir()
    bad = put(tmp_path / "x", "data.csv", "")
    good = put(tmp_path, "data.csv", "a\n1\n")
    tables, errors = load_multiple_dataframes(spark, [bad, good])
    assert list(tables) == ["data"] and len(errors) == 1


def test_inventory_rounds_ties_to_even_and_reads_no_content(spark, tmp_path):
    put(tmp_path, "a b+c%20.csv", "x" * 128)
    put(tmp_path, "b.TXT", "x" * 2048)
    found = file_inventory(spark, str(tmp_path))
    assert sorted(values(found)) == [("a b+c%20.csv", ".csv", 0.12), ("b.TXT", ".txt", 2.0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def workbook(path, rows, strings=(), styles="", sheets=("xl/worksheets/sheet1.xml",)):
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    with zipfile.ZipFile(path, "w") as book:
        listed = "".join(
            f'<sheet name="s{i}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i in range(len(sheets))
        )
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets>{listed}</sheets></workbook>',
        )
        links = "".join(
            f'<Relationship Id="rId{i + 1}" Target="{s.removeprefix("xl/")}"/>'
            for i, s in enumerate(sheets)
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}">{links}</Relationships>'
        )
        if strings:
            items = "".join(f"<si>{s}</si>" for s in strings)
            book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{items}</sst>')
        if styles:
            book.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}">{styles}</styleSheet>')
        book.writestr(
            sheets[0], f'<worksheet xmlns="{main}"><sheetData>{rows}</sheetData></worksheet>'
        )
        for other in sheets[1:]:
            book.writestr(other, f'<worksheet xmlns="{main}"><sheetData/></worksheet>')


HEADER = (
    '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c>'
    '<c r="C1" t="inlineStr"><is><t>when</t></is></c></row>'
)


def test_workbook_first_sheet(spark, tmp_path):
    path = str(tmp_path / "book.xlsx")
    rows = (
        HEADER
        + '<row r="2"><c r="A2"><v>1</v></c><c r="B2" t="s"><v>2</v></c><c r="C2" s="1"><v>44941</v></c></row>'
        + '<row r="3"><c r="A3"><v>2</v></c><c r="C3" s="2"><v>44941.5</v></c></row>'
        + '<row r="4"><c r="A4"><v>3</v></c><c r="B4" t="str"><v>NA</v></c></row>'
    )
    styles = (
        '<numFmts><numFmt numFmtId="170" formatCode="yyyy&quot;x&quot;-mm"/></numFmts>'
        '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/></cellXfs>'
    )
    strings = ["<t>id</t>", "<t>name</t>", "<r><t>rich </t></r><r><t>text</t></r>"]
    workbook(
        path, rows, strings, styles, sheets=("xl/worksheets/data.xml", "xl/worksheets/sheet2.xml")
    )
    df = read_excel(spark, path)
    assert df.dtypes == [("id", "bigint"), ("name", "string"), ("when", "string")]
    assert values(df) == [
        (1, "rich text", "2023-01-15 00:00:00"),
        (2, None, "2023-01-15 12:00:00"),
        (3, None, None),
    ]


def test_folder_of_workbooks(spark, tmp_path):
    header = '<row r="1"><c r="A1" t="inlineStr"><is><t>x</t></is></c></row>'
    for i in range(3):
        workbook(tmp_path / f"b{i}.xlsx", header + f'<row r="2"><c r="A2"><v>{i}.5</v></c></row>')
    assert sorted(values(read_excel(spark, str(tmp_path)))) == [(0.5,), (1.5,), (2.5,)]


def test_workbook_errors(spark, tmp_path):
    workbook(tmp_path / "empty.xlsx", "")
    assert load_dataframe(spark, str(tmp_path / "empty.xlsx"))[0] is None
    put(tmp_path, "broken.xlsx", "not a zip file")
    df, error = load_dataframe(spark, str(tmp_path / "broken.xlsx"))
    assert df is None and "zip" in error


def test_parquet(spark, folder):
    assert read_parquet(spark, f"{folder}/nation.parquet").count() == 25


def test_jdbc_options():
    assert partition_options("id", 1, 100, 8) == {
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "100",
        "numPartitions": "8",
    }
    with pytest.raises(ValueError):
        partition_options("id", 1, 100, 0)
