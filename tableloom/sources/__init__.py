from tableloom.sources.databases import partition_options, read_jdbc
from tableloom.sources.delimited import (
    EmptyFileError,
    HeaderMismatchError,
    RaggedRowError,
    header_names,
    read_csv,
    read_csv_files,
    survey_files,
    write_csv,
)
from tableloom.sources.files import (
    LoadError,
    file_inventory,
    load_dataframe,
    load_multiple_dataframes,
    read_parquet,
)
from tableloom.sources.footers import footer_counts
from tableloom.sources.literals import from_columns
from tableloom.sources.workbooks import read_excel

__all__ = [
    "EmptyFileError",
    "HeaderMismatchError",
    "LoadError",
    "RaggedRowError",
    "file_inventory",
    "footer_counts",
    "from_columns",
    "header_names",
    "load_dataframe",
    "load_multiple_dataframes",
    "partition_options",
    "read_csv",
    "read_csv_files",
    "read_excel",
    "read_jdbc",
    "read_parquet",
    "survey_files",
    "write_csv",
]
