from tableloom.functions.columns import column, money_sum, quoted
from tableloom.functions.hashing import keyed_hash, matches_hash
from tableloom.functions.names import file_extension, file_stem, table_name, view_name
from tableloom.functions.typing import (
    NA_TOKENS,
    ColumnTypes,
    infer_schema,
    infer_types,
    na_normalise,
)

__all__ = [
    "NA_TOKENS",
    "ColumnTypes",
    "column",
    "file_extension",
    "file_stem",
    "infer_schema",
    "infer_types",
    "keyed_hash",
    "matches_hash",
    "money_sum",
    "na_normalise",
    "quoted",
    "table_name",
    "view_name",
]
