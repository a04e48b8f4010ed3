"""Small column helpers shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """Column name as a quoted identifier, so dots and blanks are literal."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def money_sum(name: str, scale: int = 12) -> Column:
    """Sum with ``scale`` exact decimals, so the order of addition cannot matter.

    26 digits stay before the point; a value or a sum beyond them raises.
    """
    return F.sum(column(name).cast(f"decimal(38,{scale})")).cast("double")
