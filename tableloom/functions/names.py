"""File name and table name expressions."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain, count

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stem and last extension; a name's leading dots do not start an extension.
_STEM_AND_EXTENSION = r"(?s)^(\.*[^.].*)(\.[^.]*)$"


def file_stem(file_name: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(file_name, _STEM_AND_EXTENSION, "$1")


def file_extension(file_name: Column) -> Column:
    """Lower-cased last extension with its dot, or an empty string."""
    return F.lower(F.regexp_extract(file_name, _STEM_AND_EXTENSION, 2))


def table_name(file_name: Column) -> Column:
    """Table name of a file: stem in lower case, blanks as underscores."""
    return F.replace(F.lower(file_stem(file_name)), F.lit(" "), F.lit("_"))


def view_name(name: Column) -> Column:
    """Name Spark accepts for a temporary view, from any table name."""
    safe = F.regexp_replace(F.lower(name), "[^a-z0-9_]", "_")
    return F.when(safe.rlike("^[0-9]"), F.concat(F.lit("t_"), safe)).otherwise(safe)


def free_name(
    base: str, used: set[str], mark: str = "_v", same: Callable[[str], str] = str
) -> str:
    """``base``, or its first numbered spelling whose ``same`` form is not in ``used`` yet.

    The form of the name is added to ``used``.
    """
    spellings = chain([base], (f"{base}{mark}{number}" for number in count(1)))
    found = next(name for name in spellings if same(name) not in used)
    used.add(same(found))
    return found
