"""Text rules: identifiers match without regard to case or outer blanks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything up to and including the space counts as blank.
_BLANKS = "".join(chr(code) for code in range(33))


def clean(column: str | Column) -> Column:
    """The text without leading and trailing blanks or control characters."""
    return F.btrim(column, F.lit(_BLANKS))


def key(column: str | Column) -> Column:
    """The form of an identifier that is compared, joined and grouped on."""
    return F.upper(clean(column))


def same_text(left: Column, right: Column) -> Column:
    return F.lower(left) == F.lower(right)
