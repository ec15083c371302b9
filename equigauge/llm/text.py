"""Text columns as every operator here reads them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What parts words: blank, and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]++"


def whole(column: str = "text") -> Column:
    """The whole text; NULL counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")
