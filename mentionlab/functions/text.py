"""Text helpers: row formatting and dropping undecodable bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REPLACEMENT_CHAR = "�"


def format_row(*cols: Column, sep: str = " ") -> Column:
    return F.concat_ws(sep, *[c.cast("string") for c in cols])


def drop_undecodable(text: Column) -> Column:
    """Remove bytes that aren't UTF-8, whether the reader kept them or put the replacement character."""
    return F.replace(F.make_valid_utf8(text), F.lit(REPLACEMENT_CHAR), F.lit(""))
