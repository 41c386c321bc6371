"""The ``Name,offset;Name,offset`` micro-format inside ``allNames``.

Three name rules are offered, since the two reference paths disagree on names
that hold commas or digits:

* ``last_offset`` (default): drop only the trailing ``,digits`` -> ``Foo, Bar,12`` gives ``Foo, Bar``
* ``all_offsets``: drop every ``,digits`` -> ``A,12B,3`` gives ``AB``
* ``head``: text before the first comma -> ``Foo, Bar,12`` gives ``Foo``
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MENTION_SEP = ";"
OFFSET_SEP = ","
NAME_RULES = ("last_offset", "all_offsets", "head")


def split_mentions(all_names: Column) -> Column:
    """Array of mention items; empty items (a trailing ``;``) are kept, see :func:`non_empty`."""
    return F.split(all_names, MENTION_SEP)


def non_empty(items: Column) -> Column:
    return F.filter(items, lambda x: x != F.lit(""))


def mention_count(all_names: Column) -> Column:
    """Number of non-empty mention items."""
    return F.size(non_empty(split_mentions(all_names)))


def strip_all_offsets(item: Column) -> Column:
    return F.regexp_replace(item, F.lit(",[0-9]+"), F.lit(""))


def strip_last_offset(item: Column) -> Column:
    return F.regexp_replace(item, F.lit(",[0-9]+$"), F.lit(""))


def head_name(item: Column) -> Column:
    return F.split_part(item, F.lit(OFFSET_SEP), F.lit(1))


def name_of(item: Column, rule: str = "last_offset") -> Column:
    if rule == "last_offset":
        return strip_last_offset(item)
    if rule == "all_offsets":
        return strip_all_offsets(item)
    if rule == "head":
        return head_name(item)
    raise ValueError(f"name rule must be one of {NAME_RULES}, got {rule!r}")
