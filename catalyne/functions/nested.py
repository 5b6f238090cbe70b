"""Picking from nested values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, col


def first_match(items: ColumnOrName, test) -> Column:
    """The first item that passes, or null."""
    return F.get(F.filter(col(items), test), F.lit(0))


def field_of(items: ColumnOrName, key: str, value: str, field: str) -> Column:
    """A field of the first struct whose key has the value and whose field is there."""
    return F.getfield(first_match(items, lambda x: (x[key] == value) & x[field].isNotNull()), field) if hasattr(F, "getfield") else first_match(items, lambda x: (x[key] == value) & x[field].isNotNull())[field]


def field_of_first(items: ColumnOrName, key: str, value: str, field: str) -> Column:
    """A field of the first struct whose key has the value, null if it isn't there: later ones don't stand in for it."""
    return first_match(items, lambda x: x[key] == value)[field]


def path(variant: ColumnOrName, *keys: str, kind: str = "string") -> Column:
    """What stands at a path of a VARIANT, or null if it isn't there or is of another kind."""
    return F.try_variant_get(col(variant), "$" + "".join(f'["{k}"]' for k in keys), kind)


def parsed(c: ColumnOrName) -> Column:
    """JSON text as a VARIANT; null where it isn't JSON."""
    return F.try_parse_json(col(c))


def last(items: ColumnOrName) -> Column:
    """The last item, or null of none."""
    return F.try_element_at(col(items), F.lit(-1))


def ordered_unique(items: Column) -> Column:
    return F.array_distinct(F.array_compact(items))


def tag_list(c: ColumnOrName, kind: str) -> Column:
    """Tags as an array, from an array or from a printed list; null gives none."""
    from .text import literal_list

    empty = F.array().cast("array<string>")
    return F.coalesce(col(c), empty) if kind.startswith("array") else F.coalesce(literal_list(col(c)), empty)
