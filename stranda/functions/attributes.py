"""Annotation attributes: ``key "value"; ...`` lists as maps, and tags."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _pairs(text: Column) -> Column:
    """(key, value) of each item of an attribute list."""
    items = F.transform(F.split(text, ";"), lambda x: F.trim(x))
    return F.transform(
        F.filter(items, lambda x: F.instr(x, " ") > 0),
        lambda x: F.struct(
            F.substring_index(x, " ", 1).alias("key"),
            F.btrim(F.btrim(F.substr(x, F.instr(x, " ") + 1)), F.lit('"')).alias("value"),
        ),
    )


def _with_pairs(text: Column, make: Callable[[Column], Column]) -> Column:
    """``make`` of the items of an attribute list, which are taken apart once, however often it uses them."""
    return F.get(F.transform(F.array(_pairs(text)), make), F.lit(0))


def parse_attributes(text: Column) -> Column:
    """Map of an attribute list; of repeated keys the last one counts (independent of the session's map policy)."""
    later = lambda all_pairs, i: F.slice(all_pairs, i + 2, F.greatest(F.size(all_pairs), F.lit(1)))
    return _with_pairs(text, lambda x: F.map_from_entries(F.filter(x, lambda p, i: ~F.exists(later(x, i), lambda q: q["key"] == p["key"]))))


def attribute_values(text: Column, *keys: str) -> Column:
    """The values of these keys as fields, null where the list has none; of repeated keys the last one counts."""
    last = lambda x, key: F.try_element_at(F.filter(x, lambda p: p["key"] == key), F.lit(-1))["value"]
    return _with_pairs(text, lambda x: F.struct(*(last(x, k).alias(k) for k in keys)))


def has_tag(text: Column, *tags: str) -> Column:
    """Whether the raw list has one of the tags."""
    out = F.lit(False)
    for tag in tags:
        out = out | text.contains(f'tag "{tag}"')
    return out
