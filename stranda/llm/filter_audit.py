"""Filter interaction audit: what every order of a set of filters would keep and remove, from one pass over the documents.

A document fails a subset of the filters, its mask. What an order of filters does to a document depends on the mask
alone, so the corpus shrinks to a histogram of masks for each part of it. The histograms of all documents, of the good
ones and of the toxic ones are stacked as rows of an integer matrix and multiplied by incidence matrices with a row for
each mask and a column for each step of each order: 32 by 600 for five filters. No order is ever run over documents.

The only rows that grow with the input are one small row for each document; hot parts and hot texts are counted by
partial aggregation, and the copy test joins on text and document together, so that a text with very many copies is
not one key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

FILTERS = "ABCDE"
#: Parts whose product is held at once in a task.
PARTS_AT_ONCE = 64
#: Filters of an audit at most; the matrices grow with their factorial.
MOST_FILTERS = 6


class Incidence(NamedTuple):
    """The orders, and matrices of a row for each mask and a column for each (order, step), in that order."""

    orders: list[str]
    letters: np.ndarray  # the filter of each column, as its place in the filters
    kept: np.ndarray
    removed: np.ndarray
    redundant: np.ndarray
    unique: np.ndarray


def incidence(filters: Sequence[str]) -> Incidence:
    """The 0/1 matrices of all orders of ``filters``; bit k of a mask is the failure of filter k.

    ``kept``: fails no filter up to this step. ``removed``: fails this one and none before. ``redundant``: fails this one
    and one before. ``unique``: fails this one only, of all.
    """
    orders = list(permutations(range(len(filters))))
    steps = np.array(orders)
    bits = 1 << steps
    before = np.cumsum(bits, axis=1) - bits
    mask = np.arange(1 << len(filters))[:, None]
    bit, earlier = bits.reshape(1, -1), before.reshape(1, -1)
    fails, gone = (mask & bit) != 0, (mask & earlier) != 0
    whole = [m.astype(np.int64) for m in (~fails & ~gone, fails & ~gone, fails & gone, mask == bit)]
    return Incidence(["".join(filters[k] for k in o) for o in orders], steps.reshape(-1), *whole)


def mask_of(filters: Sequence[str]) -> Column:
    """The mask of a row with a boolean column for each filter; null is no failure."""
    bits = [F.when(F.col(f), F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(filters)]
    total = bits[0]
    for b in bits[1:]:
        total = total + b
    return total.cast("int")


def audit(rows: DataFrame, filters: Sequence[str] = FILTERS, tallies: Sequence[str] = ("good", "toxic")) -> DataFrame:
    """Counts for each part, order of ``filters`` and step, from ``rows`` (part, a boolean for each filter and each tally).

    Returns (part, filter_order, step, kept, removed, redundant, unique_fails, ``<tally>_lost`` for each tally, shapley): zeros are
    rows too. ``shapley`` is what the step's filter removes, summed over all orders. A null part is the empty one;
    nulls in filters and tallies are false. An empty table has no parts, so no rows.
    """
    if not 0 < len(filters) <= MOST_FILTERS or len(set(filters)) < len(filters) or any(len(f) != 1 for f in filters):
        raise ValueError(f"1 to {MOST_FILTERS} different filters of one letter are audited")
    part = F.coalesce(F.col("part").cast("string"), F.lit(""))
    marked = rows.select(part.alias("part"), mask_of(filters).alias("mask"), *(F.coalesce(F.col(t), F.lit(False)).alias(t) for t in tallies))
    counts = marked.groupBy("part", "mask").agg(F.count("*").alias("all"), *(F.count_if(t).alias(t) for t in tallies))
    # a part has a row for each mask at most
    stacked = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "all", *tallies)).alias("counts"))
    lost = [f"{t}_lost" for t in tallies]
    names = ["kept", "removed", "redundant", "unique_fails", *lost, "shapley"]

    def product(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = incidence(filters)
        of_filter = (m.letters[:, None] == np.arange(len(filters))).astype(np.int64)
        order = np.repeat(np.array(m.orders, object), len(filters))
        step = np.tile(np.arange(1, len(filters) + 1, dtype=np.int32), len(m.orders))
        for whole in batches:
            for first in range(0, len(whole), PARTS_AT_ONCE):
                pdf = whole.iloc[first : first + PARTS_AT_ONCE]
                n = len(pdf)
                # rows: the parts' histograms of all documents, then of each tally
                stack = np.zeros((1 + len(tallies), n, 1 << len(filters)), np.int64)
                for i, entries in enumerate(pdf["counts"]):
                    for e in entries:
                        stack[:, i, e["mask"]] = [e["all"], *(e[t] for t in tallies)]
                removed = stack @ m.removed
                values = [stack[0] @ m.kept, removed[0], stack[0] @ m.redundant, stack[0] @ m.unique, *removed[1:], (removed[0] @ of_filter)[:, m.letters]]
                yield pd.DataFrame(
                    {"part": np.repeat(pdf["part"].to_numpy(), len(step)), "filter_order": np.tile(order, n), "step": np.tile(step, n)}
                    | {name: v.reshape(-1) for name, v in zip(names, values, strict=True)}
                )

    return stacked.mapInPandas(product, "part string, filter_order string, step int, " + ", ".join(f"{n} long" for n in names))


def text_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, part, A to E, good, toxic) of ``docs`` (doc_id, text, lang); ``labels`` has (doc_id, quality, toxic).

    Words are runs other than U+0020 and U+0009 to U+000D. A: under 200 words. B: fewer than half of them distinct. C: more than 3
    of 100 code points are A to Z. D: one of ``#$%&*|``. E: the text is that of a row with a smaller doc_id, of whatever
    part, and kept or not.

    A null text is empty. Rows that repeat a doc_id are documents of their own, and none is smaller than the other; a
    null doc_id is smaller than none, larger than none, and has no labels. Of several labels of a document, one that says
    good (or toxic) is enough. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(F.col("_text"), r"[\x20\x09-\x0D]+"), "")
    plain = docs.select("doc_id", F.col("lang").alias("part"), text.alias("_text")).withColumn("_words", words)
    n_words = F.size("_words").cast("long")
    rows = materialize(
        plain.select(
            "doc_id", "part", (n_words < 200).alias("A"),
            (F.size(F.array_distinct("_words")).cast("long") * 100 < n_words * 50).alias("B"),
            (F.char_length(F.regexp_replace("_text", "[^A-Z]+", "")).cast("long") * 100 > F.char_length("_text").cast("long") * 3).alias("C"),
            F.col("_text").rlike(r"[#$%&*|]").alias("D"), F.sha2(F.col("_text").cast("binary"), 256).alias("_key"),
        ),
        "audit-rows",
    )
    known = rows.filter("doc_id is not null")
    firsts = known.groupBy("_key").agg(F.min("doc_id").alias("doc_id")).withColumn("_first", F.lit(True))
    told = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    marked = known.join(firsts, ["_key", "doc_id"], "left").join(told.filter("doc_id is not null"), "doc_id", "left")
    columns = ["doc_id", "part", *FILTERS, "good", "toxic"]
    no = F.lit(False)
    return marked.withColumn("E", F.col("_first").isNull()).select(*columns).unionByName(
        rows.filter("doc_id is null").withColumns({"E": no, "good": no, "toxic": no}).select(*columns)
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``audit`` of the five filters of ``text_filters``, by language."""
    return audit(text_filters(docs, labels))


_BEFORE = " + ".join(f"(case when step > {k} then bits[{k}] else 0 end)" for k in range(1, 5))

AUDIT_SQL = rf"""with texts as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents),
 cut as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words, min(doc_id) over (partition by text) as first_id from texts),
 told as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic from labels group by doc_id),
 masks as (select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
   case when len(words) < 200 then 1 else 0 end + case when 100 * len(list_distinct(words)) < 50 * len(words) then 2 else 0 end
   + case when 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text) then 4 else 0 end
   + case when regexp_matches(text, '[#$%&*|]') then 8 else 0 end + case when cut.doc_id > first_id then 16 else 0 end as mask
  from cut left join told on told.doc_id = cut.doc_id),
 counted as (select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from masks group by 1, 2),
 letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as l),
 orders as (select a.l || b.l || c.l || d.l || e.l as filter_order from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
 steps as (select filter_order, step, list_transform([1, 2, 3, 4, 5], lambda k: cast(pow(2, strpos('ABCDE', substring(filter_order, k, 1)) - 1) as integer)) as bits
  from orders, (select unnest([1, 2, 3, 4, 5]) as step)),
 cells as (select filter_order, step, bits[step] as bit, {_BEFORE} as before from steps),
 found as (select part, filter_order, step, bit,
   cast(sum(case when mask & (before + bit) = 0 then n else 0 end) as bigint) as kept, cast(sum(case when mask & bit > 0 and mask & before = 0 then n else 0 end) as bigint) as removed,
   cast(sum(case when mask & bit > 0 and mask & before > 0 then n else 0 end) as bigint) as redundant, cast(sum(case when mask = bit then n else 0 end) as bigint) as unique_fails,
   cast(sum(case when mask & bit > 0 and mask & before = 0 then good else 0 end) as bigint) as good_lost,
   cast(sum(case when mask & bit > 0 and mask & before = 0 then toxic else 0 end) as bigint) as toxic_lost
  from counted, cells group by 1, 2, 3, 4)
 select part, filter_order, cast(step as integer) as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  cast(sum(removed) over (partition by part, bit) as bigint) as shapley from found"""
