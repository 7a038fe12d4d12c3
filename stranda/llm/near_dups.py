"""Near-duplicate documents by MinHash with tensored banding and confirmation on full shingle sets.

Two small collections of ``GROUPS`` groups of ``DEPTH`` minhashes are computed for each document; every pair of
a group from one and a group from the other is the key of a table. ``2 * GROUPS * DEPTH`` minhashes thus serve
``GROUPS ** 2`` tables of ``2 * DEPTH`` minhashes each. At a threshold ``t`` a pair shares no table with
probability ``2 * (1 - t**DEPTH) ** GROUPS`` at most; lower thresholds take more groups (``groups_for``).

Documents with equal sets are one class from the start, known by its smallest doc_id. Two classes share a table only if
they share both its groups, so tables are made of groups that several classes have. In each bucket all classes are
compared with its smallest and with ``STARS`` more, picked by hash, in blocks where one of these has many; links are confirmed on full
sets, and components are formed. Of buckets whose classes still lie in several components, small ones are compared pair by pair. The
classes of the larger ones are joined exactly on the rarest shingles of their sets (any two sets that are
similar enough share one of these), so no bucket is ever expanded into all its pairs and no link is lost. All these pairs
are bounded first by the parities of their sets in ``PARITIES`` bits: a shingle that only one of two sets has changes one bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dealt, large_keys, materialize, repeated, settled, small_batches, text_bytes, tidy
from .components import connected_components
from .words import mix, windows, word_hashes

WORDS = 5
#: Least similarity, in percent, where the caller names none.
PERCENT = 85
GROUPS, DEPTH = 9, 2
#: Largest probability that a pair at the threshold shares no table.
MISSED = 2e-5
#: Buckets of at most so many classes are compared pair by pair where they join several components.
SMALL_BUCKET = 8
#: Classes of a bucket of more than two that all its others are compared with, besides its smallest, before the exact rest.
STARS = 2
#: Bits of the parities of a set, and numbers that hold them.
PARITIES = 512
PARITY_LONGS = PARITIES // 64

_U64 = np.uint64


def groups_for(percent: int) -> int:
    """Groups on each side, GROUPS at least, with which a pair at the threshold is missed with probability MISSED at most."""
    g = GROUPS
    while percent < 100 and 2 * (1 - (percent / 100) ** DEPTH) ** g > MISSED:
        g += 1
    return g


def shingles(texts: list[bytes], n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles in ascending order, and the offset of each text's first.

    A-Z are lower-cased first. A text with fewer than ``n`` words is one shingle, one without words has none.
    """
    hashes, edges = word_hashes([t.lower() for t in texts])
    window, _, owner = windows(hashes, edges, n)
    counts = np.diff(edges)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        own = []
        for k in short:
            h = _U64(0)
            with np.errstate(over="ignore"):
                for x in hashes[edges[k] : edges[k + 1]]:
                    h = h * _U64(0x9E3779B97F4A7C15) + x
            own.append(h)
        window = np.concatenate((window, mix(np.array(own, _U64) + counts[short].astype(_U64))))
        owner = np.concatenate((owner, short))
    order = np.lexsort((window, owner))
    window, owner = window[order], owner[order]
    new = np.ones(len(window), bool)
    new[1:] = (window[1:] != window[:-1]) | (owner[1:] != owner[:-1])
    window, owner = window[new], owner[new]
    return window, np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(texts))))).astype(np.int64)


def _per_text(ufunc: np.ufunc, values: np.ndarray, edges: np.ndarray, empty: np.ndarray) -> np.ndarray:
    out = np.zeros(len(edges) - 1, _U64)
    if len(values):
        out[~empty] = ufunc.reduceat(values, edges[:-1][~empty])
    return out


def minhash_groups(sets: np.ndarray, edges: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """A row for each text, of the hashes of its ``2 * groups`` groups of ``DEPTH`` minhashes."""
    seeds = mix(np.arange(1, 2 * groups * DEPTH + 1).astype(_U64) * _U64(0x9E3779B97F4A7C15))
    empty = np.diff(edges) == 0
    out = np.zeros((len(edges) - 1, 2 * groups), _U64)
    for g in range(2 * groups):
        for d in range(DEPTH):
            seed = seeds[g * DEPTH + d]
            least = _per_text(np.minimum, (sets ^ seed) * (seed | _U64(1)), edges, empty)
            out[:, g] = mix(out[:, g] * _U64(31) + least)
    return out


def parities(sets: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """A row for each text, of PARITY_LONGS numbers: whether each of PARITIES classes of hashes has an odd number of its shingles."""
    n = len(edges) - 1
    owner = np.repeat(np.arange(n), np.diff(edges))
    odd = np.bincount(owner * PARITIES + (sets % _U64(PARITIES)).astype(np.int64), minlength=n * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).reshape(n, PARITY_LONGS)


def signatures(docs: DataFrame, groups_a_side: int = GROUPS) -> DataFrame:
    """doc_id, n_shingles, two fingerprints of the set, the left and right groups, and the parities."""
    small_batches(docs.sparkSession)

    @tidy
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, edges = shingles(batch.column("_bytes").to_pylist())
            empty = np.diff(edges) == 0
            groups = minhash_groups(sets, edges, groups_a_side).astype(np.int64)
            lists = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(edges)),
                    pa.array(_per_text(np.add, mix(sets), edges, empty).astype(np.int64)),
                    pa.array(_per_text(np.bitwise_xor, mix(~sets), edges, empty).astype(np.int64)),
                    lists(groups[:, :groups_a_side]),
                    lists(groups[:, groups_a_side:]),
                    lists(parities(sets, edges)),
                ],
                ["doc_id", "n_shingles", "set_sum", "set_xor", "left", "right", "bits"],
            )

    schema = "doc_id long, n_shingles long, set_sum long, set_xor long, left array<long>, right array<long>, bits array<long>"
    return text_bytes(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id").mapInArrow(sign, schema)


def _shared_groups(classes: DataFrame) -> DataFrame:
    """rep and its left and right groups that other classes have too, of the classes that have such groups on both sides."""
    rows = classes.select("rep", F.size("left").alias("side"), F.posexplode(F.concat("left", "right")).alias("at", "h"))
    rows = rows.select("rep", (F.col("at") < F.col("side")).alias("is_left"), F.xxhash64("at", "h").alias("part"))
    shared = rows.groupBy("part").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi").select("part")
    # bounded by the groups of one class
    sides = [F.collect_list(F.when(F.col("is_left") == left, F.col("part"))).alias(name) for left, name in ((True, "left"), (False, "right"))]
    return rows.join(shared, "part", "left_semi").groupBy("rep").agg(*sides).filter((F.size("left") > 0) & (F.size("right") > 0))


def _keys(groups: DataFrame) -> DataFrame:
    """(key, rep): a row for each table of each of ``groups`` (rep, left, right)."""
    left = groups.select("rep", "right", F.explode("left").alias("l"))
    return left.select("rep", "l", F.explode("right").alias("r")).select(F.xxhash64("l", "r").alias("key"), "rep")


def _near_sizes(a: Column, b: Column, percent: int) -> Column:
    return (100 * F.least(a, b)) >= (percent * F.greatest(a, b))


def _may_be_near(a: str, b: str, percent: int) -> Column:
    """What sizes and parities say of two sets (columns ``n`` and ``bits`` with the endings ``a`` and ``b``).

    Of two sets of which one shares ``percent`` of their union, at most ``(100 - percent) / (100 + percent)`` of both sizes is in one only.
    """
    n, m, x, y = (F.col(f"{c}{s}") for c in ("n", "bits") for s in (a, b))
    odd = sum(F.bit_count(F.get(x, F.lit(k)).bitwiseXOR(F.get(y, F.lit(k)))) for k in range(PARITY_LONGS))
    return _near_sizes(n, m, percent) & (odd * (100 + percent) <= (n + m) * (100 - percent))


def _class(rows: DataFrame) -> DataFrame:
    return rows.withColumn("class", F.xxhash64("set_sum", "set_xor", "n_shingles"))


def _classes(linked: DataFrame) -> DataFrame:
    """rep, class, first, n, left, right and bits of each class: ``rep`` is its smallest doc_id, ``first``, or, where that
    has several texts, for all but one of their classes the class's hash.
    """
    named = linked.groupBy("class").agg(F.min("doc_id").alias("first"))
    owners = named.groupBy("first").agg(F.min("class").alias("owner"))
    rep = F.when(F.col("class") == F.col("owner"), F.col("first")).otherwise(F.col("class"))
    found = linked.withColumnRenamed("doc_id", "first").join(named.join(owners, "first").withColumn("rep", rep), ["class", "first"])
    return found.select("rep", "class", "first", F.col("n_shingles").alias("n"), "left", "right", "bits").dropDuplicates(["class"])


def _full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The sorted shingle hashes of the classes ``wanted`` (rep, class, first), read from the documents that they occur in first."""

    @tidy
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, edges = shingles(batch.column("_bytes").to_pylist())
            empty = np.diff(edges) == 0
            values = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(sets.astype(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.diff(edges)),
                    pa.array(_per_text(np.add, mix(sets), edges, empty).astype(np.int64)),
                    pa.array(_per_text(np.bitwise_xor, mix(~sets), edges, empty).astype(np.int64)),
                    values,
                ],
                ["n_shingles", "set_sum", "set_xor", "shingles"],
            )

    own = docs.select(F.col("doc_id").cast("long").alias("first"), "text").join(wanted.select("first"), "first", "left_semi")
    rows = _class(text_bytes(own).mapInArrow(read, "n_shingles long, set_sum long, set_xor long, shingles array<long>"))
    # rows of a class are all the same
    return rows.select("class", "shingles").dropDuplicates(["class"]).join(wanted.select("class", "rep"), "class").select("rep", "shingles")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. The set of an ``a`` with many pairs goes to each of its blocks once."""
    left, right = (sets.select(F.col("rep").alias(c), F.col("shingles").alias(f"s_{c}")) for c in ("a", "b"))
    large = large_keys(pairs, "a")
    both = F.size(F.array_intersect("s_a", "s_b"))
    union = F.size("s_a") + F.size("s_b") - both
    met = dealt(pairs, large, "a", "b").join(right, "b").join(repeated(left, large, "a"), ["a", "block"])
    return met.filter(100 * both >= percent * union).select("a", "b")


def _rare_prefix_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of ``members`` (rep, n, bits, component) in different components that share a rare shingle.

    Shingles are ordered by how many members have them. Two sets of which one is at least ``percent`` of their
    union share one of the first ``n - ceil(n * percent / 100) + 1`` shingles of each.
    """
    own = sets.join(members.select("rep", "n"), "rep").select("rep", "n", F.explode("shingles").alias("shingle"))
    held = own.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1")
    # a shingle that no other member has comes first and is in no pair, so that only the number of these counts
    ranked = (
        own.join(held, "shingle")
        .groupBy("rep", "n")
        .agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("s"))  # one set, bounded by its text
        .withColumn("own", F.col("n") - F.size("s"))
        .withColumn("k", (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - F.col("own")).cast("int"))
        .filter("k > 0")
        .select("rep", "own", F.posexplode(F.expr("slice(s, 1, k)")).alias("at", "x"))
        .select("rep", (F.col("own") + F.col("at")).alias("at"), F.col("x.shingle").alias("shingle"))
    )
    ranked = materialize(ranked.join(members, "rep"), "rare-shingles")
    a, b = (ranked.select("shingle", *(F.col(c).alias(f"{c}_{s}") for c in ("rep", "n", "bits", "component", "at"))) for s in "ab")
    rest = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    needed = F.ceil((F.col("n_a") + F.col("n_b")) * percent / (100 + percent))
    near = (F.col("rep_a") < F.col("rep_b")) & (F.col("component_a") != F.col("component_b"))
    near = near & (rest >= needed) & _may_be_near("_a", "_b", percent)
    large = large_keys(ranked, "shingle")
    met = dealt(a, large, "shingle", "rep_a").join(repeated(b, large, "shingle"), ["shingle", "block"])
    return met.filter(near).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()


def _with_leaders(rows: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a leader and another class of its bucket, of ``rows`` (leader, rep), that sizes and parities allow."""
    met = materialize(rows.filter("rep <> leader").distinct().join(known, "rep"), "leader-pairs")
    large = large_keys(met, "leader")
    leaders = repeated(known.toDF("leader", "n_leader", "bits_leader"), large, "leader")
    both = dealt(met.toDF("rep", "leader", "n_rep", "bits_rep"), large, "leader", "rep").join(leaders, ["leader", "block"])
    return both.filter(_may_be_near("_rep", "_leader", percent)).select(F.col("leader").alias("a"), F.col("rep").alias("b"))


def _left_over(buckets: DataFrame, components: DataFrame) -> DataFrame:
    """key, held, rep and component of the buckets (key, held, rep) whose classes lie in several of ``components`` (node, component)."""
    held = buckets.join(components.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    torn = held.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    return held.join(torn.select("key"), "key", "left_semi").select("key", "held", "rep", "component")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs`` (doc_id, text, ...).

    Documents are linked where their sets share ``percent`` of their union or more.
    A null or empty text, or one of white space, has no shingles and is linked with nothing. Rows with a
    null doc_id are linked with nothing either: their component is null and they are kept. Repeated rows
    count as one document; a doc_id with several texts is one node that has the links of each. An empty table
    gives no rows. Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    signed = _class(materialize(signatures(docs, groups_for(percent)), "signatures"))
    of_class = settled("class-components", lambda: _class_components(docs, signed, percent))
    # rows of a class meet its one component; a class with very many rows is dealt anew by the join itself
    found = signed.join(of_class, "class", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def _class_components(docs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """class and component_id of the classes of ``signed`` documents."""
    linked = signed.filter("doc_id is not null and n_shingles > 0")
    classes = materialize(_classes(linked), "classes")
    keys = _keys(materialize(_shared_groups(classes), "shared-groups"))
    stars = [F.min_by("rep", F.xxhash64("rep", F.lit(star))) for star in range(STARS)]
    shared = keys.groupBy("key").agg(F.min("rep").alias("leader"), F.max("rep").alias("last"), F.count("*").alias("held"), F.array(*stars).alias("stars"))
    leaders = F.when(F.col("held") > 2, F.array_distinct(F.concat(F.array("leader"), "stars"))).otherwise(F.array("leader"))
    known = classes.select("rep", "n", "bits")
    buckets = materialize(keys.join(shared.filter("leader < last").select("key", "held", leaders.alias("leaders")), "key"), "buckets")
    led = buckets.select("rep", "leaders", F.explode("leaders").alias("leader"))
    # two leaders of a bucket are one pair
    led = led.filter(~F.array_contains("leaders", F.col("rep")) | (F.col("leader") < F.col("rep"))).select("leader", "rep")
    pairs = settled("pairs", lambda: _with_leaders(led, known, percent))
    wanted = classes.select("rep", "class", "first").join(buckets.select("rep").distinct(), "rep", "left_semi")
    sets = materialize(_full_sets(docs, wanted), "sets")
    links = connected_components(materialize(_confirmed(pairs, sets, percent), "confirmed"))
    left_over = materialize(_left_over(buckets.select("key", "held", "rep"), links), "left-over").join(known, "rep")
    a, b = (
        left_over.filter(F.col("held") <= SMALL_BUCKET).select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("rep", "n", "bits", "component")))
        for s in "ab"
    )
    near = (F.col("rep_a") < F.col("rep_b")) & (F.col("component_a") != F.col("component_b")) & _may_be_near("_a", "_b", percent)
    direct = a.join(b, (a["key"] == b["key"]) & near).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()
    members = left_over.filter(F.col("held") > SMALL_BUCKET).select("rep", "n", "bits", "component").distinct()
    more = direct.union(_rare_prefix_pairs(members, sets, percent)).distinct()
    done = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = materialize(more.join(done, ["a", "b"], "left_anti"), "pairs")
    late = materialize(_confirmed(more, sets, percent), "confirmed")
    # texts of one doc_id are one node
    texts = linked.select("doc_id", "class").distinct()
    several = texts.groupBy("doc_id").agg(F.min("class").alias("one"), F.max("class").alias("last")).filter("one < last").select("doc_id", "one")
    of = lambda c, name: classes.select(F.col("class").alias(c), F.col("rep").alias(name))
    same = texts.join(several, "doc_id").join(of("one", "a"), "one").join(of("class", "b"), "class").select("a", "b")
    # what is linked so far leads to the smallest of its component
    so_far = links.select(F.col("component").alias("a"), F.col("node").alias("b"))
    joined = connected_components(so_far.union(late).union(same)).withColumnRenamed("node", "rep")

    of_class = classes.select("rep", "class", "first").join(joined, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    smallest = of_class.groupBy("component").agg(F.min("first").alias("component_id"))
    return of_class.join(smallest, "component").select("class", "component_id")


#: DuckDB SQL for the rows of ``near_duplicates``: every pair of different sets that share a shingle is compared on the full sets.
COMPONENTS_SQL = rf"""with recursive worded as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') as w from documents),
sets as (select doc_id, case when len(w) = 0 then [] when len(w) < {WORDS} then [array_to_string(w, ' ')]
  else list_sort(list_distinct([array_to_string(list_slice(w, i, i + {WORDS} - 1), ' ') for i in range(1, len(w) - {WORDS} + 2)])) end as shingles from worded),
led as (select doc_id, len(shingles) as n, shingles, case when len(shingles) = 0 then doc_id else min(doc_id) over (partition by shingles) end as leader from sets),
members as (select leader, n, unnest(shingles) as shingle from led where doc_id = leader),
shared as (select a.leader as x, b.leader as y, a.n as nx, b.n as ny, count(*) as common
  from members a join members b on a.shingle = b.shingle and a.leader < b.leader group by all),
links as (select x, y from shared where 100 * common >= {PERCENT} * (nx + ny - common)),
edges as (select x, y from links union all select y, x from links),
reach as (select distinct leader as x, leader as y from led union select r.x, e.y from reach r join edges e on r.y = e.x),
roots as (select x, min(y) as root from reach group by x)
select doc_id, cast(n as bigint) as n_shingles, cast(root as bigint) as component_id, doc_id = root as kept from led join roots on x = leader"""
