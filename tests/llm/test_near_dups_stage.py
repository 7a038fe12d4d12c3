import random

import numpy as np
from pyspark.sql import functions as F

from stranda.llm import components, near_dups
from stranda.llm.common import materialize

from .helpers import prose
from .test_dedup import find, shingle_set


def drifted(seed=6):
    """Texts and copies with two words changed: their sets share 80 to 85 percent of the union, or less."""
    rng = random.Random(seed)
    rows = []
    for k in range(30):
        words = prose(rng, 100 + k).split(" ")
        copy = list(words)
        for at in (20, 60):
            copy[at] = "changed"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(copy))]
    return rows


def similarity(a, b):
    x, y = shingle_set(a), shingle_set(b)
    return 100 * len(x & y) / len(x | y)


def brute(rows, percent):
    parent = {d: d for d, _ in rows}
    for k, (a, x) in enumerate(rows):
        for b, y in rows[k + 1 :]:
            if similarity(x, y) >= percent:
                a_, b_ = find(parent, a), find(parent, b)
                parent[max(a_, b_)] = min(a_, b_)
    return {d: find(parent, d) for d in parent}


def test_near_dups_stage_takes_four_fifths(spark):
    import corpus_pipeline as p

    rows = drifted()
    between = {b for (_, x), (b, y) in zip(rows[::2], rows[1::2], strict=True) if 80 <= similarity(x, y) < 85}
    assert len(between) > 20
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {d for d, c in brute(rows, 80).items() if d == c}
    assert {r.doc_id for r in p.near_dups(spark, docs, "").collect()} == want
    assert not want & between


def test_threshold_is_a_parameter(spark):
    rows = drifted(7)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (80, 85):
        got = near_dups.near_duplicates(docs, percent).select("doc_id", F.col("component_id")).collect()
        assert dict(map(tuple, got)) == brute(rows, percent)
        assert 2 * (1 - (percent / 100) ** near_dups.DEPTH) ** near_dups.groups_for(percent) <= near_dups.MISSED


def test_copies_that_are_too_far_apart_are_no_candidates(spark):
    """Copies of one text that differ in too much are not looked at pair by pair, and documents that share no group are in no table."""
    rng = random.Random(8)
    base = prose(rng, 80).split(" ")
    rows = []
    for k in range(60):
        copy = list(base)
        for at in (10, 40, 70):
            copy[at] = f"changed{k % 30}x{at}" if k < 30 else f"changed{k}"
        rows.append((k, " ".join(copy)))
    rows += [(100 + k, prose(rng, 60)) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = materialize(near_dups._classes(near_dups._class(near_dups.signatures(docs)).filter("n_shingles > 0")), "classes")
    shared = {r.rep for r in near_dups._shared_groups(classes).collect()}
    assert len(shared) > 30
    assert max(shared) < 100
    sets = near_dups._full_sets(docs, classes.select("rep", "class", "first"))
    members = classes.select("rep", "n", "bits", F.col("rep").alias("component"))
    assert near_dups._rare_prefix_pairs(members, sets, 85).count() == 0


def test_parities_bound_what_only_one_set_has():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 2**64, 300, np.uint64)
    for less in (0, 1, 40, 300):
        x, y = near_dups.parities(np.concatenate((a, a[less:])), np.array([0, 300, 600 - less]))
        assert int(np.bitwise_count(x ^ y).sum()) <= less
        assert less > 40 or int(np.bitwise_count(x ^ y).sum()) >= less * 0.8


def test_settled_links_take_no_round(spark, monkeypatch):
    """Links that all lead to the smallest of their component are told at once; any others go on."""
    monkeypatch.setattr(components, "MOST_ROUNDS", 1)
    stars = spark.createDataFrame([(1, 2), (1, 3), (5, 4)], "a long, b long")
    assert {tuple(r) for r in components.connected_components(stars).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)}
    for rows in ([(1, 2), (2, 3)], [(1, 3), (2, 3)]):
        assert not components._is_settled(spark.createDataFrame(rows, "b long, a long"))
