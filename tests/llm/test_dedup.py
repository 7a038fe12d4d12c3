import random
from collections import defaultdict
from itertools import combinations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stranda.llm import common, line_dedup, near_dups
from stranda.llm.components import connected_components

from .helpers import WORD, corpus, prose


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_components(spark, edges):
    parent = {x: x for e in edges for x in e}
    for a, b in edges:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(parent, x) for a, b in edges if a != b for x in (a, b)}


def test_long_chain(spark):
    edges = [(k, k + 1) for k in range(70)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.component for r in got} == {0}
    assert len(got) == 71


def test_banded_distance(spark):
    rng = random.Random(2)
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(1, 14)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(b) + 1)
            b[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "b", "é"])
        b = "".join(b)
        pairs.append((max(a, b, key=len), min(a, b, key=len) if len(a) != len(b) else b))
    for k in (0, 1, 2, 5):
        df = spark.createDataFrame([(a, b) for a, b in pairs if len(a) - len(b) <= k], "a string, b string")
        for r in df.select("a", "b", line_dedup.edit_distance(F.col("a"), F.col("b"), k).alias("d")).collect():
            want = edit_distance(r.a, r.b)
            assert r.d == want if want <= k else r.d > k


def line_rows(seed=3):
    rng = random.Random(seed)
    base = [prose(rng, 9) for _ in range(12)]
    rows = []
    for k in range(70):
        lines = []
        for _ in range(rng.randint(1, 5)):
            line = list(rng.choice(base) if rng.random() < 0.6 else prose(rng, 8))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(line))
                line[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "é", "yz"])
            lines.append("".join(line))
        rows.append((k, "\n".join([*lines, "short", " " * 30])))
    return rows


def brute_lines(rows, distance, least):
    first, places = {}, []
    for d, t in sorted({(d, t) for d, t in rows if d is not None and t is not None}):
        for k, line in enumerate(t.split("\n")):
            if len(line) >= least and any(not c.isspace() for c in line):
                first[line] = min(first.get(line, (d, k)), (d, k))
                places.append((d, k, line))
    parent = {x: x for x in first}
    for a, b in combinations(first, 2):
        if abs(len(a) - len(b)) <= distance and edit_distance(a, b) <= distance:
            a, b = find(parent, a), find(parent, b)
            parent[max(a, b, key=lambda x: first[x])] = min(a, b, key=lambda x: first[x])
    gone = defaultdict(set)
    for d, k, line in places:
        if first[find(parent, line)] != (d, k):
            gone[d].add(k)
    return gone


def test_line_dedup(spark, llm):
    for rows in (line_rows(), [r for r in corpus(9, 25) if r[0] != 205]):
        want = brute_lines(rows, 2, line_dedup.LEAST_CHARS)
        got = line_dedup.line_report(llm(rows)).collect()
        assert len(got) == len(rows)
        assert all(set(r.removed) == want[r.doc_id] and r.n_removed == len(want[r.doc_id]) for r in got if r.doc_id is not None)
        assert all(r.n_removed == 0 for r in got if r.doc_id is None)
        docs = llm(rows)
        cut = line_dedup.dedup_lines(docs)
        assert cut.columns == docs.columns
        texts = sorted(((r.doc_id is not None, r.doc_id or 0), r.text or "") for r in cut.collect())
        expected = []
        for d, t in rows:
            kept = t if t is None or not want[d] else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want[d])
            if t is None or not want[d] or kept.strip():
                expected.append(((d is not None, d or 0), kept or ""))
        assert texts == sorted(expected)
    assert line_dedup.line_report(llm([])).collect() == []


def shingle_set(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute_near(rows):
    sets = [(d, shingle_set(t)) for d, t in rows]
    parent = {d: d for d, _ in sets if d is not None}
    for (a, x), (b, y) in combinations([s for s in sets if s[0] is not None], 2):
        both = len(x & y)
        if x and y and 100 * both >= 85 * (len(x) + len(y) - both):
            a, b = find(parent, a), find(parent, b)
            parent[max(a, b)] = min(a, b)
    return sorted((d is not None, d or 0, len(s), -1 if d is None else find(parent, d)) for d, s in sets)


def check_near(rows, got):
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_shingles, -1 if r.doc_id is None else r.component_id) for r in got) == brute_near(rows)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_near_duplicates(spark, llm):
    rows = corpus()
    check_near(rows, near_dups.near_duplicates(llm(rows)).collect())
    assert near_dups.near_duplicates(llm([])).collect() == []


def test_near_duplicates_in_large_groups(spark, llm):
    """Copies of one text that drift apart: many share buckets, only neighbours are similar enough."""
    rng = random.Random(4)
    words = prose(rng, 160).split(" ")
    rows = []
    for k in range(60):
        if k % 2:
            words[rng.randrange(len(words))] = prose(rng, 1)
        else:
            for _ in range(3):
                words[rng.randrange(len(words))] = prose(rng, 1)
        rows.append((k * 7 % 61, " ".join(words)))
    check_near(rows, near_dups.near_duplicates(llm(rows)).collect())


def test_texts_of_one_id_are_one_node(spark, llm):
    rng = random.Random(31)
    one, two, three = (prose(rng, 60) for _ in range(3))
    rows = [(5, one), (5, two), (2, f"{one} end"), (9, two), (4, three), (5, one), (5, None), (7, None)]
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_dups.near_duplicates(llm(rows)).collect()}
    assert got == {(5, 56): (2, False), (2, 57): (2, True), (9, 56): (2, False), (4, 56): (4, True), (5, 0): (5, True), (7, 0): (7, True)}


def test_large_keys_are_joined_in_blocks(spark, llm, monkeypatch):
    monkeypatch.setattr(common, "BLOCK", 4)
    rows = corpus(12, 40)
    check_near(rows, near_dups.near_duplicates(llm(rows)).collect())
    rows = line_rows(14)
    want = brute_lines(rows, 2, line_dedup.LEAST_CHARS)
    assert all(set(r.removed) == want[r.doc_id] for r in line_dedup.line_report(llm(rows)).collect())
    pairs = spark.createDataFrame([(0, k) for k in range(30)] + [(1, 2)], "key long, a long")
    large = common.large_keys(pairs, "key")
    assert [tuple(r) for r in large.collect()] == [(0, 8)]
    met = common.dealt(pairs, large, "key", "a").join(common.repeated(pairs.withColumnRenamed("a", "b"), large, "key"), ["key", "block"])
    assert met.count() == 901
