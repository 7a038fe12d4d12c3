import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from stranda.llm import common, line_dedup

from .helpers import prose
from .test_dedup import edit_distance


def copies(seed=21):
    """Lines of 10 to 260 words and copies with few changes, lines of one word many times over, and lines that share long words only."""
    rng = random.Random(seed)
    lines = ["again " * 12 + "end", "again " * 12 + "fin", "again " * 13 + "end"]
    for n in (10, 12, 19, 20, 25, 40, 61, 190, 205, 245, 260):
        words = prose(rng, n).split(" ")
        lines.append(" ".join(words))
        for most in (n // 10, n // 10, n // 10 + 1):
            copy = list(words)
            for _ in range(most):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randint(0, 1)] = rng.choice([[], ["other"], ["replaced", "twice"][: rng.randint(1, 2)]])
            lines.append(" ".join(copy))
    lines += [f"{prose(rng, 9)} internationalisation {prose(rng, 3)} incomprehensibilities" for _ in range(12)]
    return list(dict.fromkeys(lines))


@pytest.mark.parametrize(("few", "torn"), [(64, 1 << 17), (1, 1 << 17), (1, 0)])
def test_links_by_words_join_what_all_pairs_join(spark, monkeypatch, few, torn):
    """With keys of many lines told apart, compared with leaders and joined in blocks, and without."""
    monkeypatch.setattr(line_dedup, "FEW_LINES", few)
    monkeypatch.setattr(line_dedup, "TORN_ROWS", torn)
    monkeypatch.setattr(common, "BLOCK", 4)
    texts = copies()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = line_dedup.occurrences(docs)
    number = {r.id: r.doc_id for r in rows.select("id", "doc_id").collect()}
    links = line_dedup.similar_by_words(rows, common.materialize(line_dedup.line_classes(rows), "line-classes"))
    got = {frozenset((number[r.a], number[r.b])) for r in links.collect()}
    words = [x.split() for x in texts]
    near = set()
    for a, b in combinations(range(len(texts)), 2):
        least = min(len(words[a]), len(words[b])) // 10
        if abs(len(words[a]) - len(words[b])) <= least and edit_distance(words[a], words[b]) <= least:
            near.add(frozenset((a, b)))
    assert len(near) > 20

    def groups(links):
        of = {k: k for k in range(len(texts))}
        for _ in of:
            for a, b in map(sorted, links):
                of[a] = of[b] = min(of[a], of[b])
        return of

    assert groups(got) == groups(near)


def test_lines_that_share_a_passage_are_no_candidates(spark):
    """The pairs to be looked at do not grow with the square of the lines that share a passage and nothing else."""
    rng = random.Random(6)
    lines = [f"{prose(rng, 30)} notwithstanding internationalisation incomprehensibilities {prose(rng, 20)}" for _ in range(90)]
    rows = line_dedup.occurrences(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    sets = common.materialize(line_dedup._word_sets(rows.select("line", "id"), line_dedup.DISTANCE), "word-sets")
    found, held = line_dedup._few_and_many(sets, line_dedup.DISTANCE, line_dedup.LEVELS)
    assert found.count() == 0
    a, b = line_dedup._sides(held)
    assert held.select("id").distinct().count() == 90
    assert a.join(b, "key").filter(line_dedup._in_order() & line_dedup._may_be_near(line_dedup.DISTANCE)).count() == 0
    assert sets.filter(F.size("keys") > 60).count() == 0


def test_pairs_that_are_left_are_made_once(spark):
    """Lines that share many keys and may be near are paired under the first of these only, and no pair is lost."""
    rng = random.Random(7)
    base = prose(rng, 60).split(" ")
    lines = []
    for k in range(80):
        copy = list(base)
        for at in rng.sample(range(60), 4):
            copy[at] = f"w{k}"
        lines.append(" ".join([*copy, "again", "again"]))
    rows = line_dedup.occurrences(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    sets = common.materialize(line_dedup._word_sets(rows.select("line", "id"), line_dedup.DISTANCE), "word-sets")
    for levels in (1, line_dedup.LEVELS):
        found, held = line_dedup._few_and_many(sets, line_dedup.DISTANCE, levels)
        torn = common.materialize(held.withColumn("component", F.col("id")), "torn")
        a, b = line_dedup._sides(torn)
        every = a.join(b, "key").filter(line_dedup._in_order() & line_dedup._may_be_near(line_dedup.DISTANCE)).select("a", "b")
        done = found.distinct()
        once = line_dedup._cross_pairs(torn, line_dedup.DISTANCE)
        assert every.distinct().exceptAll(once.union(done).distinct()).isEmpty()
        a, b = line_dedup._sides(torn, "before")
        met = a.join(b, "key").filter(line_dedup._in_order() & line_dedup._may_be_near(line_dedup.DISTANCE) & ~F.arrays_overlap("a_before", "b_before"))
        assert met.count() == met.select("a", "b").distinct().count() < every.count() / 5


def test_lines_of_the_same_words_in_other_orders_are_not_paired(spark):
    """Pairs that only numbers and parities of words allow are not written; a near copy is."""
    rng = random.Random(8)
    words = prose(rng, 40).split(" ")
    lines = [" ".join(rng.sample(words, len(words))) for _ in range(70)]
    lines.append(" ".join([*lines[0].split(" ")[:-1], "other"]))
    rows = line_dedup.occurrences(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    sets = common.materialize(line_dedup._word_sets(rows.select("line", "id"), line_dedup.DISTANCE), "word-sets")
    _, held = line_dedup._few_and_many(sets, line_dedup.DISTANCE, 1)
    torn = common.materialize(held.withColumn("component", F.col("id")), "torn")
    texts = common.materialize(rows.select("id", line_dedup._outline(line_dedup._words(F.col("line"))).alias("c")), "texts")
    number = {r.id: r.doc_id for r in rows.select("id", "doc_id").collect()}
    assert line_dedup._cross_pairs(torn, line_dedup.DISTANCE).count() > 2_000
    assert [{number[r.a], number[r.b]} for r in line_dedup._cross_pairs(torn, line_dedup.DISTANCE, texts).collect()] == [{0, 70}]
