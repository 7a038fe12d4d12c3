import random
from collections import defaultdict
from itertools import combinations

from stranda.llm import queries

from .helpers import prose
from .test_dedup import edit_distance, find


def edited_rows(seed=9):
    """Lines of 8 to 120 words and copies with some words changed, added or dropped."""
    rng = random.Random(seed)
    rows = []
    for k in range(70):
        words = prose(rng, rng.choice([8, 9, 10, 11, 14, 19, 20, 21, 22, 25, 30, 32, 39, 43, 60, 90, 97, 120])).split(" ")
        lines = [" ".join(words)]
        for _ in range(2):
            copy = list(words)
            for _ in range(rng.randint(1, len(words) // 10 + 1)):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randint(0, 1)] = rng.choice([[], ["other"], ["replaced"]])
            lines.append(" ".join(copy))
        rows.append((k, "\n".join(lines)))
    return rows


def brute(rows):
    first, places = {}, []
    for d, t in rows:
        for k, line in enumerate(t.split("\n")):
            first.setdefault(line, (d, k))
            places.append((d, k, line))
    words = {x: x.split() for x in first}
    parent = {x: x for x in first}
    for a, b in combinations(first, 2):
        few = min(len(words[a]), len(words[b])) // 10
        near = abs(len(words[a]) - len(words[b])) <= few and len(set(words[a]) & set(words[b])) > 3 and edit_distance(words[a], words[b]) <= few
        if near or abs(len(a) - len(b)) <= 2 and a[:3] + a[-3:] == b[:3] + b[-3:] and edit_distance(a, b) <= 2:
            a, b = find(parent, a), find(parent, b)
            parent[max(a, b, key=first.get)] = min(a, b, key=first.get)
    gone = defaultdict(set)
    for d, k, line in places:
        if first[find(parent, line)] != (d, k):
            gone[d].add(k)
    return gone


def test_op2_links_lines_that_differ_in_few_words(spark, tmp_path):
    rows = edited_rows()
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = brute(rows)
    assert sum(map(len, want.values())) > 40
    assert {r.doc_id: set(r.removed) for r in queries.op2_line_dedup(spark, str(tmp_path)).collect()} == {d: want[d] for d, _ in rows}
