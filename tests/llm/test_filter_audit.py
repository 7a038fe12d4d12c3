import random
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from stranda.llm import filter_audit as fa

from .helpers import WORD, corpus

SCHEMA = "doc_id long, text string, lang string"


def fails(rows):
    """The set of failed filters of each row, one document at a time."""
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = WORD.findall(text)
        earlier = doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows)
        tests = (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            any(c in "#$%&*|" for c in text), earlier,
        )
        out.append({f for f, bad in zip("ABCDE", tests, strict=True) if bad})
    return out


def brute(rows, labels):
    """Every order is run over every document."""
    good, toxic = ({d for d, *x in labels if d is not None and x[k] == 1} for k in (0, 1))
    counts, removed_by = {}, Counter()
    parts = {lang or "" for *_, lang in rows}
    failed = fails(rows)
    for order in map("".join, permutations("ABCDE")):
        for step, letter in enumerate(order, 1):
            for part in parts:
                c = Counter()
                for (doc_id, _, lang), bad in zip(rows, failed, strict=True):
                    if (lang or "") != part:
                        continue
                    gone = bool(bad & set(order[: step - 1]))
                    c["kept"] += not bad & set(order[:step])
                    here = letter in bad and not gone
                    c["removed"] += here
                    c["redundant"] += letter in bad and gone
                    c["unique_fails"] += bad == {letter}
                    c["good_lost"] += here and doc_id in good
                    c["toxic_lost"] += here and doc_id in toxic
                counts[part, order, step] = c
                removed_by[part, letter] += c["removed"]
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return {k: (*(c[n] for n in names), removed_by[k[0], k[1][k[2] - 1]]) for k, c in counts.items()}


def found(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(out) == len(rows)
    return out


def test_against_every_order(spark):
    rng = random.Random(3)
    rows = [(i, t, rng.choice(["en", "de", "", None])) for i, t in corpus(n=25)]
    long = " ".join(f"w{k}" for k in range(230))
    rows += [(300, long, "en"), (301, long, "de"), (302, long + " #", "fr"), (303, "AB " * 250, "fr"), (299, "a " * 400, "fr"), (300, long, "en"), (None, long, "en"), (305, "É" * 40 + "A", "fr"), (306, "a\x0bb\x1cc\xa0d", "fr")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 304, 3)] + [(3, 1, 0), (3, 0, 0), (None, 1, 1), (9, None, None), (5000, 1, 1)]
    labels = [(i, q, None if t is None else int(t)) for i, q, t in labels]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as A", "'y' as part", "1 as _key", "2 as good", "3 as mask", "4 as `a.b`")
    got = found(fa.audit_documents(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'z' as text")))
    assert got == brute(rows, labels)
    assert len(got) == 600 * 4


def test_masks(spark):
    """Every mask once: what an order keeps at its end is the one document that fails nothing."""
    rows = [("p", *(bool(k >> b & 1) for b in range(5)), k % 2 == 0, None) for k in range(32)]
    got = found(fa.audit(spark.createDataFrame(rows, "part string, A boolean, B boolean, C boolean, D boolean, E boolean, good boolean, toxic boolean")))
    assert {v[0] for (_, _, step), v in got.items() if step == 5} == {1}
    assert {v[:4] for (_, _, step), v in got.items() if step == 1} == {(16, 16, 0, 1)}
    assert all(v[5] == 0 for v in got.values())
    for order in {o for _, o, _ in got}:
        assert sum(got["p", order, k][1] for k in range(1, 6)) == 31
    # each filter is worth the same here, and the values of all filters are what all orders remove
    assert {v[6] for v in got.values()} == {31 * 120 // 5}


def test_general_filters(spark):
    rows = [(k % 3, k % 2 == 0, None if k % 5 == 0 else k % 7 == 0, k == 4) for k in range(40)]
    df = spark.createDataFrame(rows, "part int, X boolean, Y boolean, hit boolean")
    got = {(r.part, r.filter_order, r.step): r for r in fa.audit(df, "XY", ("hit",)).collect()}
    assert len(got) == 3 * 2 * 2
    assert got["1", "XY", 1].hit_lost == 1
    assert sum(r.kept for (_, o, k), r in got.items() if (o, k) == ("YX", 2)) == sum(not x and not y for _, x, y, _ in rows)
    with pytest.raises(ValueError):
        fa.audit(df, "XX")


def test_empty(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fa.audit_documents(docs, labels).collect() == []
    got = found(fa.audit_documents(spark.createDataFrame([(None, None, None)], SCHEMA), labels))
    assert len(got) == 600
    assert {k[0] for k in got} == {""}
    assert {v[0] + v[1] + v[2] for v in got.values()} <= {0, 1}


def test_matrices():
    m = fa.incidence("ABCDE")
    assert m.kept.shape == m.removed.shape == (32, 600)
    assert len(set(m.orders)) == 120
    # a failure is removed now or was removed before, and neither is kept
    failing = (np.arange(32)[:, None] & (1 << m.letters)[None, :]) != 0
    assert (m.removed + m.redundant == failing).all()
    assert (m.kept * failing == 0).all()
