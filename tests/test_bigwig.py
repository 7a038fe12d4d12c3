"""bigWig files that a helper writes: every kind of block, both byte orders, and indexes of several levels."""

import random
import struct
import zlib

import pytest

from stranda.operators.signal import score_stats
from stranda.sources import bigwig
from stranda.sources.readers import scan_signal

KINDS = {"bed": 1, "variable": 2, "fixed": 3}


def node(order, items, fan, leaf_kinds, branch_kinds, base, span):
    """Nodes of a tree over ``items`` (key, packed), written level by level at ``base``; the root comes first."""
    levels = [[(key, data) for key, data in items]]
    groups = [[levels[0][k : k + fan] for k in range(0, len(items), fan)] or [[]]]
    while len(groups[-1]) > 1:
        above = [(span([k for k, _ in g]), None) for g in groups[-1]]
        groups.append([above[k : k + fan] for k in range(0, len(above), fan)])
    sizes = [struct.calcsize(order + (leaf_kinds if k == 0 else branch_kinds)) for k in range(len(groups))]
    at, places = base, {}
    for level in range(len(groups) - 1, -1, -1):
        for n, g in enumerate(groups[level]):
            places[level, n] = at
            at += 4 + sizes[level] * len(g)
    out = b""
    for level in range(len(groups) - 1, -1, -1):
        child = 0
        for g in groups[level]:
            out += struct.pack(order + "BBH", level == 0, 0, len(g))
            for key, data in g:
                if level == 0:
                    out += data
                else:
                    out += struct.pack(order + branch_kinds, *key, places[level - 1, child])
                    child += 1
    return out


def write_bigwig(path, lengths, blocks, order="<", packed=True, fan=3):
    """``blocks``: (contig, kind, step, span, [(start, end, value)])."""
    names = sorted(lengths)
    number = {n: k for k, n in enumerate(names)}
    key = max(map(len, names))
    leaves = [((n.encode(),), struct.pack(f"{order}{key}sII", n.encode(), number[n], lengths[n])) for n in names]
    tree_at = 64
    tree = struct.pack(order + "IIIIQQ", bigwig.CONTIG_MAGIC, fan, key, 8, len(names), 0)
    tree += node(order, leaves, fan, f"{key}sII", f"{key}sQ", tree_at + 32, lambda keys: keys[0])
    data_at = tree_at + len(tree)
    data, entries, largest = struct.pack(order + "Q", len(blocks)), [], 0
    for contig, kind, step, span, rows in sorted(blocks, key=lambda b: (number[b[0]], b[4][0][0])):
        raw = struct.pack(order + "IIIIIBBH", number[contig], rows[0][0], rows[-1][1], step, span, KINDS[kind], 0, len(rows))
        pack = {"bed": lambda r: struct.pack(order + "IIf", *r), "variable": lambda r: struct.pack(order + "If", r[0], r[2]), "fixed": lambda r: struct.pack(order + "f", r[2])}[kind]
        raw += b"".join(map(pack, rows))
        largest = max(largest, len(raw))
        raw = zlib.compress(raw) if packed else raw
        where = (number[contig], rows[0][0], number[contig], rows[-1][1])
        entries.append((where, struct.pack(order + "IIIIQQ", *where, data_at + len(data), len(raw))))
        data += raw
    index_at = data_at + len(data)
    whole = lambda keys: (*min(k[:2] for k in keys), *max(k[2:] for k in keys))
    index = struct.pack(order + "IIQIIIIQII", bigwig.INDEX_MAGIC, fan, len(entries), *(whole([k for k, _ in entries]) if entries else (0,) * 4), index_at, 1, 0)
    index += node(order, entries, fan, "IIIIQQ", "IIIIQ", index_at + 48, whole)
    head = struct.pack(order + "IHHQQQHHQQIQ", bigwig.FILE_MAGIC, 4, 0, tree_at, data_at, index_at, 0, 0, 0, 0, largest if packed else 0, 0)
    path.write_bytes(head + tree + data + index)


def track(seed, contigs=5, blocks=30):
    rng = random.Random(seed)
    lengths = {f"chr{k}" + "x" * (k % 3): 5000 for k in range(contigs)}
    out, at = [], dict.fromkeys(lengths, 0)
    for _ in range(blocks):
        c, kind = rng.choice(sorted(lengths)), rng.choice(sorted(KINDS))
        span = 1 if kind == "bed" else rng.randint(1, 4)
        step = span + rng.randint(0, 3)
        pos, rows = at[c] + rng.randint(0, 30), []
        for _ in range(rng.randint(1, 12)):
            end = pos + (rng.randint(1, 20) if kind == "bed" else span)
            rows.append((pos, end, rng.randint(-400, 400) / 8))
            pos = pos + step if kind == "fixed" else end + rng.randint(0, 5)
        at[c] = rows[-1][1]
        out.append((c, kind, step, span, rows))
    return lengths, out


def read(df):
    return sorted((r.chrom, r.start, r.end, r.value) for r in df.collect())


@pytest.mark.parametrize(("order", "packed"), [("<", True), (">", True), ("<", False)])
def test_all_intervals(spark, tmp_path, monkeypatch, order, packed):
    monkeypatch.setattr(bigwig, "BRANCHES", 4)
    lengths, blocks = track(1)
    write_bigwig(tmp_path / "t.bw", lengths, blocks, order, packed)
    want = sorted((c, *r) for c, *_, rows in blocks for r in rows)
    df = bigwig.scan_bigwig(spark, str(tmp_path / "t.bw"))
    assert df.rdd.getNumPartitions() > 2
    assert read(df) == want
    assert read(scan_signal(spark, str(tmp_path / "t.bw"))) == want
    assert read(bigwig.scan_bigwig(spark, f"file://{tmp_path}/t.bw")) == want
    assert bigwig.bigwig_contigs(str(tmp_path / "t.bw")) == lengths


def test_ranges(spark, tmp_path):
    lengths, blocks = track(2, 6, 60)
    path = str(tmp_path / "t.bw")
    write_bigwig(tmp_path / "t.bw", lengths, blocks)
    names = sorted(lengths)
    rows = [(c, *r) for c, *_, rows in blocks for r in rows]
    for contigs, start, end in (([names[1]], 0, None), ([names[0], names[4]], 50, 120), (None, 100, 101), ([names[2], "elsewhere"], 4990, 9000), (["elsewhere"], 0, None), ([], 0, None)):
        high = end if end is not None else 1 << 40
        want = sorted((c, max(s, start), min(e, high), v) for c, s, e, v in rows if (contigs is None or c in contigs) and s < high and e > start)
        assert read(bigwig.scan_bigwig(spark, path, contigs, start, end)) == want


def test_only_what_is_asked_for_is_read(tmp_path, monkeypatch):
    lengths, blocks = track(3, 6, 200)
    write_bigwig(tmp_path / "t.bw", lengths, blocks)
    name = sorted(lengths)[2]
    reader = bigwig.TrackReader({"path": str(tmp_path / "t.bw"), "contigs": name, "start": "0", "end": "200"})
    seen = []
    unpack = bigwig.intervals
    monkeypatch.setattr(bigwig, "intervals", lambda *a: seen.append(1) or unpack(*a))
    rows = [r for p in reader.partitions() for batch in reader.read(p) for r in batch.to_pylist()]
    own = [b for b in blocks if b[0] == name and b[4][0][0] < 200]
    assert len(seen) == len(own) < len(blocks) / 4
    assert len(rows) == sum(s < 200 for b in own for s, *_ in b[4])


def test_statistics_over_a_file(spark, tmp_path):
    """Spans without data, and contigs that the file lacks, have the statistics of zeros."""
    write_bigwig(tmp_path / "t.bw", {"a": 100}, [("a", "bed", 0, 0, [(10, 20, 2.0), (20, 30, -1.0)])])
    spans = spark.createDataFrame([("x", "a", 0, 40), ("y", "a", 50, 60), ("z", "b", 0, 10)], "span_id string, chrom string, start long, end long")
    got = {r.span_id: tuple(r)[1:] for r in score_stats(spans, scan_signal(spark, str(tmp_path / "t.bw"))).collect()}
    assert got["y"] == got["z"] == (0,) * 6
    assert got["x"][0] == 0.25
    assert got["x"][2:] == (0.25, 0.25, 2.0, -1.0)


def test_odd_files(spark, tmp_path):
    write_bigwig(tmp_path / "none.bw", {"a": 100}, [])
    assert read(bigwig.scan_bigwig(spark, str(tmp_path / "none.bw"))) == []
    (tmp_path / "x.bw").write_bytes(b"x" * 200)
    with pytest.raises(Exception, match="no bigWig file"):
        bigwig.scan_bigwig(spark, str(tmp_path / "x.bw")).collect()
