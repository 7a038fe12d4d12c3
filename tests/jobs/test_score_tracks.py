import math
import os
import random
import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import duckdb
import pytest

from jobs import score_tracks
from jobs.config import load
from jobs.queries import SCORE_TRACKS_SQL, job2_score_tracks

SF = "/root/testdata/sf0.001"
CONFIG = {"baseline": 245.0, "window": 100, "buckets": 4, "files_per_batch": 1}


def brute(events, config):
    """Statistics of every window, one dense array at a time."""
    window = config["window"]
    dense = defaultdict(lambda: [0.0] * window)
    seen = defaultdict(int)
    for at, user, value in events:
        if at is None or user is None or value is None or not math.isfinite(value):
            continue
        key = f"u{user}", at // window
        dense[key][at % window] += round((value - config["baseline"]) * 100)
        seen[key] += 1
    out = {}
    for (chrom, w), x in dense.items():
        s, ss, up, down = sum(x) / 100, sum(v * v for v in x) / 10_000, [v for v in x if v > 0], [v for v in x if v < 0]
        mean = s / window
        values = mean, math.sqrt(window * round(ss * 10_000) - round(s * 100) ** 2) / window / 100, len(up) / window, len(down) / window, sum(up) / 100 / len(up) if up else 0.0, sum(down) / 100 / len(down) if down else 0.0
        out[chrom, w * window] = (w * window + window, seen[chrom, w], *values)
    return out


def stand(spark, out):
    return {(r.chrom, r.start): tuple(r)[2:] for r in score_tracks.read(spark, out).collect()}


def some(n, seed, first=0):
    rng = random.Random(seed)
    return [(first + k, rng.randint(1, 6), round(rng.uniform(100, 400), 3)) for k in range(n)]


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, score_tracks.EVENTS).coalesce(1).write.mode("append").parquet(folder)


def test_growing_input(spark, tmp_path):
    """Two runs over growing input leave what one run over all of it leaves, and take only what is new."""
    folder, out, mark = (str(tmp_path / x) for x in ("events", "out", "mark"))
    first, second = some(700, 1), some(500, 2, 650)
    second = [(at + 50 if at < 700 else at, u, v) for at, u, v in second]
    second = [x for x in second if x[0] >= 750]
    odd = [(5000, None, 250.0), (None, 1, 250.0), (5001, 1, None), (5002, 1, math.nan), (5003, 1, math.inf), (5004, 9, 245.0)]
    arrive(spark, folder, first)
    assert score_tracks.run(spark, folder, out, mark, CONFIG) == 1
    assert stand(spark, out) == brute(first, CONFIG)
    arrive(spark, folder, second)
    arrive(spark, folder, odd)
    assert score_tracks.run(spark, folder, out, mark, CONFIG) == 2
    want = brute(first + second + odd, CONFIG)
    assert stand(spark, out) == want
    assert want["u9", 5000][1:3] == (1, 0.0)
    assert score_tracks.run(spark, folder, out, mark, CONFIG) == 0
    assert stand(spark, out) == want
    # and in one run
    assert score_tracks.run(spark, folder, f"{out}-2", f"{mark}-2", CONFIG | {"files_per_batch": 10}) == 1
    assert stand(spark, f"{out}-2") == want


@pytest.mark.parametrize("step", ["sums", "statistics"])
def test_broken_run(spark, tmp_path, monkeypatch, step):
    """A batch that breaks after a write is taken again and counted once."""
    folder, out, mark = (str(tmp_path / x) for x in ("events", "out", "mark"))
    rows = some(300, 3)
    arrive(spark, folder, rows)
    write = score_tracks.replace_partitions

    def breaks(df, path, *by):
        write(df, path, *by)
        if path.endswith(step):
            raise OSError("lost")

    monkeypatch.setattr(score_tracks, "replace_partitions", breaks)
    with pytest.raises(Exception, match="lost"):
        score_tracks.run(spark, folder, out, mark, CONFIG)
    monkeypatch.setattr(score_tracks, "replace_partitions", write)
    more = some(100, 4, 1000)
    arrive(spark, folder, more)
    score_tracks.run(spark, folder, out, mark, CONFIG)
    assert stand(spark, out) == brute(rows + more, CONFIG)


def test_only_touched_buckets_are_written(spark, tmp_path):
    folder, out, mark = (str(tmp_path / x) for x in ("events", "out", "mark"))
    arrive(spark, folder, some(300, 5))
    score_tracks.run(spark, folder, out, mark, CONFIG)
    files = lambda: {p: p.stat().st_mtime_ns for p in Path(out, "statistics").rglob("*.parquet")}
    before = files()
    arrive(spark, folder, [(9000, 1, 300.0)])
    score_tracks.run(spark, folder, out, mark, CONFIG)
    assert len(before.keys() - files().keys()) <= 1
    assert len({p.parent for p in before} & {p.parent for p in files()}) >= 2


def test_no_events(spark, tmp_path):
    folder = str(tmp_path / "events")
    arrive(spark, folder, [(None, None, None)])
    score_tracks.run(spark, folder, str(tmp_path / "out"), str(tmp_path / "mark"), CONFIG)
    assert stand(spark, str(tmp_path / "out")) == {}


@pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not here")
def test_query(spark):
    overwrite = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    got = job2_score_tracks(spark, SF)
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{SF}/events.parquet'")
    want = con.execute(SCORE_TRACKS_SQL)
    names = [c[0] for c in want.description]
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == sorted(want.fetchall())
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == overwrite
    assert not spark.streams.active


@pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not here")
def test_command(spark, tmp_path):
    config = tmp_path / "c.toml"
    config.write_text("baseline = 200.0\nwindow = 500\nbuckets = 2\nfiles_per_batch = 1\n")
    args = ["--events", f"{SF}/events.parquet", "--output", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "mark"), "--config", str(config)]
    done = subprocess.run([sys.executable, "-m", "jobs.score_tracks", *args], cwd=Path(__file__).parents[2], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "new events in 1 batches" in done.stderr
    assert load(str(config), "score_tracks.toml")["window"] == 500
    events = duckdb.sql(f"select event_id, user_id, value from '{SF}/events.parquet'").fetchall()
    assert stand(spark, str(tmp_path / "out")).keys() == brute(events, {"baseline": 200.0, "window": 500}).keys()
