"""Windows of many keys at once: steps against step, and a stream with more keys than groups."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartlake.streaming import first_use as W
from tests.test_first_use import BASE, SCHEMA, WIDTH, got, plain, write


@pytest.mark.parametrize("seed", range(12))
def test_steps_are_steps_of_each_key(seed):
    rnd = random.Random(seed)
    keys, passed = rnd.randrange(1, 7), rnd.choice([0, 300, 2000, 9000])
    windows, pending = [], []
    for k in range(keys):
        start = rnd.choice([None, rnd.randrange(0, 500)])
        windows.append((start, rnd.randrange(9) if start is not None else 0, rnd.randrange(9) if start is not None else 0))
        low = 0 if start is None else start
        pending.append(sorted((s, rnd.randrange(-5, 9), rnd.randrange(1, 4)) for s in rnd.sample(range(low, 6000), rnd.randrange(0, 60))))
    table = np.array([[W.NONE if w[0] is None else w[0], w[1], w[2]] for w in windows], np.int64).T
    flat = np.array([(k, *p) for k, own in enumerate(pending) for p in own], np.int64).reshape(-1, 4).T
    (code, *shown), open_, kept, rest = W.steps(table, tuple(flat), passed, 900)
    for k in range(keys):
        want, last, left = W.step(*windows[k], pending[k], passed, 900)
        mine = code == k
        assert sorted(zip(*(x[mine].tolist() for x in shown), open_[mine].tolist())) == sorted(want)
        assert tuple(kept[:, k].tolist()) == (W.NONE if last[0] is None else last[0], last[1], last[2])
        assert [tuple(r) for r in np.stack(rest[1:])[:, rest[0] == k].T.tolist()] == left


def test_a_stream_of_more_keys_than_groups(spark, tmp_path):
    rnd, folder, path = random.Random(3), str(tmp_path / "in"), str(tmp_path / "out")
    rows = sorted((BASE + rnd.randrange(9000), f"k{rnd.randrange(80)}", rnd.randrange(9)) for _ in range(1200))
    for k in range(3):
        write(spark, folder, rows[k * 400 : (k + 1) * 400])
    events = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    windows = W.stream_windows(events, F.col("who"), F.col("amount"), F.col("ts"), WIDTH, "10 minutes", groups=3)
    last = W.run_windows(windows, path)
    assert got(last) == plain(rows)
    newest = max(s for s, _, _ in rows)
    assert {(r["key"], r["window_start"]) for r in last.where("open").collect()} == {(k, s) for k, s in plain(rows) if s + WIDTH > newest - 600}
