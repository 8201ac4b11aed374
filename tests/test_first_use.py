"""Windows from first use: batch and stream against a plain scan, with late, unordered and restarted input."""

import random

import pytest
from pyspark.sql import functions as F

from chartlake.streaming import first_use as W

WIDTH, BASE = 900, 1_700_000_000
SCHEMA = "ts timestamp, who string, amount long"


def plain(rows, width=WIDTH):
    out = {}
    for who in {w for _, w, _ in rows if w is not None}:
        start = None
        for second, amount in sorted((s, a or 0) for s, w, a in rows if w == who and s is not None):
            if start is None or second >= start + width:
                start = second
            used, n = out.get((who, start), (0, 0))
            out[who, start] = (used + amount, n + 1)
    return out


def frame(spark, rows):
    raw = spark.createDataFrame([(s, w, a) for s, w, a in rows], "s long, who string, amount long")
    return raw.select(F.timestamp_seconds("s").alias("ts"), "who", "amount")


def got(df):
    return {(r["key"], r["window_start"]): (r["used"], r["requests"]) for r in df.collect()}


def args(events):
    return events, F.col("who"), F.col("amount"), F.col("ts"), WIDTH


def sample():
    rnd = random.Random(4)
    rows = [(BASE + rnd.randrange(40_000), rnd.choice(["a", "a", "a", "b", "c"]), rnd.randrange(9)) for _ in range(1500)]
    return rows + [(BASE + 7, "once", 1), (BASE + 899, "edge", 1), (BASE + 901, "edge", 2), (BASE + 1799, "edge", 4), (BASE + 5, None, 1), (None, "a", 1), (BASE + 9, "a", None)]


def test_batch(spark):
    rows = sample()
    assert got(W.batch_windows(*args(frame(spark, rows).repartition(5)))) == plain(rows)
    # 899 s and 901 s lie in one window, the event at 1799 s opens the next.
    assert plain(rows)["edge", BASE + 899] == (3, 2) and plain(rows)["edge", BASE + 1799] == (4, 1)
    assert W.batch_windows(*args(frame(spark, rows).filter("false"))).count() == 0


def test_batch_over_small_arrow_batches(spark):
    rows = sample()
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert got(W.batch_windows(*args(frame(spark, rows)))) == plain(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def write(spark, folder, rows):
    frame(spark, rows).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder, delay="10 minutes"):
    events = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    return W.stream_windows(*args(events), delay)


def test_stream_equals_batch_over_unordered_files_and_a_restart(spark, tmp_path):
    rows, folder, path = sorted(sample(), key=lambda r: r[0] or 0), str(tmp_path / "in"), str(tmp_path / "out")
    rnd = random.Random(2)
    # Events arrive up to some minutes out of order, in files of their own; the second run goes on from the checkpoint.
    jumbled = sorted(rows, key=lambda r: (r[0] or 0) + rnd.randrange(300))
    cut = len(jumbled) // 4
    for k in range(2):
        write(spark, folder, jumbled[k * cut : (k + 1) * cut])
    first = W.run_windows(stream(spark, folder), path)
    seen = jumbled[: 2 * cut]
    assert got(first) == plain(seen)
    for k in range(2, 5):
        write(spark, folder, jumbled[k * cut : (k + 1) * cut])
    last = W.run_windows(stream(spark, folder), path)
    assert got(last) == plain(rows)
    assert W.late_events(last, *args(frame(spark, rows))[:4]).count() == 0
    newest = max(s for s, _, _ in rows if s)
    assert {(r["key"], r["window_start"]) for r in last.where("open").collect()} == {(k, s) for k, s in plain(rows) if s + WIDTH > newest - 600}
    # A run without new input changes nothing.
    assert got(W.run_windows(stream(spark, folder), path)) == plain(rows)


def test_late_events_are_counted(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    write(spark, folder, [(BASE, "a", 1), (BASE + 5000, "b", 1)])
    W.run_windows(stream(spark, folder), path)
    write(spark, folder, [(BASE + 10, "a", 1), (BASE + 20, "a", 1), (BASE + 5010, "b", 1)])
    last = W.run_windows(stream(spark, folder), path)
    assert got(last) == {("a", BASE): (1, 1), ("b", BASE + 5000): (2, 2)}
    came = spark.read.parquet(folder)
    assert [tuple(r) for r in W.late_events(last, *args(came)[:4]).collect()] == [("a", 2)]


@pytest.mark.parametrize("passed", [0, 50, 950, 1000, 5000])
def test_step(passed):
    shown, kept, rest = W.step(None, 0, 0, [(40, 1, 1), (60, 1, 2), (945, 1, 1)], passed, 900)
    assert [w[:3] for w in shown] == [(40, 2, 3), (945, 1, 1)]
    assert [w[3] for w in shown] == [passed < 940, passed < 1845]
    assert kept[0] == {0: None, 50: 40, 950: 945, 1000: 945, 5000: None}[passed] and [r[0] for r in rest] == [s for s in (40, 60, 945) if s >= passed]
