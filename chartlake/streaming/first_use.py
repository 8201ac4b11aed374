"""Windows that open at a key's first use and last a fixed time; the first use after that opens the next.

A window is [start, start + width) in whole seconds. On a batch, each key's seconds are scanned in order. On a stream, a key's state
is the window that is open and the seconds that the watermark has not passed yet; those are put in order before they count, so the
stream's windows are the batch's, whatever the order of arrival within the watermark's delay. A timer closes a window without a
next event. Usage shows while a window is open. Events behind the watermark are too late for their window and go; late_events counts
them, as every other event is in a window.

A frequent key is summed per second in each task before it is shuffled, so its rows and its state grow with seconds, not with events.
On a stream, keys are dealt to a fixed number of groups; a group's keys are worked out together, as arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

WINDOWS = "key string, window_start long, used long, requests long, open boolean"
STATE = "keys array<string>, windows binary, pending binary"


def uses(events: DataFrame, key: Column, amount: Column, ts: Column) -> DataFrame:
    """(key, second, amount, n, ts): a task's events summed per key and second; ts is the latest of them.

    Events without a key or time take no part; a null amount counts as 0.
    """
    rows = events.select(
        key.cast("string").alias("key"), F.unix_timestamp(ts).alias("second"),
        F.coalesce(amount.cast("long"), F.lit(0).cast("long")).alias("amount"), ts.alias("ts"),
    ).where("key is not null and second is not null")

    def combined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.groupby(["key", "second"], as_index=False, sort=False).agg(
                amount=("amount", "sum"), n=("amount", "size"), ts=("ts", "max")
            )

    return rows.mapInPandas(combined, "key string, second long, amount long, n long, ts timestamp")


def batch_windows(events: DataFrame, key: Column, amount: Column, ts: Column, width: int) -> DataFrame:
    """(key, window_start, used, requests) of a batch.

    A key's rows, one a second at most, pass through one task in order; the task holds one Arrow batch of them at a time.
    """
    seconds = uses(events, key, amount, ts).groupBy("key", "second").agg(F.sum("amount").alias("amount"), F.sum("n").alias("n"))
    ordered = seconds.repartition("key").sortWithinPartitions("key", "second")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = None  # key, start, used, requests of the open window
        for batch in batches:
            out = []
            for name, part in batch.groupby("key", sort=False):
                second, amount, n = (part[c].to_numpy() for c in ("second", "amount", "n"))
                upto, count = np.concatenate([[0], np.cumsum(amount)]), np.concatenate([[0], np.cumsum(n)])
                at = 0
                while at < len(second):
                    if own is None or own[0] != name or second[at] >= own[1] + width:
                        if own is not None:
                            out.append(own)
                        own = (name, int(second[at]), 0, 0)
                    end = int(np.searchsorted(second, own[1] + width))
                    own = (name, own[1], own[2] + int(upto[end] - upto[at]), own[3] + int(count[end] - count[at]))
                    at = end
            if out:
                yield pd.DataFrame(out, columns=["key", "window_start", "used", "requests"])
        if own is not None:
            yield pd.DataFrame([own], columns=["key", "window_start", "used", "requests"])

    return ordered.mapInPandas(run, "key string, window_start long, used long, requests long")


def step(
    start: int | None, used: int, requests: int, pending: list[tuple[int, int, int]], passed: int, width: int
) -> tuple[list[tuple[int, int, int, bool]], tuple[int | None, int, int], list[tuple[int, int, int]]]:
    """One round of a key: windows to show (start, used, requests, open), the window that stays open, and what is still pending.

    pending: (second, amount, events) in order; seconds before `passed` are final.
    """
    shown: list[tuple[int, int, int, bool]] = []
    rest = [p for p in pending if p[0] >= passed]
    for second, amount, n in pending[: len(pending) - len(rest)]:
        if start is not None and second >= start + width:
            shown.append((start, used, requests, False))
            start = None
        if start is None:
            start, used, requests = second, 0, 0
        used, requests = used + amount, requests + n
    if start is not None and start + width <= passed:
        shown.append((start, used, requests, False))
        start, used, requests = None, 0, 0
    kept = (start, used, requests)
    for second, amount, n in rest:
        if start is not None and second >= start + width:
            shown.append((start, used, requests, True))
            start = None
        if start is None:
            start, used, requests = second, 0, 0
        used, requests = used + amount, requests + n
    if start is not None:
        shown.append((start, used, requests, True))
    return shown, kept, rest


#: Keys are dealt to this many groups, each one call and one state; it is fixed for a checkpoint's life.
GROUPS = 1024
#: Rows a task adds up by key and second at once.
COMBINED_ROWS = 1_000_000
NONE = np.iinfo(np.int64).min


def _summed(code: np.ndarray, second: np.ndarray, amount: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """The same, one row for each code and second, in their order."""
    order = np.lexsort((second, code))
    code, second = code[order], second[order]
    first = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (second[1:] != second[:-1])]) if len(code) else np.zeros(0, np.int64)
    add = lambda x: np.add.reduceat(x[order], first) if len(first) else np.zeros(0, np.int64)
    return code[first], second[first], add(amount), add(n)


def _chain(windows: np.ndarray, code: np.ndarray, second: np.ndarray, amount: np.ndarray, n: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Go on from each key's open window (rows start, used, requests; start NONE: none) over rows in the order of code and second.

    Gives (code, start, used, requests) of the windows that a later row ended, in order for each key, and the windows then open. All
    keys open their next window in the same round, so a round costs a few array operations whatever the number of keys.
    """
    start, used, requests = windows.copy()
    upto, count = np.r_[0, np.cumsum(amount)], np.r_[0, np.cumsum(n)]
    at, end = np.searchsorted(code, np.arange(len(start))), np.searchsorted(code, np.arange(len(start)), side="right")
    base = int(second.min()) if len(second) else 0
    span = int(second.max()) - base + 2 if len(second) else 1
    place = code * span + (second - base)
    ended: list[np.ndarray] = []
    live = np.flatnonzero(at < end)
    while len(live):
        now = second[at[live]]
        over = (start[live] != NONE) & (now >= start[live] + width)
        gone = live[over]
        if len(gone):
            ended.append(np.stack([gone, start[gone], used[gone], requests[gone]]))
        fresh = over | (start[live] == NONE)
        opened = live[fresh]
        start[opened], used[opened], requests[opened] = now[fresh], 0, 0
        upper = np.clip(start[live] + width - base, 0, span - 1)
        stop = np.searchsorted(place, live * span + upper)
        used[live] += upto[stop] - upto[at[live]]
        requests[live] += count[stop] - count[at[live]]
        at[live] = stop
        live = live[stop < end[live]]
    return np.concatenate(ended, axis=1) if ended else np.zeros((4, 0), np.int64), np.stack([start, used, requests])


def steps(windows: np.ndarray, pending: tuple[np.ndarray, ...], passed: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
    """step for many keys: (windows shown: code, start, used, requests; whether open; the windows that stay open; what is still pending)."""
    final = pending[1] < passed
    closed, kept = _chain(windows, *(x[final] for x in pending), width)
    past = np.flatnonzero((kept[0] != NONE) & (kept[0] + width <= passed))
    closed = np.concatenate([closed, np.stack([past, *kept[:, past]])], axis=1)
    kept[:, past] = np.array([[NONE], [0], [0]])
    rest = tuple(x[~final] for x in pending) if final.any() else pending
    ended, last = _chain(kept, *rest, width)
    held = np.flatnonzero(last[0] != NONE)
    open_ = np.concatenate([ended, np.stack([held, *last[:, held]])], axis=1)
    return np.concatenate([closed, open_], axis=1), np.arange(closed.shape[1] + open_.shape[1]) >= closed.shape[1], kept, rest


def stream_windows(events: DataFrame, key: Column, amount: Column, ts: Column, width: int, delay: str, groups: int = GROUPS) -> DataFrame:
    """WINDOWS rows in update mode: a key's windows that closed since its last rows, and all its open ones as they stand.

    Keys share the calls and the state of a group, whose numbers are arrays: 32 bytes for each second of a key that the watermark has
    not passed, however many keys there are. A key is shown when it has new events or a window of it closes.
    """
    rows = uses(events, key, amount, ts).withWatermark("ts", delay)

    def run(name: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        passed = max(state.getCurrentWatermarkMs(), 0) // 1000
        keys, open_, seconds = state.get if state.exists else ([], b"", b"")
        keys, at = list(keys), {k: i for i, k in enumerate(keys)}
        windows = np.frombuffer(open_, np.int64).reshape(3, -1)
        old = len(keys)
        held = tuple(np.frombuffer(seconds, np.int64).reshape(4, -1))
        new: list[tuple[np.ndarray, ...]] = []
        touched: list[np.ndarray] = []
        size = 0
        for part in parts:
            part = part[part["second"] >= passed]
            own, names = pd.factorize(part["key"])
            for k in names:
                if at.setdefault(k, len(keys)) == len(keys):
                    keys.append(k)
            places = np.array([at[k] for k in names], np.int64)
            touched.append(places)
            new.append((places[own], *(part[c].to_numpy(np.int64) for c in ("second", "amount", "n"))))
            size += len(part)
            if size > COMBINED_ROWS:
                held, new, size = _summed(*(np.concatenate(x) for x in zip(held, *new))), [], 0
        pending = _summed(*(np.concatenate(x) for x in zip(held, *new)))
        del held, new
        none = np.tile(np.array([[NONE], [0], [0]]), len(keys) - old)
        windows = np.concatenate([windows, none], axis=1)
        (code, start, used, requests), is_open, kept, rest = steps(windows, pending, passed, width)
        show = np.zeros(len(keys), bool)
        show[np.concatenate([np.zeros(0, np.int64), *touched])] = True
        show[code[~is_open]] = True
        stays = kept[0] != NONE
        stays[rest[0]] = True
        if not stays.any():
            state.remove()
        else:
            # Keys without a window or pending seconds go.
            renumbered = np.cumsum(stays) - 1
            kept, own = kept[:, stays], np.stack([renumbered[rest[0]], *rest[1:]])
            state.update(([k for k, s in zip(keys, stays) if s], kept.tobytes(), own.tobytes()))
            first = min(int(x.min()) for x in (kept[0][kept[0] != NONE], own[1]) if len(x))
            state.setTimeoutTimestamp((first + width) * 1000)
        shown = show[code]
        yield pd.DataFrame({
            "key": np.array(keys, object)[code[shown]], "window_start": start[shown], "used": used[shown], "requests": requests[shown], "open": is_open[shown],
        })

    dealt = rows.withColumn("_group", F.pmod(F.xxhash64("key"), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandasWithState(run, WINDOWS, STATE, "update", GroupStateTimeout.EventTimeTimeout)


def run_windows(windows: DataFrame, path: str) -> DataFrame:
    """Run a stream of windows over all input present, keep its rows below path, and read them as they stand.

    Each micro-batch writes a folder of its own, so one that runs again after a failure replaces what it wrote. Run again with the
    same path, the stream goes on from its checkpoint.
    """

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/rows/batch={batch}")

    query = (
        windows.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return current_windows(windows.sparkSession, path)


def _rows(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType.fromDDL(WINDOWS).add("batch", T.LongType())
    return spark.read.schema(schema).option("basePath", f"{path}/rows").parquet(f"{path}/rows")


def current_windows(spark: SparkSession, path: str) -> DataFrame:
    """(key, window_start, used, requests, open): all closed windows, and the open ones as the key's last rows show them."""
    rows = _rows(spark, path)
    last = _rows(spark, path).groupBy("key").agg(F.max("batch").alias("_last"))
    return rows.join(last, "key").where("not open or batch = _last").select("key", "window_start", "used", "requests", "open")


def late_events(windows: DataFrame, events: DataFrame, key: Column, amount: Column, ts: Column) -> DataFrame:
    """(key, late): how many of a batch of all events are in no window of their key, for keys that have some."""
    came = uses(events, key, amount, ts).groupBy("key").agg(F.sum("n").alias("_came"))
    counted = windows.groupBy("key").agg(F.sum("requests").alias("_counted"))
    late = F.col("_came") - F.coalesce("_counted", F.lit(0))
    return came.join(counted, "key", "left").select("key", late.alias("late")).where("late > 0")
