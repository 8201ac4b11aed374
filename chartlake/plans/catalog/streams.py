"""Streaming jobs over the event table, each with its batch form: windows from first use, and windows aligned to the epoch."""

from pyspark.sql import functions as F

from chartlake import constants as K
from chartlake.fixtures import table
from chartlake.plans.catalog.base import query
from chartlake.session import work_dir
from chartlake.streaming import first_use as W
from chartlake.streaming import usage as U

# An event stands for a request: its type is the text or the provider, its user the history.
DEDUPE_SQL = """SELECT DISTINCT sha256(lower(trim(event_type)) || '|' || '{"user_id":' || user_id || '}') AS reply_key,
  CAST(floor(epoch(ts) / 900) * 900 AS BIGINT) AS window_start FROM events"""


def _dedupe(events):
    return U.reply_dedupe(events, F.col("event_type"), F.struct("user_id"))


def _events_stream(spark, sf):
    return U.read_stream(spark, sf, "events.parquet", table(spark, sf, "events").schema)


query("stream_reply_dedupe_aligned", DEDUPE_SQL)(
    lambda spark, sf: U.run_to_table(_dedupe(_events_stream(spark, sf)), "reply_dedupe")
)
query("reply_dedupe_batch_aligned", DEDUPE_SQL)(lambda spark, sf: _dedupe(table(spark, sf, "events")))

USAGE_SQL = """SELECT event_type AS provider, CAST(floor(epoch(ts) / {width}) * {width} AS BIGINT) AS window_start,
  CAST(sum({amount}) AS BIGINT) AS used, count(*) AS requests, sum({amount}) >= {budget} AS over_budget FROM events GROUP BY 1, 2"""
# Only windows whose end the watermark (latest event less an hour) has reached.
CLOSED = " HAVING floor(min(epoch(ts)) / {width}) * {width} + {width} <= (SELECT max(epoch(ts)) FROM events) - 3600"
TOKENS = {"width": K.USAGE_LIMITS["tokens"][0], "amount": "CAST(round(value * 100) AS BIGINT)", "budget": K.USAGE_LIMITS["tokens"][1]}
REQUESTS = {"width": K.USAGE_LIMITS["requests"][0], "amount": "1", "budget": 2}


def _tokens(events):
    """Spend in hundredths per day."""
    return U.usage_budget(events, "event_type", F.round(F.col("value") * 100).cast("long"), TOKENS["width"], TOKENS["budget"])


def _requests(events):
    return U.usage_budget(events, "event_type", F.lit(1).cast("long"), REQUESTS["width"], REQUESTS["budget"])


query("stream_usage_budget_aligned", (USAGE_SQL + CLOSED).format(**TOKENS))(
    lambda spark, sf: U.run_to_table(_tokens(_events_stream(spark, sf)), "usage_tokens")
)
query("stream_usage_requests_aligned", (USAGE_SQL + CLOSED).format(**REQUESTS))(
    lambda spark, sf: U.run_to_table(_requests(_events_stream(spark, sf)), "usage_requests")
)
query("usage_budget_batch_aligned", USAGE_SQL.format(**TOKENS))(lambda spark, sf: _tokens(table(spark, sf, "events")))

# --- windows from first use ---------------------------------------------------------------

REPLY_KEY = """sha256(lower(trim(event_type)) || '|' || '{"user_id":' || user_id || '}')"""
#: Each window's start is the first second at or after the last window's end: a chain of joins, one step for each window.
FIRST_USE_SQL = """WITH RECURSIVE e AS MATERIALIZED (SELECT {key} AS key, CAST(floor(epoch(ts)) AS BIGINT) AS s, CAST(sum({amount}) AS BIGINT) AS a, count(*) AS n
    FROM events GROUP BY ALL),
  following AS MATERIALIZED (SELECT e.key, e.s, f.s AS t FROM (SELECT key, s, s + {width} AS after FROM e) e ASOF JOIN e f ON e.key = f.key AND e.after <= f.s),
  w AS (SELECT key, min(s) AS s FROM e GROUP BY key UNION ALL SELECT f.key, f.t FROM w JOIN following f ON f.key = w.key AND f.s = w.s),
  summed AS (SELECT w.key, w.s AS window_start, sum(e.a)::BIGINT AS used, sum(e.n)::BIGINT AS requests
    FROM (SELECT key, s, a, n FROM e) e ASOF JOIN w ON e.key = w.key AND e.s >= w.s GROUP BY ALL)
  SELECT {columns} FROM summed"""
SHOWN_OPEN = "(window_start + {width}) * 1000 > (SELECT max(epoch_ms(ts)) FROM events) - {delay} AS open"


def _reply_windows(events):
    """A reply is kept for the time-to-live from its first request on; the others in that time are answered from it."""
    return events, U.reply_key(F.col("event_type"), F.struct("user_id")), F.lit(1), U.event_time(events, "ts"), K.REPLY_TTL_SECONDS


def _spend_windows(events):
    return events, F.col("event_type"), F.round(F.col("value") * 100), U.event_time(events, "ts"), TOKENS["width"]


def _request_windows(events):
    return events, F.col("event_type"), F.lit(1), U.event_time(events, "ts"), REQUESTS["width"]


def _stream(spark, sf, make, delay, name):
    return W.run_windows(W.stream_windows(*make(_events_stream(spark, sf)), delay), work_dir(spark, name))


def _first_use_sql(key, width, amount, columns):
    return FIRST_USE_SQL.format(key=key, width=width, amount=amount, columns=columns)


REPLY_COLUMNS = "key AS reply_key, window_start, requests"
USED_COLUMNS = "key AS provider, window_start, used, requests, used >= {budget} AS over_budget"
HOUR_MS = 3_600_000


def _replies(windows):
    return windows.select(F.col("key").alias("reply_key"), "window_start", "requests")


def _budget(windows, budget, *more):
    return windows.select(F.col("key").alias("provider"), "window_start", "used", "requests", (F.col("used") >= budget).alias("over_budget"), *more)


REPLY_SQL = _first_use_sql(REPLY_KEY, K.REPLY_TTL_SECONDS, "1", REPLY_COLUMNS)
query("stream_reply_dedupe", REPLY_SQL)(
    lambda spark, sf: _replies(_stream(spark, sf, _reply_windows, f"{K.REPLY_TTL_SECONDS} seconds", "reply_windows"))
)
query("reply_dedupe_batch", REPLY_SQL)(lambda spark, sf: _replies(W.batch_windows(*_reply_windows(table(spark, sf, "events")))))

for _name, _use, _make in (("budget", TOKENS, _spend_windows), ("requests", REQUESTS, _request_windows)):
    _columns = USED_COLUMNS.format(**_use)
    _open = SHOWN_OPEN.format(width=_use["width"], delay=HOUR_MS)
    query(f"stream_usage_{_name}", _first_use_sql("event_type", _use["width"], _use["amount"], f"{_columns}, {_open}"))(
        lambda spark, sf, use=_use, make=_make: _budget(_stream(spark, sf, make, "1 hour", "usage_windows"), use["budget"], "open")
    )
    query(f"usage_{_name}_batch", _first_use_sql("event_type", _use["width"], _use["amount"], _columns))(
        lambda spark, sf, use=_use, make=_make: _budget(W.batch_windows(*make(table(spark, sf, "events"))), use["budget"])
    )
