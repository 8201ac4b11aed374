"""Windowed usage counts and time-bounded deduplication; each function takes a batch or a streaming frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake import constants as K
from chartlake.session import work_dir


def reply_key(text: Column, history: Column) -> Column:
    """Digest of the trimmed, lower-cased text and its history; the same words after another history differ."""
    return F.sha2(F.concat_ws("|", F.lower(F.trim(text)), F.to_json(history)), 256)


def event_time(events: DataFrame, ts: str) -> Column:
    """The event time as a timestamp; one without a zone is read as UTC, whatever the session's zone."""
    instant = F.col(ts).cast("timestamp")
    if isinstance(events.schema[ts].dataType, T.TimestampNTZType):
        instant = F.from_utc_timestamp(instant, F.current_timezone())
    return instant.alias("ts")


def _seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts)


def reply_dedupe(
    events: DataFrame, text: Column, history: Column, ts: str = "ts", ttl: int = K.REPLY_TTL_SECONDS
) -> DataFrame:
    """Each reply key once per time-to-live window: reply_key, window_start (epoch seconds).

    Windows are aligned to the epoch rather than opened by the first use, so the result does not depend on
    the order of arrival, and state is dropped once the watermark has passed it.
    """
    keyed = events.select(
        event_time(events, ts), reply_key(text, history).alias("reply_key")
    ).withColumn("window_start", _seconds(F.window("ts", f"{ttl} seconds")["start"]))
    if keyed.isStreaming:
        once = keyed.withWatermark("ts", f"{ttl} seconds").dropDuplicatesWithinWatermark(["reply_key", "window_start"])
    else:
        once = keyed.dropDuplicates(["reply_key", "window_start"])
    return once.select("reply_key", "window_start")


def usage_budget(
    events: DataFrame,
    provider: str,
    amount: Column,
    window_seconds: int,
    budget: int,
    ts: str = "ts",
    delay: str = "1 hour",
) -> DataFrame:
    """Usage per provider and tumbling window, with a flag once the budget is reached.

    A frequent provider is summed per task before the shuffle. On a stream a window comes out when the
    watermark has passed its end.
    """
    used = events.select(event_time(events, ts), F.col(provider).alias("provider"), amount.alias("amount"))
    if used.isStreaming:
        used = used.withWatermark("ts", delay)
    totals = used.groupBy(F.window("ts", f"{window_seconds} seconds").alias("w"), "provider").agg(
        F.sum("amount").alias("used"), F.count(F.lit(1)).alias("requests")
    )
    return totals.select(
        "provider", _seconds(F.col("w.start")).alias("window_start"), "used", "requests",
        (F.col("used") >= budget).alias("over_budget"),
    )


def read_stream(spark: SparkSession, folder: str, file_glob: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", file_glob).parquet(folder)


def run_to_table(df: DataFrame, name: str) -> DataFrame:
    """Run a stream over all input present, into a fresh table with its own checkpoint, and read the table."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    query = (
        df.writeStream.format("parquet").outputMode("append")
        .option("path", f"{path}/table").option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/table")
