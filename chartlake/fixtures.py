"""Chart-shaped inputs derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Country map for the derived chart; nation_24 is left out, so the unmapped case exists.
CHART_COUNTRIES = {**{f"nation_{i}": f"Country {i}" for i in range(1, 24)}, "global": "Global"}

# The same text runs on Spark and as an oracle; table names are filled in.
CHART_SQL = """
SELECT d AS date,
  CASE WHEN nk = 0 THEN 'global' ELSE lower(nn) END AS country,
  CAST(rk AS INT) AS rank,
  concat('track:', CAST(pk AS STRING)) AS uri,
  CASE WHEN pk % 97 = 0 THEN NULL
       WHEN sk % 41 = 0 THEN concat('Act ', CAST(sk AS STRING), ' | Alias')
       WHEN ln % 3 = 0 THEN concat('Act ', CAST(sk AS STRING), '|Act ', CAST(sk + 1 AS STRING))
       ELSE concat(' Act ', CAST(sk AS STRING)) END AS artist_names,
  CASE WHEN pk % 97 = 0 THEN NULL ELSE pn END AS track_name,
  CASE WHEN pk % 89 = 0 THEN NULL WHEN ln % 2 = 0 THEN concat(upper(pb), ' ') ELSE pb END AS label,
  CAST(least(rk, 1 + pk % 200) AS INT) AS peak_rank,
  CAST(CASE WHEN ln = 1 THEN -1 ELSE 1 + (pk * 11 + ok) % 200 END AS INT) AS previous_rank,
  CAST(dc AS INT) AS days_on_chart, q AS streams,
  CAST(1 + (dc - 1) % 30 AS INT) AS consecutive_days,
  CASE WHEN ln % 3 = 0 AND sk % 41 <> 0 THEN concat('artist:', CAST(sk AS STRING), '|artist:', CAST(sk + 1 AS STRING))
       ELSE concat('artist:', CAST(sk AS STRING)) END AS artist_uris,
  CAST(CASE WHEN pk % 67 = 0 THEN NULL WHEN pk % 10 = 0 THEN d + INTERVAL 30 DAY ELSE d - INTERVAL 400 DAY END AS DATE) AS release_date
FROM (SELECT *, 1 + (pk * 7 + ln * 13 + ok) % 200 AS rk, 1 + (pk + ln * 3) % 365 AS dc FROM (
  SELECT CAST(o.o_orderdate AS DATE) AS d, l.l_partkey AS pk, l.l_suppkey AS sk, l.l_orderkey AS ok, l.l_linenumber AS ln,
         c.c_nationkey AS nk, n.n_name AS nn, p.p_name AS pn, p.p_brand AS pb, CAST(l.l_quantity * 1000 AS BIGINT) AS q
  FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN {customer} c ON o.o_custkey = c.c_custkey
  JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {part} p ON l.l_partkey = p.p_partkey) base) x
"""

# The same rows in the order of joins that shuffles least: the small tables meet the orders before the line items do, and the tracks come
# last and by uri, so that what is grouped by uri and more needs no further shuffle.
CHART_BASE = CHART_SQL[CHART_SQL.index("  SELECT CAST(o.o_orderdate") : CHART_SQL.index(") base) x")]
URI = "concat('track:', CAST(pk AS STRING)) AS uri"
ORDERS_SQL = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, c_nationkey AS nk, n_name AS nn
FROM {orders} o JOIN {customer} c ON o_custkey = c_custkey JOIN {nation} n ON c_nationkey = n_nationkey
"""
TRACKS_SQL = "SELECT concat('track:', CAST(p_partkey AS STRING)) AS uri, p_partkey AS pk, p_name AS pn, p_brand AS pb FROM {part}"
ITEMS_SQL = """
SELECT concat('track:', CAST(l_partkey AS STRING)) AS uri, l_suppkey AS sk, l_orderkey AS ok, l_linenumber AS ln, CAST(l_quantity * 1000 AS BIGINT) AS q
FROM {lineitem}
"""
BASE_SQL = """
SELECT d, pk, i.uri AS uri, sk, ok, ln, nk, nn, pn, pb, q
FROM ({items}) i JOIN ({ordered}) o ON ok = o_orderkey JOIN ({tracks}) t ON i.uri = t.uri
""".format(items=ITEMS_SQL, ordered=ORDERS_SQL, tracks=TRACKS_SQL)
JOINED_SQL = CHART_SQL.replace(CHART_BASE, BASE_SQL).replace(URI, "uri")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def chart_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily chart facts: one row per line item."""
    sides = {n: table(spark, sf_dir, n) for n in ("orders", "customer", "nation", "part")}
    facts = table(spark, sf_dir, "lineitem")
    return spark.sql(JOINED_SQL, lineitem=facts, **sides)


def song_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The song list, from the part table."""
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("track:"), F.col("p_partkey").cast("string")).alias("track_uri"),
        F.col("p_name").alias("track_name"),
        F.col("p_brand").alias("label"),
    )


def artist_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The artist list, from the supplier table."""
    key = F.col("s_suppkey").cast("string")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("artist:"), key).alias("artist_uri"), F.concat(F.lit("Act "), key).alias("artist_name")
    )
