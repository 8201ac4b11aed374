"""Sources and sinks. Written tables go to a fresh path in the session's work folder."""

from pyspark.sql import functions as F

from chartlake import constants as K
from chartlake.fixtures import CHART_COUNTRIES, table
from chartlake.functions.features import hit_category
from chartlake.plans import gold as G
from chartlake.plans import silver as S
from chartlake.plans.catalog.base import HIT_CATEGORY, IS_HIT, ORACLES, STREAMS, bronze, over_chart, over_silver, query, silver
from chartlake.plans.catalog.gold import OPTIONS
from chartlake.session import work_dir
from chartlake.sources import readers, writers
from chartlake.streaming import monthly as M

ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate"
ORDER_SCHEMA = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate DATE"
KPI_SQL = f"""SELECT year, month, country_name, uri, standardized_label, {STREAMS} AS total_streams,
  CAST(max(CASE WHEN {IS_HIT} THEN 1 ELSE 0 END) AS INT) AS is_hit FROM silver GROUP BY ALL"""

query("scan_parquet", "SELECT * FROM lineitem")(lambda spark, sf: readers.scan_parquet(spark, f"{sf}/lineitem.parquet"))


def _orders_as_csv(spark, sf):
    path = work_dir(spark, "orders_csv")
    orders = table(spark, sf, "orders").selectExpr(*ORDER_COLUMNS.split(", "))
    orders.write.csv(path, header=True)
    return path


@query("scan_csv_inferred", f"SELECT CAST(o_orderkey AS INT) AS o_orderkey, CAST(o_custkey AS INT) AS o_custkey, "
       f"o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def scan_csv_inferred(spark, sf):
    return readers.scan_csv_inferred(spark, _orders_as_csv(spark, sf))


@query("scan_csv_schema", f"SELECT {ORDER_COLUMNS} FROM orders")
def scan_csv_schema(spark, sf):
    return readers.scan_csv_schema(spark, _orders_as_csv(spark, sf), ORDER_SCHEMA)


@query("scan_hive_partitioned", over_silver(f"SELECT *, printf('%04d-%02d', year, month) AS year_month FROM ({KPI_SQL})"))
def scan_hive_partitioned(spark, sf):
    path = work_dir(spark, "kpi_song")
    writers.sink_parquet_partitioned(G.kpi_song(silver(spark, sf)), path, G.MONTH)
    return readers.scan_hive_partitioned(spark, path)


query("scan_nonempty", "SELECT count(*) AS n, CAST(min(o_orderdate) AS DATE) AS first_date FROM orders")(
    lambda spark, sf: readers.require_rows(table(spark, sf, "orders"), "orders").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderdate").cast("date").alias("first_date")
    )
)


@query(
    "from_rows",
    over_chart(
        f"""SELECT band, upper_rank, count(hit_category) AS n FROM (VALUES ('Global Hit', 10), ('Major Hit', 50), ('Popular Track', 100),
        ('No Such Band', 0)) AS b(band, upper_rank) LEFT JOIN (SELECT {HIT_CATEGORY} AS hit_category FROM chart) c
        ON c.hit_category = b.band GROUP BY ALL"""
    ),
)
def from_rows(spark, sf):
    rows = [(label, bound) for bound, label in K.HIT_BANDS] + [("No Such Band", 0)]
    bands = readers.from_rows(spark, rows, "band STRING, upper_rank INT")
    counts = bronze(spark, sf).groupBy(hit_category().alias("band")).agg(F.count(F.lit(1)).alias("n"))
    return bands.join(counts, "band", "left").fillna({"n": 0})


@query("sink_parquet_partitioned", over_silver(f"SELECT * FROM ({KPI_SQL})"))
def sink_parquet_partitioned(spark, sf):
    path = work_dir(spark, "kpi_song")
    writers.sink_parquet_partitioned(G.kpi_song(silver(spark, sf)), path, G.MONTH)
    return spark.read.parquet(path)


MONTH_SQL = f"SELECT year, month, {STREAMS} AS total_streams, count(*) AS n FROM silver GROUP BY ALL"


def _months(df):
    return df.groupBy(*G.MONTH).agg(F.sum("streams").alias("total_streams"), F.count(F.lit(1)).alias("n"))


@query("sink_single_file", over_silver(MONTH_SQL))
def sink_single_file(spark, sf):
    path = work_dir(spark, "months")
    writers.sink_single_file(_months(silver(spark, sf)), path)
    return spark.read.parquet(path)


@query("sink_gold_table", over_silver(MONTH_SQL))
def sink_gold_table(spark, sf):
    path = work_dir(spark, "months")
    writers.sink_gold_table(_months(silver(spark, sf)), path, partition_by=["year"])
    return spark.read.parquet(path)


@query(
    "readback_check",
    over_silver(
        f"""SELECT count(*) AS row_count, CAST(7 AS BIGINT) AS column_count, count(DISTINCT (year, month)) AS partition_count
        FROM ({KPI_SQL})"""
    ),
)
def readback_check(spark, sf):
    path = work_dir(spark, "kpi_song")
    writers.sink_parquet_partitioned(G.kpi_song(silver(spark, sf)), path, G.MONTH)
    return writers.readback_check(spark, path, G.MONTH)


@query(
    "reload_first_wins",
    over_silver(
        f""", kpi AS ({KPI_SQL}), once AS (SELECT * FROM kpi QUALIFY row_number() OVER (
          PARTITION BY country_name, uri, year, month ORDER BY standardized_label, total_streams, is_hit) = 1),
        counted AS (SELECT count(*) AS rows_read FROM kpi), loaded AS (SELECT count(*) AS rows_loaded FROM once)
        SELECT once.*, rows_read, rows_read - rows_loaded AS rows_skipped FROM once, counted, loaded"""
    ),
)
def reload_first_wins(spark, sf):
    path = work_dir(spark, "kpi_song")
    counts = writers.reload_first_wins(
        G.kpi_song(silver(spark, sf)), path, (*G.PLACE, "uri"), ["standardized_label", "total_streams", "is_hit"], G.MONTH
    )
    return spark.read.parquet(path).select(
        "*", F.lit(counts["rows_read"]).cast("long").alias("rows_read"),
        F.lit(counts["rows_skipped"]).cast("long").alias("rows_skipped"),
    )


#: What is added up to compare contents, where it isn't total_streams.
MEASURES = {
    "artist_country_dominance": "artist_streams", "artist_country_dominance_deduped": "artist_streams",
    "gold_song_charts": "streams", "kpi_artist": None, "track_catalog": None,
}


def measure(name: str) -> str:
    return MEASURES.get(name, "total_streams") or "0"


GOLD_TOTALS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n, CAST(sum({measure(name)}) AS BIGINT) AS streams FROM ({ORACLES[name]})" for name in G.GOLD_TABLES
)


def _totals(tables):
    """One row per table: its rows and its measure's total."""
    out = None
    for name, df in tables.items():
        sums = F.sum(F.expr(measure(name))).cast("long").alias("streams")
        row = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"), sums)
        out = row if out is None else out.unionByName(row)
    return out


@query("run_gold", GOLD_TOTALS)
def run_gold(spark, sf):
    """Every monthly table, written from one cleaned chart and read back."""
    paths = G.run_gold(spark, silver(spark, sf), work_dir(spark, "gold"), options=OPTIONS)
    return _totals({name: spark.read.parquet(paths[name]) for name in G.GOLD_TABLES})


#: The most rows of the chart in one incoming file.
FILE_ROWS = 1_000_000


def _streamed_gold(spark, sf, tables):
    """The chart in two increments that share their months, taken in as a stream, one increment a micro-batch.

    The chart is written as it comes, in files of FILE_ROWS rows at most, and half of the files are an increment.
    """
    out = work_dir(spark, "gold_stream")
    rows = bronze(spark, sf)
    half = -(-table(spark, sf, "lineitem").count() // 2)
    rows.write.option("maxRecordsPerFile", max(1, min(FILE_ROWS, half))).parquet(f"{out}/incoming")
    files = len(spark.read.schema(rows.schema).parquet(f"{out}/incoming").inputFiles())
    incoming = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", max(1, -(-files // 2))).parquet(f"{out}/incoming")
    M.run_updates(incoming, out, lambda df: S.silver_chart(df, countries=CHART_COUNTRIES), tables=tables, options=OPTIONS)
    return out


@query("incremental_gold", GOLD_TOTALS)
def incremental_gold(spark, sf):
    """The same tables as run_gold, from two increments."""
    out = _streamed_gold(spark, sf, tuple(G.GOLD_TABLES))
    return _totals({name: M.gold_table(spark, out, name) for name in G.GOLD_TABLES})


@query("incremental_country_performance", ORACLES["country_performance"])
def incremental_country_performance(spark, sf):
    """All rows of the table whose growth looks across months, from two increments."""
    out = _streamed_gold(spark, sf, ("country_performance",))
    return M.gold_table(spark, out, "country_performance")
