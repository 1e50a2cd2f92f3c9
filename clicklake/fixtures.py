"""Source tables of the lakehouse, derived from the given test tables.

Every view covers its whole base table. Expressions are plain SQL; the twin views for the SQL
check are in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def src_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source clicks, made dirty on purpose: blank codes, lost times, odd devices, bad digests."""
    return clicks_of(table(spark, sf_dir, "events"))


def clicks_of(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id + 1 AS id",
        "CASE WHEN event_id % 53 = 0 THEN '   ' ELSE concat('  p', CAST(event_id % 50 AS STRING), ' ') END AS short_code",
        "CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END AS occurred_at",
        "CASE event_type WHEN 'view' THEN ' Mobile ' WHEN 'click' THEN 'desktop' WHEN 'purchase' THEN 'TABLET' "
        "WHEN 'signup' THEN NULL ELSE 'smart-tv' END AS device_type",
        "CASE event_id % 3 WHEN 0 THEN sha2(CAST(user_id AS STRING), 256) WHEN 1 THEN 'not-a-hash' END AS hashed_ip",
        "CAST(CASE WHEN event_id % 10 < 7 THEN NULL WHEN event_id % 40 = 8 THEN user_id + 1000000000 ELSE user_id END "
        "AS DOUBLE) AS user_id",
    )


def _with_lost_ids(clicks: DataFrame) -> DataFrame:
    lost = F.when(F.col("id") % 101 != 0, F.col("id"))
    return clicks.withColumn("id", lost)


def bronze_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot taken when 70 % of the ids existed."""
    clicks = src_clicks(spark, sf_dir)
    top = clicks.agg(F.max("id")).scalar()
    return _with_lost_ids(clicks.where(F.col("id") * 10 <= top * 7))


def bronze_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later batch; it repeats the last tenth of ids that the snapshot has."""
    clicks = src_clicks(spark, sf_dir)
    top = clicks.agg(F.max("id")).scalar()
    return _with_lost_ids(clicks.where(F.col("id") * 10 > top * 6))


def bronze_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_full(spark, sf_dir).unionByName(bronze_incremental(spark, sf_dir))


def src_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").selectExpr(
        "page_id AS id",
        "CASE WHEN page_id % 10 = 9 THEN NULL ELSE concat('p', CAST(page_id AS STRING)) END AS short_code",
        "url AS original_url",
        "date_add(DATE'2023-12-01', CAST(page_id % 30 AS INT)) AS created_at",
        "page_id % 7 <> 0 AS is_active",
    )


def src_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id",
        "concat(lower(c_name), '@example.com') AS email",
        "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'PREMIUM' ELSE 'FREE' END AS plan_type",
    )


def ledger_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_of(table(spark, sf_dir, "orders"))


def runs_of(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "CAST(o_orderkey AS STRING) AS run_id",
        "concat('pipeline_', CAST(o_custkey % 2 AS STRING)) AS pipeline_name",
        "CASE o_orderkey % 3 WHEN 0 THEN 'urls' WHEN 1 THEN 'users' ELSE 'clicks' END AS source_table",
        "CASE WHEN o_orderkey % 3 = 2 THEN 'incremental' ELSE 'full' END AS load_type",
        "CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' ELSE 'running' END AS status",
        "CASE WHEN o_orderkey % 3 = 2 AND o_orderstatus = 'F' THEN o_orderkey END AS watermark_end",
        "CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS rows_written",
        "CASE WHEN o_orderstatus = 'F' AND o_orderkey % 4 <> 0 "
        "THEN concat('bronze/k', CAST(o_orderkey % 400 AS STRING)) END AS bronze_key",
        "o_orderdate AS started_at",
        "CASE WHEN o_orderstatus = 'O' THEN repeat(concat('failed after ', CAST(o_orderkey AS STRING), '; '), 150) END "
        "AS error_message",
    )


def ledger_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same runs as events: a start for every run, an end for every finished one."""
    runs = ledger_runs(spark, sf_dir).drop("error_message")
    start = runs.select(
        "run_id", "pipeline_name", "source_table", "load_type", F.lit("running").alias("status"),
        F.lit(None).cast("bigint").alias("watermark_end"), F.lit(None).cast("bigint").alias("rows_written"),
        F.lit(None).cast("string").alias("bronze_key"), "started_at", F.lit(1).alias("event_seq"),
    )
    end = runs.where(F.col("status") != "running").withColumn("event_seq", F.lit(2))
    return start.unionByName(end)


def stored_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(
        "concat('bronze/k', CAST(doc_id % 450 + 30 AS STRING)) AS path",
        "n_chars * 4096 AS length",
        "CASE doc_id % 3 WHEN 0 THEN 'urls' WHEN 1 THEN 'users' ELSE 'clicks' END AS source_table",
    )
