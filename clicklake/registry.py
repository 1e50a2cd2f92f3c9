"""Registered queries by name, and their SQL twins.

Each entry is ``name: (query, sql)``; ``sql`` is None where no SQL engine can state the query.
A query takes ``(spark, sf_dir)`` and reads whole tables. Times come out without a zone, so that
every engine hashes them alike, and load times are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake import fixtures as fx
from clicklake.functions.columns import full_key, incremental_key, known_device, url_host, valid_digest
from clicklake.operators import contracts as ct
from clicklake.operators import dims, facts, pii, quality, silver, storage
from clicklake.operators import ledger as lg
from clicklake.operators.dedup import freshest
from clicklake.oracle import scatter as scatter_sql
from clicklake.oracle import with_views
from clicklake.plans import clustering, increments, ingest, metrics, refine
from clicklake.schemas import FACT_CLICKS, SOURCE_TABLES, STAR_KEYS, STAR_LENGTHS, conform
from clicklake.session import scratch_path
from clicklake.sinks import formats as sink_formats
from clicklake.sinks import tables as sinks
from clicklake.sinks.versions import Dataset, added
from clicklake.sources import bronze as src_bronze
from clicklake.sources import footers, formats, generators, listing, relational
from clicklake.streaming import silver_stream

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}

_NOW = datetime(2001, 8, 1)
_GEN_NOW = datetime(2026, 1, 1)


def register(name: str, sql: str | None = None, views: list[str] | None = None):
    def add(query: Query) -> Query:
        REGISTRY[name] = (query, None if sql is None else with_views(views or [], sql))
        return query

    return add


def naive(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return refine.silver_clicks(fx.bronze_clicks(spark, sf)).drop("silver_loaded_at")


_STARS: dict[tuple[str, str], str] = {}


_LAKES: dict[tuple[str, str], str] = {}


def _gold(spark: SparkSession, sf: str) -> str:
    """Star schema of the given tables, written once per session: the metrics expect stored tables."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STARS:
        gold = scratch_path(spark, "gold")
        refine.publish_star(gold, fx.src_urls(spark, sf), fx.src_users(spark, sf), _silver(spark, sf))
        _STARS[key] = gold
    return _STARS[key]


def _star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return refine.read_star(spark, _gold(spark, sf))


def _lake(spark: SparkSession, sf: str) -> str:
    """A Bronze layer in the shared folder: three snapshots of growing coverage and one batch. Written once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key in _LAKES:
        return _LAKES[key]
    lake = scratch_path(spark, "lake")
    clicks = conform(fx.src_clicks(spark, sf), SOURCE_TABLES["clicks"])
    top = clicks.agg(F.max("id")).first()[0]
    for day, tenths in (("2024-01-01", 3), ("2024-01-02", 5), ("2024-01-03", 7)):
        sinks.write_snapshot(clicks.where(F.col("id") * 10 <= top * tenths), lake, "clicks", day)
    start = src_bronze.watermark_from_snapshot(spark, f"{lake}/bronze")
    sinks.write_batch(relational.incremental_scan(clicks, start, top), lake, "clicks", start, top)
    _LAKES[key] = lake
    return lake


# --- Sources -------------------------------------------------------------------------------------

@register(
    "src_full_scan",
    """SELECT id, short_code, occurred_at, device_type, hashed_ip, CAST(user_id AS BIGINT) AS user_id,
         concat('land ', CAST(id % 7 AS VARCHAR)) AS country
       FROM src_clicks""",
    ["src_clicks"],
)
def src_full_scan(spark, sf):
    """The production path, over a source with a column that the contract does not declare."""
    wider = fx.src_clicks(spark, sf).withColumn("country", F.concat(F.lit("land "), (F.col("id") % 7).cast("string")))
    return naive(relational.full_scan(lambda _: wider, "clicks"), "occurred_at")


@register(
    "src_incremental_scan",
    "SELECT * FROM src_clicks WHERE id > (SELECT max(id) FROM bronze_full)",
    ["src_clicks", "bronze_full"],
)
def src_incremental_scan(spark, sf):
    watermark = fx.bronze_full(spark, sf).agg(F.max("id")).first()[0]
    return relational.incremental_scan(fx.src_clicks(spark, sf), watermark)


@register(
    "incremental_watermark_end",
    """SELECT count(*) AS row_count, max(id) AS watermark_end FROM src_clicks
       WHERE id > (SELECT max(id) FROM bronze_full)""",
    ["src_clicks", "bronze_full"],
)
def incremental_watermark_end(spark, sf):
    return src_incremental_scan(spark, sf).agg(
        F.count(F.lit(1)).alias("row_count"), F.max("id").alias("watermark_end")
    )


_MIXED_SQL = """
SELECT CAST(id AS BIGINT) AS id, short_code, CAST(occurred_at AS TIMESTAMP) AS occurred_at, device_type, hashed_ip,
  CAST(user_id AS BIGINT) AS user_id
FROM (
  SELECT * FROM src_clicks WHERE id * 10 <= (SELECT max(id) FROM src_clicks) * 3
  UNION ALL SELECT * FROM src_clicks WHERE id * 10 <= (SELECT max(id) FROM src_clicks) * 5
  UNION ALL SELECT * FROM src_clicks WHERE id * 10 <= (SELECT max(id) FROM src_clicks) * 7
  UNION ALL SELECT * FROM src_clicks WHERE id * 10 > (SELECT max(id) FROM src_clicks) * 7)"""


@register("bronze_mixed_read", _MIXED_SQL, ["src_clicks"])
def bronze_mixed_read(spark, sf):
    return naive(src_bronze.read_bronze(spark, f"{_lake(spark, sf)}/bronze"), "occurred_at")


@register(
    "bronze_foreign_types",
    """SELECT CAST(id AS BIGINT) AS id, short_code, occurred_at, device_type, hashed_ip, CAST(user_id AS BIGINT) AS user_id
       FROM src_clicks""",
    ["src_clicks"],
)
def bronze_foreign_types(spark, sf):
    """Snapshots of other writers: ids as int, decimal and text, users as float and long, codes as bytes."""
    root, clicks = scratch_path(spark, "foreign"), fx.src_clicks(spark, sf)
    kinds = [
        {"id": "int"}, {"id": "decimal(20,0)", "short_code": "binary"}, {"id": "string", "user_id": "bigint"},
        {"occurred_at": "timestamp", "device_type": "binary"},
    ]
    for k, casts in enumerate(kinds):
        part = clicks.where(F.col("id") % len(kinds) == k).withColumns({c: F.col(c).cast(t) for c, t in casts.items()})
        part.write.parquet(f"{root}/clicks/ingestion_date=2024-01-0{k + 1}")
    return naive(src_bronze.read_bronze(spark, root), "occurred_at")


@register(
    "explore_job",
    """SELECT id, short_code, lower(device_type) AS device_type FROM src_clicks
       JOIN (VALUES (DATE '2024-01-01', 3), (DATE '2024-01-02', 5), (DATE '2024-01-03', 7)) AS s(d, tenths)
         ON id * 10 <= (SELECT max(id) FROM src_clicks) * tenths
       WHERE id IS NOT NULL""",
    ["src_clicks"],
)
def explore_job(spark, sf):
    lake = _lake(spark, sf)
    refine.explore_job(spark, lake)
    return spark.read.parquet(f"{lake}/explore/clicks").select("id", "short_code", "device_type")


def _growing(spark: SparkSession, sf: str, tenths: int, broken: str | None = None) -> relational.Source:
    """Sources whose clicks have grown to so many tenths; one table may fail."""
    clicks = fx.src_clicks(spark, sf)
    top = clicks.agg(F.max("id")).first()[0]
    tables = {"clicks": clicks.where(F.col("id") * 10 <= top * tenths), "urls": fx.src_urls(spark, sf), "users": fx.src_users(spark, sf)}

    def read(table: str) -> DataFrame:
        if table == broken:
            raise relational.ExtractionError(f"cannot read table {table}")
        return tables[table]

    return read


@register(
    "pipeline_run",
    """, n AS (SELECT (SELECT count(*) FROM src_urls) AS urls, (SELECT count(*) FROM src_users) AS users, count(*) AS clicks, max(id) AS top,
           max(id) FILTER (WHERE id * 10 <= t.m * 6) AS mid, count(*) FILTER (WHERE id * 10 <= t.m * 6) AS early
         FROM src_clicks, (SELECT max(id) AS m FROM src_clicks) t GROUP BY t.m),
       r AS (
         SELECT 'urls' AS source_table, 'full' AS load_type, 'success' AS status, NULL::BIGINT AS watermark_start, NULL::BIGINT AS watermark_end,
           urls AS rows_written, k AS run FROM n, (VALUES (1), (2), (3), (4)) AS v(k)
         UNION ALL SELECT 'users', 'full', CASE k WHEN 2 THEN 'failed' ELSE 'success' END, NULL, NULL, CASE k WHEN 2 THEN NULL ELSE users END, k
           FROM n, (VALUES (1), (2), (3), (4)) AS v(k)
         UNION ALL SELECT 'clicks', 'incremental', 'success', 0, mid, early, 1 FROM n
         UNION ALL SELECT 'clicks', 'incremental', 'success', mid, top, clicks - early, 2 FROM n
         UNION ALL SELECT 'clicks', 'incremental', 'success', top, top, 0, 3 FROM n
         UNION ALL SELECT 'clicks', 'full', 'success', NULL, NULL, clicks, 4 FROM n)
       SELECT source_table, load_type, status, watermark_start, watermark_end, rows_written, CAST(run AS INTEGER) AS run FROM r""",
    ["src_clicks", "src_urls", "src_users"],
)
def pipeline_run(spark, sf):
    """Four runs: six tenths of the clicks, all of them with a failing table, nothing new, and all in full."""
    lake = scratch_path(spark, "pipeline")
    days = []
    ledger = ingest.Ledger(spark, lake, lambda: datetime(2024, 1, len(days), tzinfo=UTC))
    for tenths, broken, full in ((6, None, False), (10, "users", False), (10, None, False), (10, None, True)):
        days.append(tenths)
        ingest.run_pipeline(_growing(spark, sf, tenths, broken), lake, ledger, force_full=full)
    kept = ["source_table", "load_type", "status", "watermark_start", "watermark_end", "rows_written"]
    return ledger.runs().select(*kept, F.dayofmonth("started_at").alias("run"))


@register(
    "gold_two_days",
    """, early AS (SELECT id, row_number() OVER (ORDER BY id) AS url_key FROM src_urls WHERE id % 3 <> 0),
       late AS (SELECT id, (SELECT count(*) FROM early) + row_number() OVER (ORDER BY id) AS url_key FROM src_urls WHERE id % 3 = 0)
       SELECT CAST(url_key AS INTEGER) AS url_key, id AS url_id FROM (SELECT * FROM early UNION ALL SELECT * FROM late)""",
    ["src_urls"],
)
def gold_two_days(spark, sf):
    """Keys of the second day: known urls keep theirs, also those gone from the source, new ones go on."""
    lake, urls, users = scratch_path(spark, "two-days"), fx.src_urls(spark, sf), fx.src_users(spark, sf)
    sinks.write_snapshot(conform(fx.src_clicks(spark, sf), SOURCE_TABLES["clicks"]), lake, "clicks", "2024-01-01")
    refine.silver_job(spark, lake)
    for day, known in (("2024-01-01", urls.where("id % 3 <> 0")), ("2024-01-02", urls.where("id % 5 <> 1 OR id % 3 = 0"))):
        sinks.write_snapshot(conform(known, SOURCE_TABLES["urls"]), lake, "urls", day)
        sinks.write_snapshot(conform(users, SOURCE_TABLES["users"]), lake, "users", day)
        refine.gold_job(spark, lake)
    return refine.read_star(spark, f"{lake}/gold")["dim_url"].select("url_key", "url_id")


@register(
    "silver_incremental",
    "SELECT * FROM silver",
    ["silver"],
)
def silver_incremental(spark, sf):
    """Three loads, one after the other: a snapshot, a later one that holds the first, and a batch that overlaps both."""
    lake = scratch_path(spark, "increments")
    full, batch = fx.bronze_full(spark, sf), fx.bronze_incremental(spark, sf)
    top = batch.agg(F.max("id")).first()[0]
    loads = [
        lambda: full.where(F.col("id") * 10 <= top * 3).write.parquet(f"{lake}/bronze/clicks/ingestion_date=2024-01-01"),
        lambda: full.write.parquet(f"{lake}/bronze/clicks/ingestion_date=2024-01-02"),
        lambda: batch.write.parquet(f"{lake}/bronze/clicks/incremental/watermark_start=000000000000/watermark_end={top:012d}"),
    ]
    for load in loads:
        load()
        increments.silver_increment(spark, lake)
    return naive(increments.read_silver(spark, lake).drop("silver_loaded_at"), "occurred_at")


@register(
    "gold_late_members",
    """SELECT f.click_id, f.date_key, u.url_id, p.user_id, v.device_type, f.short_code, f.occurred_at
       FROM fact_clicks f JOIN dim_url u ON u.url_key = f.url_key JOIN dim_user p ON p.user_key = f.user_key
         JOIN dim_device v ON v.device_key = f.device_key""",
    ["fact_clicks", "dim_url", "dim_user", "dim_device"],
)
def gold_late_members(spark, sf):
    """A third of the urls and a quarter of the users come a day after their first clicks, with further clicks."""
    lake, urls, users = scratch_path(spark, "late-members"), fx.src_urls(spark, sf), fx.src_users(spark, sf)
    days = [
        ("2024-01-01", fx.bronze_full(spark, sf), urls.where("id % 3 <> 0"), users.where("id % 4 <> 0")),
        ("2024-01-02", fx.bronze_incremental(spark, sf), urls, users),
    ]
    for day, clicks, known_urls, known_users in days:
        clicks.write.parquet(f"{lake}/bronze/clicks/ingestion_date={day}")
        sinks.write_snapshot(conform(known_urls, SOURCE_TABLES["urls"]), lake, "urls", day)
        sinks.write_snapshot(conform(known_users, SOURCE_TABLES["users"]), lake, "users", day)
        increments.silver_increment(spark, lake)
        increments.gold_increment(spark, lake)
    star = increments.read_gold(spark, lake)
    fact = star["fact_clicks"].join(star["dim_url"].select("url_key", "url_id"), "url_key").join(star["dim_user"].select("user_key", "user_id"), "user_key")
    fact = fact.join(star["dim_device"], "device_key")
    return naive(fact.select("click_id", "date_key", "url_id", "user_id", "device_type", "short_code", "occurred_at"), "occurred_at")


@register(
    "bronze_full_only",
    """SELECT d AS ingestion_date, count(*) AS row_count, max(id) AS max_id FROM src_clicks
       JOIN (VALUES (DATE '2024-01-01', 3), (DATE '2024-01-02', 5), (DATE '2024-01-03', 7)) AS s(d, tenths)
         ON id * 10 <= (SELECT max(id) FROM src_clicks) * tenths
       GROUP BY d""",
    ["src_clicks"],
)
def bronze_full_only(spark, sf):
    snapshots = src_bronze.read_snapshots(spark, f"{_lake(spark, sf)}/bronze")
    return snapshots.groupBy("ingestion_date").agg(F.count(F.lit(1)).alias("row_count"), F.max("id").alias("max_id"))


@register(
    "pruned_date_range",
    """SELECT d AS ingestion_date, CAST(id AS BIGINT) AS id, device_type FROM src_clicks
       JOIN (VALUES (DATE '2024-01-02', 5), (DATE '2024-01-03', 7)) AS s(d, tenths)
         ON id * 10 <= (SELECT max(id) FROM src_clicks) * tenths""",
    ["src_clicks"],
)
def pruned_date_range(spark, sf):
    rows = src_bronze.read_date_range(spark, f"{_lake(spark, sf)}/bronze", "clicks", "2024-01-02", "2024-01-03")
    return rows.select("ingestion_date", "id", "device_type")


@register(
    "watermark_from_snapshot",
    """SELECT max(id) AS watermark,
         (SELECT count(*) FROM src_clicks WHERE id * 10 > (SELECT max(id) FROM src_clicks) * 7) AS rows_above
       FROM src_clicks WHERE id * 10 <= (SELECT max(id) FROM src_clicks) * 7""",
    ["src_clicks"],
)
def watermark_from_snapshot(spark, sf):
    watermark = src_bronze.watermark_from_snapshot(spark, f"{_lake(spark, sf)}/bronze")
    above = relational.incremental_scan(fx.src_clicks(spark, sf), watermark)
    return above.agg(F.lit(watermark).cast("bigint").alias("watermark"), F.count(F.lit(1)).alias("rows_above"))


@register("scan_parquet", "SELECT * FROM events")
def scan_parquet(spark, sf):
    return fx.table(spark, sf, "events")


@register("scan_one_column", "SELECT event_type FROM events")
def scan_one_column(spark, sf):
    path = f"{sf}/events.parquet"
    return formats.scan(spark, path, "parquet", "event_type string", ["event_type"])


@register(
    "roundtrip_formats",
    """SELECT fmt AS format, CAST(id AS BIGINT) AS id, short_code, occurred_at, device_type, hashed_ip,
         CAST(user_id AS BIGINT) AS user_id
       FROM src_clicks CROSS JOIN (VALUES ('csv'), ('json'), ('parquet')) AS f(fmt)""",
    ["src_clicks"],
)
def roundtrip_formats(spark, sf):
    clicks = conform(fx.src_clicks(spark, sf), SOURCE_TABLES["clicks"])
    result = None
    for fmt in formats.FORMATS:
        path = scratch_path(spark, f"clicks-{fmt}")
        sink_formats.write(clicks, path, fmt)
        back = formats.scan(spark, path, fmt).withColumn("format", F.lit(fmt))
        result = back if result is None else result.unionByName(back)
    return naive(result, "occurred_at").select(
        "format", "id", "short_code", "occurred_at", "device_type", "hashed_ip", "user_id"
    )


def _scan_of(fmt: str) -> None:
    """Full scan of an extract of the clicks in one format."""

    @register(
        f"scan_{'jsonl' if fmt == 'json' else fmt}",
        """SELECT CAST(id AS BIGINT) AS id, short_code, occurred_at, device_type, hashed_ip, CAST(user_id AS BIGINT) AS user_id
           FROM src_clicks""",
        ["src_clicks"],
    )
    def query(spark, sf):
        path = scratch_path(spark, f"extract-{fmt}")
        sink_formats.write(conform(fx.src_clicks(spark, sf), SOURCE_TABLES["clicks"]), path, fmt)
        return naive(formats.scan(spark, path, fmt), "occurred_at")


_scan_of("csv")
_scan_of("json")


@register(
    "repartition_invariance",
    """SELECT CAST(n AS INTEGER) AS partitions, count(*) AS row_count, CAST(sum(id) AS BIGINT) AS id_sum, count(DISTINCT short_code) AS codes, count(occurred_at) AS timed
       FROM src_clicks CROSS JOIN (VALUES (1), (7), (32)) AS v(n) GROUP BY n""",
    ["src_clicks"],
)
def repartition_invariance(spark, sf):
    """The same figures in any number of partitions."""
    clicks, report = fx.src_clicks(spark, sf), None
    for n in (1, 7, 32):
        row = sinks.repartitioned(clicks, n).agg(
            F.lit(n).alias("partitions"), F.count(F.lit(1)).alias("row_count"), F.sum("id").alias("id_sum"),
            F.countDistinct("short_code").alias("codes"), F.count("occurred_at").alias("timed"),
        )
        report = row if report is None else report.unionByName(row)
    return report


@register(
    "footer_counts",
    """SELECT d AS ingestion_date, count(*) AS row_count, min(id) AS min_id, max(id) AS max_id FROM src_clicks
       JOIN (VALUES ('2024-01-01', 3), ('2024-01-02', 5), ('2024-01-03', 7)) AS s(d, tenths)
         ON id * 10 <= (SELECT max(id) FROM src_clicks) * tenths
       GROUP BY d""",
    ["src_clicks"],
)
def footer_counts(spark, sf):
    """Rows and id bounds of each snapshot, from footers alone."""
    root, report = f"{_lake(spark, sf)}/bronze", None
    for day in listing.partition_values(spark, f"{root}/clicks", "ingestion_date"):
        found = footers.footer_bounds(spark, [f"{root}/clicks/ingestion_date={day}"], "clicks")
        row = found.select(F.lit(day).alias("ingestion_date"), "row_count", F.col("min_value").alias("min_id"), F.col("max_value").alias("max_id"))
        report = row if report is None else report.unionByName(row)
    return report


@register(
    "footer_watermark",
    """SELECT max(id) AS watermark,
         (SELECT count(*) FROM src_clicks WHERE id * 10 > (SELECT max(id) FROM src_clicks) * 7) AS rows_above
       FROM src_clicks WHERE id * 10 <= (SELECT max(id) FROM src_clicks) * 7""",
    ["src_clicks"],
)
def footer_watermark(spark, sf):
    watermark = footers.watermark_from_footers(spark, f"{_lake(spark, sf)}/bronze")
    above = relational.incremental_scan(fx.src_clicks(spark, sf), watermark)
    return above.agg(F.lit(watermark).cast("bigint").alias("watermark"), F.count(F.lit(1)).alias("rows_above"))


@register(
    "bronze_misfits",
    """SELECT 'id' AS column_name, concat('x', CAST(id AS VARCHAR)) AS value FROM src_clicks WHERE id % 2 = 0 AND id % 11 = 0
       UNION ALL SELECT 'user_id', concat(CAST(id AS VARCHAR), '.5') FROM src_clicks WHERE id % 2 = 1 AND id % 13 = 0
       UNION ALL SELECT 'user_id', '1.0E30' FROM src_clicks WHERE id % 2 = 1 AND id % 13 <> 0 AND id % 17 = 0
       UNION ALL SELECT 'occurred_at', 'soon' FROM src_clicks WHERE id % 2 = 1 AND id % 19 = 0""",
    ["src_clicks"],
)
def bronze_misfits(spark, sf):
    """Two foreign loads: ids as text, some of them none; fractional and far too large users, a time in words."""
    lake, clicks = scratch_path(spark, "misfits"), fx.src_clicks(spark, sf)
    named = clicks.where("id % 2 = 0").withColumn("id", F.expr("concat(CASE WHEN id % 11 = 0 THEN 'x' ELSE '' END, CAST(id AS STRING))"))
    odd = clicks.where("id % 2 = 1").withColumns({
        "user_id": F.expr("CASE WHEN id % 13 = 0 THEN id + 0.5D WHEN id % 17 = 0 THEN 1e30D ELSE user_id END"),
        "occurred_at": F.expr("CASE WHEN id % 19 = 0 THEN 'soon' ELSE CAST(occurred_at AS STRING) END"),
    })
    named.write.parquet(f"{lake}/bronze/clicks/ingestion_date=2024-01-01")
    odd.write.parquet(f"{lake}/bronze/clicks/ingestion_date=2024-01-02")
    refine.misfits_job(spark, lake)
    kept = spark.read.parquet(f"{lake}/silver/misfits")
    return kept.select(F.explode(src_bronze.MISFITS).alias("column_name", "value"))


@register(
    "table_counts",
    """SELECT 'clicks' AS "table", count(*) AS row_count, coalesce(max(id), 0) AS max_id FROM src_clicks
       UNION ALL SELECT 'urls', count(*), coalesce(max(id), 0) FROM src_urls
       UNION ALL SELECT 'users', count(*), coalesce(max(id), 0) FROM src_users""",
    ["src_clicks", "src_urls", "src_users"],
)
def table_counts(spark, sf):
    return relational.table_counts(
        {"clicks": fx.src_clicks(spark, sf), "urls": fx.src_urls(spark, sf), "users": fx.src_users(spark, sf)}
    )


# --- Silver --------------------------------------------------------------------------------------

@register("silver_clean", "SELECT * FROM clean", ["clean"])
def silver_clean(spark, sf):
    return naive(silver.clean_clicks(fx.bronze_clicks(spark, sf)).drop("silver_loaded_at"), "occurred_at")


@register(
    "silver_cast_ts",
    """SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN ts END AS occurred_at FROM events""",
)
def silver_cast_ts(spark, sf):
    texts = fx.table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("no time "), "event_type"))
        .otherwise(F.col("ts").cast("string")).alias("text"),
    )
    return texts.select("event_id", F.col("text").try_cast("timestamp").cast("timestamp_ntz").alias("occurred_at"))


@register(
    "silver_device_coerce",
    """SELECT device_type AS raw_device, CASE WHEN trim(lower(device_type)) IN ('mobile', 'desktop', 'tablet', 'unknown')
         THEN trim(lower(device_type)) ELSE 'unknown' END AS device_type, count(*) AS clicks
       FROM src_clicks GROUP BY 1, 2""",
    ["src_clicks"],
)
def silver_device_coerce(spark, sf):
    raw = F.col("device_type")
    return fx.src_clicks(spark, sf).groupBy(raw.alias("raw_device"), known_device(raw).alias("device_type")).agg(
        F.count(F.lit(1)).alias("clicks")
    )


@register(
    "silver_hash_nullout",
    """SELECT id, CASE WHEN regexp_full_match(trim(hashed_ip), '[0-9a-f]{64}') THEN trim(hashed_ip) END AS hashed_ip
       FROM src_clicks""",
    ["src_clicks"],
)
def silver_hash_nullout(spark, sf):
    return fx.src_clicks(spark, sf).select("id", valid_digest(F.col("hashed_ip")).alias("hashed_ip"))


@register("silver_dedup", "SELECT * FROM silver", ["silver"])
def silver_dedup(spark, sf):
    clean = silver.clean_clicks(fx.bronze_clicks(spark, sf)).drop("silver_loaded_at")
    return naive(silver.deduplicate_clicks(clean), "occurred_at")


@register(
    "silver_stats",
    """SELECT (SELECT count(*) FROM typed) AS bronze_rows,
         (SELECT count(*) FROM typed) - (SELECT count(*) FROM clean) AS invalid_rows_dropped,
         (SELECT count(*) FROM clean) - (SELECT count(*) FROM silver) AS duplicate_rows_removed,
         (SELECT count(*) FROM silver) AS silver_rows""",
    ["silver"],
)
def silver_stats(spark, sf):
    return silver.silver_stats(fx.bronze_clicks(spark, sf))


@register(
    "silver_rejects",
    """SELECT *, CASE WHEN click_id IS NULL THEN 'missing_id' WHEN occurred_at IS NULL THEN 'missing_time'
         ELSE 'missing_code' END AS reason
       FROM typed WHERE click_id IS NULL OR occurred_at IS NULL OR coalesce(length(short_code), 0) = 0""",
    ["typed"],
)
def silver_rejects(spark, sf):
    return naive(silver.rejected_clicks(fx.bronze_clicks(spark, sf)), "occurred_at")


_LAKE_SILVER_SQL = """
SELECT DISTINCT CAST(id AS BIGINT) AS click_id, trim(short_code) AS short_code, occurred_at,
  CASE WHEN trim(lower(device_type)) IN ('mobile', 'desktop', 'tablet', 'unknown')
    THEN trim(lower(device_type)) ELSE 'unknown' END AS device_type,
  CASE WHEN regexp_full_match(trim(hashed_ip), '[0-9a-f]{64}') THEN trim(hashed_ip) END AS hashed_ip,
  CAST(user_id AS BIGINT) AS user_id
FROM src_clicks WHERE occurred_at IS NOT NULL AND length(trim(short_code)) > 0"""


@register("silver_clicks", _LAKE_SILVER_SQL, ["src_clicks"])
def silver_clicks(spark, sf):
    lake = _lake(spark, sf)
    refine.silver_job(spark, lake)
    return naive(spark.read.parquet(f"{lake}/silver/clicks").drop("silver_loaded_at"), "occurred_at")


@register(
    "explore_valid_clicks",
    "SELECT id, short_code, occurred_at, lower(device_type) AS device_type FROM bronze_full WHERE id IS NOT NULL",
    ["bronze_full"],
)
def explore_valid_clicks(spark, sf):
    return silver.valid_clicks(fx.bronze_full(spark, sf))


@register("stream_silver_clicks", _LAKE_SILVER_SQL, ["src_clicks"])
def stream_silver_clicks(spark, sf):
    work = scratch_path(spark, "stream")
    fx.configure(spark)
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    events = silver_stream.bronze_stream(silver_stream.stream_session(spark), sf, schema, "events.parquet")
    clicks = silver_stream.distinct_clicks(fx.clicks_of(events))
    silver_stream.run_available(clicks, f"{work}/clicks", f"{work}/checkpoint")
    return naive(spark.read.parquet(f"{work}/clicks").drop("silver_loaded_at"), "occurred_at")


@register("stream_silver_merged", _LAKE_SILVER_SQL, ["src_clicks"])
def stream_silver_merged(spark, sf):
    """The stream without state: clicks are landed and merged by the ids on record, here twice over."""
    work, plain = scratch_path(spark, "stream"), fx.configure(spark)
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    for run in ("first", "again"):
        clicks = fx.clicks_of(silver_stream.bronze_stream(plain, sf, schema, "events.parquet"))
        silver_stream.merge_available(clicks, work, f"{work}/checkpoint-{run}")
    return naive(increments.read_silver(spark, work).drop("silver_loaded_at"), "occurred_at")


# --- Scalar functions ----------------------------------------------------------------------------

@register(
    "url_domain",
    """SELECT page_id, nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1), '') AS domain
       FROM pages""",
)
def url_domain(spark, sf):
    return fx.table(spark, sf, "pages").select("page_id", url_host(F.col("url")).alias("domain"))


@register("hash_digests", "SELECT doc_id, sha256(text) AS sha256, md5(text) AS md5 FROM documents")
def hash_digests(spark, sf):
    return fx.table(spark, sf, "documents").select(
        "doc_id", F.sha2("text", 256).alias("sha256"), F.md5("text").alias("md5")
    )


@register(
    "bronze_keys",
    """SELECT run_id, CASE WHEN load_type = 'full'
         THEN concat('bronze/', source_table, '/ingestion_date=', strftime(started_at, '%Y-%m-%d'))
         ELSE concat('bronze/', source_table, '/incremental/watermark_start=',
           lpad(CAST(CAST(run_id AS BIGINT) AS VARCHAR), 12, '0'), '/watermark_end=',
           lpad(CAST(CAST(run_id AS BIGINT) + 1000000 AS VARCHAR), 12, '0')) END AS storage_key
       FROM ledger_runs""",
    ["ledger_runs"],
)
def bronze_keys(spark, sf):
    start = F.col("run_id").cast("bigint")
    key = F.when(F.col("load_type") == "full", full_key(F.col("source_table"), F.col("started_at"))).otherwise(
        incremental_key(F.col("source_table"), start, start + 1000000)
    )
    return fx.ledger_runs(spark, sf).select("run_id", key.alias("storage_key"))


# --- Dimensional model ---------------------------------------------------------------------------

@register(
    "dim_date",
    """SELECT d.*, coalesce(c.clicks, 0) AS clicks FROM dim_date d
       LEFT JOIN (SELECT CAST(occurred_at AS DATE) AS day, count(*) AS clicks FROM silver GROUP BY 1) c
         ON c.day = d.full_date""",
    ["dim_date", "silver"],
)
def dim_date(spark, sf):
    days = _silver(spark, sf).groupBy(F.col("occurred_at").cast("date").alias("full_date")).agg(
        F.count(F.lit(1)).alias("clicks")
    )
    return dims.calendar(spark).join(days, "full_date", "left").withColumn("clicks", F.coalesce("clicks", F.lit(0)))


@register(
    "date_keys_of_year",
    """SELECT d.date_key, count(*) AS clicks FROM dim_date d JOIN silver s ON CAST(s.occurred_at AS DATE) = d.full_date
       WHERE d.year = 2024 GROUP BY 1""",
    ["dim_date", "silver"],
)
def date_keys_of_year(spark, sf):
    keys = dims.date_keys_of_year(dims.calendar(spark), 2024)
    per_day = _silver(spark, sf).groupBy(dims.date_key(F.col("occurred_at").cast("date")).alias("date_key")).agg(
        F.count(F.lit(1)).alias("clicks")
    )
    return keys.join(per_day, "date_key")


@register(
    "dim_device",
    """SELECT v.device_key, v.device_type, count(s.click_id) AS clicks FROM dim_device v
       LEFT JOIN silver s ON s.device_type = v.device_type GROUP BY 1, 2""",
    ["dim_device", "silver"],
)
def dim_device(spark, sf):
    per_type = _silver(spark, sf).groupBy("device_type").agg(F.count(F.lit(1)).alias("clicks"))
    return dims.devices(spark).join(per_type, "device_type", "left").select(
        "device_key", "device_type", F.coalesce("clicks", F.lit(0)).alias("clicks")
    )


@register("dim_url", "SELECT * FROM dim_url", ["dim_url"])
def dim_url(spark, sf):
    return dims.dim_url(fx.src_urls(spark, sf))


@register("dim_user", "SELECT * FROM dim_user", ["dim_user"])
def dim_user(spark, sf):
    return dims.dim_user(fx.src_users(spark, sf))


@register(
    "scd1_upsert",
    """, known AS (
         SELECT url_id, short_code, CAST(row_number() OVER (ORDER BY url_id) AS INTEGER) AS url_key,
           NOT is_active AS is_active, original_url_domain, created_date_key FROM dim_url WHERE short_code IS NOT NULL),
       fresh AS (
         SELECT url_id, short_code, original_url_domain, is_active, created_date_key FROM dim_url
         WHERE created_date_key > 20231201),
       added AS (
         SELECT url_id, CAST(row_number() OVER (ORDER BY url_id) + (SELECT max(url_key) FROM known) AS INTEGER) AS url_key
         FROM fresh WHERE url_id NOT IN (SELECT url_id FROM known))
       SELECT coalesce(k.url_key, a.url_key) AS url_key, coalesce(k.url_id, f.url_id) AS url_id,
         CASE WHEN f.url_id IS NULL THEN k.short_code ELSE f.short_code END AS short_code,
         CASE WHEN f.url_id IS NULL THEN k.original_url_domain ELSE f.original_url_domain END AS original_url_domain,
         CASE WHEN f.url_id IS NULL THEN k.is_active ELSE f.is_active END AS is_active,
         CASE WHEN f.url_id IS NULL THEN k.created_date_key ELSE f.created_date_key END AS created_date_key
       FROM known k FULL OUTER JOIN fresh f ON f.url_id = k.url_id LEFT JOIN added a ON a.url_id = f.url_id""",
    ["dim_url"],
)
def scd1_upsert(spark, sf):
    """Yesterday's dimension knew only urls with a code and had the active flag wrong; urls of the first day are gone."""
    urls = fx.src_urls(spark, sf)
    known = dims.dim_url(urls.where(F.col("short_code").isNotNull())).withColumn("is_active", ~F.col("is_active"))
    fresh = dims.url_attributes(urls).where(F.col("created_date_key") > 20231201)
    return dims.upsert(known, fresh, "url_id", "url_key").select(*known.columns)


@register(
    "dedup_freshest_wins",
    """SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
       WHERE rn = 1""",
)
def dedup_freshest_wins(spark, sf):
    orders = fx.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    return freshest(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@register("fact_clicks_shuffled", "SELECT * FROM fact_clicks", ["fact_clicks"])
def fact_clicks_shuffled(spark, sf):
    """The fact by way of the shuffled lookup, as with dimensions beyond the broadcast limit."""
    gold = scratch_path(spark, "gold-shuffled")
    refine.publish_star(gold, fx.src_urls(spark, sf), fx.src_users(spark, sf), _silver(spark, sf), broadcast_bytes=0)
    return naive(refine.read_star(spark, gold)["fact_clicks"].drop("row_loaded_at"), "occurred_at")


@register("fact_clustered", "SELECT * FROM fact_clicks", ["fact_clicks"])
def fact_clustered(spark, sf):
    """The fact in two loads of many small files, then in fewer, ordered along days and urls."""
    lake = Dataset(spark, scratch_path(spark, "clustered"))
    fact = _star(spark, sf)["fact_clicks"]
    loads = [fact.where(f"pmod(click_id, 2) = {k}").repartition(12) for k in range(2)]
    lake.change(lambda base: ({"fact_clicks": added(lake.stage(loads[0], "fact_clicks-1"), lake.stage(loads[1], "fact_clicks-2"))}, {}))
    clustering.cluster(lake, "fact_clicks", FACT_CLICKS, ["date_key", "url_key"], target_bytes=64 << 10)
    return naive(lake.read(lake.current(), "fact_clicks", FACT_CLICKS).drop("row_loaded_at"), "occurred_at")


@register("fact_clicks", "SELECT * FROM fact_clicks", ["fact_clicks"])
def fact_clicks(spark, sf):
    return naive(_star(spark, sf)["fact_clicks"].drop("row_loaded_at"), "occurred_at")


@register(
    "fact_rejects",
    "SELECT click_id, short_code, occurred_at, reject_reason FROM resolved WHERE reject_reason IS NOT NULL",
    ["resolved"],
)
def fact_rejects(spark, sf):
    return naive(refine.read_rejects(spark, _gold(spark, sf)), "occurred_at")


@register(
    "fk_violations",
    """SELECT 'user_id' AS key_column, count(*) AS violations FROM silver
         WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM dim_user)
       UNION ALL SELECT 'short_code', count(*) FROM silver
         WHERE short_code NOT IN (SELECT short_code FROM dim_url WHERE short_code IS NOT NULL)
       UNION ALL SELECT 'device_type', count(*) FROM silver WHERE device_type NOT IN (SELECT device_type FROM dim_device)
       UNION ALL SELECT 'date_key', count(*) FROM fact_clicks WHERE date_key NOT IN (SELECT date_key FROM dim_date)
       UNION ALL SELECT 'url_key', count(*) FROM fact_clicks WHERE url_key NOT IN (SELECT url_key FROM dim_url)
       UNION ALL SELECT 'user_key', count(*) FROM fact_clicks WHERE user_key NOT IN (SELECT user_key FROM dim_user)
       UNION ALL SELECT 'device_key', count(*) FROM fact_clicks WHERE device_key NOT IN (SELECT device_key FROM dim_device)
       UNION ALL SELECT 'created_date_key', count(*) FROM dim_url
         WHERE created_date_key NOT IN (SELECT date_key FROM dim_date)""",
    ["silver", "dim_user", "dim_url", "dim_device", "fact_clicks"],
)
def fk_violations(spark, sf):
    star, rows = _star(spark, sf), _silver(spark, sf)
    clicks = facts.foreign_key_violations(
        rows, {"user_id": star["dim_user"], "short_code": star["dim_url"], "device_type": star["dim_device"]}
    )
    fact = facts.foreign_key_violations(
        star["fact_clicks"],
        {"date_key": star["dim_date"], "url_key": star["dim_url"], "user_key": star["dim_user"], "device_key": star["dim_device"]},
    )
    created = star["dim_date"].withColumnRenamed("date_key", "created_date_key")
    return clicks.unionByName(fact).unionByName(
        facts.foreign_key_violations(star["dim_url"], {"created_date_key": created})
    )


@register(
    "seed_if_absent",
    """SELECT d.date_key, d.full_date, d.date_key IN (SELECT date_key FROM fact_clicks) AS was_present FROM dim_date d""",
    ["dim_date", "fact_clicks"],
)
def seed_if_absent(spark, sf):
    """Days with clicks are in the table already; the seed adds the rest of the calendar, none twice."""
    calendar = dims.calendar(spark).select("date_key", "full_date")
    used = _star(spark, sf)["fact_clicks"].select("date_key").distinct()
    existing = calendar.join(used, "date_key", "left_semi")
    added = dims.insert_missing(existing, calendar, "date_key")
    return existing.withColumn("was_present", F.lit(True)).unionByName(added.withColumn("was_present", F.lit(False)))


@register(
    "delete_range",
    "SELECT * FROM bronze_clicks WHERE id IS NULL OR id < (SELECT max(o_custkey) FROM orders)",
    ["bronze_clicks"],
)
def delete_range(spark, sf):
    floor = fx.table(spark, sf, "orders").agg(F.max("o_custkey")).first()[0]
    return sinks.delete_rows(fx.bronze_clicks(spark, sf), "id", floor)


# --- Metrics -------------------------------------------------------------------------------------

def _metric(name: str, build, sql: str, views: list[str]) -> None:
    register(name, sql, ["fact_clicks", *views])(lambda spark, sf: build(_star(spark, sf)))


_metric(
    "m_total_clicks_per_url", lambda s: metrics.total_clicks_per_url(s["fact_clicks"], s["dim_url"]),
    "SELECT u.short_code, count(*) AS total_clicks FROM fact_clicks f JOIN dim_url u ON f.url_key = u.url_key GROUP BY 1",
    ["dim_url"],
)
_metric(
    "m_clicks_from_id", lambda s: metrics.total_clicks_per_url(s["fact_clicks"], s["dim_url"], min_click_id=500),
    """SELECT u.short_code, count(*) AS total_clicks FROM fact_clicks f JOIN dim_url u ON f.url_key = u.url_key
       WHERE f.click_id >= 500 GROUP BY 1""",
    ["dim_url"],
)
_metric(
    "m_clicks_over_time", lambda s: metrics.clicks_over_time(s["fact_clicks"], s["dim_date"]),
    "SELECT d.full_date, count(*) AS clicks FROM fact_clicks f JOIN dim_date d ON f.date_key = d.date_key GROUP BY 1 ORDER BY 1",
    ["dim_date"],
)
_metric(
    "m_clicks_by_device", lambda s: metrics.clicks_by_device_type(s["fact_clicks"], s["dim_device"]),
    "SELECT v.device_type, count(*) AS clicks FROM fact_clicks f JOIN dim_device v ON f.device_key = v.device_key GROUP BY 1",
    ["dim_device"],
)
_metric(
    "m_top10_urls", lambda s: metrics.top_urls(s["fact_clicks"], s["dim_url"]),
    """SELECT u.short_code, count(*) AS total_clicks FROM fact_clicks f JOIN dim_url u ON f.url_key = u.url_key
       GROUP BY 1 ORDER BY total_clicks DESC, u.short_code LIMIT 10""",
    ["dim_url"],
)
_metric(
    "m_anon_vs_attributed", lambda s: metrics.anonymous_vs_attributed(s["fact_clicks"], s["dim_user"]),
    "SELECT p.is_known, count(*) AS clicks FROM fact_clicks f JOIN dim_user p ON f.user_key = p.user_key GROUP BY 1",
    ["dim_user"],
)
_metric(
    "m_clicks_by_plan", lambda s: metrics.clicks_by_plan_type(s["fact_clicks"], s["dim_user"]),
    """SELECT p.plan_type, count(*) AS clicks FROM fact_clicks f JOIN dim_user p ON f.user_key = p.user_key
       WHERE p.is_known GROUP BY 1""",
    ["dim_user"],
)
_metric(
    "m_clicks_by_domain", lambda s: metrics.clicks_by_domain(s["fact_clicks"], s["dim_url"]),
    """SELECT u.original_url_domain, count(*) AS clicks FROM fact_clicks f JOIN dim_url u ON f.url_key = u.url_key
       GROUP BY 1""",
    ["dim_url"],
)
_metric(
    "m_active_vs_inactive", lambda s: metrics.active_vs_inactive(s["fact_clicks"], s["dim_url"]),
    "SELECT u.is_active, count(*) AS clicks FROM fact_clicks f JOIN dim_url u ON f.url_key = u.url_key GROUP BY 1",
    ["dim_url"],
)
_metric(
    "m_additive_check", lambda s: metrics.additive_check(s["fact_clicks"]),
    "SELECT count(*) AS row_count, CAST(coalesce(sum(click_count), 0) AS BIGINT) AS click_count FROM fact_clicks", [],
)


# --- Run ledger ----------------------------------------------------------------------------------

@register(
    "ledger_current_state",
    """SELECT * EXCLUDE (event_seq, rn) FROM (
         SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY event_seq DESC) AS rn FROM ledger_events)
       WHERE rn = 1""",
    ["ledger_events"],
)
def ledger_current_state(spark, sf):
    return lg.current_runs(fx.ledger_events(spark, sf))


def _watermark_sql(extra: str) -> str:
    return f"""SELECT pipeline_name, source_table, coalesce(watermark_end, 0) AS watermark FROM (
         SELECT *, row_number() OVER (PARTITION BY pipeline_name, source_table ORDER BY started_at DESC, run_id DESC) AS rn
         FROM ledger_runs WHERE status = 'success' {extra}) WHERE rn = 1"""


@register("ledger_last_watermark", _watermark_sql(""), ["ledger_runs"])
def ledger_last_watermark(spark, sf):
    return lg.last_watermarks(fx.ledger_runs(spark, sf))


@register("ledger_last_watermark_skip_null", _watermark_sql("AND watermark_end IS NOT NULL"), ["ledger_runs"])
def ledger_last_watermark_skip_null(spark, sf):
    return lg.last_watermarks(fx.ledger_runs(spark, sf), skip_null_watermarks=True)


@register(
    "ledger_failures",
    "SELECT run_id, source_table, substring(error_message, 1, 2000) AS error_message FROM ledger_runs WHERE status = 'failed'",
    ["ledger_runs"],
)
def ledger_failures(spark, sf):
    failed = fx.ledger_runs(spark, sf).where(F.col("status") == "failed")
    return failed.select("run_id", "source_table", lg.error_text(F.col("error_message")).alias("error_message"))


@register(
    "ledger_stale_runs",
    """SELECT run_id, pipeline_name, source_table, load_type, started_at FROM ledger_runs
       WHERE status = 'running' AND started_at < TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 60 MINUTE""",
    ["ledger_runs"],
)
def ledger_stale_runs(spark, sf):
    return lg.stale_runs(fx.ledger_runs(spark, sf), _NOW, 60)


@register(
    "ledger_run_history",
    """SELECT run_id, pipeline_name, source_table, load_type, status, rows_written, bronze_key, started_at, error_message
       FROM ledger_runs ORDER BY started_at DESC, run_id LIMIT 20""",
    ["ledger_runs"],
)
def ledger_run_history(spark, sf):
    return lg.run_history(fx.ledger_runs(spark, sf))


@register(
    "ledger_summary",
    """SELECT source_table, count(*) FILTER (WHERE status = 'success') AS successful_runs,
         count(*) FILTER (WHERE status = 'failed') AS failed_runs,
         CAST(coalesce(sum(rows_written) FILTER (WHERE status = 'success'), 0) AS BIGINT) AS total_rows_written,
         max(started_at) FILTER (WHERE status = 'success') AS last_success_at
       FROM ledger_runs GROUP BY source_table ORDER BY source_table""",
    ["ledger_runs"],
)
def ledger_summary(spark, sf):
    return lg.summary(fx.ledger_runs(spark, sf))


@register("ledger_success_keys", "SELECT bronze_key FROM recorded", ["recorded"])
def ledger_success_keys(spark, sf):
    return lg.success_keys(fx.ledger_runs(spark, sf))


# --- Storage reports -----------------------------------------------------------------------------

def _stored(spark: SparkSession, sf: str) -> DataFrame:
    return fx.stored_objects(spark, sf).select(F.col("path").alias("bronze_key"))


@register("reconcile_orphans", "SELECT bronze_key FROM orphans ORDER BY 1", ["orphans"])
def reconcile_orphans(spark, sf):
    return storage.orphaned_objects(_stored(spark, sf), lg.success_keys(fx.ledger_runs(spark, sf)))


@register("reconcile_missing", "SELECT bronze_key FROM missing ORDER BY 1", ["missing"])
def reconcile_missing(spark, sf):
    return storage.missing_objects(_stored(spark, sf), lg.success_keys(fx.ledger_runs(spark, sf)))


@register(
    "reconcile_summary",
    """SELECT (SELECT count(*) FROM orphans) AS orphaned, (SELECT count(*) FROM missing) AS missing,
         (SELECT count(*) FROM orphans) + (SELECT count(*) FROM missing) = 0 AS clean""",
    ["orphans", "missing"],
)
def reconcile_summary(spark, sf):
    return storage.reconcile(_stored(spark, sf), lg.success_keys(fx.ledger_runs(spark, sf)))


@register(
    "storage_stats",
    """SELECT count(*) AS object_count, CAST(coalesce(sum(length), 0) AS BIGINT) AS total_bytes FROM stored_objects
       WHERE starts_with(path, 'bronze/')""",
    ["stored_objects"],
)
def storage_stats(spark, sf):
    return storage.storage_stats(fx.stored_objects(spark, sf))


@register(
    "layout_report",
    """SELECT source_table, count(*) AS object_count, CAST(sum(length) AS BIGINT) AS total_bytes,
         CAST(sum(length) // count(*) AS BIGINT) AS avg_bytes, min(length) AS min_bytes, max(length) AS max_bytes,
         count(*) FILTER (WHERE length < 8388608) AS small_file_count
       FROM stored_objects GROUP BY source_table""",
    ["stored_objects"],
)
def layout_report(spark, sf):
    return storage.layout_report(fx.stored_objects(spark, sf), by=["source_table"])


# --- Contracts, personal data, quality -----------------------------------------------------------

def _source_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {"clicks": fx.src_clicks(spark, sf), "urls": fx.src_urls(spark, sf), "users": fx.src_users(spark, sf)}


_CONTRACT_VIEWS = """, actual("table", "column", category, has_null) AS (
  SELECT 'clicks', unnest(['id', 'short_code', 'occurred_at', 'device_type', 'hashed_ip', 'user_id']),
    unnest(['integer', 'text', 'timestamp', 'text', 'text', 'numeric']),
    unnest([bool_or(id IS NULL), bool_or(short_code IS NULL), bool_or(occurred_at IS NULL), bool_or(device_type IS NULL),
      bool_or(hashed_ip IS NULL), bool_or(user_id IS NULL)]) FROM src_clicks
  UNION ALL SELECT 'urls', unnest(['id', 'short_code', 'original_url', 'created_at', 'is_active']),
    unnest(['integer', 'text', 'text', 'unknown', 'boolean']),
    unnest([bool_or(id IS NULL), bool_or(short_code IS NULL), bool_or(original_url IS NULL), bool_or(created_at IS NULL),
      bool_or(is_active IS NULL)]) FROM src_urls
  UNION ALL SELECT 'users', unnest(['id', 'email', 'plan_type']), unnest(['integer', 'text', 'text']),
    unnest([bool_or(id IS NULL), bool_or(email IS NULL), bool_or(plan_type IS NULL)]) FROM src_users),
declared("table", "column", "type", nullable) AS (VALUES
  ('clicks', 'id', 'integer', false), ('clicks', 'short_code', 'text', false), ('clicks', 'occurred_at', 'timestamp', false),
  ('clicks', 'device_type', 'text', false), ('clicks', 'hashed_ip', 'text', true), ('clicks', 'user_id', 'integer', true),
  ('urls', 'id', 'integer', false), ('urls', 'short_code', 'text', true), ('urls', 'original_url', 'text', false),
  ('urls', 'created_at', 'timestamp', false), ('urls', 'expires_at', 'timestamp', true), ('urls', 'user_id', 'integer', true),
  ('urls', 'is_active', 'boolean', false), ('urls', 'deleted_at', 'timestamp', true),
  ('users', 'id', 'integer', false), ('users', 'email', 'text', false), ('users', 'plan_type', 'text', false),
  ('users', 'created_at', 'timestamp', false)),
paired AS (SELECT "table", "column", d."type", d.nullable, a.category, a.has_null FROM declared d
  FULL OUTER JOIN actual a USING ("table", "column")),
findings("table", severity, kind, "column") AS (
  SELECT "table", 'violation', 'missing_column', "column" FROM paired WHERE category IS NULL
  UNION ALL SELECT "table", 'violation', 'type_mismatch', "column" FROM paired WHERE "type" <> category
  UNION ALL SELECT "table", 'violation', 'nullability_mismatch', "column" FROM paired WHERE NOT nullable AND has_null
  UNION ALL SELECT "table", 'warning', 'extra_column', "column" FROM paired WHERE "type" IS NULL)"""


def _findings(spark: SparkSession, sf: str) -> DataFrame:
    return ct.validate_contracts(spark, ct.load_contracts(), _source_tables(spark, sf))


@register("contract_report", _CONTRACT_VIEWS + ' SELECT * FROM findings', ["src_clicks", "src_urls", "src_users"])
def contract_report(spark, sf):
    return _findings(spark, sf).drop("detail")


@register(
    "contract_summary",
    _CONTRACT_VIEWS + """ SELECT "table", count(*) FILTER (WHERE severity = 'violation') = 0 AS passed,
      count(*) FILTER (WHERE severity = 'violation') AS violations, count(*) FILTER (WHERE severity = 'warning') AS warnings
      FROM findings GROUP BY "table" """,
    ["src_clicks", "src_urls", "src_users"],
)
def contract_summary(spark, sf):
    return ct.contract_summary(ct.contract_columns(spark, ct.load_contracts()), _findings(spark, sf))


@register(
    "pii_report",
    """SELECT 'clicks' AS "table", 'hashed_ip' AS "column", 'pseudonymized' AS category, count(hashed_ip) AS filled_values
         FROM src_clicks
       UNION ALL SELECT 'clicks', 'user_id', 'pseudonymized', count(user_id) FROM src_clicks
       UNION ALL SELECT 'urls', 'user_id', 'pseudonymized', 0
       UNION ALL SELECT 'users', 'email', 'direct', count(email) FROM src_users""",
    ["src_clicks", "src_users"],
)
def pii_report(spark, sf):
    """Declared personal data and how many values of it the tables hold."""
    declared = pii.pii_columns(ct.contract_columns(spark, ct.load_contracts()))
    filled = pii.filled_values(_source_tables(spark, sf))
    return declared.join(filled, ["table", "column"], "left").select(
        "table", "column", "category", F.coalesce("filled_values", F.lit(0)).alias("filled_values")
    )


@register("pii_safe_users", "SELECT id, plan_type FROM src_users", ["src_users"])
def pii_safe_users(spark, sf):
    contract = next(c for c in ct.load_contracts() if c["table"] == "users")
    return pii.without_direct_pii(fx.src_users(spark, sf), contract)


@register(
    "dq_rule_counts",
    """SELECT 'clicks' AS "table", 'device_type_known' AS rule, count(*) AS rows_checked,
         count(*) FILTER (WHERE device_type IS NULL OR device_type NOT IN ('mobile', 'desktop', 'tablet', 'unknown')) AS violations
         FROM src_clicks
       UNION ALL SELECT 'clicks', 'hashed_ip_is_digest', count(*),
         count(*) FILTER (WHERE hashed_ip IS NOT NULL AND NOT regexp_full_match(hashed_ip, '[0-9a-f]{64}')) FROM src_clicks
       UNION ALL SELECT 'users', 'plan_type_known', count(*),
         count(*) FILTER (WHERE plan_type IS NULL OR plan_type NOT IN ('FREE', 'PREMIUM')) FROM src_users""",
    ["src_clicks", "src_users"],
)
def dq_rule_counts(spark, sf):
    return quality.click_rules(fx.src_clicks(spark, sf)).unionByName(quality.user_rules(fx.src_users(spark, sf)))


@register(
    "dq_unique_short_code",
    """SELECT short_code, count(*) AS occurrences FROM src_clicks WHERE short_code IS NOT NULL
       GROUP BY 1 HAVING count(*) > 1
       UNION ALL SELECT short_code, count(*) FROM src_urls WHERE short_code IS NOT NULL GROUP BY 1 HAVING count(*) > 1
       UNION ALL SELECT email, count(*) FROM src_users WHERE email IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    ["src_clicks", "src_urls", "src_users"],
)
def dq_unique_short_code(spark, sf):
    """The rule on urls and users, which hold it, and on clicks, which repeat codes."""
    clicks = quality.repeated_values(fx.src_clicks(spark, sf), "short_code")
    urls = quality.repeated_values(fx.src_urls(spark, sf), "short_code")
    users = quality.repeated_values(fx.src_users(spark, sf), "email").withColumnRenamed("email", "short_code")
    return clicks.unionByName(urls).unionByName(users)


def _key_check_sql() -> str:
    """Both checks of every star table, from the same lists of keys and lengths."""
    parts = []
    for name in _CHECKED:
        for key in STAR_KEYS[name]:
            parts.append(f"SELECT '{name}', '{key}', 'unique', count({key}) - count(DISTINCT {key}) FROM {name}")
        for column, limit in STAR_LENGTHS[name].items():
            over = f"count(*) FILTER (WHERE length({column}) > {limit})"
            parts.append(f"SELECT '{name}', '{column}', 'length', {over} FROM {name}")
    rows = " UNION ALL ".join(parts)
    return f"""SELECT c1 AS "table", c2 AS "column", c3 AS "check", CAST(c4 AS BIGINT) AS violations
               FROM ({rows}) AS checks(c1, c2, c3, c4)"""


_CHECKED = ["dim_date", "dim_url", "dim_user", "dim_device", "fact_clicks"]


@register("dq_key_checks", _key_check_sql(), _CHECKED)
def dq_key_checks(spark, sf):
    star = _star(spark, sf)
    reports = [quality.key_report(star[t], t, STAR_KEYS[t], STAR_LENGTHS[t]) for t in _CHECKED]
    return reduce(DataFrame.unionByName, reports)


@register(
    "dq_immutable_rows",
    """SELECT id, CASE WHEN trim(short_code) = '' THEN 'vanished' ELSE 'changed' END AS change FROM src_clicks
       WHERE trim(short_code) = '' OR (occurred_at IS NULL AND device_type IS DISTINCT FROM 'desktop')""",
    ["src_clicks"],
)
def dq_immutable_rows(spark, sf):
    """Against a later snapshot that lost the rows without a code and changed the device of those without a time."""
    before = fx.src_clicks(spark, sf)
    later = before.where(F.trim("short_code") != "").withColumn(
        "device_type", F.when(F.col("occurred_at").isNull(), "desktop").otherwise(F.col("device_type"))
    )
    return quality.changed_rows(before, later, "id")


@register(
    "dq_immutable_ranges",
    """SELECT id, CASE WHEN trim(short_code) = '' THEN 'vanished' ELSE 'changed' END AS change FROM src_clicks
       WHERE (trim(short_code) = '' OR (occurred_at IS NULL AND device_type IS DISTINCT FROM 'desktop'))
         AND id < (SELECT max(id) FROM src_clicks) / 4""",
    ["src_clicks"],
)
def dq_immutable_ranges(spark, sf):
    """As ``dq_immutable_rows``, but only the first quarter of the ids has changed: ranges above it agree."""
    before = fx.src_clicks(spark, sf)
    early = F.col("id") < before.agg(F.max("id")).first()[0] / 4
    later = before.where(~early | (F.trim("short_code") != "")).withColumn(
        "device_type", F.when(early & F.col("occurred_at").isNull(), "desktop").otherwise(F.col("device_type"))
    )
    return quality.changed_rows_by_range(before, later, "id", width=1024)


@register(
    "dq_monotonic_ids",
    """SELECT min(id) AS min_id, max(id) AS max_id,
         count(*) FILTER (WHERE id IS NULL OR id <= (SELECT max(id) FROM bronze_full)) AS violations FROM bronze_incremental""",
    ["bronze_full", "bronze_incremental"],
)
def dq_monotonic_ids(spark, sf):
    watermark = fx.bronze_full(spark, sf).agg(F.max("id")).first()[0]
    return quality.ids_above(fx.bronze_incremental(spark, sf), watermark)


@register(
    "dq_freshness",
    """SELECT t.source_table, last_success_at,
         CAST(floor(epoch(TIMESTAMP '2001-08-01 00:00:00' - last_success_at) / 60) AS BIGINT) AS age_minutes,
         CAST(sla_minutes AS INTEGER) AS sla_minutes,
         coalesce(epoch(TIMESTAMP '2001-08-01 00:00:00' - last_success_at) > sla_minutes * 60, true) AS is_late
       FROM (VALUES ('clicks', 1440), ('urls', 1440), ('users', 1440)) AS t(source_table, sla_minutes)
       LEFT JOIN (SELECT source_table, max(started_at) AS last_success_at FROM ledger_runs WHERE status = 'success' GROUP BY 1) r
         ON r.source_table = t.source_table""",
    ["ledger_runs"],
)
def dq_freshness(spark, sf):
    limits = ct.freshness_limits(ct.load_contracts())
    return quality.freshness(lg.summary(fx.ledger_runs(spark, sf)), limits, _NOW)


# --- Generators ----------------------------------------------------------------------------------

_GEN_SQL = "TIMESTAMP '2026-01-01 00:00:00'"


def _picked(pool: str, key: str, columns: str = "*") -> str:
    return f"(SELECT {columns}, row_number() OVER (ORDER BY {key}) AS pick FROM {pool})"


def _pick(seed: int, pool: str, g: str = "g") -> str:
    return f"{scatter_sql(g, seed)} % (SELECT count(*) FROM {pool}) + 1"


def _numbered(spark: SparkSession, sf: str, name: str, key: str) -> DataFrame:
    return fx.table(spark, sf, name).select(F.col(key).alias("g"))


@register(
    "gen_clicks_source",
    f"""SELECT 900000000 + g AS id, u.short_code, {_GEN_SQL} AS occurred_at,
          ['mobile', 'desktop', 'tablet', 'unknown'][g % 4 + 1] AS device_type, md5(concat('synthetic-ip-', g)) AS hashed_ip,
          CASE WHEN g % 5 <> 0 THEN p.id END AS user_id
        FROM (SELECT g, {_pick(42, 'src_urls')} AS url_pick, {_pick(43, 'src_users')} AS user_pick
          FROM (SELECT event_id AS g FROM events))
        JOIN {_picked('src_urls', 'id')} u ON u.pick = url_pick
        JOIN {_picked('src_users', 'id')} p ON p.pick = user_pick""",
    ["src_urls", "src_users"],
)
def gen_clicks_source(spark, sf):
    rows = _numbered(spark, sf, "events", "event_id")
    return naive(
        generators.source_clicks(rows, fx.src_urls(spark, sf), fx.src_users(spark, sf), _GEN_NOW), "occurred_at"
    )


def queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}
