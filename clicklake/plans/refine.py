"""Jobs from Bronze to Silver to the star schema."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clicklake.operators import dims, facts
from clicklake.operators.silver import COPIES, clean_clicks, deduplicate_counting, valid_clicks
from clicklake.schemas import CLICKS, DIM_URL, DIM_USER, FACT_CLICKS, SILVER_CLICKS, STAR_TABLES, empty
from clicklake.sinks.tables import publish, publish_split, recover
from clicklake.sources.bronze import MISFITS, latest_snapshot_day, read_bronze, read_date_range, read_rescued, read_snapshots
from clicklake.sources.listing import exists


def silver_clicks(bronze: DataFrame) -> DataFrame:
    """Clean, distinct clicks."""
    return deduplicate_counting(clean_clicks(bronze)).select(*SILVER_CLICKS.names)


def silver_job(spark: SparkSession, lake: str, own_files: bool = False) -> dict[str, int]:
    """Bronze clicks -> ``silver/clicks``; returns the row counts.

    One pass writes the table. Usable rows and distinct clicks are observed after the shuffle, in
    the stage that writes: there each task counts once, while counts taken before the shuffle grow
    when a lost executor makes map tasks run again. Bronze rows come from file footers.
    """
    bronze = read_bronze(spark, f"{lake}/bronze", "clicks", own_files)
    seen = Observation()
    counted = deduplicate_counting(clean_clicks(bronze)).observe(
        seen, F.count(F.lit(1)).alias("silver"), F.coalesce(F.sum(COPIES), F.lit(0)).alias("usable")
    )
    publish(counted.select(*SILVER_CLICKS.names), f"{lake}/silver/clicks")
    bronze_rows, counts = bronze.count(), seen.get
    return {
        "bronze_rows": bronze_rows,
        "invalid_rows_dropped": bronze_rows - counts["usable"],
        "duplicate_rows_removed": counts["usable"] - counts["silver"],
        "silver_rows": counts["silver"],
    }


def misfits_job(spark: SparkSession, lake: str) -> dict[str, int]:
    """Values of Bronze clicks that do not fit -> ``silver/misfits``; returns their number by column, in one pass."""
    rows = read_rescued(spark, f"{lake}/bronze").where(F.size(MISFITS) > 0)
    counts = [F.count_if(F.map_contains_key(MISFITS, name)).alias(name) for name in CLICKS.names]
    publish(rows, f"{lake}/silver/misfits")
    # The table has the misfit rows only, and is counted as it was written.
    return spark.read.schema(rows.schema).parquet(f"{lake}/silver/misfits").agg(*counts).first().asDict()


def explore_job(spark: SparkSession, lake: str) -> int:
    """Valid clicks of the full snapshots -> ``explore/clicks``; returns their number, in one pass."""
    seen = Observation()
    rows = valid_clicks(read_snapshots(spark, f"{lake}/bronze")).observe(seen, F.count(F.lit(1)).alias("rows"))
    publish(rows, f"{lake}/explore/clicks")
    return int(seen.get["rows"])


def read_star(spark: SparkSession, gold: str) -> dict[str, DataFrame]:
    """All star tables below ``gold``; a table that was not built yet is empty.

    A table whose replacement died is put back first. A dimension that is gone although clicks were worked in
    is an error: taken for empty, its members would be numbered anew.
    """
    for name in STAR_TABLES:
        recover(spark, f"{gold}/{name}")
    lost = [name for name in STAR_TABLES if name.startswith("dim_") and not exists(spark, f"{gold}/{name}")]
    if lost and exists(spark, f"{gold}/progress"):
        raise FileNotFoundError(f"{', '.join(lost)} missing under {gold}, which has progress; restore it or delete gold")
    return {
        name: spark.read.schema(schema).parquet(f"{gold}/{name}") if exists(spark, f"{gold}/{name}") else empty(spark, schema)
        for name, schema in STAR_TABLES.items()
    }


def read_rejects(spark: SparkSession, gold: str) -> DataFrame:
    """Clicks that got no place in the fact, with the reason."""
    return spark.read.parquet(f"{gold}/fact_rejects").select("click_id", "short_code", "occurred_at", "reject_reason")


def publish_star(
    gold: str,
    urls: DataFrame,
    users: DataFrame,
    silver: DataFrame,
    old: dict[str, DataFrame] | None = None,
    order: list[str] | None = None,
    broadcast_bytes: int | None = None,
    by_day: bool = True,
) -> None:
    """Build the star schema below ``gold``.

    Dimensions are written first and read back, so that the fact sees their final keys and sizes
    and computes none of them twice. One pass over the clicks then writes both the fact and
    ``fact_rejects``, the clicks that cannot get a url or date.

    The fact lies in one directory per day, or in one for all with ``by_day=False``, which suits a small lake.
    Its rows are rebalanced by day: Spark measures the days as they are shuffled, gives a day with a third of all
    clicks to as many tasks as its bytes ask for, and small days to one task together, a file each.
    """
    spark = silver.sparkSession
    old = old or {}

    def previous(name: str) -> DataFrame | None:
        return None if name not in old or old[name].isEmpty() else old[name].drop("row_loaded_at")

    devices = dims.devices(spark)
    if previous("dim_device") is not None:
        devices = old["dim_device"].unionByName(dims.insert_missing(old["dim_device"], devices, "device_type"))
    # The dimensions do not need each other, so their jobs run side by side.
    jobs = [
        lambda: publish(dims.calendar(spark).coalesce(1), f"{gold}/dim_date"),
        lambda: publish(devices.coalesce(1), f"{gold}/dim_device"),
        lambda: publish(dims.stamped(dims.dim_url(urls, previous("dim_url"), order), DIM_URL), f"{gold}/dim_url"),
        lambda: publish(dims.stamped(dims.dim_user(users, previous("dim_user"), order), DIM_USER), f"{gold}/dim_user"),
    ]
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()

    star = read_star(spark, gold)
    resolved = facts.resolve_clicks(
        silver, star["dim_date"], star["dim_url"], star["dim_user"], star["dim_device"], broadcast_bytes
    )
    rows = resolved.select(
        *[c for c in FACT_CLICKS.names if c != "row_loaded_at"],
        F.current_timestamp().alias("row_loaded_at"),
        "reject_reason",
        F.when(F.col("reject_reason").isNull(), "fact_clicks").otherwise("fact_rejects").alias("_table"),
    )
    days = ["date_key"] if by_day else []
    rows = rows.hint("rebalance", "date_key").sortWithinPartitions("_table", "date_key")
    publish_split(rows, "_table", {name: f"{gold}/{name}" for name in ("fact_clicks", "fact_rejects")}, days)


def gold_job(spark: SparkSession, lake: str, broadcast_bytes: int | None = None) -> None:
    """Silver clicks and the newest urls and users -> star schema, keeping the keys given before.

    Snapshots that an earlier run has worked in are not read again, but for the last day, which a
    rerun may have replaced. The days are noted below ``gold/progress`` once the star is in place.
    """
    gold, bronze = f"{lake}/gold", f"{lake}/bronze"
    done = {}
    recover(spark, f"{gold}/progress")
    recover(spark, f"{lake}/silver/clicks")
    if exists(spark, f"{gold}/progress"):
        done = {r["source_table"]: r["last_day"] for r in spark.read.parquet(f"{gold}/progress").collect()}
    newest = {table: latest_snapshot_day(spark, bronze, table) for table in ("urls", "users")}
    urls, users = (read_date_range(spark, bronze, t, done.get(t, "0001-01-01"), day) for t, day in newest.items())
    silver = spark.read.schema(SILVER_CLICKS).parquet(f"{lake}/silver/clicks")
    publish_star(gold, urls, users, silver, read_star(spark, gold), ["ingestion_date"], broadcast_bytes)
    publish(spark.createDataFrame(list(newest.items()), "source_table string, last_day string").coalesce(1), f"{gold}/progress")
