"""Storage reports over an object listing with columns ``path`` and ``length``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.schemas import SMALL_FILE_BYTES


def storage_stats(objects: DataFrame, prefix: str = "bronze/") -> DataFrame:
    """Number of objects under ``prefix`` and their bytes; zeros when there are none."""
    return objects.where(F.col("path").startswith(prefix)).agg(
        F.count(F.lit(1)).alias("object_count"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes")
    )


def layout_report(objects: DataFrame, small_file_bytes: int = SMALL_FILE_BYTES, by: list[str] | None = None) -> DataFrame:
    """File-size health: count, total, floor of the average, extremes and small files.

    Without ``by`` there is one row, of zeros for an empty listing.
    """
    def or_zero(column):
        return F.coalesce(column, F.lit(0))

    report = objects.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("object_count"),
        or_zero(F.sum("length")).alias("total_bytes"),
        or_zero(F.min("length")).alias("min_bytes"),
        or_zero(F.max("length")).alias("max_bytes"),
        F.count_if(F.col("length") < small_file_bytes).alias("small_file_count"),
    )
    average = F.when(F.col("object_count") == 0, 0).otherwise(F.expr("total_bytes div nullif(object_count, 0)"))
    return report.select(
        *(by or []), "object_count", "total_bytes", average.cast("bigint").alias("avg_bytes"),
        "min_bytes", "max_bytes", "small_file_count",
    )


_CHUNK = 10_000


def _orphans(stored: DataFrame, recorded: DataFrame) -> DataFrame:
    keys = stored.select("bronze_key").distinct()
    return keys.join(recorded.select("bronze_key").distinct(), "bronze_key", "left_anti")


def _missing(stored: DataFrame, recorded: DataFrame) -> DataFrame:
    """Recorded but absent keys with the number ``n`` of their records.

    Records are counted before the join, so a key recorded very often is one row there.
    """
    counted = recorded.groupBy("bronze_key").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(stored.select("bronze_key").distinct(), "bronze_key", "left_anti")


def orphaned_objects(stored: DataFrame, recorded: DataFrame) -> DataFrame:
    """Stored keys that no successful run recorded, each once, sorted."""
    return _orphans(stored, recorded).orderBy("bronze_key")


def missing_objects(stored: DataFrame, recorded: DataFrame) -> DataFrame:
    """Recorded keys that are not stored, once per record, sorted.

    Counts unfold in chunks to keep arrays short, and the copy number takes part in the sort so
    that the copies of one key can lie in several partitions.
    """
    chunks = _missing(stored, recorded).select(
        "bronze_key", "n", F.explode(F.expr(f"sequence(0L, (n - 1) div {_CHUNK})")).alias("_chunk")
    )
    last = F.least(F.col("n"), (F.col("_chunk") + 1) * _CHUNK)
    copies = chunks.select("bronze_key", F.explode(F.sequence(F.col("_chunk") * _CHUNK + 1, last)).alias("_copy"))
    return copies.orderBy("bronze_key", "_copy").select("bronze_key")


def reconcile(stored: DataFrame, recorded: DataFrame) -> DataFrame:
    """Counts of both kinds of drift and whether there is none."""
    none = F.lit(0).cast("bigint")
    drift = _orphans(stored, recorded).select(F.lit(1).cast("bigint").alias("orphaned"), none.alias("missing")).unionByName(
        _missing(stored, recorded).select(none.alias("orphaned"), F.col("n").alias("missing"))
    )
    totals = drift.agg(
        F.coalesce(F.sum("orphaned"), F.lit(0)).alias("orphaned"), F.coalesce(F.sum("missing"), F.lit(0)).alias("missing")
    )
    return totals.withColumn("clean", (F.col("orphaned") == 0) & (F.col("missing") == 0))
