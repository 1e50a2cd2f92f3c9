"""Bronze clicks -> Silver clicks: typing, trimming, validity and one copy per click."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklake.functions.columns import known_device, valid_digest
from clicklake.schemas import SILVER_CLICKS

COPIES = "_copies"


def _typed(bronze: DataFrame) -> DataFrame:
    """All cleaned columns of every Bronze row, valid or not. Casts that fail give NULL."""
    return bronze.select(
        F.col("id").try_cast("bigint").alias("click_id"),
        F.trim("short_code").alias("short_code"),
        F.col("occurred_at").try_cast("timestamp").alias("occurred_at"),
        known_device(F.col("device_type")).alias("device_type"),
        valid_digest(F.col("hashed_ip")).alias("hashed_ip"),
        F.col("user_id").try_cast("bigint").alias("user_id"),
    )


def reject_reason() -> Column:
    """Why a typed row cannot be a click; NULL for a usable row."""
    return (
        F.when(F.col("click_id").isNull(), "missing_id")
        .when(F.col("occurred_at").isNull(), "missing_time")
        .when(F.coalesce(F.length("short_code"), F.lit(0)) == 0, "missing_code")
    )


def clean_clicks(bronze: DataFrame) -> DataFrame:
    """Usable clicks in the Silver shape. One narrow stage, no shuffle."""
    return (
        _typed(bronze)
        .where(F.col("click_id").isNotNull() & F.col("occurred_at").isNotNull() & (F.length("short_code") > 0))
        .withColumn("silver_loaded_at", F.current_timestamp())
        .select(*SILVER_CLICKS.names)
    )


def rejected_clicks(bronze: DataFrame) -> DataFrame:
    """The rows that ``clean_clicks`` leaves out, each with its reason."""
    return _typed(bronze).withColumn("reason", reject_reason()).where(F.col("reason").isNotNull())


def deduplicate_clicks(silver: DataFrame) -> DataFrame:
    """One row per click. Clicks never change at the source, so any copy will do.

    The aggregate merges copies before the shuffle, so a click copied a billion times still
    sends one row per input partition.
    """
    return deduplicate_counting(silver).select(*silver.columns)


def deduplicate_counting(silver: DataFrame) -> DataFrame:
    """``deduplicate_clicks`` plus the number of copies behind each row, for the same one shuffle."""
    others = [c for c in silver.columns if c != "click_id"]
    return silver.groupBy("click_id").agg(
        *[F.first(c).alias(c) for c in others], F.count(F.lit(1)).alias(COPIES)
    )


def silver_stats(bronze: DataFrame) -> DataFrame:
    """Row counts of the Bronze -> Silver step, in one pass over three columns."""
    typed = _typed(bronze).select("click_id", reject_reason().isNull().alias("usable"))
    per_click = typed.groupBy(F.when(F.col("usable"), F.col("click_id")).alias("click_id")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("usable").alias("usable")
    )
    return per_click.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("bronze_rows"),
        F.coalesce(F.sum(F.col("n") - F.col("usable")), F.lit(0)).alias("invalid_rows_dropped"),
        F.coalesce(F.sum(F.greatest(F.col("usable") - 1, F.lit(0))), F.lit(0)).alias("duplicate_rows_removed"),
        F.count_if(F.col("usable") > 0).alias("silver_rows"),
    )


def valid_clicks(clicks: DataFrame) -> DataFrame:
    """Exploration view: clicks with an id, four columns, lower-case device name."""
    return clicks.where(F.col("id").isNotNull()).select(
        "id", "short_code", "occurred_at", F.lower("device_type").alias("device_type")
    )
