"""The click fact: surrogate keys for every click, and the clicks that cannot have them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.functions.columns import date_key
from clicklake.operators.lookup import broadcast_limit, hot_keys, lookup, plan_bytes
from clicklake.schemas import UNKNOWN_USER_KEY


def resolve_clicks(
    silver: DataFrame,
    dim_date: DataFrame,
    dim_url: DataFrame,
    dim_user: DataFrame,
    dim_device: DataFrame,
    broadcast_bytes: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Every click with its dimension keys and, if one that must exist is missing, a reason.

    An anonymous click, or one whose user is not in the dimension, gets the Unknown member. There
    is no unknown url or date, so those clicks carry ``reject_reason``. The date and device
    dimensions are fixed and small; the others go through the skew-safe lookup. ``keep`` names further
    columns of the click to carry along.
    """
    # One url per code, so that a repeated code cannot multiply clicks.
    codes = (
        dim_url.where(F.col("short_code").isNotNull()).groupBy("short_code").agg(F.min("url_key").alias("url_key"))
    )
    people = dim_user.where(F.col("user_key") != UNKNOWN_USER_KEY)

    clicks = silver.withColumn("_day", date_key(F.col("occurred_at").cast("date")))
    dates = dim_date.select(F.col("date_key"))
    clicks = clicks.join(F.broadcast(dates), F.col("_day") == F.col("date_key"), "left").drop("_day")
    clicks = clicks.join(F.broadcast(dim_device), "device_type", "left")
    limit = broadcast_limit(silver.sparkSession) if broadcast_bytes is None else broadcast_bytes
    hot = None
    if max(plan_bytes(codes), plan_bytes(people)) > limit:
        hot = hot_keys(silver.select("short_code", "user_id"), ["short_code", "user_id"])
    clicks = lookup(clicks, codes, "short_code", "url_key", "click_id", limit, hot=hot)
    clicks = lookup(clicks, people, "user_id", "user_key", "click_id", limit, hot=hot)
    return clicks.select(
        "click_id",
        "date_key",
        "url_key",
        F.coalesce("user_key", F.lit(UNKNOWN_USER_KEY)).alias("user_key"),
        "device_key",
        "short_code",
        "occurred_at",
        F.lit(1).cast("smallint").alias("click_count"),
        (F.col("user_id").isNotNull() & F.col("user_key").isNull()).alias("user_unresolved"),
        F.when(F.col("url_key").isNull(), "unknown_url")
        .when(F.col("date_key").isNull(), "unknown_date")
        .when(F.col("device_key").isNull(), "unknown_device")
        .alias("reject_reason"),
        *keep,
    )


def fact_clicks(resolved: DataFrame) -> DataFrame:
    return resolved.where(F.col("reject_reason").isNull()).drop("reject_reason", "user_unresolved")


def fact_rejects(resolved: DataFrame) -> DataFrame:
    return resolved.where(F.col("reject_reason").isNotNull()).select(
        "click_id", "short_code", "occurred_at", "reject_reason"
    )


def foreign_key_violations(child: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """Per foreign key: child rows whose key is set but missing in the parent.

    ``parents`` maps a key column to its dimension. Child keys are counted before they meet the
    parent, so the join works on distinct keys, never on click rows.
    """
    report = None
    for column, parent in parents.items():
        counts = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        lost = counts.join(parent.select(column), column, "left_anti").agg(
            F.lit(column).alias("key_column"), F.coalesce(F.sum("n"), F.lit(0)).alias("violations")
        )
        report = lost if report is None else report.unionByName(lost)
    return report
