"""Dimension tables of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.functions.columns import date_key, padded_name, url_host
from clicklake.operators.dedup import freshest
from clicklake.operators.keys import number_rows
from clicklake.schemas import (
    CALENDAR_END, CALENDAR_START, DEVICE_TYPES, DIM_DATE, DIM_DEVICE, UNKNOWN_PLAN, UNKNOWN_USER_KEY, conform,
)


def calendar(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """``dim_date``: one row per day from ``start`` to ``end``, both included."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("full_date")
    )
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_key"),
        "full_date",
        (F.dayofweek(day) - 1).cast("smallint").alias("day_of_week"),
        padded_name(day, "EEEE").alias("day_name"),
        F.dayofmonth(day).cast("smallint").alias("day_of_month"),
        F.month(day).cast("smallint").alias("month"),
        padded_name(day, "MMMM").alias("month_name"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.year(day).cast("smallint").alias("year"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    ).select(*DIM_DATE.names)


def devices(spark: SparkSession) -> DataFrame:
    """``dim_device``: the declared device types, numbered in their fixed order."""
    return spark.createDataFrame(list(enumerate(DEVICE_TYPES, start=1)), DIM_DEVICE)


def date_keys_of_year(dim_date: DataFrame, year: int) -> DataFrame:
    return dim_date.where(F.col("year") == year).select("date_key")


def url_attributes(urls: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Natural key and attributes of ``dim_url``. ``order`` picks the freshest of several versions."""
    source = freshest(urls, ["id"], order) if order else urls
    return source.select(
        F.col("id").alias("url_id"),
        "short_code",
        url_host(F.col("original_url")).alias("original_url_domain"),
        "is_active",
        date_key(F.col("created_at").cast("date")).alias("created_date_key"),
    )


def user_attributes(users: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Natural key and attributes of ``dim_user``. The e-mail address stays behind."""
    source = freshest(users, ["id"], order) if order else users
    return source.select(F.col("id").alias("user_id"), "plan_type", F.lit(True).alias("is_known"))


def upsert(previous: DataFrame | None, source: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """SCD type 1: overwrite attributes of known members, add new ones, keep members that left.

    Keys are never renumbered. New members get the numbers after the largest key so far, in
    natural-key order.
    """
    if previous is None:
        return number_rows(source, natural, surrogate).withColumn(surrogate, F.col(surrogate).cast("int"))

    attributes = [c for c in source.columns if c != natural]
    members = previous.where(F.col(surrogate) > 0)
    largest = members.agg(F.coalesce(F.max(surrogate), F.lit(0))).scalar()

    old = members.select(natural, surrogate, *[F.col(c).alias(f"_old_{c}") for c in attributes])
    kept = old.join(source.withColumn("_seen", F.lit(True)), natural, "left").select(
        surrogate,
        natural,
        *[F.when(F.col("_seen"), F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c) for c in attributes],
    )
    added = number_rows(source.join(members, natural, "left_anti"), natural, "_number").select(
        (F.col("_number") + largest).cast("int").alias(surrogate), natural, *attributes
    )
    return kept.unionByName(added)


def dim_url(urls: DataFrame, previous: DataFrame | None = None, order: list[str] | None = None) -> DataFrame:
    """``dim_url`` without its load time."""
    return upsert(previous, url_attributes(urls, order), "url_id", "url_key").select(
        "url_key", "url_id", "short_code", "original_url_domain", "is_active", "created_date_key"
    )


def unknown_user(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(
        F.lit(UNKNOWN_USER_KEY).alias("user_key"),
        F.lit(UNKNOWN_USER_KEY).cast("bigint").alias("user_id"),
        F.lit(UNKNOWN_PLAN).alias("plan_type"),
        F.lit(False).alias("is_known"),
    )


def dim_user(users: DataFrame, previous: DataFrame | None = None, order: list[str] | None = None) -> DataFrame:
    """``dim_user`` without its load time, with the Unknown member for anonymous clicks."""
    known = upsert(previous, user_attributes(users, order), "user_id", "user_key")
    return known.select("user_key", "user_id", "plan_type", "is_known").unionByName(
        unknown_user(users.sparkSession)
    )


def insert_missing(existing: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """Rows of ``candidates`` whose key is not there yet: an insert that can be repeated."""
    return candidates.join(existing.select(key), key, "left_anti").select(*candidates.columns)


def stamped(df: DataFrame, schema) -> DataFrame:
    """Add the load time and put the columns in table order."""
    return conform(df.withColumn("row_loaded_at", F.current_timestamp()), schema)
