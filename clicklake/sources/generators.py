"""Synthetic sources and star tables, for load tests.

Rows are numbered by a column ``g`` (``spark.range`` gives one). Every value is a function of that
number and a seed, so results do not depend on partitioning and a retried task repeats itself.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.functions.columns import scatter, weighted_choice, zero_padded
from clicklake.operators.keys import number_rows
from clicklake.operators.lookup import lookup
from clicklake.schemas import DEVICE_TYPES, UNKNOWN_USER_KEY

# Floors that keep synthetic ids apart from real ones, shares and name lists.
SYNTHETIC_KEY_FLOOR = 900_000
SYNTHETIC_CLICK_FLOOR = 900_000_000
DOMAINS = ["example.com", "github.com", "news.example", "shop.example", "blog.example"]
DEVICE_WEIGHTS = [("mobile", 60), ("desktop", 35), ("tablet", 5)]
PLAN_WEIGHTS = [("FREE", 85), ("PREMIUM", 15)]
WEIGHTED_CODES = 500
WEIGHTED_USERS = 200
SEED = 42
LATER_SEED = 43


def numbers(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).withColumnRenamed("id", "g")


def _one_of(values: list, draw: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (draw % len(values) + 1).cast("int"))


def _member(rows: DataFrame, pool: DataFrame, draw: Column, column: str, out: str) -> DataFrame:
    """Give each row ``column`` of one member of ``pool`` (unique on ``id``) by its evenly spread draw."""
    size = pool.agg(F.count(F.lit(1))).scalar()
    members = number_rows(pool.select("id", F.col(column).alias(out)), "id", "_pick")
    rows = rows.withColumn("_pick", draw % size + 1)
    return lookup(rows, members, "_pick", out, "g", sized_by=pool.select(*dict.fromkeys(["id", column]))).drop("_pick")


def source_clicks(
    rows: DataFrame, urls: DataFrame, users: DataFrame, now: datetime,
    id_floor: int = SYNTHETIC_CLICK_FLOOR, seed: int = SEED, hot_key: bool = False,
) -> DataFrame:
    """Clicks on existing urls by existing users; every fifth click is anonymous.

    ``hot_key`` puts all clicks on one url and one user, to test for skew.
    """
    g = F.col("g")
    draw = (lambda s: F.lit(0).cast("bigint")) if hot_key else (lambda s: scatter(g, s))
    picked = _member(rows, urls, draw(seed), "short_code", "short_code")
    picked = _member(picked, users, draw(seed + 1), "id", "_user")
    return picked.select(
        (F.lit(id_floor) + g).alias("id"),
        "short_code",
        F.lit(now).cast("timestamp").alias("occurred_at"),
        _one_of(DEVICE_TYPES, g).alias("device_type"),
        F.md5(F.concat(F.lit("synthetic-ip-"), g.cast("string"))).alias("hashed_ip"),
        F.when(g % 5 != 0, F.col("_user")).alias("user_id"),
    )


def weighted_clicks(rows: DataFrame, start: str = "2026-01-01", seed: int = SEED) -> DataFrame:
    """Clicks one second apart over a cycle of codes, with weighted devices; 30 % have a user."""
    g = F.col("g")
    return rows.select(
        (g + 1).alias("id"),
        F.concat(F.lit("abc"), zero_padded(g % WEIGHTED_CODES, 3)).alias("short_code"),
        F.timestamp_seconds(F.unix_seconds(F.lit(start).cast("timestamp")) + g).alias("occurred_at"),
        weighted_choice(scatter(g, seed), DEVICE_WEIGHTS).alias("device_type"),
        F.lpad(F.lower(F.hex(g)), 64, "0").alias("hashed_ip"),
        F.when(scatter(g, seed + 1) % 100 < 30, scatter(g, seed + 2) % WEIGHTED_USERS + 1).alias("user_id"),
    )


def _days(dates: DataFrame) -> DataFrame:
    return dates.select(F.col("date_key").cast("bigint").alias("id"), "date_key")


def star_urls(rows: DataFrame, dates: DataFrame, seed: int = SEED) -> DataFrame:
    """Synthetic ``dim_url``: 90 % active, one of five domains. ``dates`` has the date keys to use."""
    g = F.col("g")
    dated = _member(rows, _days(dates), scatter(g, seed + 2), "date_key", "created_date_key")
    return dated.select(
        (F.lit(SYNTHETIC_KEY_FLOOR) + g).alias("url_key"),
        (F.lit(SYNTHETIC_KEY_FLOOR) + g).alias("url_id"),
        F.concat(F.lit("bench"), zero_padded(g, 6)).alias("short_code"),
        _one_of(DOMAINS, scatter(g, seed)).alias("original_url_domain"),
        (scatter(g, seed + 1) % 10 != 0).alias("is_active"),
        "created_date_key",
    )


def star_users(rows: DataFrame, seed: int = SEED) -> DataFrame:
    g = F.col("g")
    return rows.select(
        (F.lit(SYNTHETIC_KEY_FLOOR) + g).alias("user_key"),
        (F.lit(SYNTHETIC_KEY_FLOOR) + g).alias("user_id"),
        _one_of(["FREE", "PREMIUM"], scatter(g, seed + 3)).alias("plan_type"),
        F.lit(True).alias("is_known"),
    )


def star_clicks(
    rows: DataFrame, n_urls: int | Column, n_users: int | Column, dates: DataFrame, now: datetime, seed: int = SEED
) -> DataFrame:
    """Synthetic ``fact_clicks``: 20 % anonymous, keys drawn evenly."""
    g = F.col("g")
    url = scatter(g, seed + 4) % n_urls
    user = F.lit(SYNTHETIC_KEY_FLOOR) + scatter(g, seed + 6) % n_users
    dated = _member(rows, _days(dates), scatter(g, seed + 8), "date_key", "date_key")
    return dated.select(
        (F.lit(SYNTHETIC_CLICK_FLOOR) + g).alias("click_id"),
        "date_key",
        (F.lit(SYNTHETIC_KEY_FLOOR) + url).alias("url_key"),
        F.when(scatter(g, seed + 5) % 5 == 0, F.lit(UNKNOWN_USER_KEY)).otherwise(user).alias("user_key"),
        (scatter(g, seed + 7) % len(DEVICE_TYPES) + 1).cast("int").alias("device_key"),
        F.concat(F.lit("bench"), zero_padded(url, 6)).alias("short_code"),
        F.lit(now).cast("timestamp").alias("occurred_at"),
        F.lit(1).cast("smallint").alias("click_count"),
    )


def _code(g: Column, seed: int) -> Column:
    """Six letters, different for every number below 26^6; later numbers get a round counter."""
    codes = 26**6
    # The factor shares no divisor with 26, so the mapping is one to one.
    shuffled = ((g % codes) * 48271 + seed * 7919) % codes
    letters = [F.chr(97 + F.call_function("div", shuffled, F.lit(26**place)) % 26) for place in range(6)]
    rounds = F.call_function("div", g, F.lit(codes))
    return F.concat(*letters, F.when(rounds > 0, rounds.cast("string")).otherwise(""))


def seed_urls(rows: DataFrame, now: datetime, seed: int = SEED) -> DataFrame:
    """Seed urls: a distinct code and a target per url."""
    g = F.col("g")
    return rows.select(
        (g + 1).alias("id"),
        _code(g, seed).alias("short_code"),
        F.concat(F.lit("https://"), _one_of(DOMAINS, scatter(g, seed + 2)), F.lit("/"), g.cast("string")).alias("original_url"),
        F.lit(now).cast("timestamp").alias("created_at"),
        F.lit(True).alias("is_active"),
    )


def seed_users(rows: DataFrame, now: datetime, seed: int = SEED) -> DataFrame:
    g = F.col("g")
    return rows.select(
        (g + 1).alias("id"),
        F.concat(F.lit("user"), g.cast("string"), F.lit("@example.com")).alias("email"),
        weighted_choice(scatter(g, seed), PLAN_WEIGHTS).alias("plan_type"),
        F.lit(now).cast("timestamp").alias("created_at"),
    )


def seed_clicks(
    rows: DataFrame, urls: DataFrame, users: DataFrame, now: datetime, minutes_back: int,
    first_id: int | Column = 1, seed: int = SEED,
) -> DataFrame:
    """Seed clicks on existing urls within the last ``minutes_back`` minutes; 30 % have a user.

    A later batch continues after the largest id so far: pass it as ``first_id`` with another seed.
    """
    g = F.col("g")
    picked = _member(rows, urls, scatter(g, seed), "short_code", "short_code")
    picked = _member(picked, users, scatter(g, seed + 1), "id", "_user")
    age = scatter(g, seed + 2) % (minutes_back + 1)
    return picked.select(
        (g + first_id).alias("id"),
        "short_code",
        F.timestamp_seconds(F.unix_seconds(F.lit(now).cast("timestamp")) - age * 60).alias("occurred_at"),
        weighted_choice(scatter(g, seed + 3), DEVICE_WEIGHTS).alias("device_type"),
        F.sha2(F.concat(F.lit(f"{seed}-"), g.cast("string")), 256).alias("hashed_ip"),
        F.when(scatter(g, seed + 4) % 100 < 30, F.col("_user")).alias("user_id"),
    )
