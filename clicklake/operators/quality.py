"""Quality rules the contracts state in words, as aggregates over the data."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklake.schemas import DEVICE_TYPES, HASHED_IP_PATTERN, PLAN_TYPES
from clicklake.session import stored


def _rules(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking each rule, for all rules of a table in one aggregate."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(bad).alias(name) for name, bad in rules.items()])
    entries = F.array(
        *[
            F.struct(
                F.lit(table).alias("table"), F.lit(name).alias("rule"),
                F.col("_rows").alias("rows_checked"), F.col(name).alias("violations"),
            )
            for name in rules
        ]
    )
    return counts.select(F.inline(entries))


def click_rules(clicks: DataFrame) -> DataFrame:
    return _rules(
        clicks,
        "clicks",
        {
            "device_type_known": F.col("device_type").isNull() | ~F.col("device_type").isin(DEVICE_TYPES),
            "hashed_ip_is_digest": F.col("hashed_ip").isNotNull() & ~F.col("hashed_ip").rlike(HASHED_IP_PATTERN),
        },
    )


def user_rules(users: DataFrame) -> DataFrame:
    return _rules(
        users, "users", {"plan_type_known": F.col("plan_type").isNull() | ~F.col("plan_type").isin(PLAN_TYPES)}
    )


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values that should be unique but occur more than once; NULLs are left out."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("occurrences"))
    return counts.where(F.col("occurrences") > 1)


def key_report(df: DataFrame, table: str, keys: list[str], lengths: dict[str, int]) -> DataFrame:
    """Uniqueness of each key and length limit of each text column of one table."""
    checks = [
        repeated_values(df, key).agg(
            F.lit(table).alias("table"), F.lit(key).alias("column"), F.lit("unique").alias("check"),
            F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0)).alias("violations"),
        )
        for key in keys
    ]
    if lengths:
        counts = df.agg(*[F.count_if(F.length(c) > limit).alias(c) for c, limit in lengths.items()])
        entries = F.array(
            *[
                F.struct(
                    F.lit(table).alias("table"), F.lit(c).alias("column"),
                    F.lit("length").alias("check"), F.col(c).alias("violations"),
                )
                for c in lengths
            ]
        )
        checks.append(counts.select(F.inline(entries)))
    report = checks[0]
    for check in checks[1:]:
        report = report.unionByName(check)
    return report


def _written(columns: list[str]) -> Column:
    """Values of a row as one text. Each is written with its length, so no two different rows make the same."""
    parts = []
    for c in columns:
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat_ws("|", *parts)


def changed_rows(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows of an insert-only table that changed or vanished between two snapshots.

    Rows are compared by a digest, so only the key and 64 characters per row are shuffled.
    """
    columns = [c for c in before.columns if c != key]

    def digest(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col(key).isNotNull()).select(key, F.sha2(_written(columns), 256).alias(name))

    compared = digest(before, "_before").join(digest(after, "_after"), key, "left")
    change = F.when(F.col("_after").isNull(), "vanished").when(F.col("_before") != F.col("_after"), "changed")
    return compared.select(key, change.alias("change")).where(F.col("change").isNotNull())


def range_digests(df: DataFrame, key: str, columns: list[str], width: int) -> DataFrame:
    """``low, n, mark, total`` per range of ``width`` keys: a count, and two digests that no order of rows changes.

    One row per range and task is shuffled. Rows that differ in any value differ in 128 bits.
    """
    text = _written([key, *columns])
    rows = df.where(F.col(key).isNotNull()).select(
        (F.floor(F.col(key) / width) * width).cast("long").alias("low"), F.xxhash64(text).alias("h"), F.xxhash64(text, F.lit(1)).cast("decimal(20,0)").alias("g")
    )
    return rows.groupBy("low").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("mark"), F.sum("g").alias("total"))


def changed_ranges(before: DataFrame, after: DataFrame, key: str, width: int = 65_536) -> DataFrame:
    """``low`` of the ranges of whole-number keys in which the snapshots differ; ranges that only ``after`` has do not count."""
    columns = [c for c in before.columns if c != key]
    old, new = (range_digests(df, key, columns, width) for df in (before, after))
    both = old.join(new.select("low", *[F.col(c).alias(f"_{c}") for c in ("n", "mark", "total")]), "low", "left")
    same = F.lit(True)
    for c in ("n", "mark", "total"):
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return both.where(~same).select("low")


def changed_rows_by_range(before: DataFrame, after: DataFrame, key: str, width: int = 65_536) -> DataFrame:
    """``changed_rows`` by digests of key ranges first: rows are only shuffled where a range differs.

    Two snapshots that agree cost one pass over each and a row per range. Ranges in which only rows were added are
    compared row by row, too.
    """
    ranges = stored(changed_ranges(before, after, key, width), "changed-ranges")
    low = (F.floor(F.col(key) / width) * width).cast("long")

    def within(df: DataFrame) -> DataFrame:
        return df.withColumn("_low", low).join(ranges.withColumnRenamed("low", "_low"), "_low", "left_semi").select(*df.columns)

    return changed_rows(within(before), within(after), key)


def ids_above(batch: DataFrame, watermark: int) -> DataFrame:
    """Id range of a batch, and its rows that are not above the watermark they should follow."""
    return batch.agg(
        F.min("id").alias("min_id"),
        F.max("id").alias("max_id"),
        F.count_if(F.col("id").isNull() | (F.col("id") <= watermark)).alias("violations"),
    )


def freshness(last_success: DataFrame, sla_minutes: dict[str, int], now: datetime) -> DataFrame:
    """Age of each table's last success against its limit. A table that never loaded is late.

    ``last_success`` has ``source_table`` and ``last_success_at`` (the ledger summary).
    """
    spark = last_success.sparkSession
    limits = spark.createDataFrame(sorted(sla_minutes.items()), "source_table string, sla_minutes int")
    age = (F.lit(now).cast("timestamp").cast("bigint") - F.col("last_success_at").cast("timestamp").cast("bigint"))
    return limits.join(last_success.select("source_table", "last_success_at"), "source_table", "left").select(
        "source_table",
        "last_success_at",
        F.floor(age / 60).cast("bigint").alias("age_minutes"),
        "sla_minutes",
        F.coalesce(age > F.col("sla_minutes") * 60, F.lit(True)).alias("is_late"),
    )
