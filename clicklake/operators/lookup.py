"""Key lookups against a dimension, safe against hot and missing keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.session import stored

def plan_bytes(df: DataFrame) -> int:
    """Size of ``df`` as Catalyst estimates it; the figure its own broadcast choice uses."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def hot_keys(df: DataFrame, keys: list[str], share: float | None = None) -> DataFrame:
    """``key_column, key_value`` (as text) of keys that hold more than ``share`` of all rows, from one pass.

    By default that is what one shuffle partition should hold, so there are fewer hot keys per column than
    shuffle partitions, and no other key fills more than one.
    """
    if share is None:
        share = 1 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = [F.struct(F.lit(k).alias("key_column"), F.col(k).cast("string").alias("key_value")) for k in keys]
    total = F.struct(F.lit("").alias("key_column"), F.lit("").alias("key_value"))
    counts = df.select(F.inline(F.array(total, *pairs))).where("key_value IS NOT NULL")
    # One row per key and task before the shuffle. The total travels as a key of its own.
    counts = stored(counts.groupBy("key_column", "key_value").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR key_column = ''"), "hot-keys")
    rows = counts.where("key_column = ''").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return counts.where((F.col("key_column") != "") & (F.col("n") > rows * share)).select("key_column", "key_value")


def lookup(
    rows: DataFrame,
    members: DataFrame,
    key: str,
    value: str,
    row_id: str,
    broadcast_bytes: int | None = None,
    sized_by: DataFrame | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Left join ``rows`` with ``members`` (unique on ``key``), adding ``value``.

    Members within the broadcast limit are sent to every task. ``sized_by`` is the table they come
    from, one member per row, for members whose own estimate a join has inflated. Beyond the limit
    the rows are shuffled on ``key``, and two kinds of rows would gather in one task:

    * rows of a hot key. Those few members (bounded by ``hot_keys``) are broadcast first, which
      resolves the rows before the shuffle. ``hot`` hands them in, counted once for several lookups;
    * rows without a key, or already resolved. A second shuffle key spreads them: for open rows and
      for members it follows from the key, so they still meet; for the others from the row id.
    """
    members = members.select(key, value)
    limit = broadcast_limit(rows.sparkSession) if broadcast_bytes is None else broadcast_bytes
    if plan_bytes(members if sized_by is None else sized_by) <= limit:
        return rows.join(F.broadcast(members), key, "left")

    columns = rows.columns
    hot = hot_keys(rows, [key]) if hot is None else hot
    own = hot.where(F.col("key_column") == key).select(F.col("key_value").alias("_text"))
    hot_members = members.join(F.broadcast(own), F.col(key).cast("string") == F.col("_text"), "left_semi")
    hot_members = hot_members.withColumnRenamed(value, "_hot")
    cold_members = members.select(
        F.col(key).alias("_key"), F.xxhash64(F.col(key)).alias("_key_slot"), F.col(value).alias("_cold")
    )
    left = rows.join(F.broadcast(hot_members), key, "left")
    pending = F.col(key).isNotNull() & F.col("_hot").isNull()
    left = left.withColumn("_probe", F.when(pending, F.col(key))).withColumn(
        "_slot", F.when(pending, F.xxhash64(F.col(key))).otherwise(F.xxhash64(F.col(row_id)))
    )
    same = (F.col("_probe") == F.col("_key")) & (F.col("_slot") == F.col("_key_slot"))
    joined = left.join(cold_members, same, "left")
    return joined.select(*[F.col(c) for c in columns], F.coalesce("_hot", "_cold").alias(value))
