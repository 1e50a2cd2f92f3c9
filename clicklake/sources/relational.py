"""Reads of the source tables: JDBC in production, Parquet extracts for tests and backfills."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.schemas import SOURCE_TABLES, fitted

# A source gives a lazy DataFrame for a table name.
Source = Callable[[str], DataFrame]


class ExtractionError(Exception):
    """A source table could not be read."""


def jdbc_options(
    url: str, table: str, lower: int, upper: int, partitions: int, fetch_rows: int = 10_000, **extra: str
) -> dict[str, str]:
    """Options of a partitioned JDBC read on ``id``.

    The bounds only decide how ids spread over the tasks; rows outside them are still read.
    """
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": "id",
        "lowerBound": str(lower),
        "upperBound": str(max(upper, lower + 1)),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_rows),
        "pushDownPredicate": "true",
        **extra,
    }


def jdbc_source(spark: SparkSession, url: str, partitions: int = 64, **extra: str) -> Source:
    """Source over a database. Id bounds come from one min/max query that the database answers."""

    def read(table: str) -> DataFrame:
        try:
            bounds = (
                spark.read.format("jdbc")
                .options(url=url, query=f"SELECT min(id) AS lo, max(id) AS hi FROM {table}", **extra)
                .load()
                .first()
            )
            options = jdbc_options(url, table, int(bounds["lo"] or 0), int(bounds["hi"] or 0), partitions, **extra)
            return spark.read.format("jdbc").options(**options).load()
        except Exception as err:
            raise ExtractionError(f"cannot read table {table}") from err

    return read


def parquet_source(spark: SparkSession, folder: str) -> Source:
    """Source over ``<folder>/<table>`` Parquet directories."""

    def read(table: str) -> DataFrame:
        try:
            return spark.read.parquet(f"{folder}/{table}")
        except Exception as err:
            raise ExtractionError(f"cannot read table {table}") from err

    return read


def full_scan(source: Source, table: str) -> DataFrame:
    """All rows and columns of a table, the declared ones in their types; values that do not fit end the load."""
    df = source(table)
    return fitted(df, SOURCE_TABLES[table]) if table in SOURCE_TABLES else df


def incremental_scan(rows: DataFrame, watermark: int, upper: int | None = None) -> DataFrame:
    """Rows above the watermark, up to ``upper`` if given.

    The bounds are pushed to the scan. A pinned upper bound makes parallel reads agree on the
    batch while the table still grows. The scan orders nothing; the write of a batch sorts by id within
    partitions, which keeps file statistics tight without a global sort.
    """
    batch = rows.where(F.col("id") > watermark)
    if upper is not None:
        batch = batch.where(F.col("id") <= upper)
    return batch


def upper_bound(rows: DataFrame, watermark: int) -> int | None:
    """Largest id above the watermark, or None when there is nothing new."""
    top = rows.where(F.col("id") > watermark).agg(F.max("id").alias("top")).first()["top"]
    return None if top is None else int(top)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count and largest id (0 for an empty table) of every table."""
    report = None
    for name, df in sorted(tables.items()):
        row = df.agg(
            F.lit(name).alias("table"), F.count(F.lit(1)).alias("row_count"),
            F.coalesce(F.max("id"), F.lit(0)).cast("bigint").alias("max_id"),
        )
        report = row if report is None else report.unionByName(row)
    return report
