"""Row counts and bounds of stored tables from Parquet footers, without reading a value.

Spark answers count, min and max from footer statistics when the files are read through its newer source API with
aggregate pushdown on, which are settings of a session. They are made in a child session, so nothing else is
read that way. Spark looks a column's statistics up by its place in the schema, not by its name, so this is only
done for files of this library, which all have the declared columns first and in the declared order. Other files are scanned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.schemas import SOURCE_TABLES
from clicklake.session import configure
from clicklake.sources.bronze import latest_snapshot_day, read_folders

_SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def _session(spark: SparkSession) -> SparkSession:
    child = configure(spark.newSession())
    for name, value in _SETTINGS.items():
        child.conf.set(name, value)
    return child


def footer_bounds(spark: SparkSession, folders: Sequence[str], table: str, column: str = "id") -> DataFrame:
    """``row_count, min_value, max_value`` of a column as a plan over the footers of loads this library wrote.

    One file of each folder, all of which one job wrote, is asked for its columns; others than declared are an error.
    """
    child, declared = _session(spark), SOURCE_TABLES[table]
    shape = [(f.name, f.dataType) for f in declared]
    for folder in folders:
        found = child.read.option("pathGlobFilter", "*.parquet").parquet(folder).schema
        if [(f.name, f.dataType) for f in found][: len(shape)] != shape:
            raise TypeError(f"{folder} does not have the declared columns of {table} in their order")
    rows = child.read.schema(declared).option("pathGlobFilter", "*.parquet").parquet(*folders)
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def bounds(
    spark: SparkSession, folders: Sequence[str], table: str, column: str = "id", own_files: bool = False
) -> tuple[int, int | None, int | None]:
    """Rows of some load folders, and least and largest ``column``: from footers with ``own_files``, else by a scan.

    Where a file has no bounds, as a column of NULLs has none, the column is scanned.
    """
    if own_files:
        try:
            return tuple(footer_bounds(spark, folders, table, column).first())
        except Exception as err:
            # A file whose column is all NULL has no bounds in its footer, and Spark does not take that for an answer.
            if "No min/max found" not in str(err):
                raise
    rows = read_folders(spark, [f"{x}/*.parquet" for x in folders], table)
    return tuple(rows.agg(F.count(F.lit(1)), F.min(column), F.max(column)).first())


def watermark_from_footers(spark: SparkSession, root: str, table: str = "clicks") -> int:
    """``watermark_from_snapshot`` of a lake of this library, by footers: the largest id of the newest full snapshot."""
    day = latest_snapshot_day(spark, root, table)
    top = bounds(spark, [f"{root}/{table}/ingestion_date={day}"], table, own_files=True)[2]
    if top is None:
        raise ValueError(f"the snapshot of {table} of {day} has no rows")
    return int(top)
