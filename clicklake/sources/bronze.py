"""Reads of the Bronze layer: full snapshots and incremental batches of one table side by side."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklake.schemas import SOURCE_TABLES, conform, empty
from clicklake.session import configure
from clicklake.sources.listing import has_files, list_files, partition_values

def bronze_files(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Path and size of every Bronze file of a table, both layouts, sorted by path."""
    return list_files(spark, f"{root}/{table}").select("path", "length").orderBy("path")


def _all_below(spark: SparkSession, schema: T.StructType | str) -> DataFrameReader:
    reader = spark.read.schema(schema)
    return reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")


def _nano_session(spark: SparkSession) -> SparkSession:
    """A session of its own, in which nanosecond times, that Spark has no type for, read as numbers."""
    child = configure(spark.newSession())
    child.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    return child


def _reader(spark: SparkSession, base: str | None) -> DataFrameReader:
    """Reader of a partitioned table below ``base``, or of plain files in any layout."""
    reader = spark.read.option("mergeSchema", "true").option("pathGlobFilter", "*.parquet")
    return reader.option("basePath", base) if base else reader.option("recursiveFileLookup", "true")


#: Column of the values of a row that do not fit their declared columns, as text by column name.
MISFITS = "misfits"


def _scan(spark: SparkSession, base: str | None, folders: list[str], schema: T.StructType, rescue: bool = False) -> DataFrame:
    """Scan of folders whose files have the same physical types, in the declared types of the table.

    Spark reads the footers in a distributed job. A plain read refuses nanosecond columns, so whatever it
    accepts has none; else times that come as whole numbers are nanoseconds. A type that cannot be read, or
    can never become the declared one, ends the read with the folder and column. With ``rescue``, values that
    do not fit come along in ``MISFITS``.
    """
    lost = []

    try:
        rows, nanos = _reader(spark, base).parquet(*folders), False
    except AnalysisException as err:
        if "NANOS" not in str(err):
            raise
        rows, nanos = _reader(_nano_session(spark), base).parquet(*folders), True

    def column(field: T.StructField):
        if field.name not in rows.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        have, value = rows.schema[field.name].dataType, F.col(field.name)
        if have == field.dataType:
            return value
        if isinstance(have, T.BinaryType) and not isinstance(field.dataType, T.BinaryType):
            value = value.cast("string")
        elif isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
            raise TypeError(f"column {field.name} of {folders[0]} is a {have.simpleString()}, not a {field.dataType.simpleString()}")
        elif isinstance(field.dataType, T.TimestampType) and isinstance(have, T.LongType):
            if not nanos:
                raise TypeError(f"column {field.name} of {folders[0]} holds numbers, not times")
            value = F.timestamp_micros(F.expr(f"`{field.name}` div 1000"))
        cast = value.try_cast(field.dataType)
        wrong = value.isNotNull() & cast.isNull()
        if isinstance(field.dataType, T.IntegralType) and isinstance(have, T.FractionalType):
            # A fraction is cut off; the value it had is kept.
            wrong = wrong | (value != cast)
        lost.append(F.when(wrong, F.struct(F.lit(field.name).alias("key"), value.cast("string").alias("value"))))
        return cast.alias(field.name)

    columns = [column(field) for field in schema]
    if not rescue:
        return rows.select(*columns)
    none = F.array().cast("array<struct<key:string,value:string>>")
    found = F.map_from_entries(F.array_compact(F.array(*lost)) if lost else none)
    return rows.select(*columns, found.alias(MISFITS))


def _leaf_folders(spark: SparkSession, root: str) -> list[str]:
    """Folders below ``root`` that hold files: one per load, not per file. Files beside folders go by a pattern."""
    folder = F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("folder")
    found = [r["folder"] for r in list_files(spark, root).select(folder).distinct().orderBy("folder").collect()]
    above = {a for a, b in zip(found, found[1:], strict=False) if b.startswith(f"{a}/")}
    return [f"{x}/*.parquet" if x in above else x for x in found]


def _read_kinds(spark: SparkSession, base: str | None, folders: list[str], schema: T.StructType, rescue: bool = False) -> DataFrame:
    """One scan for each kind of physical types among the folders."""
    kinds: dict[str, list[str]] = {}
    for folder in folders:
        try:
            kind = _reader(spark, base).parquet(folder).schema.json()
        except AnalysisException:
            kind = "nanos " + _reader(_nano_session(spark), base).parquet(folder).schema.json()
        kinds.setdefault(kind, []).append(folder)
    return reduce(DataFrame.unionByName, [_scan(spark, base, paths, schema, rescue) for _, paths in sorted(kinds.items())])


def _disagree(err: Exception) -> bool:
    """Whether a read failed because files hold a column in different types, or some in nanoseconds."""
    return "MERGE" in str(err) or "NANOS" in str(err) or "merge" in str(err)


def read_bronze(spark: SparkSession, root: str, table: str = "clicks", own_files: bool = False) -> DataFrame:
    """All Bronze rows of a table, repeats included, in its declared types.

    The two layouts cannot be read as one partitioned table, so each folder of a load is its own root and no
    partition column appears. Files from other writers may hold a column in another physical type, which
    no single scan accepts; folders are then scanned in one group per combination of types.
    ``own_files=True`` skips the look at the footers for a lake written only by this library, whose files
    all have the declared types.
    """
    schema, folder = SOURCE_TABLES[table], f"{root}/{table}"
    if not has_files(spark, folder):
        raise FileNotFoundError(f"no Bronze files of {table} under {root}")
    if own_files:
        return conform(_all_below(spark, schema).parquet(folder), schema)
    try:
        return _scan(spark, None, [folder], schema)
    except Exception as err:
        if not _disagree(err):
            raise
        return _read_kinds(spark, None, _leaf_folders(spark, folder), schema)


def read_rescued(spark: SparkSession, root: str, table: str = "clicks") -> DataFrame:
    """``read_bronze`` with ``MISFITS``: by column, the text of each value that is no value of its declared type.

    These are texts that are no number or time, numbers out of range and fractions in whole-number columns; the
    column itself has what ``read_bronze`` gives. A row without any has an empty map.
    """
    schema, folder = SOURCE_TABLES[table], f"{root}/{table}"
    if not has_files(spark, folder):
        raise FileNotFoundError(f"no Bronze files of {table} under {root}")
    try:
        return _scan(spark, None, [folder], schema, rescue=True)
    except Exception as err:
        if not _disagree(err):
            raise
        return _read_kinds(spark, None, _leaf_folders(spark, folder), schema, rescue=True)


def read_folders(spark: SparkSession, folders: list[str], table: str = "clicks") -> DataFrame:
    """Rows of some folders (or patterns) of a table only, in its declared types; see ``read_bronze``."""
    schema = SOURCE_TABLES[table]
    try:
        return _scan(spark, None, folders, schema)
    except Exception as err:
        if not _disagree(err):
            raise
        return _read_kinds(spark, None, folders, schema)


def _snapshot(spark: SparkSession, root: str, table: str, days: list[str]) -> DataFrame:
    """Snapshots of some days in the declared types, with their ``ingestion_date``."""
    base = f"{root}/{table}"
    schema = T.StructType([*SOURCE_TABLES[table], T.StructField("ingestion_date", T.DateType())])
    folders = [f"{base}/ingestion_date={day}" for day in days]
    try:
        return _scan(spark, base, folders, schema)
    except Exception as err:
        if not _disagree(err):
            raise
        return _read_kinds(spark, base, folders, schema)


def read_snapshots(spark: SparkSession, root: str, table: str = "clicks") -> DataFrame:
    """Full snapshots only, with their ``ingestion_date``."""
    days = partition_values(spark, f"{root}/{table}", "ingestion_date")
    if not days:
        raise FileNotFoundError(f"no full snapshot of {table} under {root}")
    return _snapshot(spark, root, table, days)


def read_date_range(spark: SparkSession, root: str, table: str, start: str, end: str) -> DataFrame:
    """Snapshots of the days ``start`` to ``end``, both included.

    Only the directories of those days are listed. No snapshot in the range gives an empty frame.
    """
    days = [day for day in partition_values(spark, f"{root}/{table}", "ingestion_date") if start <= day <= end]
    if not days:
        return empty(spark, SOURCE_TABLES[table]).withColumn("ingestion_date", F.lit(None).cast("date"))
    rows = _snapshot(spark, root, table, days)
    return rows.where(F.col("ingestion_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def latest_snapshot_day(spark: SparkSession, root: str, table: str = "clicks") -> str:
    """Date of the newest full snapshot, from directory names alone."""
    days = partition_values(spark, f"{root}/{table}", "ingestion_date")
    if not days:
        raise FileNotFoundError(f"no full snapshot of {table} under {root}")
    return days[-1]


def watermark_from_snapshot(spark: SparkSession, root: str, table: str = "clicks") -> int:
    """Largest id in the newest full snapshot. One column of one directory is read."""
    day = latest_snapshot_day(spark, root, table)
    top = _snapshot(spark, root, table, [day]).agg(F.max("id")).first()[0]
    if top is None:
        raise ValueError(f"the snapshot of {table} of {day} has no rows")
    return int(top)
