"""File listings as DataFrames."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.session import scratch_path, stored

_LISTING = "path string, modificationTime timestamp, length bigint"
_PACKING = "spark.sql.files.maxPartitionBytes"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def has_files(spark: SparkSession, folder: str, suffix: str = ".parquet") -> bool:
    """Whether there is any such file below ``folder``. Stops at the first."""
    files, target = _file_system(spark, folder)
    if not files.exists(target):
        return False
    found = files.listFiles(target, True)
    while found.hasNext():
        if found.next().getPath().getName().endswith(suffix):
            return True
    return False


def partition_values(spark: SparkSession, folder: str, column: str) -> list[str]:
    """Values of the ``column=value`` directories right below ``folder``, sorted. One directory listing."""
    files, target = _file_system(spark, f"{folder}/{column}=*")
    found = files.globStatus(target) or []
    return sorted(entry.getPath().getName().split("=", 1)[1] for entry in found)


def list_files(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """Every file below ``folder`` with its size; empty when the folder does not exist.

    Spark lists directories in parallel; the file content column is never selected, so no file is
    opened. The listing is written to the shared folder, which freezes it for all that compare
    against it. Scan tasks are packed by file size, which means nothing to a listing, so while it
    is written the limit is lifted: it takes one task per core, not one per file.
    """
    if not exists(spark, folder):
        return spark.createDataFrame([], _LISTING)
    # A session of its own carries the setting, so that nothing that runs beside it is packed alike.
    child = spark.newSession()
    child.conf.set(_PACKING, str(2**60))
    files = (
        child.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", "modificationTime", "length")
    )
    frozen = scratch_path(spark, "listing")
    files.write.parquet(frozen)
    return spark.read.schema(_LISTING).parquet(frozen)


def walk_files(spark: SparkSession, folder: str, pattern: str = "*.parquet", folders_per_task: int = 100) -> DataFrame:
    """The rows of ``list_files``, found level by level in tasks: no file is ever known to the driver.

    Each level's folders are listed by tasks of ``folders_per_task``, and what they hold is written to the shared
    folder; the folders among it are the next level. The driver learns how many there are. Names that begin with a
    dot, or with an underscore and have no ``=``, are passed over, and so are empty files, as Spark does. A folder
    that goes meanwhile is empty. One folder's own entries are held by one task.

    Folders are listed by Arrow's file systems, which have their own names and credentials for object stores;
    where Arrow does not reach, ``list_files`` does. ``pattern`` knows ``*``, ``?`` and ``[...]``.
    """
    files, target = _file_system(spark, folder)
    root = files.makeQualified(target).toString()
    matches = re.compile(fnmatch.translate(pattern)).match

    def entries(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        if root.startswith("file:"):
            system, top = fs.LocalFileSystem(), re.sub("^file:/+", "/", root)
        else:
            system, top = fs.FileSystem.from_uri(root)
        for batch in batches:
            for below in batch.column(0).to_pylist():
                found = system.get_file_info(fs.FileSelector(top + below, allow_not_found=True))
                names = [e.base_name for e in found]
                inside = [e.type == fs.FileType.Directory for e in found]
                shown = [not n.startswith(".") and (not n.startswith("_") or "=" in n) for n in names]
                use = [k for k, e in enumerate(found) if shown[k] and (inside[k] or (e.size and matches(names[k])))]
                times = [found[k].mtime_ns for k in use]
                # Hadoop knows times to the millisecond.
                times = [None if t is None else t // 1_000_000 * 1000 for t in times]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f"{below}/{names[k]}" for k in use], pa.string()),
                        pa.array([inside[k] for k in use], pa.bool_()),
                        pa.array(times, pa.timestamp("us", tz="UTC")),
                        pa.array([found[k].size or 0 for k in use], pa.int64()),
                    ],
                    names=["below", "inside", "modificationTime", "length"],
                )

    level, count, levels = spark.createDataFrame([("",)], "below string"), 1, []
    while count:
        # A fixed number of tasks: the few bytes of a name say nothing about the work behind it.
        dealt = level.repartition(-(-count // folders_per_task), "below")
        found = dealt.mapInArrow(entries, "below string, inside boolean, modificationTime timestamp, length bigint")
        levels.append(stored(found, "listing"))
        level = levels[-1].where("inside").select("below")
        count = level.count()
    rows = levels[0]
    for deeper in levels[1:]:
        rows = rows.unionByName(deeper)
    return rows.where("NOT inside").select(F.concat(F.lit(root), "below").alias("path"), "modificationTime", "length")


def in_lake(path: Column, lake: str | None, marker: str = "bronze") -> Column:
    """Path below the lake. Without the lake's own path, from the first ``marker`` directory on."""
    if lake is None:
        return F.regexp_extract(path, f"(?:^|/)({marker}/.*)$", 1)
    # The listing spells paths with their scheme; the lake may come without.
    root = re.sub(r"^[a-z0-9]+:/*", "/", lake.rstrip("/"))
    return F.expr(f"substr({{p}}, instr({{p}}, {_quoted(root + '/')}) + {len(root) + 1})".format(p="path"))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def stored_keys(files: DataFrame, marker: str = "bronze", lake: str | None = None) -> DataFrame:
    """Distinct partition directories that hold files: ``bronze/clicks/ingestion_date=...``."""
    key = F.regexp_extract(in_lake(F.col("path"), lake, marker), "^(.*)/[^/]+$", 1)
    return files.select(key.alias("bronze_key")).distinct()


def bronze_objects(files: DataFrame, marker: str = "bronze", lake: str | None = None) -> DataFrame:
    """Listing with paths relative to the lake, the form the storage reports take."""
    return files.select(in_lake(F.col("path"), lake, marker).alias("path"), "length")
