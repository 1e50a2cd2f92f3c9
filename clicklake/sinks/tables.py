"""Writes of lake tables. Every write leaves the old data in place until the new data is complete."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clicklake.schemas import STAR_TABLES, WATERMARK_DIGITS, empty
from clicklake.session import configure
from clicklake.sources.listing import exists


def _replace_partition(df: DataFrame, root: str, partition: dict[str, str]) -> int:
    """Replace one partition directory of ``root`` and return the number of rows written.

    Spark stages a dynamic overwrite beside the table and swaps the partition in when the job
    commits. The count is observed in the writing stage itself, where Spark takes each task's
    figure once even if the task ran twice.
    """
    configure(df.sparkSession)
    seen = Observation()
    counted = df.sortWithinPartitions("id") if "id" in df.columns else df
    counted = counted.observe(seen, F.count(F.lit(1)).alias("rows"))
    for name, value in partition.items():
        counted = counted.withColumn(name, F.lit(value))
    (
        counted.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partition)
        .parquet(root)
    )
    rows = int(seen.get["rows"])
    if rows == 0:
        # A dynamic overwrite without rows touches nothing, but an empty table is a result too.
        where = "/".join(f"{name}={value}" for name, value in partition.items())
        df.limit(0).write.mode("overwrite").parquet(f"{root}/{where}")
    return rows


def write_snapshot(df: DataFrame, lake: str, table: str, day: str) -> tuple[str, int]:
    """Full snapshot of one day; a second run on the day replaces the first. Returns key and rows."""
    rows = _replace_partition(df, f"{lake}/bronze/{table}", {"ingestion_date": day})
    return f"bronze/{table}/ingestion_date={day}", rows


def write_batch(df: DataFrame, lake: str, table: str, start: int, end: int) -> tuple[str, int]:
    """Incremental batch of one id range. The same range replaces itself, another range never does."""
    first, last = (str(n).zfill(WATERMARK_DIGITS) for n in (start, end))
    partition = {"watermark_start": first, "watermark_end": last}
    rows = _replace_partition(df, f"{lake}/bronze/{table}/incremental", partition)
    return f"bronze/{table}/incremental/watermark_start={first}/watermark_end={last}", rows


def _previous(path: str) -> str:
    parent, name = path.rstrip("/").rsplit("/", 1)
    return f"{parent}/_previous/{name}"


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def _move(files, source, target) -> None:
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"could not move {source} to {target}")


def recover(spark: SparkSession, path: str) -> None:
    """Finish what a swap that died has left: the old table goes back where no new one is in its place."""
    files, target = _files(spark, path)
    _, aside = _files(spark, _previous(path))
    if not files.exists(aside):
        return
    if files.exists(target):
        files.delete(aside, True)
    else:
        _move(files, aside, target)


def _swap(spark: SparkSession, staged: str, path: str) -> bool:
    """Put the staged directory in the place of ``path``; False if nothing was staged.

    The old table is moved aside, the new one in, then the old one deleted. At every moment one of them is
    whole under a name that ``recover`` knows.
    """
    files, source = _files(spark, staged)
    if not files.exists(source):
        return False
    recover(spark, path)
    _, target = _files(spark, path)
    _, aside = _files(spark, _previous(path))
    if files.exists(target):
        _move(files, target, aside)
    _move(files, source, target)
    files.delete(aside, True)
    return True


def _staging(path: str) -> str:
    parent, name = path.rstrip("/").rsplit("/", 1)
    return f"{parent}/_staging/{name}-{uuid.uuid4().hex}"


def publish(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``: write it aside in full, then rename.

    A plain overwrite deletes first and leaves nothing behind if the job fails. On object stores a
    rename is a copy, so the swap is short there but not atomic.
    """
    spark, staged = configure(df.sparkSession), _staging(path)
    df.write.option("compression", "snappy").parquet(staged)
    _swap(spark, staged, path)


def publish_split(df: DataFrame, by: str, paths: dict[str, str], partition_by: list[str] | None = None) -> None:
    """Replace several tables in one pass: rows whose ``by`` is a key of ``paths`` go to its path."""
    spark, staged = configure(df.sparkSession), _staging(next(iter(paths.values())))
    df.write.option("compression", "snappy").partitionBy(by, *(partition_by or [])).parquet(staged)
    for value, path in paths.items():
        if not _swap(spark, f"{staged}/{by}={value}", path):
            publish(df.drop(by).limit(0), path)


def append(df: DataFrame, path: str) -> None:
    configure(df.sparkSession)
    df.write.mode("append").option("compression", "snappy").parquet(path)


def create_star_tables(spark: SparkSession, gold: str) -> None:
    """Create every star table that is not there yet, empty and typed."""
    for name, schema in STAR_TABLES.items():
        if not exists(spark, f"{gold}/{name}"):
            append(empty(spark, schema), f"{gold}/{name}")


def delete_rows(df: DataFrame, column: str, floor: int) -> DataFrame:
    """What is left after deleting all rows with ``column >= floor``; NULLs stay, as in SQL."""
    return df.where(F.col(column).isNull() | (F.col(column) < floor))


def repartitioned(df: DataFrame, partitions: int) -> DataFrame:
    """The same rows in another number of partitions."""
    return df.repartition(partitions)
