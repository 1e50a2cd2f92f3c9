"""Session settings the library relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Settings the layers rely on. Call it before reading or writing lake tables.

    Business time is UTC everywhere, so dates derived from it must not follow the host. Times are
    stored as microseconds: the older INT96 form has no statistics to skip row groups by.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return spark


# Folders of local sessions without the setting, which is left as it is.
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors reach, from ``spark.checkpoint.dir``.

    Only a local session may run without the setting; it then gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _LOCAL.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="clicklake-"))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe when executors go."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
