"""Scans of click extracts in the three file formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clicklake.schemas import CLICKS

FORMATS = ["csv", "json", "parquet"]


def scan(
    spark: SparkSession, path: str, fmt: str, schema=CLICKS, columns: list[str] | None = None, null_text: str = ""
) -> DataFrame:
    """Full scan, or only ``columns``. Only Parquet skips the bytes of the other columns.

    CSV has no NULL: by default an empty field is one, quoted or not. Give the writer and the
    reader another ``null_text`` to keep empty texts apart.
    """
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.options(header="true", nullValue=null_text, emptyValue="")
    df = reader.format(fmt).load(path)
    return df.select(*columns) if columns else df


def peek(spark: SparkSession, path: str, rows: int = 5) -> DataFrame:
    """The first few rows of one Parquet object."""
    return spark.read.parquet(path).limit(rows)
