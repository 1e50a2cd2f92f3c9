"""Writers for the three file formats, and their size comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.sources.listing import list_files

TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write(df: DataFrame, path: str, fmt: str, null_text: str = "") -> None:
    """Write ``df`` in one format. Text formats carry ISO times; Parquet is snappy-compressed."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        # Blanks around a text belong to it; by default the writer would cut them off.
        writer = writer.options(
            header="true", timestampFormat=TIME_FORMAT, nullValue=null_text, emptyValue='""',
            ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
        )
    elif fmt == "json":
        writer = writer.option("timestampFormat", TIME_FORMAT)
    else:
        writer = writer.option("compression", "snappy")
    writer.save(path)


def size_ratios(spark: SparkSession, datasets: dict[str, dict[str, str]]) -> DataFrame:
    """Size of each format relative to Parquet. ``datasets`` maps dataset -> format -> folder."""
    sizes = None
    for dataset, folders in datasets.items():
        for fmt, folder in folders.items():
            part = list_files(spark, folder, "part-*").agg(F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes"))
            part = part.select(F.lit(dataset).alias("dataset"), F.lit(fmt).alias("format"), "size_bytes")
            sizes = part if sizes is None else sizes.unionByName(part)
    wide = sizes.groupBy("dataset").pivot("format", ["csv", "json", "parquet"]).agg(F.sum("size_bytes"))
    return wide.select(
        "dataset", "csv", "json", "parquet",
        F.round(F.col("csv") / F.col("parquet"), 2).alias("csv_ratio"),
        F.round(F.col("json") / F.col("parquet"), 2).alias("json_ratio"),
    )
