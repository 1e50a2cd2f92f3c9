"""Bronze -> Silver as a file stream that processes what is new and stops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from clicklake.operators.silver import clean_clicks
from clicklake.plans.increments import silver_increment
from clicklake.schemas import CLICKS
from clicklake.session import configure


def bronze_stream(spark: SparkSession, folder: str, schema: StructType = CLICKS, pattern: str = "*.parquet") -> DataFrame:
    """New files below ``folder``, both layouts, as they appear."""
    return (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .parquet(folder)
    )


def distinct_clicks(bronze: DataFrame) -> DataFrame:
    """Clean clicks, each id once across all runs of the stream, however late it comes.

    The stream remembers every id it has seen; ``stream_session`` keeps them on disk.
    """
    return clean_clicks(bronze).dropDuplicates(["click_id"])


def stream_session(spark: SparkSession) -> SparkSession:
    """A session of its own for streams, whose state lies in RocksDB and not in executor memory."""
    child = configure(spark.newSession())
    child.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return child


def run_available(clicks: DataFrame, target: str, checkpoint: str) -> None:
    """Append all that is available to ``target``; the checkpoint makes a restart exact."""
    query = (
        clicks.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def merge_available(bronze: DataFrame, lake: str, checkpoint: str) -> dict[str, int]:
    """Land all that is available and merge it into the versioned Silver; returns the merge's counts.

    The stream itself keeps no state: it lands rows as they are, each file once. The merge notes the files it has
    worked in and meets only the bitmaps of the ids that came, so a click that comes again, or years
    late, is taken once, and what is remembered is a bit per click on disk.
    """
    landing = f"{lake}/landing/clicks"
    run_available(bronze, landing, checkpoint)
    return silver_increment(bronze.sparkSession, lake, landing, by_file=True)
