"""Run ledger: what each load did, and where the next one resumes.

The stored form is an append-only table of run events. ``current_runs`` folds it to one row per
run; every report below takes that folded frame (or any frame with its columns).
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklake.operators.dedup import freshest
from clicklake.schemas import ERROR_TEXT_LIMIT

HISTORY_COLUMNS = [
    "run_id", "pipeline_name", "source_table", "load_type", "status", "rows_read", "rows_written",
    "bronze_key", "started_at", "completed_at", "error_message",
]


def _of(runs: DataFrame, pipeline: str | None, table: str | None = None) -> DataFrame:
    if pipeline is not None:
        runs = runs.where(F.col("pipeline_name") == pipeline)
    if table is not None:
        runs = runs.where(F.col("source_table") == table)
    return runs


def current_runs(events: DataFrame) -> DataFrame:
    """State of every run: its last event."""
    return freshest(events, ["run_id"], ["event_seq"]).drop("event_seq")


def error_text(message: Column) -> Column:
    return F.substring(message, 1, ERROR_TEXT_LIMIT)


def last_watermarks(runs: DataFrame, pipeline: str | None = None, skip_null_watermarks: bool = False) -> DataFrame:
    """Resume point per pipeline and table: the end of its latest successful run, or 0.

    A full load ends without a watermark. By default it still counts as the latest run, so the
    next incremental load starts from 0; ``skip_null_watermarks`` looks past such runs.
    """
    done = _of(runs, pipeline).where(F.col("status") == "success")
    if skip_null_watermarks:
        done = done.where(F.col("watermark_end").isNotNull())
    latest = F.max_by(F.struct("watermark_end"), F.struct("started_at", "run_id"))
    return done.groupBy("pipeline_name", "source_table").agg(latest.alias("_last")).select(
        "pipeline_name", "source_table", F.coalesce("_last.watermark_end", F.lit(0)).alias("watermark")
    )


def last_watermark(runs: DataFrame, pipeline: str, table: str, skip_null_watermarks: bool = False) -> int:
    """The resume point of one table, 0 if it never loaded."""
    row = last_watermarks(_of(runs, pipeline, table), skip_null_watermarks=skip_null_watermarks).first()
    return int(row["watermark"]) if row else 0


def stale_runs(
    runs: DataFrame, now: datetime, max_runtime_minutes: int = 60, pipeline: str | None = None
) -> DataFrame:
    """Runs still marked running that started before the cutoff, oldest first."""
    cutoff = now - timedelta(minutes=max_runtime_minutes)
    return (
        _of(runs, pipeline)
        .where((F.col("status") == "running") & (F.col("started_at") < F.lit(cutoff)))
        .select("run_id", "pipeline_name", "source_table", "load_type", "started_at")
        .orderBy("started_at", "run_id")
    )


def success_keys(runs: DataFrame, pipeline: str | None = None) -> DataFrame:
    """Storage keys that successful runs wrote, repeats kept; runs that wrote nothing have none."""
    done = _of(runs, pipeline).where((F.col("status") == "success") & F.col("bronze_key").isNotNull())
    return done.select("bronze_key")


def run_history(
    runs: DataFrame, pipeline: str | None = None, table: str | None = None, limit: int = 20
) -> DataFrame:
    """The latest runs of any status, newest first."""
    columns = [c for c in HISTORY_COLUMNS if c in runs.columns]
    return _of(runs, pipeline, table).select(*columns).orderBy(F.desc("started_at"), "run_id").limit(limit)


def summary(runs: DataFrame, pipeline: str | None = None) -> DataFrame:
    """Per table: successes, failures, rows written and the time of the last success."""
    ok = F.col("status") == "success"
    return (
        _of(runs, pipeline)
        .groupBy("source_table")
        .agg(
            F.count_if(ok).alias("successful_runs"),
            F.count_if(F.col("status") == "failed").alias("failed_runs"),
            F.coalesce(F.sum(F.when(ok, F.col("rows_written"))), F.lit(0)).alias("total_rows_written"),
            F.max(F.when(ok, F.col("started_at"))).alias("last_success_at"),
        )
        .orderBy("source_table")
    )
