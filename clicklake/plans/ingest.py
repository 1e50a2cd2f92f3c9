"""Bronze loads: full snapshots and id-watermark batches, each with its entries in the run ledger."""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from clicklake.operators.dedup import freshest
from clicklake.operators.ledger import current_runs, last_watermark
from clicklake.schemas import ERROR_TEXT_LIMIT, RUN_EVENTS, empty
from clicklake.sinks.tables import append, write_batch, write_snapshot
from clicklake.sources.bronze import watermark_from_snapshot
from clicklake.sources.listing import exists, list_files
from clicklake.sources.relational import Source, full_scan, incremental_scan, upper_bound

logger = logging.getLogger(__name__)

# The tables of the pipeline and how each is loaded.
DEFAULT_PIPELINE = {
    "pipeline_name": "bronze_ingestion",
    "tables": [
        {"name": "urls", "load_type": "full"},
        {"name": "users", "load_type": "full"},
        {"name": "clicks", "load_type": "incremental"},
    ],
}


def load_pipeline(path: str) -> dict:
    """Pipeline description from a JSON file, or YAML where a parser is installed."""
    text = Path(path).read_text()
    if path.endswith((".yaml", ".yml")):
        import yaml

        pipeline = yaml.safe_load(text)
    else:
        pipeline = json.loads(text)
    if not {"pipeline_name", "tables"} <= pipeline.keys():
        raise ValueError(f"pipeline {path} needs 'pipeline_name' and 'tables'")
    return pipeline


Clock = Callable[[], datetime]


def utc_now() -> datetime:
    return datetime.now(UTC)


@dataclass(frozen=True)
class Run:
    """State of one run, as far as it has got."""

    run_id: str
    pipeline_name: str
    source_table: str
    load_type: str
    started_at: datetime
    status: str = "running"
    watermark_start: int | None = None
    watermark_end: int | None = None
    rows_read: int | None = None
    rows_written: int | None = None
    bronze_key: str | None = None
    completed_at: datetime | None = None
    error_message: str | None = None
    event_seq: int = 1


class Ledger:
    """Append-only run events below ``<lake>/control/run_events``; one writer per pipeline and table."""

    def __init__(self, spark: SparkSession, lake: str, clock: Clock = utc_now):
        self.spark, self.path, self.clock = spark, f"{lake}/control/run_events", clock

    def _append(self, run: Run) -> Run:
        row = tuple(getattr(run, f.name) for f in RUN_EVENTS)
        append(self.spark.createDataFrame([row], RUN_EVENTS).coalesce(1), self.path)
        return run

    def start(self, pipeline: str, table: str, load_type: str) -> Run:
        """Record a running load before anything is read."""
        return self._append(Run(str(uuid.uuid4()), pipeline, table, load_type, self.clock()))

    def succeed(self, run: Run, **outcome) -> Run:
        """Record success. Call it only after the data is in place."""
        return self._append(replace(run, status="success", completed_at=self.clock(), event_seq=2, **outcome))

    def fail(self, run: Run, message: str) -> Run:
        return self._append(
            replace(
                run, status="failed", completed_at=self.clock(), event_seq=2,
                error_message=message[:ERROR_TEXT_LIMIT],
            )
        )

    def events(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return empty(self.spark, RUN_EVENTS)
        return self.spark.read.schema(RUN_EVENTS).parquet(self.path)

    def runs(self) -> DataFrame:
        return current_runs(self.events())

    def compact(self) -> int:
        """Fold the events so far into one row per run; returns how many files went.

        The folded rows are added before the files they come from are dropped. In between, and after a crash
        there, both are read, and folding both gives the same. Events that are added meanwhile stay.
        """
        if not exists(self.spark, self.path):
            return 0
        files = [r["path"] for r in list_files(self.spark, self.path).select("path").collect()]
        if len(files) < 2:
            return 0
        events = self.spark.read.schema(RUN_EVENTS).parquet(*files)
        folded = freshest(events, ["run_id"], ["event_seq"]).select(*RUN_EVENTS.names)
        append(folded.coalesce(1), self.path)
        for path in files:
            target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(target, False)
        return len(files)


def full_load(source: Source, lake: str, ledger: Ledger, pipeline: str, table: str) -> Run:
    """Copy a whole table into today's snapshot. A failure is recorded and raised again."""
    run = ledger.start(pipeline, table, "full")
    try:
        key, rows = write_snapshot(full_scan(source, table), lake, table, f"{run.started_at:%Y-%m-%d}")
        return ledger.succeed(run, rows_read=rows, rows_written=rows, bronze_key=key)
    except Exception as err:
        ledger.fail(run, str(err))
        raise


def incremental_load(
    source: Source,
    lake: str,
    ledger: Ledger,
    pipeline: str,
    table: str,
    overlap: int = 0,
    skip_null_watermarks: bool = False,
    still_ours: Callable[[], None] = lambda: None,
) -> Run:
    """Copy the rows above the last watermark into a batch of their own.

    Nothing new is a success that writes nothing and keeps the watermark. ``overlap`` reads the
    last ids again for sources where a lower id may be committed late; Silver drops the repeats.
    ``still_ours`` is called before the batch is made known and raises if another load has taken over.
    """
    run = ledger.start(pipeline, table, "incremental")
    try:
        start = last_watermark(ledger.runs(), pipeline, table, skip_null_watermarks)
        rows = full_scan(source, table)
        end = upper_bound(rows, start)
        if end is None:
            return ledger.succeed(run, rows_read=0, rows_written=0, watermark_start=start, watermark_end=start)
        batch = incremental_scan(rows, max(start - overlap, 0) if overlap else start, end)
        key, written = write_batch(batch, lake, table, start, end)
        still_ours()
        return ledger.succeed(
            run, rows_read=written, rows_written=written, watermark_start=start, watermark_end=end, bronze_key=key
        )
    except Exception as err:
        ledger.fail(run, str(err))
        raise


@dataclass
class PipelineResult:
    runs: list[Run] = field(default_factory=list)
    failures: dict[str, str] = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return not self.failures


def run_pipeline(
    source: Source, lake: str, ledger: Ledger, pipeline: dict | None = None, force_full: bool = False
) -> PipelineResult:
    """Load every table of the pipeline as declared, or all in full. A failing table does not stop the rest."""
    pipeline = pipeline or DEFAULT_PIPELINE
    result = PipelineResult()
    for spec in pipeline["tables"]:
        table = spec["name"]
        load_type = "full" if force_full else spec.get("load_type", "full")
        try:
            if load_type == "full":
                run = full_load(source, lake, ledger, pipeline["pipeline_name"], table)
            elif load_type == "incremental":
                run = incremental_load(source, lake, ledger, pipeline["pipeline_name"], table)
            else:
                raise ValueError(f"unknown load_type {load_type!r} of table {table}")
            result.runs.append(run)
        except Exception as err:
            logger.exception("load of %s failed", table)
            result.failures[table] = str(err)
    return result


def write_local_snapshot(source: Source, lake: str, table: str, day: str) -> tuple[str, int]:
    """Full snapshot without a ledger entry."""
    return write_snapshot(full_scan(source, table), lake, table, day)


def write_local_batch(spark: SparkSession, source: Source, lake: str, table: str) -> tuple[str, int] | None:
    """Incremental batch without a ledger: it resumes from the newest snapshot. None if nothing is new."""
    start = watermark_from_snapshot(spark, f"{lake}/bronze", table)
    rows = full_scan(source, table)
    end = upper_bound(rows, start)
    return None if end is None else write_batch(incremental_scan(rows, start, end), lake, table, start, end)
