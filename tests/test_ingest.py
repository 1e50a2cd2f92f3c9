import pytest
from pyspark.sql import functions as F

from clicklake.operators import ledger as lg
from clicklake.plans import ingest, reports
from clicklake.sources.bronze import read_bronze
from clicklake.sources.relational import ExtractionError, jdbc_options, parquet_source
from helpers import at


def clicks(spark, first, last):
    return spark.range(first, last + 1).selectExpr(
        "id", "concat('c', id % 3) AS short_code", "timestamp'2026-09-01 10:00:00' AS occurred_at",
        "'mobile' AS device_type", "CAST(NULL AS STRING) AS hashed_ip", "CAST(NULL AS BIGINT) AS user_id",
    )


class Tables:
    """A source whose tables can be swapped between loads."""

    def __init__(self, **frames):
        self.frames = frames

    def __call__(self, table):
        if table not in self.frames:
            raise ExtractionError(f"cannot read table {table}")
        return self.frames[table]


@pytest.fixture
def clock():
    class Clock:
        now = at("2026-09-01T08:00:00")

        def __call__(self):
            Clock.now = Clock.now.replace(minute=(Clock.now.minute + 1) % 60)
            return Clock.now

    return Clock()


@pytest.fixture
def lake(tmp_path):
    return str(tmp_path / "lake")


@pytest.fixture
def ledger(spark, lake, clock):
    return ingest.Ledger(spark, lake, clock)


def stored(spark, lake):
    return sorted(r["id"] for r in read_bronze(spark, f"{lake}/bronze").collect())


def test_full_load_writes_and_records(spark, lake, ledger):
    run = ingest.full_load(Tables(clicks=clicks(spark, 1, 3)), lake, ledger, "p", "clicks")
    assert (run.status, run.rows_read, run.rows_written) == ("success", 3, 3)
    assert run.bronze_key == "bronze/clicks/ingestion_date=2026-09-01"
    assert run.watermark_end is None
    assert stored(spark, lake) == [1, 2, 3]
    row = ledger.runs().first()
    assert (row["status"], row["bronze_key"], row["rows_written"]) == ("success", run.bronze_key, 3)


def test_same_day_rerun_replaces(spark, lake, ledger):
    source = Tables(clicks=clicks(spark, 1, 3))
    ingest.full_load(source, lake, ledger, "p", "clicks")
    source.frames["clicks"] = clicks(spark, 2, 2)
    ingest.full_load(source, lake, ledger, "p", "clicks")
    assert stored(spark, lake) == [2]


def test_rerun_with_an_emptied_table_replaces_too(spark, lake, ledger):
    source = Tables(clicks=clicks(spark, 1, 3))
    ingest.full_load(source, lake, ledger, "p", "clicks")
    source.frames["clicks"] = clicks(spark, 1, 3).limit(0)
    assert ingest.full_load(source, lake, ledger, "p", "clicks").rows_written == 0
    assert stored(spark, lake) == []


def test_other_days_stay(spark, lake, ledger, clock):
    source = Tables(clicks=clicks(spark, 1, 3))
    ingest.full_load(source, lake, ledger, "p", "clicks")
    type(clock).now = at("2026-09-02T08:00:00")
    ingest.full_load(source, lake, ledger, "p", "clicks")
    assert stored(spark, lake) == [1, 1, 2, 2, 3, 3]


def test_incremental_loads_resume(spark, lake, ledger):
    source = Tables(clicks=clicks(spark, 1, 5))
    first = ingest.incremental_load(source, lake, ledger, "p", "clicks")
    assert (first.watermark_start, first.watermark_end, first.rows_written) == (0, 5, 5)
    assert first.bronze_key == "bronze/clicks/incremental/watermark_start=000000000000/watermark_end=000000000005"
    source.frames["clicks"] = clicks(spark, 1, 7)
    second = ingest.incremental_load(source, lake, ledger, "p", "clicks")
    assert (second.watermark_start, second.watermark_end, second.rows_written) == (5, 7, 2)
    assert stored(spark, lake) == [1, 2, 3, 4, 5, 6, 7]


def test_nothing_new_is_a_success_without_a_file(spark, lake, ledger):
    source = Tables(clicks=clicks(spark, 1, 5))
    ingest.incremental_load(source, lake, ledger, "p", "clicks")
    idle = ingest.incremental_load(source, lake, ledger, "p", "clicks")
    assert (idle.status, idle.rows_written, idle.bronze_key) == ("success", 0, None)
    assert (idle.watermark_start, idle.watermark_end) == (5, 5)
    assert len(stored(spark, lake)) == 5
    assert ingest.incremental_load(source, lake, ledger, "p", "clicks").watermark_start == 5


def test_failed_run_is_recorded_and_does_not_move_the_watermark(spark, lake, ledger):
    source = Tables(clicks=clicks(spark, 1, 5))
    ingest.incremental_load(source, lake, ledger, "p", "clicks")
    with pytest.raises(ExtractionError):
        ingest.incremental_load(Tables(), lake, ledger, "p", "clicks")
    failed = ledger.runs().where("status = 'failed'").first()
    assert "clicks" in failed["error_message"] and failed["watermark_end"] is None
    assert lg.last_watermark(ledger.runs(), "p", "clicks") == 5


def test_failing_write_leaves_the_old_snapshot(spark, lake, ledger):
    source = Tables(clicks=clicks(spark, 1, 3))
    ingest.full_load(source, lake, ledger, "p", "clicks")
    source.frames["clicks"] = clicks(spark, 1, 3).withColumn(
        "short_code", F.when(F.col("id") == 3, F.raise_error(F.lit("source broke"))).otherwise("x")
    )
    with pytest.raises(Exception, match="source broke"):
        ingest.full_load(source, lake, ledger, "p", "clicks")
    assert stored(spark, lake) == [1, 2, 3]


def test_same_range_retry_replaces(spark, lake, ledger):
    source = Tables(clicks=clicks(spark, 1, 5))
    first = ingest.incremental_load(source, lake, ledger, "p", "clicks")
    again = ingest.incremental_load(source, lake, ledger, "other", "clicks")
    assert again.bronze_key == first.bronze_key
    assert stored(spark, lake) == [1, 2, 3, 4, 5]


def test_full_load_resets_the_watermark_unless_skipped(spark, lake, ledger):
    source = Tables(clicks=clicks(spark, 1, 5))
    ingest.incremental_load(source, lake, ledger, "p", "clicks")
    ingest.full_load(source, lake, ledger, "p", "clicks")
    assert lg.last_watermark(ledger.runs(), "p", "clicks") == 0
    assert lg.last_watermark(ledger.runs(), "p", "clicks", skip_null_watermarks=True) == 5


def test_overlap_reads_late_ids_again(spark, lake, ledger):
    source = Tables(clicks=clicks(spark, 1, 5).where("id <> 4"))
    ingest.incremental_load(source, lake, ledger, "p", "clicks")
    source.frames["clicks"] = clicks(spark, 1, 6)
    run = ingest.incremental_load(source, lake, ledger, "p", "clicks", overlap=2)
    assert (run.watermark_start, run.rows_written) == (5, 3)
    assert set(stored(spark, lake)) == {1, 2, 3, 4, 5, 6}


def _users(spark):
    return spark.createDataFrame([(1, "a@example.com", "FREE", at("2026-01-01T00:00:00"))], "id bigint, email string, plan_type string, created_at timestamp")


def test_pipeline_goes_on_after_a_failing_table(spark, lake, ledger):
    source = Tables(users=_users(spark), clicks=clicks(spark, 1, 2))
    result = ingest.run_pipeline(source, lake, ledger)
    assert not result.ok and list(result.failures) == ["urls"]
    assert [(r.source_table, r.load_type) for r in result.runs] == [("users", "full"), ("clicks", "incremental")]


def test_pipeline_defaults_and_unknown_types(spark, lake, ledger):
    spec = {"pipeline_name": "p", "tables": [{"name": "clicks"}, {"name": "users", "load_type": "sideways"}]}
    result = ingest.run_pipeline(Tables(users=_users(spark), clicks=clicks(spark, 1, 2)), lake, ledger, spec)
    assert [r.load_type for r in result.runs] == ["full"]
    assert "sideways" in result.failures["users"]


def test_forced_full_load(spark, lake, ledger):
    spec = {"pipeline_name": "p", "tables": [{"name": "clicks", "load_type": "incremental"}]}
    result = ingest.run_pipeline(Tables(clicks=clicks(spark, 1, 2)), lake, ledger, spec, force_full=True)
    assert result.ok and result.runs[0].load_type == "full"


def test_local_writers_need_no_ledger(spark, lake):
    source = Tables(clicks=clicks(spark, 1, 3))
    with pytest.raises(FileNotFoundError):
        ingest.write_local_batch(spark, source, lake, "clicks")
    ingest.write_local_snapshot(source, lake, "clicks", "2026-09-01")
    assert ingest.write_local_batch(spark, source, lake, "clicks") is None
    source.frames["clicks"] = clicks(spark, 1, 5)
    key, rows = ingest.write_local_batch(spark, source, lake, "clicks")
    assert key.endswith("watermark_start=000000000003/watermark_end=000000000005") and rows == 2


def test_error_text_is_cut(spark, ledger):
    run = ledger.start("p", "clicks", "full")
    ledger.fail(run, "x" * 5000)
    assert len(ledger.runs().first()["error_message"]) == 2000


def test_reports_over_a_real_lake(spark, lake, ledger):
    source = Tables(clicks=clicks(spark, 1, 5))
    ingest.full_load(source, lake, ledger, "p", "clicks")
    ingest.incremental_load(source, lake, ledger, "p", "clicks")
    drift, clean = reports.reconcile_report(spark, lake, ledger, "p")
    assert clean and drift.count() == 0
    clicks(spark, 1, 1).write.parquet(f"{lake}/bronze/clicks/ingestion_date=1999-01-01")
    ghost = ledger.start("p", "clicks", "full")
    ledger.succeed(ghost, rows_read=1, rows_written=1, bronze_key="bronze/clicks/ingestion_date=1998-01-01")
    drift, clean = reports.reconcile_report(spark, lake, ledger, "p")
    assert not clean
    assert sorted(map(tuple, drift.collect())) == [
        ("missing", "bronze/clicks/ingestion_date=1998-01-01"), ("orphaned", "bronze/clicks/ingestion_date=1999-01-01"),
    ]
    stats, ok = reports.storage_report(spark, lake)
    assert ok and stats.first()["object_count"] >= 3
    layout, _ = reports.layout_of_table(spark, lake, "clicks")
    assert layout.first()["small_file_count"] == layout.first()["object_count"]
    assert reports.history_report(ledger)[0].count() == 3
    assert reports.summary_report(ledger, "p")[0].first()["successful_runs"] == 3
    assert reports.stale_report(ledger, at("2030-01-01T00:00:00"))[1]
    ledger.start("p", "clicks", "full")
    assert not reports.stale_report(ledger, at("2030-01-01T00:00:00"))[1]


def test_jdbc_options_partition_the_read():
    options = jdbc_options("jdbc:postgresql://db/app", "clicks", 1, 1_000_000, 32)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "32"
    assert (options["lowerBound"], options["upperBound"]) == ("1", "1000000")
    assert jdbc_options("u", "t", 0, 0, 1)["upperBound"] == "1"


def test_parquet_source(spark, tmp_path):
    clicks(spark, 1, 3).write.parquet(str(tmp_path / "clicks"))
    source = parquet_source(spark, str(tmp_path))
    assert source("clicks").count() == 3
    with pytest.raises(ExtractionError):
        source("visits")


def test_pipeline_files(tmp_path):
    path = tmp_path / "p.json"
    path.write_text('{"pipeline_name": "p", "tables": [{"name": "clicks", "load_type": "incremental"}]}')
    assert ingest.load_pipeline(str(path))["tables"][0]["name"] == "clicks"
    path.write_text('{"tables": []}')
    with pytest.raises(ValueError):
        ingest.load_pipeline(str(path))
