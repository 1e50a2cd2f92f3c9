import datetime as dt
import os
import subprocess
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from clicklake.schemas import CLICKS
from clicklake.sources import bronze, listing
from helpers import plan_of

FULL = "clicks/ingestion_date={}/clicks.parquet"
BATCH = "clicks/incremental/watermark_start={:012d}/watermark_end={:012d}/clicks.parquet"


def put(root, name, ids, user_type=pa.float64(), unit="us", users=None):
    """A file as another writer would leave it: single object, types that follow its data."""
    n = len(ids)
    table = pa.table(
        {
            "id": pa.array(ids, pa.int64()),
            "short_code": pa.array([f"c{i}" for i in ids]),
            "occurred_at": pa.array([dt.datetime(2026, 9, 1, 10, 0, 0, i) for i in ids], pa.timestamp(unit)),
            "device_type": pa.array(["mobile"] * n),
            "hashed_ip": pa.array([None] * n, pa.string()),
            "user_id": pa.array(users or [None] * n, user_type),
        }
    )
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(table, path)


def test_both_layouts_read_as_one_table(spark, tmp_path):
    put(tmp_path, FULL.format("2026-09-01"), [1])
    put(tmp_path, BATCH.format(1, 2), [2])
    out = bronze.read_bronze(spark, str(tmp_path))
    assert out.columns == CLICKS.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in CLICKS]
    assert sorted(r["id"] for r in out.collect()) == [1, 2]


def test_overlapping_snapshots_keep_repeats(spark, tmp_path):
    put(tmp_path, FULL.format("2026-09-01"), [1, 2])
    put(tmp_path, FULL.format("2026-09-02"), [1, 2, 3])
    assert bronze.read_bronze(spark, str(tmp_path)).count() == 5


def test_user_ids_of_every_physical_type(spark, tmp_path):
    put(tmp_path, FULL.format("2026-09-01"), [1, 2], pa.float64(), users=[5.0, None])
    put(tmp_path, FULL.format("2026-09-02"), [3], pa.int64(), users=[6])
    put(tmp_path, BATCH.format(3, 4), [4], pa.null())
    put(tmp_path, BATCH.format(4, 5), [5], pa.int32(), users=[7])
    rows = bronze.read_bronze(spark, str(tmp_path)).collect()
    assert {r["id"]: r["user_id"] for r in rows} == {1: 5, 2: None, 3: 6, 4: None, 5: 7}


def test_nanosecond_times(spark, tmp_path):
    put(tmp_path, FULL.format("2026-09-01"), [1, 2], unit="ns")
    put(tmp_path, BATCH.format(2, 3), [3], unit="ms")
    rows = bronze.read_bronze(spark, str(tmp_path)).select("id", F.date_format("occurred_at", "ss.SSSSSS").alias("t")).collect()
    assert {r["id"]: r["t"] for r in rows} == {1: "00.000001", 2: "00.000002", 3: "00.000000"}


def test_int96_times_of_spark_writers(spark, tmp_path):
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    try:
        spark.range(1, 3).selectExpr(
            "id", "'a' AS short_code", "timestamp'2026-09-01 10:00:00.000005' AS occurred_at", "'mobile' AS device_type",
            "CAST(NULL AS STRING) AS hashed_ip", "id AS user_id",
        ).write.parquet(str(tmp_path / "clicks/ingestion_date=2026-09-01"))
    finally:
        spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    row = bronze.read_bronze(spark, str(tmp_path)).selectExpr("max(date_format(occurred_at, 'ss.SSSSSS')) AS t", "count(*) AS n").first()
    assert (row["t"], row["n"]) == ("00.000005", 2)


def test_file_lacking_a_column(spark, tmp_path):
    put(tmp_path, FULL.format("2026-09-01"), [1])
    path = tmp_path / FULL.format("2026-09-02")
    path.parent.mkdir(parents=True)
    pq.write_table(pa.table({"id": pa.array([2], pa.int64())}), path)
    rows = bronze.read_bronze(spark, str(tmp_path)).collect()
    assert {r["id"]: r["short_code"] for r in rows} == {1: "c1", 2: None}


def test_groups_follow_types_not_files(spark, tmp_path):
    for day in range(1, 8):
        put(tmp_path, FULL.format(f"2026-09-{day:02d}"), [day], pa.float64())
    put(tmp_path, BATCH.format(7, 8), [8], pa.int64(), users=[1])
    plan = plan_of(bronze.read_bronze(spark, str(tmp_path)))
    assert plan.count("FileScan parquet") == 2


def test_own_files_need_no_footer_pass(spark, tmp_path):
    put(tmp_path, FULL.format("2026-09-01"), [1], pa.int64(), users=[2])
    put(tmp_path, BATCH.format(1, 2), [2], pa.int64(), users=[2])
    out = bronze.read_bronze(spark, str(tmp_path), own_files=True)
    assert out.columns == CLICKS.names and out.count() == 2


@pytest.mark.parametrize("own_files", [False, True])
def test_no_files_is_an_error(spark, tmp_path, own_files):
    (tmp_path / "urls").mkdir()
    (tmp_path / "clicks").mkdir()
    with pytest.raises(FileNotFoundError):
        bronze.read_bronze(spark, str(tmp_path), own_files=own_files)


def test_discovery_is_sorted_and_keeps_to_its_table(spark, tmp_path):
    put(tmp_path, BATCH.format(1, 2), [2])
    put(tmp_path, FULL.format("2026-09-01"), [1])
    put(tmp_path, "urls/ingestion_date=2026-09-01/urls.parquet", [1])
    paths = [r["path"].split("/clicks/", 1)[1] for r in bronze.bronze_files(spark, str(tmp_path), "clicks").collect()]
    assert paths == [
        "incremental/watermark_start=000000000001/watermark_end=000000000002/clicks.parquet",
        "ingestion_date=2026-09-01/clicks.parquet",
    ]
    assert bronze.bronze_files(spark, str(tmp_path), "visits").isEmpty()


def test_a_listing_is_frozen_and_does_not_change_the_session(spark, tmp_path):
    put(tmp_path, FULL.format("2026-09-01"), [1])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    files = listing.list_files(spark, str(tmp_path))
    put(tmp_path, FULL.format("2026-09-02"), [2])
    assert files.count() == 1 and files.first()["length"] > 0
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert listing.list_files(spark, str(tmp_path / "none")).isEmpty()


def test_uniform_files_are_one_scan_of_the_folder(spark, tmp_path):
    put(tmp_path, FULL.format("2026-09-01"), [1])
    put(tmp_path, BATCH.format(1, 2), [2])
    (tmp_path / "clicks" / "notes.txt").write_text("not data")
    out = bronze.read_bronze(spark, str(tmp_path))
    assert plan_of(out).count("FileScan parquet") == 1 and out.count() == 2


def test_date_range_is_inclusive_and_pruned(spark, tmp_path):
    for day in (1, 2, 3, 4):
        put(tmp_path, FULL.format(f"2026-09-0{day}"), [day])
    put(tmp_path, BATCH.format(4, 5), [5])
    out = bronze.read_date_range(spark, str(tmp_path), "clicks", "2026-09-02", "2026-09-03")
    assert sorted(r["id"] for r in out.collect()) == [2, 3]
    plan = plan_of(out)
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan and "InMemoryFileIndex(2 paths)" in plan
    assert bronze.read_date_range(spark, str(tmp_path), "clicks", "2027-01-01", "2027-12-31").isEmpty()


def test_full_snapshots_leave_batches_out(spark, tmp_path):
    put(tmp_path, FULL.format("2026-09-01"), [1])
    put(tmp_path, BATCH.format(1, 2), [2])
    assert [r["id"] for r in bronze.read_snapshots(spark, str(tmp_path)).collect()] == [1]


def test_watermark_of_the_newest_snapshot(spark, tmp_path):
    put(tmp_path, FULL.format("2026-09-01"), [1, 9])
    put(tmp_path, FULL.format("2026-09-02"), [1, 5])
    put(tmp_path, BATCH.format(5, 20), [20])
    assert bronze.watermark_from_snapshot(spark, str(tmp_path)) == 5


def test_watermark_needs_a_snapshot_with_rows(spark, tmp_path):
    put(tmp_path, BATCH.format(0, 1), [1])
    with pytest.raises(FileNotFoundError):
        bronze.watermark_from_snapshot(spark, str(tmp_path))
    put(tmp_path, FULL.format("2026-09-01"), [])
    with pytest.raises(ValueError):
        bronze.watermark_from_snapshot(spark, str(tmp_path))


def test_executors_need_no_copy_of_the_package(tmp_path):
    """Workers of this session start elsewhere and cannot import the package."""
    put(tmp_path, FULL.format("2026-09-01"), [1, 2])
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
sys.path.insert(0, {repo!r})
from clicklake.sources.bronze import read_bronze
print("rows", read_bronze(spark, {str(tmp_path)!r}).count())
"""
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=180)
    assert "rows 2" in done.stdout, done.stderr[-2000:]


def test_unsigned_dictionary_and_binary_columns_keep_their_values(spark, tmp_path):
    path = tmp_path / FULL.format("2026-09-01")
    path.parent.mkdir(parents=True)
    table = pa.table({
        "id": pa.array([1, 2], pa.uint32()), "short_code": pa.array([b"c1", b"c2"], pa.binary()),
        "occurred_at": pa.array([10**15, 10**15 + 7], pa.timestamp("ns")),
        "device_type": pa.array(["mobile", "desktop"]).dictionary_encode(), "user_id": pa.array([5, None], pa.uint64()),
    })
    pq.write_table(table, path)
    want = [(1, "c1", "mobile", 5), (2, "c2", "desktop", None)]
    for rows in (bronze.read_bronze(spark, str(tmp_path)), bronze.read_snapshots(spark, str(tmp_path)),
                 bronze.read_date_range(spark, str(tmp_path), "clicks", "2026-09-01", "2026-09-01")):
        assert sorted(tuple(r) for r in rows.select("id", "short_code", "device_type", "user_id").collect()) == want
    assert bronze.watermark_from_snapshot(spark, str(tmp_path)) == 2
    assert spark.conf.get("spark.sql.legacy.parquet.nanosAsLong") == "false"


def test_types_that_cannot_be_read_end_the_read(spark, tmp_path):
    path = tmp_path / FULL.format("2026-09-01")
    path.parent.mkdir(parents=True)
    pq.write_table(pa.table({"id": pa.array([[1], [2]])}), path)
    with pytest.raises(Exception, match="id"):
        bronze.read_bronze(spark, str(tmp_path)).collect()


def test_full_scan_keeps_columns_and_refuses_what_does_not_fit(spark):
    from clicklake.sources.relational import full_scan

    good = spark.createDataFrame([("1", "a", "x"), ("2", None, "y")], "id string, short_code string, country string")
    out = full_scan(lambda _: good, "clicks")
    assert [(r["id"], r["country"]) for r in out.orderBy("id").collect()] == [(1, "x"), (2, "y")]
    for kind, value in (("string", "x1"), ("double", 1.5), ("decimal(30,0)", 10**25)):
        from decimal import Decimal

        bad = spark.createDataFrame([(Decimal(value) if kind[:3] == "dec" else value,)], f"id {kind}")
        with pytest.raises(Exception, match="takes no"):
            full_scan(lambda _, bad=bad: bad, "clicks").collect()
