"""Leases, the folded ledger, footers, range digests, misfits and contracts that say too little."""

import glob
import json
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clicklake.operators import contracts, quality
from clicklake.plans import ingest, lease, refine
from clicklake.sources import bronze, footers
from helpers import plan_of

ROWS = "id bigint, short_code string, occurred_at timestamp, device_type string, hashed_ip string, user_id bigint"


class Hour:
    """A clock that is moved by hand."""

    def __init__(self):
        self.now = datetime(2024, 1, 1, tzinfo=UTC)

    def __call__(self):
        return self.now


def source(spark, top):
    rows = spark.range(1, top + 1).selectExpr("id", "'a' AS short_code", "timestamp'2024-01-01' AS occurred_at", "'mobile' AS device_type", "CAST(NULL AS STRING) AS hashed_ip", "CAST(NULL AS BIGINT) AS user_id")
    return lambda table: rows


# --- Leases and ledger ---------------------------------------------------------------------------


def test_two_loads_of_one_table_write_each_id_once(spark, tmp_path):
    lake, clock = str(tmp_path), Hour()
    ledger = ingest.Ledger(spark, lake, clock)
    inner = []

    def slow(table):
        """While the first load reads, a second one tries, and another table is free."""
        if not inner:
            inner.append(1)
            with pytest.raises(lease.LeaseHeld):
                lease.leased_load(source(spark, 10), lake, ledger, "p", "clicks")
            with lease.Lease(spark, lake, "p", "urls", clock=clock):
                pass
        return source(spark, 6)(table)

    assert lease.leased_load(slow, lake, ledger, "p", "clicks").watermark_end == 6
    clock.now += timedelta(minutes=1)
    assert lease.leased_load(source(spark, 10), lake, ledger, "p", "clicks").rows_written == 4
    assert sorted(r.id for r in bronze.read_bronze(spark, f"{lake}/bronze").collect()) == list(range(1, 11))


def test_a_load_that_outlives_its_lease_makes_nothing_known(spark, tmp_path):
    lake, clock = str(tmp_path), Hour()
    ledger = ingest.Ledger(spark, lake, clock)

    def late(table):
        clock.now += timedelta(hours=2)
        with lease.Lease(spark, lake, "p", "clicks", clock=clock):
            pass
        return source(spark, 6)(table)

    with pytest.raises(lease.LeaseHeld):
        lease.leased_load(late, lake, ledger, "p", "clicks", seconds=3600)
    assert [r.status for r in ledger.runs().collect()] == ["failed"]
    assert lease.leased_load(source(spark, 6), lake, ledger, "p", "clicks").rows_written == 6


def test_a_lease_ends_with_its_holder(spark, tmp_path):
    clock = Hour()
    one, two = (lease.Lease(spark, str(tmp_path), "p", "t", 60, clock) for _ in range(2))
    one.__enter__()
    with pytest.raises(lease.LeaseHeld):
        two.__enter__()
    clock.now += timedelta(seconds=61)
    two.__enter__()
    with pytest.raises(lease.LeaseHeld):
        one.renew()
    with pytest.raises(lease.LeaseHeld):
        one.__exit__(None, None, None)
    two.renew()
    two.__exit__(None, None, None)
    for _ in range(6):
        with lease.Lease(spark, str(tmp_path), "p", "t", 60, clock):
            pass
    assert len(glob.glob(f"{tmp_path}/control/leases/p.t/_versions/*.json")) <= 2


def test_the_folded_ledger_says_the_same(spark, tmp_path):
    ledger = ingest.Ledger(spark, str(tmp_path), Hour())
    assert ledger.compact() == 0
    for k in range(5):
        run = ledger.start("p", "t", "incremental")
        if k:
            ledger.succeed(run, watermark_end=k) if k % 2 else ledger.fail(run, "no")
    before = sorted(map(str, ledger.runs().collect()))
    files = lambda: len(glob.glob(f"{ledger.path}/*.parquet"))
    assert files() == 9 and ledger.compact() == 9 and files() == 1
    assert sorted(map(str, ledger.runs().collect())) == before and ledger.compact() == 0
    for _ in range(3):
        ledger.start("p", "t", "full")
        ledger.compact()
    assert files() == 1 and ledger.runs().count() == 8


def test_a_fold_that_dies_half_way_changes_nothing(spark, tmp_path, monkeypatch):
    ledger = ingest.Ledger(spark, str(tmp_path), Hour())
    for k in range(3):
        ledger.succeed(ledger.start("p", "t", "incremental"), watermark_end=k)
    before, append = sorted(map(str, ledger.runs().collect())), ingest.append

    def die(df, path):
        append(df, path)
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "append", die)
    with pytest.raises(RuntimeError, match="lost"):
        ledger.compact()
    monkeypatch.undo()
    assert sorted(map(str, ledger.runs().collect())) == before
    ledger.compact()
    assert sorted(map(str, ledger.runs().collect())) == before


# --- Footers -------------------------------------------------------------------------------------


def test_footers_answer_for_own_files(spark, tmp_path):
    folder = f"{tmp_path}/bronze/clicks/ingestion_date=2024-01-0"
    rows = source(spark, 1000)("clicks").withColumn("country", F.lit("x"))
    rows.repartition(3).write.parquet(f"{folder}1")
    found = footers.footer_bounds(spark, [f"{folder}1"], "clicks")
    plan = plan_of(found)
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id)]" in plan and tuple(found.first()) == (1000, 1, 1000)
    assert "PushedAggregation" not in plan_of(spark.read.parquet(f"{folder}1").agg(F.max("id"))), "the session is as it was"
    assert footers.watermark_from_footers(spark, f"{tmp_path}/bronze") == bronze.watermark_from_snapshot(spark, f"{tmp_path}/bronze") == 1000
    assert footers.bounds(spark, [f"{folder}1"], "clicks", "user_id", own_files=True) == (1000, None, None)
    rows.where("id > 990").write.parquet(f"{folder}2")
    assert footers.bounds(spark, [f"{folder}1", f"{folder}2"], "clicks", own_files=True) == (1010, 1, 1000)


@pytest.mark.parametrize("kind", ["int", "decimal(20,2)", "string", None])
def test_other_files_are_scanned(spark, tmp_path, kind):
    """Other types, or another order of columns, under which Spark would take the statistics of a wrong column."""
    folder = f"{tmp_path}/bronze/clicks/ingestion_date=2024-01-01"
    rows = source(spark, 300)("clicks")
    other = rows.withColumn("id", F.col("id").cast(kind)) if kind else rows.select("user_id", *[c for c in rows.columns if c != "user_id"])
    other.write.parquet(folder)
    with pytest.raises(TypeError, match="declared columns"):
        footers.bounds(spark, [folder], "clicks", own_files=True)
    assert footers.bounds(spark, [folder], "clicks") == (300, 1, 300)
    more = f"{tmp_path}/bronze/clicks/ingestion_date=2024-01-02"
    rows.where("id > 250").write.parquet(more)
    assert footers.bounds(spark, [folder, more], "clicks") == (350, 1, 300)


def test_an_empty_snapshot_has_no_watermark(spark, tmp_path):
    source(spark, 0)("clicks").write.parquet(f"{tmp_path}/bronze/clicks/ingestion_date=2024-01-01")
    with pytest.raises(ValueError, match="no rows"):
        footers.watermark_from_footers(spark, f"{tmp_path}/bronze")


# --- Range digests -------------------------------------------------------------------------------


def test_only_ranges_that_differ_are_compared(spark):
    before = spark.range(-500, 20_000).selectExpr("id", "id % 7 AS a", "CASE WHEN id % 5 > 0 THEN concat('x', id) END AS b")
    after = before.where("id <> 7000").withColumn("b", F.when(F.col("id") == 12_346, F.lit(None)).otherwise(F.col("b")))
    after = after.unionByName(spark.range(20_000, 30_000).selectExpr("id", "id AS a", "'' AS b"))
    assert sorted(r.low for r in quality.changed_ranges(before, after, "id", 1000).collect()) == [7000, 12_000]
    found = {(r.id, r.change) for r in quality.changed_rows_by_range(before, after, "id", 1000).collect()}
    assert found == {(7000, "vanished"), (12_346, "changed")}
    assert found == {tuple(r) for r in quality.changed_rows(before, after, "id").collect()}
    swapped = before.withColumns({"a": F.when(F.col("id").isin(1, 2), 3 - F.col("id")).otherwise(F.col("a"))})
    assert {r.id for r in quality.changed_rows_by_range(before, swapped, "id").collect()} == {1, 2}
    assert quality.changed_rows_by_range(before, before.repartition(5), "id").count() == 0
    null = before.withColumn("id", F.when(F.col("id") % 3 > 0, F.col("id")))
    assert quality.changed_rows_by_range(null, null, "id").count() == 0


# --- Misfits and contracts -----------------------------------------------------------------------


def test_misfits_are_kept_and_counted(spark, tmp_path):
    folder = f"{tmp_path}/bronze/clicks/ingestion_date=2024-01-0"
    texts = [("1", "a", "2024-01-01 00:00:00", "mobile", None, 2.0), ("one", "a", "soon", "mobile", None, 1.5), (None, "b", None, "mobile", None, 1e30), ("99999999999999999999", "c", "2024-01-01", "mobile", None, None)]
    spark.createDataFrame(texts, "id string, short_code string, occurred_at string, device_type string, hashed_ip string, user_id double").write.parquet(f"{folder}1")
    source(spark, 3)("clicks").write.parquet(f"{folder}2")
    rows = bronze.read_rescued(spark, f"{tmp_path}/bronze")
    assert rows.columns == [*bronze.read_bronze(spark, f"{tmp_path}/bronze").columns, bronze.MISFITS]
    found = {frozenset(r.misfits.items()) for r in rows.collect()}
    assert found == {
        frozenset(), frozenset({("id", "one"), ("occurred_at", "soon"), ("user_id", "1.5")}), frozenset({("user_id", "1.0E30")}),
        frozenset({("id", "99999999999999999999")}),
    }
    assert sorted(map(str, rows.drop(bronze.MISFITS).collect())) == sorted(map(str, bronze.read_bronze(spark, f"{tmp_path}/bronze").collect()))
    counts = refine.misfits_job(spark, str(tmp_path))
    assert counts == {"id": 2, "short_code": 0, "occurred_at": 1, "device_type": 0, "hashed_ip": 0, "user_id": 2}
    assert spark.read.parquet(f"{tmp_path}/silver/misfits").count() == 3


@pytest.mark.parametrize("column", [
    {"name": "id", "nullable": False}, {"name": "id", "type": "integer"}, {"type": "integer", "nullable": False}, "id",
    {"name": "id", "type": "bignum", "nullable": False}, {"name": "id", "type": "integer", "nullable": "no"},
])
def test_a_contract_that_says_too_little_is_refused(tmp_path, column):
    path = tmp_path / "t.json"
    path.write_text(json.dumps({"table": "t", "columns": [{"name": "x", "type": "text", "nullable": True}, column]}))
    with pytest.raises(contracts.ContractError):
        contracts.load_contract(path)
