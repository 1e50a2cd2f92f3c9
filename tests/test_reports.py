import pytest

from clicklake.operators import contracts as ct
from clicklake.operators import ledger as lg
from clicklake.operators import pii, quality, storage
from clicklake.plans import reports
from clicklake.schemas import SOURCE_TABLES, empty
from helpers import at

RUNS = (
    "run_id string, pipeline_name string, source_table string, load_type string, status string, watermark_end bigint, "
    "rows_written bigint, bronze_key string, started_at timestamp"
)


@pytest.fixture
def runs(spark):
    return spark.createDataFrame(
        [
            ("r1", "p", "clicks", "incremental", "success", 10, 10, "k1", at("2026-09-01T08:00:00")),
            ("r2", "p", "clicks", "incremental", "success", 15, 5, "k2", at("2026-09-01T09:00:00")),
            ("r3", "p", "clicks", "incremental", "failed", None, None, None, at("2026-09-01T10:00:00")),
            ("r4", "p", "urls", "full", "running", None, None, None, at("2026-09-01T08:00:00")),
            ("r5", "q", "clicks", "full", "success", None, 7, None, at("2026-09-01T11:00:00")),
            ("r6", "p", "users", "full", "running", None, None, None, at("2026-09-01T09:30:00")),
        ],
        RUNS,
    )


def test_watermark_is_that_of_the_latest_success(runs):
    assert lg.last_watermark(runs, "p", "clicks") == 15
    assert lg.last_watermark(runs, "q", "clicks") == 0
    assert lg.last_watermark(runs, "p", "visits") == 0


def test_stale_runs_are_strictly_before_the_cutoff_and_oldest_first(runs):
    now = at("2026-09-01T10:30:00")
    assert [r["run_id"] for r in lg.stale_runs(runs, now, 59).collect()] == ["r4", "r6"]
    assert [r["run_id"] for r in lg.stale_runs(runs, now, 60).collect()] == ["r4"]
    assert lg.stale_runs(runs, now, 60, "q").isEmpty()


def test_history_is_newest_first_and_filtered(runs):
    assert [r["run_id"] for r in lg.run_history(runs, limit=3).collect()] == ["r5", "r3", "r6"]
    assert [r["run_id"] for r in lg.run_history(runs, "p", "clicks").collect()] == ["r3", "r2", "r1"]


def test_summary(runs):
    rows = {r["source_table"]: r for r in lg.summary(runs, "p").collect()}
    clicks = rows["clicks"]
    assert (clicks["successful_runs"], clicks["failed_runs"], clicks["total_rows_written"]) == (2, 1, 15)
    assert (rows["urls"]["total_rows_written"], rows["urls"]["last_success_at"]) == (0, None)
    assert [r["source_table"] for r in lg.summary(runs).collect()] == ["clicks", "urls", "users"]


def test_success_keys_leave_out_runs_without_one(runs):
    assert sorted(r["bronze_key"] for r in lg.success_keys(runs).collect()) == ["k1", "k2"]
    assert lg.success_keys(runs, "q").isEmpty()


def listing(spark, *objects):
    return spark.createDataFrame(list(objects), "path string, length bigint")


@pytest.mark.parametrize("limit", [1, 64, 65, 4096])
def test_layout_follows_the_sizes(spark, limit):
    sizes = [k * k for k in range(1, 65)]
    row = storage.layout_report(listing(spark, *[(f"part-{k}", n) for k, n in enumerate(sizes)]), limit).first()
    assert (row["object_count"], row["total_bytes"], row["avg_bytes"]) == (64, sum(sizes), sum(sizes) // 64)
    assert (row["min_bytes"], row["max_bytes"]) == (1, 4096)
    assert row["small_file_count"] == sum(n < limit for n in sizes)


def test_empty_listings_give_zeros(spark):
    nothing = listing(spark, ("x", 1)).limit(0)
    assert set(storage.layout_report(nothing).first().asDict().values()) == {0}
    assert storage.storage_stats(nothing).first().asDict() == {"object_count": 0, "total_bytes": 0}


def test_stats_keep_to_the_prefix(spark):
    files = listing(spark, ("bronze/a", 5), ("silver/a", 7))
    assert storage.storage_stats(files).first().asDict() == {"object_count": 1, "total_bytes": 5}


def keys(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "bronze_key string")


def test_reconcile_finds_both_kinds_of_drift(spark):
    stored, recorded = keys(spark, "a", "orphan", "orphan"), keys(spark, "a", "b", "b")
    assert [r[0] for r in storage.orphaned_objects(stored, recorded).collect()] == ["orphan"]
    assert [r[0] for r in storage.missing_objects(stored, recorded).collect()] == ["b", "b"]
    assert storage.reconcile(stored, recorded).first().asDict() == {"orphaned": 1, "missing": 2, "clean": False}
    assert storage.reconcile(keys(spark, "a"), keys(spark, "a")).first()["clean"]


def test_one_key_recorded_very_often_is_unfolded_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(storage, "_CHUNK", 7)
    recorded = spark.range(50).selectExpr("IF(id < 36, 'hot', concat('k', id)) AS bronze_key")
    out = [r[0] for r in storage.missing_objects(keys(spark, "k40"), recorded).collect()]
    assert out == sorted(out) and out.count("hot") == 36 and len(out) == 49


READINGS = {
    "table": "readings",
    "columns": [
        {"name": "sensor", "type": "text", "nullable": False, "pii": "none"},
        {"name": "taken_at", "type": "timestamp", "nullable": False, "pii": "none"},
        {"name": "celsius", "type": "numeric", "nullable": True, "pii": "none"},
        {"name": "valid", "type": "boolean", "nullable": True, "pii": "none"},
    ],
}
GOOD = {"sensor": "string NOT NULL", "taken_at": "timestamp NOT NULL", "celsius": "double", "valid": "boolean"}


def findings(spark, contract=READINGS, nullability="schema", **changed):
    """Findings for the good table with some columns changed, added or (None) left out."""
    columns = {name: kind for name, kind in {**GOOD, **changed}.items() if kind}
    df = spark.createDataFrame([], ", ".join(f"{name} {kind}" for name, kind in columns.items()))
    out = ct.validate_contracts(spark, [contract], {"readings": df}, nullability)
    return sorted((r["severity"], r["kind"], r["column"]) for r in out.collect())


def test_good_table_and_equivalent_types_pass(spark):
    assert findings(spark) == []
    assert findings(spark, celsius="decimal(7,3)", taken_at="timestamp_ntz NOT NULL") == []


@pytest.mark.parametrize(
    ("changed", "found"),
    [
        ({"valid": None}, ("violation", "missing_column", "valid")),
        ({"celsius": "string"}, ("violation", "type_mismatch", "celsius")),
        ({"taken_at": "string NOT NULL"}, ("violation", "type_mismatch", "taken_at")),
        ({"sensor": "string"}, ("violation", "nullability_mismatch", "sensor")),
        ({"valid": "boolean NOT NULL"}, ("violation", "nullability_mismatch", "valid")),
        ({"site": "int"}, ("warning", "extra_column", "site")),
    ],
)
def test_one_change_is_one_finding(spark, changed, found):
    assert findings(spark, **changed) == [found]


def test_all_findings_come_at_once(spark):
    assert findings(spark, sensor="bigint", celsius=None, unit="string", batch="int") == [
        ("violation", "missing_column", "celsius"), ("violation", "nullability_mismatch", "sensor"),
        ("violation", "type_mismatch", "sensor"), ("warning", "extra_column", "batch"), ("warning", "extra_column", "unit"),
    ]


def test_nullability_from_the_data(spark):
    kinds = "sensor string, taken_at timestamp, celsius double, valid boolean"
    df = spark.createDataFrame([("s1", at("2026-01-01"), None, None), (None, at("2026-01-02"), 3.5, True)], kinds)
    out = ct.validate_contracts(spark, [READINGS], {"readings": df}).collect()
    assert [(r["kind"], r["column"]) for r in out] == [("nullability_mismatch", "sensor")]
    assert ct.validate_contracts(spark, [READINGS], {"readings": df.where("sensor IS NOT NULL")}).isEmpty()


def test_type_categories(spark):
    schema = spark.createDataFrame(
        [], "a boolean, b tinyint, c bigint, d double, e decimal(5,2), f string, g timestamp, h timestamp_ntz, i date, j binary"
    ).schema
    assert [ct.type_category(f.dataType) for f in schema] == [
        "boolean", "integer", "integer", "numeric", "numeric", "text", "timestamp", "timestamp", "unknown", "unknown",
    ]


def test_missing_table_stops_the_check(spark):
    with pytest.raises(ct.ContractError):
        ct.validate_contracts(spark, [READINGS], {})


@pytest.mark.parametrize("text", ["{broken", "[]", '{"table": "t"}', '{"columns": []}', ""])
def test_broken_contract_files(tmp_path, text):
    (tmp_path / "c.json").write_text(text)
    with pytest.raises(ct.ContractError):
        ct.load_contract(tmp_path / "c.json")


def test_unreadable_contract_file(tmp_path):
    with pytest.raises(ct.ContractError):
        ct.load_contract(tmp_path / "none.json")


def test_yaml_contracts(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "w.yaml").write_text("table: w\ncolumns:\n  - {name: id, type: integer, nullable: false, pii: none}\n")
    assert ct.load_contracts(tmp_path)[0]["columns"][0]["name"] == "id"


def test_own_contracts_hold_for_the_source_tables(spark):
    tables = {name: empty(spark, schema) for name, schema in SOURCE_TABLES.items()}
    out, passed = reports.contracts_report(spark, tables, nullability="schema")
    assert passed and out.isEmpty()
    summary = ct.contract_summary(ct.contract_columns(spark, ct.load_contracts()), out).collect()
    assert [(r["table"], r["passed"]) for r in summary] == [("clicks", True), ("urls", True), ("users", True)]


def test_declared_personal_data(spark):
    out, passed = reports.pii_report(spark)
    assert passed
    assert [(r["table"], r["column"], r["category"]) for r in out.collect()] == [
        ("clicks", "hashed_ip", "pseudonymized"), ("clicks", "user_id", "pseudonymized"),
        ("urls", "user_id", "pseudonymized"), ("users", "email", "direct"),
    ]


@pytest.mark.parametrize("column", [{"name": "x", "type": "text", "nullable": True}, {"name": "x", "type": "text", "nullable": True, "pii": "maybe"}])
def test_every_column_needs_a_valid_class(spark, column):
    declared = ct.contract_columns(spark, [{"table": "t", "columns": [READINGS["columns"][0], column]}])
    with pytest.raises(ct.ContractError, match="t.x"):
        pii.pii_columns(declared)


def test_direct_personal_data_is_dropped(spark):
    users = spark.createDataFrame([(1, "a@example.com", "FREE")], "id bigint, email string, plan_type string")
    contract = next(c for c in ct.load_contracts() if c["table"] == "users")
    assert pii.without_direct_pii(users, contract).columns == ["id", "plan_type"]


def test_no_direct_personal_data_in_the_star():
    from clicklake.schemas import STAR_TABLES

    direct = {c["name"] for t in ct.load_contracts() for c in t["columns"] if c["pii"] == "direct"}
    assert direct and not direct & {name for schema in STAR_TABLES.values() for name in schema.names}


def test_repeated_values_ignore_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "code string")
    assert [tuple(r) for r in quality.repeated_values(df, "code").collect()] == [("a", 2)]


def test_changed_and_vanished_rows(spark):
    schema = "id bigint, a string, b string"
    before = spark.createDataFrame([(1, "x", "y"), (2, "x", None), (3, "ab", "c"), (4, "q", "q")], schema)
    after = spark.createDataFrame([(1, "x", "y"), (2, None, "x"), (3, "a", "bc"), (5, "n", "n")], schema)
    out = {r["id"]: r["change"] for r in quality.changed_rows(before, after, "id").collect()}
    assert out == {2: "changed", 3: "changed", 4: "vanished"}


def test_ids_must_follow_the_watermark(spark):
    batch = spark.createDataFrame([(5,), (6,), (3,), (None,)], "id bigint")
    assert tuple(quality.ids_above(batch, 4).first()) == (3, 6, 2)


def test_freshness(spark, runs):
    out = quality.freshness(lg.summary(runs), {"clicks": 60, "users": 60, "visits": 60}, at("2026-09-01T11:30:00"))
    rows = {r["source_table"]: (r["age_minutes"], r["is_late"]) for r in out.collect()}
    assert rows == {"clicks": (30, False), "users": (None, True), "visits": (None, True)}
