"""Versioned tables, and Silver and Gold that take in only what is new."""

import os
import random

import pytest
from pyspark.sql import functions as F

from clicklake.plans import increments, refine
from clicklake.schemas import FACT_CLICKS, SOURCE_TABLES, conform
from clicklake.sinks import tables as sinks
from clicklake.sinks.versions import WHOLE, Dataset, Outdated, added, replaced
from clicklake.streaming import silver_stream
from helpers import BRONZE_CLICK, at

DAY = "2024-03-0{}T10:00:00"


def clicks(spark, rows):
    """(id, day, code) -> Bronze clicks."""
    full = [(i, c, at(DAY.format(d)) if d else None, "mobile", None, u) for i, d, c, u in ((*r, None)[:4] for r in rows)]
    return spark.createDataFrame(full, BRONZE_CLICK)


def load(spark, lake, name, rows):
    clicks(spark, rows).coalesce(1).write.mode("overwrite").parquet(f"{lake}/bronze/clicks/ingestion_date={name}")


def ids(spark, lake):
    return sorted(r.click_id for r in increments.read_silver(spark, lake).collect())


def silver_now(spark, lake):
    return increments.silver_dataset(spark, lake).current()


# --- Versions ------------------------------------------------------------------------------------


@pytest.fixture
def data(spark, tmp_path):
    return Dataset(spark, f"{tmp_path}/set")


def numbers(data, version=None):
    version = version or data.current()
    return sorted(r.id for r in data.read(version, "t", data.spark.range(0).schema).collect())


def test_a_reader_sees_one_version_between_any_two_steps(spark, data, monkeypatch):
    """Two tables change together; whoever looks at any moment sees both before or both after."""
    schema, seen, reader = spark.range(0).schema, [], Dataset(spark, data.root)

    def look():
        version = reader.current()
        seen.append(tuple(tuple(sorted(r.id for r in reader.read(version, name, schema).collect())) for name in ("t", "u")))

    def watched(step):
        def run(*args):
            look()
            out = step(*args)
            look()
            return out

        return run

    for name in ("stage", "_create", "_names"):
        monkeypatch.setattr(data, name, watched(getattr(data, name)))
    monkeypatch.setattr("os.link", watched(os.link))
    data.change(lambda base: ({"t": data.stage(spark.range(3), "t"), "u": data.stage(spark.range(5, 7), "u")}, {}))
    data.change(lambda base: ({"t": data.stage(spark.range(1), "t"), "u": data.stage(spark.range(9, 10), "u")}, {}))
    assert set(seen) == {((), ()), ((0, 1, 2), (5, 6)), ((0,), (9,))}


def test_of_two_writers_one_loses(spark, data):
    base = data.commit(data.current(), {"t": data.stage(spark.range(1), "t")}, {"by": "first"})
    data.commit(base, {"t": added(base.tables["t"], data.stage(spark.range(5, 6), "t"))}, {"by": "second"})
    with pytest.raises(Outdated):
        data.commit(base, {"t": {}}, {"by": "third"})
    assert numbers(data) == [0, 5] and data.current().notes == {"by": "second"} and data.numbers() == [1, 2]
    assert numbers(data, data.version(1)) == [0]


def test_a_change_starts_again_from_the_newer_version(spark, data):
    tries = []

    def build(base):
        tries.append(base.number)
        if len(tries) == 1:
            data.commit(data.current(), {"t": data.stage(spark.range(7, 8), "t")}, {})
        return {"t": added(base.tables.get("t", {}), data.stage(spark.range(1), "t"))}, {}

    data.change(build)
    assert tries == [0, 1] and numbers(data) == [0, 7]
    with pytest.raises(Outdated):
        data.change(lambda base: data.commit(base, {}, {}) and ({}, {}), attempts=2)
    assert data.change(lambda base: None) == data.current()


def test_a_writer_that_dies_leaves_nothing_to_see(spark, data, monkeypatch):
    data.change(lambda base: ({"t": data.stage(spark.range(2), "t")}, {}))

    def die(base):
        data.stage(spark.range(100), "t")
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError, match="executor lost"):
        data.change(die)
    monkeypatch.setattr("os.link", lambda *a: (_ for _ in ()).throw(OSError("disk full")))
    with pytest.raises(OSError, match="disk full"):
        data.change(lambda base: ({"t": data.stage(spark.range(50), "t")}, {}))
    monkeypatch.undo()
    assert numbers(data) == [0, 1] and data.numbers() == [1]
    assert data.vacuum() == 0, "what is young may still be named"
    assert data.vacuum(older_than_s=-5) == 2 and numbers(data) == [0, 1]
    for k in range(4):
        data.change(lambda base, k=k: ({"t": data.stage(spark.range(k, k + 1), "t")}, {}))
    assert data.vacuum(keep=2, older_than_s=-5) == 3
    assert data.numbers() == [4, 5] and numbers(data) == [3] and numbers(data, data.version(4)) == [2]


def test_parts(spark, data):
    rows = spark.range(6).selectExpr("id", "CAST(id % 3 AS INT) AS k")
    parts = data.stage(rows, "t", "k")
    assert sorted(parts) == ["0", "1", "2"] and data.stage(rows.limit(0), "t", "k") == {}
    version = data.commit(data.current(), {"t": parts}, {})
    assert sorted(map(tuple, data.read(version, "t", rows.schema, data.folders(version, "t", [1, 5])).collect())) == [(1, 1), (4, 1)]
    assert added({"a": ["x"]}, {"a": ["y"], "b": ["z"]}) == {"a": ["x", "y"], "b": ["z"]}
    assert replaced({"a": ["x"], "b": ["y"], "c": ["z"]}, ["a", "b"], {"a": ["w"]}) == {"a": ["w"], "c": ["z"]}
    assert WHOLE in data.stage(rows, "t")


# --- Silver --------------------------------------------------------------------------------------


def test_loads_are_worked_in_once_and_untouched_days_keep_their_files(spark, tmp_path):
    lake = str(tmp_path)
    load(spark, lake, "1", [(1, 1, "a"), (2, 2, "b"), (2, 2, "b"), (3, 3, "c"), (None, 3, "c"), (4, None, "c"), (5, 3, " ")])
    first = increments.silver_increment(spark, lake)
    assert first == {"loads": 1, "bronze_rows": 7, "usable": 4, "distinct": 3, "silver_rows_added": 3, "days_touched": 3}
    before = silver_now(spark, lake)
    assert increments.silver_increment(spark, lake)["loads"] == 0 and silver_now(spark, lake) == before
    load(spark, lake, "2", [(3, 3, "c"), (1, 1, "a"), (6, 3, "d"), (7, 4, "e"), (7, 4, "e")])
    second = increments.silver_increment(spark, lake)
    assert second == {"loads": 1, "bronze_rows": 5, "usable": 5, "distinct": 4, "silver_rows_added": 2, "days_touched": 2}
    after = silver_now(spark, lake)
    kept, grown = before.tables["clicks"], after.tables["clicks"]
    assert grown["20240301"] == kept["20240301"] and grown["20240302"] == kept["20240302"]
    assert grown["20240303"][:1] == kept["20240303"] and len(grown["20240303"]) == 2 and len(grown["20240304"]) == 1
    assert ids(spark, lake) == [1, 2, 3, 6, 7]


def test_a_click_that_comes_again_on_another_day_is_known(spark, tmp_path):
    lake = str(tmp_path)
    load(spark, lake, "1", [(1, 1, "a")])
    increments.silver_increment(spark, lake)
    load(spark, lake, "2", [(1, 5, "changed"), (2, 5, "b")])
    increments.silver_increment(spark, lake)
    rows = {r.click_id: r.short_code for r in increments.read_silver(spark, lake).collect()}
    assert rows == {1: "a", 2: "b"}


def test_a_load_that_was_replaced_is_worked_in_again(spark, tmp_path):
    lake = str(tmp_path)
    load(spark, lake, "1", [(1, 1, "a")])
    increments.silver_increment(spark, lake)
    load(spark, lake, "1", [(1, 1, "a"), (2, 1, "b")])
    assert increments.silver_increment(spark, lake)["silver_rows_added"] == 1
    assert ids(spark, lake) == [1, 2]


def test_only_new_folders_and_the_chunks_of_their_ids_are_read(spark, tmp_path, monkeypatch):
    lake, far = str(tmp_path), 40_000_000_000
    load(spark, lake, "1", [(1, 1, "a"), (far, 2, "b")])
    increments.silver_increment(spark, lake)
    opened, read = [], Dataset.read
    monkeypatch.setattr(Dataset, "read", lambda self, version, table, schema, folders=None: opened.append((table, folders)) or read(self, version, table, schema, folders))
    asked = []
    monkeypatch.setattr(increments, "read_folders", lambda s, folders, t, f=increments.read_folders: asked.append(folders) or f(s, folders, t))
    base = silver_now(spark, lake)
    load(spark, lake, "2", [(far + 1, 2, "c"), (far, 2, "b")])
    increments.silver_increment(spark, lake)
    assert [x.split("ingestion_date=")[1] for x in asked[0]] == ["2/*.parquet"]
    index = [f for t, f in opened if t == "ids"][0]
    assert len(base.tables["ids"]) == 2 and index and len(index) == 1
    assert not set(x for t, f in opened if t == "clicks" for x in f) & set(x for p in base.tables["clicks"].values() for x in p)


def test_bitmaps_know_every_id(spark):
    draw = random.Random(4)
    values = {0, -1, 1, -32768, 32767, 32768, 32769, 2**31, -(2**31), 2**62, -(2**62), 2**63 - 1, -(2**63) + 1}
    values |= {draw.randrange(-(10**6), 10**6) for _ in range(500)} | {draw.randrange(2**62) for _ in range(50)}
    have = spark.createDataFrame([(v,) for v in values], "click_id bigint")
    index = increments.id_index(have).unionByName(increments.id_index(have.where("click_id % 3 = 0")))
    around = {v + d for v in values for d in (-1, 0, 1, 32768) if -(2**63) < v + d < 2**63}
    asked = spark.createDataFrame([(v,) for v in around], "click_id bigint")
    assert {r.click_id for r in increments.without_known(asked, index).collect()} == around - values


def test_compaction_changes_no_row(spark, tmp_path):
    lake = str(tmp_path)
    for k in range(4):
        load(spark, lake, str(k), [(k, 1, "a"), (10 + k, 2 + (k == 0), "b")])
        increments.silver_increment(spark, lake)
    silver, before = increments.silver_dataset(spark, lake), ids(spark, lake)
    kept = silver.current().tables["clicks"]
    assert increments.compact(silver, "clicks", increments.VERSIONED_CLICKS, "day", 3, ["click_id"]) == 1
    after = silver.current().tables["clicks"]
    assert {p: len(f) for p, f in after.items()} == {"20240301": 1, "20240302": 3, "20240303": 1}
    assert after["20240302"] == kept["20240302"] and ids(spark, lake) == before
    assert increments.compact(silver, "clicks", increments.VERSIONED_CLICKS, "day", 3) == 0
    load(spark, lake, "9", [(0, 1, "a"), (99, 1, "a")])
    assert increments.silver_increment(spark, lake)["silver_rows_added"] == 1


def test_the_stream_keeps_no_state_and_takes_late_and_repeated_clicks_once(spark, tmp_path):
    lake, source = f"{tmp_path}/lake", f"{tmp_path}/source"
    for k, rows in enumerate([[(1, 5, "a"), (2, 5, "b")], [(2, 5, "b"), (3, 1, "late"), (1, 5, "a")], [(3, 1, "late")]]):
        conform(clicks(spark, rows), SOURCE_TABLES["clicks"]).coalesce(1).write.parquet(f"{source}/batch{k}")
        found = silver_stream.merge_available(silver_stream.bronze_stream(spark, source), lake, f"{tmp_path}/checkpoint")
        assert found["silver_rows_added"] == [2, 1, 0][k]
    assert ids(spark, lake) == [1, 2, 3]
    assert not os.path.exists(f"{tmp_path}/checkpoint/state"), "a stateful stream keeps its state there"


# --- Gold ----------------------------------------------------------------------------------------


def snapshot(spark, lake, day, codes, users):
    urls = spark.createDataFrame([(i, c, f"https://{c}.example/x", at("2024-01-01T00:00:00"), None, None, True, None) for i, c in codes], SOURCE_TABLES["urls"])
    people = spark.createDataFrame([(u, f"{u}@x", "FREE", at("2024-01-01T00:00:00")) for u in users], SOURCE_TABLES["users"])
    sinks.write_snapshot(urls, lake, "urls", day)
    sinks.write_snapshot(people, lake, "users", day)


def facts(spark, lake):
    star = increments.read_gold(spark, lake)
    rows = star["fact_clicks"].join(star["dim_url"], "url_key").join(star["dim_user"].select("user_key", "user_id"), "user_key")
    return sorted((r.click_id, r.date_key, r.url_id, r.user_id) for r in rows.collect())


def test_late_members_release_clicks_and_mend_facts(spark, tmp_path, monkeypatch):
    lake = str(tmp_path)
    load(spark, lake, "1", [(1, 1, "a", 7.0), (2, 2, "late", None), (3, 3, "a", 8.0), (4, 4, "never", 7.0), (5, 1, "late", 8.0)])
    snapshot(spark, lake, "2024-03-01", [(10, "a")], [7])
    increments.silver_increment(spark, lake)
    assert increments.gold_increment(spark, lake) == {"clicks": 5, "released": 0, "users_found": 0, "days_rewritten": 0}
    assert facts(spark, lake) == [(1, 20240301, 10, 7), (3, 20240303, 10, -1)]
    before = increments.gold_dataset(spark, lake).current()

    load(spark, lake, "2", [(6, 2, "a", 8.0), (1, 1, "a", 7.0)])
    snapshot(spark, lake, "2024-03-02", [(10, "a"), (11, "late")], [7, 8])
    increments.silver_increment(spark, lake)
    opened, read = [], Dataset.read
    monkeypatch.setattr(Dataset, "read", lambda self, version, table, schema, folders=None: opened.append((table, folders)) or read(self, version, table, schema, folders))
    assert increments.gold_increment(spark, lake) == {"clicks": 1, "released": 2, "users_found": 1, "days_rewritten": 1}
    monkeypatch.undo()
    old = {x for p in increments.silver_dataset(spark, lake).version(1).tables["clicks"].values() for x in p}
    assert not old & {x for t, f in opened if t == "clicks" for x in f}, "old Silver was read"
    want = [(1, 20240301, 10, 7), (2, 20240302, 11, -1), (3, 20240303, 10, 8), (5, 20240301, 11, 8), (6, 20240302, 10, 8)]
    assert facts(spark, lake) == want
    after = increments.gold_dataset(spark, lake).current()
    assert after.tables["fact_clicks"]["20240301"][:1] == before.tables["fact_clicks"]["20240301"], "a day without a found user keeps its files"
    assert [r.click_id for r in increments.read_gold(spark, lake)["fact_rejects"].collect()] == [4]

    # The same by a rebuild from all.
    refine.silver_job(spark, lake)
    refine.gold_job(spark, lake)
    star = refine.read_star(spark, f"{lake}/gold")
    rebuilt = star["fact_clicks"].join(star["dim_url"], "url_key").join(star["dim_user"].select("user_key", "user_id"), "user_key")
    assert sorted((r.click_id, r.date_key, r.url_id, r.user_id) for r in rebuilt.collect()) == want


def test_gold_takes_no_click_twice_after_a_compaction(spark, tmp_path):
    lake = str(tmp_path)
    snapshot(spark, lake, "2024-03-01", [(10, "a")], [7])
    for k in range(3):
        load(spark, lake, str(k), [(k, 1, "a")])
        increments.silver_increment(spark, lake)
        if k == 1:
            increments.gold_increment(spark, lake)
    increments.compact(increments.silver_dataset(spark, lake), "clicks", increments.VERSIONED_CLICKS, "day", 2)
    assert increments.gold_increment(spark, lake)["clicks"] == 1
    assert [f[0] for f in facts(spark, lake)] == [0, 1, 2]
    assert increments.gold_increment(spark, lake)["clicks"] == 0 and len(facts(spark, lake)) == 3
    gold = increments.gold_dataset(spark, lake)
    assert increments.compact(gold, "fact_clicks", FACT_CLICKS, "date_key", 1) == 1 and len(facts(spark, lake)) == 3


def test_dimension_keys_stay(spark, tmp_path):
    lake = str(tmp_path)
    load(spark, lake, "1", [(1, 1, "b")])
    increments.silver_increment(spark, lake)
    keys = []
    for day, codes in (("2024-03-01", [(20, "b")]), ("2024-03-02", [(10, "a"), (20, "b")])):
        snapshot(spark, lake, day, codes, [])
        increments.gold_increment(spark, lake)
        keys.append({r.url_id: r.url_key for r in increments.read_gold(spark, lake)["dim_url"].collect()})
    assert keys == [{20: 1}, {20: 1, 10: 2}]
    assert increments.read_gold(spark, lake)["dim_user"].where(F.col("user_key") == -1).count() == 1
