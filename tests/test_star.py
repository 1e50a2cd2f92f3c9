import os

import random

import pytest
from pyspark.sql import functions as F

from clicklake import fixtures as fx
from clicklake.operators import dims, facts
from clicklake.operators.dedup import freshest
from clicklake.operators.keys import number_rows
from clicklake.operators.lookup import hot_keys, lookup
from clicklake.operators.silver import clean_clicks, deduplicate_clicks
from clicklake.oracle import VIEWS
from clicklake.plans import ingest, metrics, refine
from clicklake.schemas import DIM_URL, STAR_KEYS, STAR_TABLES
from clicklake.session import scratch_path
from clicklake.sinks import tables as sinks
from helpers import at, plan_of


def test_calendar_equals_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    ours = sorted(map(tuple, dims.calendar(spark).collect()))
    assert len(ours) == 4018
    assert ours == sorted(duckdb.connect().execute(VIEWS["dim_date"]).fetchall())


def test_calendar_names_are_padded(spark):
    row = dims.calendar(spark).where("date_key = 20260901").first()
    assert (row["day_name"], row["month_name"], row["day_of_week"]) == ("Tuesday  ", "September", 2)


def test_devices_and_year_keys(spark):
    assert [tuple(r) for r in dims.devices(spark).collect()] == [(1, "mobile"), (2, "desktop"), (3, "tablet"), (4, "unknown")]
    assert dims.date_keys_of_year(dims.calendar(spark), 2024).count() == 366


def _check_numbers(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "k bigint").repartition(5)
    got = {r["k"]: r["n"] for r in number_rows(df, "k", "n").collect()}
    assert got == {k: i for i, k in enumerate(sorted(values), start=1)}


def test_numbers_are_dense_over_the_whole_range(spark):
    rng = random.Random(7)
    edge = [-(2**63), -(2**63) + 1, -1, 0, 1, 2**22 - 1, 2**22, 2**44, 2**44 + 1, 2**60, 2**62, 2**63 - 1]
    _check_numbers(spark, edge)
    _check_numbers(spark, list({rng.randrange(-(2**63), 2**63) for _ in range(300)}))
    _check_numbers(spark, list(range(2**22 - 150, 2**22 + 150)) + [2**45 + i for i in range(50)])


def test_no_number_window_spans_the_table(spark):
    plan = plan_of(number_rows(spark.range(10), "id", "n"))
    for window in plan.split("Window [row_number()")[1:]:
        assert window.startswith(" windowspecdefinition(_block")
    assert plan.count("SinglePartition") <= 1  # groups of blocks, at most 2^20 whatever the table


URL = "id bigint, short_code string, original_url string, created_at timestamp, is_active boolean"


def urls(spark, *rows):
    return spark.createDataFrame([(i, c, u, at("2026-01-05T00:00:00"), a) for i, c, u, a in rows], URL)


def test_upsert_keeps_keys_overwrites_attributes_and_adds(spark):
    first = dims.dim_url(urls(spark, (10, "a", "https://x.com/1", True), (20, "b", "https://y.com", True)))
    previous = spark.createDataFrame(first.collect(), first.schema)
    source = urls(spark, (5, "n", "https://z.com", True), (20, None, "https://w.com", False))
    rows = {r["url_id"]: r for r in dims.dim_url(source, previous).collect()}
    assert {i: r["url_key"] for i, r in rows.items()} == {10: 1, 20: 2, 5: 3}
    assert (rows[20]["short_code"], rows[20]["original_url_domain"], rows[20]["is_active"]) == (None, "w.com", False)
    assert (rows[10]["short_code"], rows[10]["is_active"]) == ("a", True)


def test_malformed_urls_have_no_domain(spark):
    rows = dims.url_attributes(urls(spark, (1, "a", "not a url", True), (2, "b", "https://h.org:8080/p?q=1", True)))
    assert {r["url_id"]: r["original_url_domain"] for r in rows.collect()} == {1: None, 2: "h.org"}


def test_freshest_version_wins(spark):
    df = spark.createDataFrame([(1, "old", 1, 1), (1, "new", 2, 1), (1, "tie", 2, 2), (2, "only", 1, 1)], "id int, v string, t int, s int")
    assert {r["id"]: r["v"] for r in freshest(df, ["id"], ["t", "s"]).collect()} == {1: "tie", 2: "only"}


def test_users_have_no_address_but_an_unknown_member(spark):
    users = spark.createDataFrame([(3, "a@example.com", "FREE")], "id bigint, email string, plan_type string")
    out = dims.dim_user(users)
    assert out.columns == ["user_key", "user_id", "plan_type", "is_known"]
    assert sorted(map(tuple, out.collect())) == [(-1, -1, "UNKNOWN", False), (1, 3, "FREE", True)]
    again = dims.dim_user(users, spark.createDataFrame(out.collect(), out.schema))
    assert sorted(map(tuple, again.collect())) == [(-1, -1, "UNKNOWN", False), (1, 3, "FREE", True)]


def test_seed_inserts_do_not_repeat(spark):
    devices = dims.devices(spark)
    assert dims.insert_missing(devices, devices, "device_type").isEmpty()
    assert dims.insert_missing(devices.limit(1), devices, "device_type").count() == 3


def test_hot_keys_are_few_by_arithmetic(spark):
    df = spark.range(1000).selectExpr("IF(id < 400, 'hot', concat('k', id)) AS k")
    assert [tuple(r) for r in hot_keys(df, ["k"], 0.3).collect()] == [("k", "hot")]
    assert hot_keys(spark.range(1000).selectExpr("id % 3 AS k", "id % 2 AS j"), ["k", "j"], 0.2).count() == 5


def test_skew_safe_lookup_equals_the_plain_join(spark):
    rows = spark.range(4000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('k', id % 2900) END AS k", "id * 2 AS other"
    )
    members = spark.range(2000).selectExpr("IF(id = 0, 'hot', concat('k', id)) AS k", "CAST(id AS INT) AS v")
    plain = sorted(map(str, lookup(rows, members, "k", "v", "id").select("id", "k", "other", "v").collect()))
    safe = lookup(rows, members, "k", "v", "id", broadcast_bytes=0)
    assert sorted(map(str, safe.select("id", "k", "other", "v").collect())) == plain


def test_unmatched_rows_spread_in_the_shuffled_lookup(spark):
    rows = spark.range(100).selectExpr("id", "IF(id % 5 = 9, 'a', NULL) AS k")
    plan = plan_of(lookup(rows, spark.createDataFrame([("a", 1)], "k string, v int"), "k", "v", "id", broadcast_bytes=0))
    assert "hashpartitioning(_probe" in plan and "_slot" in plan.split("hashpartitioning(_probe")[1][:40]


def test_hot_and_missing_keys_spread_evenly(spark):
    """A third of the rows on one key and a third without: no partition of the shuffle stands out."""
    rows = spark.range(30_000).selectExpr(
        "id", "CASE id % 3 WHEN 0 THEN 7 WHEN 1 THEN NULL ELSE 1000 + id % 5000 END AS k"
    )
    members = spark.range(6000).selectExpr("id AS k", "CAST(id AS INT) AS v")
    settings = {
        "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = lookup(rows, members, "k", "v", "id", broadcast_bytes=0)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        found = joined.where("v IS NOT NULL").count()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(sizes) == 30_000 and found == 20_000
    assert len(sizes) == 8 and max(sizes) < 1.5 * 30_000 / 8


def _parts(spark, sf):
    silver = deduplicate_clicks(clean_clicks(fx.bronze_clicks(spark, sf)))
    return silver, dims.calendar(spark), dims.dim_url(fx.src_urls(spark, sf)), dims.dim_user(fx.src_users(spark, sf)), dims.devices(spark)


def test_fact_does_not_depend_on_the_join_strategy(spark, sf):
    parts = _parts(spark, sf)
    plain = sorted(map(str, facts.resolve_clicks(*parts).collect()))
    assert sorted(map(str, facts.resolve_clicks(*parts, broadcast_bytes=0).collect())) == plain


def test_clicks_are_either_facts_or_rejects(spark, sf):
    silver, *rest = _parts(spark, sf)
    resolved = facts.resolve_clicks(silver, *rest)
    assert facts.fact_clicks(resolved).count() + facts.fact_rejects(resolved).count() == silver.count()


CLICK = "click_id bigint, short_code string, occurred_at timestamp, device_type string, hashed_ip string, user_id bigint"


def test_key_resolution_rules(spark):
    day = at("2026-01-05T12:00:00")
    silver = spark.createDataFrame(
        [(1, "a", day, "mobile", None, 3), (2, "a", day, "tablet", None, None), (3, "a", day, "mobile", None, 99),
         (4, "zz", day, "mobile", None, 3), (5, "a", at("1999-01-01T00:00:00"), "mobile", None, 3),
         (6, "a", day, "mobile", None, -1)],
        CLICK,
    )
    url = dims.dim_url(urls(spark, (8, "a", "https://x.com", True), (9, "a", "https://x.com", True), (10, None, "https://x.com", True)))
    user = dims.dim_user(spark.createDataFrame([(3, "e", "FREE")], "id bigint, email string, plan_type string"))
    resolved = facts.resolve_clicks(silver, dims.calendar(spark), url, user, dims.devices(spark))
    rows = {r["click_id"]: r for r in resolved.collect()}
    assert len(rows) == resolved.count() == 6
    assert (rows[1]["url_key"], rows[1]["user_key"], rows[1]["device_key"], rows[1]["date_key"]) == (1, 1, 1, 20260105)
    assert {i: (r["user_key"], r["user_unresolved"]) for i, r in rows.items() if i in (2, 3, 6)} == {
        2: (-1, False), 3: (-1, True), 6: (-1, True),
    }
    assert (rows[4]["reject_reason"], rows[5]["reject_reason"]) == ("unknown_url", "unknown_date")


def test_foreign_key_violations_are_counted_per_row(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "url_key int")
    report = facts.foreign_key_violations(child, {"url_key": spark.createDataFrame([(2,)], "url_key int")})
    assert tuple(report.first()) == ("url_key", 2)


def test_metrics_equal_plain_sql(spark, sf):
    silver, date, url, user, device = _parts(spark, sf)
    star = {"dim_date": date, "dim_url": url, "dim_user": user, "dim_device": device,
            "fact_clicks": facts.fact_clicks(facts.resolve_clicks(silver, date, url, user, device))}
    gold = scratch_path(spark, "metrics")
    for name, df in star.items():
        df.write.parquet(f"{gold}/{name}")
        star[name] = spark.read.parquet(f"{gold}/{name}")
        star[name].createOrReplaceTempView(name)

    def plain(attribute, dim, key, extra=""):
        return f"SELECT {attribute}, count(*) FROM fact_clicks f JOIN {dim} d ON f.{key} = d.{key} WHERE click_id >= 300 {extra} GROUP BY 1"

    expected = {
        "total_clicks_per_url": plain("d.short_code", "dim_url", "url_key"),
        "clicks_over_time": plain("full_date", "dim_date", "date_key"),
        "clicks_by_device_type": plain("device_type", "dim_device", "device_key"),
        "top_10_urls_by_clicks": plain("d.short_code", "dim_url", "url_key") + " ORDER BY 2 DESC, 1 LIMIT 10",
        "anonymous_vs_attributed_share": plain("is_known", "dim_user", "user_key"),
        "clicks_by_plan_type": plain("plan_type", "dim_user", "user_key", "AND is_known"),
        "clicks_by_destination_domain": plain("original_url_domain", "dim_url", "url_key"),
        "active_vs_inactive_url_share": plain("is_active", "dim_url", "url_key"),
    }
    assert metrics.CATALOGUE.keys() == expected.keys()
    for name, sql in expected.items():
        assert sorted(map(tuple, metrics.metric(name, star, 300).collect()), key=str) == sorted(map(tuple, spark.sql(sql).collect()), key=str), name


def test_star_tables_are_created_once(spark, tmp_path):
    gold = str(tmp_path)
    sinks.create_star_tables(spark, gold)
    dims.devices(spark).write.mode("append").parquet(f"{gold}/dim_device")
    sinks.create_star_tables(spark, gold)
    star = refine.read_star(spark, gold)
    assert star["dim_device"].count() == 4
    for name, schema in STAR_TABLES.items():
        assert [(f.name, f.dataType) for f in star[name].schema] == [(f.name, f.dataType) for f in schema]


def test_delete_range_keeps_null_keys(spark):
    df = spark.createDataFrame([(1,), (900,), (901,), (None,)], "id bigint")
    assert sorted((r["id"] is None, r["id"]) for r in sinks.delete_rows(df, "id", 900).collect()) == [(False, 1), (True, None)]


@pytest.fixture(scope="module")
def built_lake(spark, tmp_path_factory):
    """Two days of loads, through every layer."""
    lake = str(tmp_path_factory.mktemp("lake"))
    times = iter([at("2026-09-01T08:00:00")] * 6 + [at("2026-09-02T08:00:00")] * 6)
    ledger = ingest.Ledger(spark, lake, lambda: next(times))
    user = spark.createDataFrame([(3, "e@example.com", "FREE", at("2026-01-01T00:00:00"))], "id bigint, email string, plan_type string, created_at timestamp")
    click = "id bigint, short_code string, occurred_at timestamp, device_type string, hashed_ip string, user_id bigint"
    day = at("2026-09-01T10:00:00")
    clicks = [(1, "a", day, "mobile", None, 3), (2, " b ", day, "TV", None, None), (3, "", day, "mobile", None, None), (4, "zz", day, "tablet", None, 8)]
    first = {"urls": urls(spark, (10, "a", "https://x.com", True), (20, "b", "https://y.com", True)), "users": user,
             "clicks": spark.createDataFrame(clicks, click)}
    assert ingest.run_pipeline(lambda t: first[t], lake, ledger).ok
    stats = [refine.silver_job(spark, lake)]
    refine.gold_job(spark, lake)
    keys = {r["url_id"]: r["url_key"] for r in refine.read_star(spark, f"{lake}/gold")["dim_url"].collect()}
    later = clicks + [(5, "c", at("2026-09-02T10:00:00"), "mobile", None, 3)]
    second = {"urls": urls(spark, (5, "c", "https://z.com", True), (10, "a", "https://x.com", False)), "users": user,
              "clicks": spark.createDataFrame(later, click)}
    assert ingest.run_pipeline(lambda t: second[t], lake, ledger).ok
    ingest.write_local_snapshot(lambda t: second[t], lake, "clicks", "2026-09-02")
    stats.append(refine.silver_job(spark, lake, own_files=True))
    refine.gold_job(spark, lake)
    return lake, stats, keys


def test_silver_job_counts(built_lake):
    _, stats, _ = built_lake
    assert stats[0] == {"bronze_rows": 4, "invalid_rows_dropped": 1, "duplicate_rows_removed": 0, "silver_rows": 3}
    assert stats[1] == {"bronze_rows": 10, "invalid_rows_dropped": 2, "duplicate_rows_removed": 4, "silver_rows": 4}


def test_gold_job_keeps_keys_over_runs(spark, built_lake):
    lake, _, keys = built_lake
    star = refine.read_star(spark, f"{lake}/gold")
    rows = {r["url_id"]: r for r in star["dim_url"].collect()}
    assert keys == {10: 1, 20: 2}
    assert {i: r["url_key"] for i, r in rows.items()} == {10: 1, 20: 2, 5: 3}
    assert (rows[10]["is_active"], rows[20]["is_active"]) == (False, True)
    assert star["dim_device"].count() == 4 and star["dim_user"].count() == 2


def test_gold_fact(spark, built_lake):
    lake, _, _ = built_lake
    fact = refine.read_star(spark, f"{lake}/gold")["fact_clicks"]
    rows = {r["click_id"]: r for r in fact.collect()}
    assert sorted(rows) == [1, 2, 5]
    assert (rows[2]["url_key"], rows[2]["user_key"], rows[2]["device_key"]) == (2, -1, 4)
    assert all(r["row_loaded_at"] is not None and r["click_count"] == 1 for r in rows.values())
    rejects = refine.read_rejects(spark, f"{lake}/gold").collect()
    assert [(r["click_id"], r["reject_reason"]) for r in rejects] == [(4, "unknown_url")]
    assert "PartitionFilters: [isnotnull(date_key" in plan_of(fact.where("date_key > 20260901"))


def test_a_big_fact_lies_in_one_directory_per_day(spark, built_lake, tmp_path):
    lake, gold = built_lake[0], str(tmp_path / "gold")
    silver = spark.read.parquet(f"{lake}/silver/clicks")
    urls, users = (spark.read.parquet(f"{lake}/bronze/{t}/ingestion_date=2026-09-02") for t in ("urls", "users"))
    refine.publish_star(gold, urls, users, silver, by_day=True)
    pruned = refine.read_star(spark, gold)["fact_clicks"].where("date_key = 20260902")
    assert "PartitionFilters: [isnotnull(date_key" in plan_of(pruned)
    assert [r["click_id"] for r in pruned.collect()] == [5]
    rejects = refine.read_rejects(spark, gold).collect()
    assert sorted((r["click_id"], r["reject_reason"]) for r in rejects) == [(2, "unknown_url"), (4, "unknown_url")]


def test_split_publish_makes_every_table(spark, tmp_path):
    paths = {"a": str(tmp_path / "a"), "b": str(tmp_path / "b")}
    df = spark.range(4).selectExpr("id", "IF(id < 3, 'a', 'b') AS t")
    sinks.publish_split(df, "t", paths)
    assert [spark.read.parquet(p).count() for p in paths.values()] == [3, 1]
    sinks.publish_split(df.where("id < 2"), "t", paths)
    assert [spark.read.parquet(p).count() for p in paths.values()] == [2, 0]
    assert spark.read.parquet(paths["b"]).columns == ["id"]

def test_gold_keys_are_unique(spark, built_lake):
    from clicklake.operators.quality import key_report
    from clicklake.schemas import STAR_LENGTHS

    star = refine.read_star(spark, f"{built_lake[0]}/gold")
    for name in STAR_TABLES:
        assert key_report(star[name], name, STAR_KEYS[name], STAR_LENGTHS[name]).where("violations > 0").isEmpty()


def test_explore_job(spark, built_lake):
    lake = built_lake[0]
    assert refine.explore_job(spark, lake) == 5
    assert spark.read.parquet(f"{lake}/explore/clicks").columns == ["id", "short_code", "occurred_at", "device_type"]


def test_failed_publish_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.publish(spark.range(3), path)
    broken = spark.range(5).withColumn("id", F.when(F.col("id") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        sinks.publish(broken, path)
    assert spark.read.parquet(path).count() == 3
    sinks.publish(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_dim_url_schema_of_the_stored_table(spark, built_lake):
    stored = spark.read.parquet(f"{built_lake[0]}/gold/dim_url")
    assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in DIM_URL]


@pytest.mark.parametrize("step", range(4))
def test_a_swap_that_dies_loses_nothing(spark, built_lake, tmp_path, monkeypatch, step):
    """The swap is ended after each of its moves; the next run finds all members, keys and clicks."""
    import shutil

    from clicklake.sinks import tables

    lake = str(tmp_path / "lake")
    shutil.copytree(built_lake[0], lake)
    before = sorted(map(str, refine.read_star(spark, f"{lake}/gold")["dim_url"].select("url_id", "url_key").collect()))
    clicks = refine.read_star(spark, f"{lake}/gold")["fact_clicks"].count()
    moves, move = [], tables._move

    def dying(files, source, target):
        if "dim_url" in target.toString() + source.toString():
            moves.append(1)
            if len(moves) > step:
                raise KeyboardInterrupt
        move(files, source, target)

    monkeypatch.setattr(tables, "_move", dying)
    try:
        refine.gold_job(spark, lake)
    except KeyboardInterrupt:
        pass
    monkeypatch.setattr(tables, "_move", move)
    refine.gold_job(spark, lake)
    star = refine.read_star(spark, f"{lake}/gold")
    assert sorted(map(str, star["dim_url"].select("url_id", "url_key").collect())) == before
    assert star["fact_clicks"].count() == clicks


def test_a_lost_dimension_is_an_error(spark, built_lake, tmp_path):
    import shutil

    lake = str(tmp_path / "lake")
    shutil.copytree(built_lake[0], lake)
    os.rename(f"{lake}/gold/dim_url", f"{lake}/elsewhere")
    with pytest.raises(FileNotFoundError, match="dim_url"):
        refine.gold_job(spark, lake)
