import pytest
from pyspark.sql import functions as F

from clicklake.functions.columns import scatter, weighted_choice, zero_padded
from clicklake.schemas import CLICKS, conform
from clicklake.sinks import formats as out
from clicklake.sinks import tables as sinks
from clicklake.sources import formats, generators
from clicklake.streaming import silver_stream
from helpers import at, plan_of

NOW = at("2026-09-01T12:00:00")


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("formats")
    clicks = generators.weighted_clicks(generators.numbers(spark, 3000))
    # Texts that formats like to change: blanks at the ends, emptiness, quotes, line breaks.
    odd = spark.createDataFrame(
        [(9001, " a ", at("2026-01-01T00:00:00.000001"), "", None, None), (9002, 'q"u,o\\te', NOW, "x", "é", 1)], CLICKS
    )
    clicks = conform(clicks, CLICKS).unionByName(odd)
    paths = {fmt: str(root / fmt) for fmt in formats.FORMATS}
    for fmt, path in paths.items():
        out.write(clicks, path, fmt, r"\N")
    return clicks, paths


@pytest.mark.parametrize("fmt", formats.FORMATS)
def test_round_trip(spark, files, fmt):
    clicks, paths = files
    back = formats.scan(spark, paths[fmt], fmt, null_text=r"\N")
    assert sorted(map(str, back.collect())) == sorted(map(str, clicks.collect()))


def test_empty_csv_fields_are_null_by_default(spark, tmp_path):
    (tmp_path / "c.csv").write_text("id,short_code,occurred_at,device_type,hashed_ip,user_id\n1,a,2026-01-01T00:00:00Z,\"\",,\n")
    row = formats.scan(spark, str(tmp_path / "c.csv"), "csv").first()
    assert (row["id"], row["device_type"], row["hashed_ip"], row["user_id"]) == (1, None, None, None)


@pytest.mark.parametrize("fmt", formats.FORMATS)
def test_one_column(spark, files, fmt):
    clicks, paths = files
    column = formats.scan(spark, paths[fmt], fmt, columns=["device_type"])
    assert column.columns == ["device_type"] and column.count() == clicks.count()
    if fmt == "parquet":
        assert "ReadSchema: struct<device_type:string>" in plan_of(column)


def test_sizes_relative_to_parquet(spark, files):
    row = out.size_ratios(spark, {"synthetic": files[1]}).first()
    assert row["csv_ratio"] > 1 and row["json_ratio"] > row["csv_ratio"]
    assert row["csv_ratio"] == round(row["csv"] / row["parquet"], 2)


def test_peek(spark, files):
    assert formats.peek(spark, files[1]["parquet"]).count() == 5


def test_repartitioning_keeps_the_rows(spark):
    df = spark.range(100)
    for n in (1, 4, 50):
        moved = sinks.repartitioned(df, n)
        assert moved.rdd.getNumPartitions() == n
        assert moved.agg(F.sum("id")).first()[0] == 4950


def test_stream_takes_each_click_once_over_runs(spark, tmp_path):
    root, target, checkpoint = (str(tmp_path / n) for n in ("bronze", "silver", "checkpoint"))
    clicks = conform(generators.weighted_clicks(generators.numbers(spark, 50)), CLICKS)

    def run():
        stream = silver_stream.bronze_stream(silver_stream.stream_session(spark), root)
        silver_stream.run_available(silver_stream.distinct_clicks(stream), target, checkpoint)
        return spark.read.parquet(target)

    clicks.where("id <= 30").write.parquet(f"{root}/ingestion_date=2026-09-01")
    assert run().count() == 30
    clicks.where("id > 20").write.parquet(f"{root}/incremental/watermark_start=000000000020/watermark_end=000000000050")
    once = run()
    assert once.count() == once.select("click_id").distinct().count() == 50
    assert run().count() == 50


def test_stream_keeps_clicks_that_come_late(spark, tmp_path):
    """A click first seen long after later ones is taken; its copies are not."""
    root, target, checkpoint = (str(tmp_path / n) for n in ("bronze", "silver", "checkpoint"))
    clicks = conform(generators.weighted_clicks(generators.numbers(spark, 20)), CLICKS)
    late = clicks.where("id <= 5").withColumn("occurred_at", F.expr("occurred_at - INTERVAL 900 DAYS"))
    for day, part in ((1, clicks.where("id > 5")), (2, late), (3, clicks.where("id > 15").unionByName(late))):
        part.write.parquet(f"{root}/ingestion_date=2026-09-0{day}")
        stream = silver_stream.bronze_stream(silver_stream.stream_session(spark), root)
        silver_stream.run_available(silver_stream.distinct_clicks(stream), target, checkpoint)
    out = spark.read.parquet(target)
    assert out.count() == out.select("click_id").distinct().count() == 20



def test_scatter_is_even_and_independent_of_the_seed(spark):
    df = spark.range(100_000).select((scatter(F.col("id"), 42) % 100).alias("a"), (scatter(F.col("id"), 43) % 100).alias("b"))
    counts = [r["count"] for r in df.groupBy("a").count().collect()]
    assert len(counts) == 100 and 850 < min(counts) and max(counts) < 1150
    cells = [r["count"] for r in df.groupBy((F.col("a") % 10).alias("x"), (F.col("b") % 10).alias("y")).count().collect()]
    assert len(cells) == 100 and 850 < min(cells) and max(cells) < 1150


def test_weighted_choice_follows_its_weights(spark):
    rows = spark.range(60).select(weighted_choice(F.col("id"), [("a", 1), ("b", 2), ("c", 3)]).alias("v")).groupBy("v").count()
    assert {r["v"]: r["count"] for r in rows.collect()} == {"a": 10, "b": 20, "c": 30}


def test_wide_numbers_keep_their_digits(spark):
    row = spark.range(1).select(zero_padded(F.lit(7), 3), zero_padded(F.lit(12345), 3)).first()
    assert tuple(row) == ("007", "12345")


def test_weighted_clicks_have_the_stated_shares(spark):
    clicks = generators.weighted_clicks(generators.numbers(spark, 20_000))
    shares = {r["device_type"]: r["count"] / 20_000 for r in clicks.groupBy("device_type").count().collect()}
    assert abs(shares["mobile"] - 0.60) < 0.02 and abs(shares["desktop"] - 0.35) < 0.02 and abs(shares["tablet"] - 0.05) < 0.01
    row = clicks.agg(F.count("user_id") / 20_000, F.countDistinct("short_code"), F.min("user_id"), F.max("user_id")).first()
    assert abs(row[0] - 0.3) < 0.02 and tuple(row)[1:] == (500, 1, 200)
    assert clicks.where("length(hashed_ip) <> 64").isEmpty()


def test_generators_do_not_depend_on_partitioning(spark):
    one = generators.weighted_clicks(generators.numbers(spark, 500).coalesce(1))
    many = generators.weighted_clicks(generators.numbers(spark, 500).repartition(7))
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


@pytest.fixture(scope="module")
def seeds(spark):
    return generators.seed_urls(generators.numbers(spark, 500), NOW), generators.seed_users(generators.numbers(spark, 200), NOW)


def test_seed_tables(spark, seeds):
    urls, users = seeds
    assert urls.select("short_code").distinct().count() == 500
    assert urls.where("short_code NOT RLIKE '^[a-z]{6}$'").isEmpty()
    assert 0.05 < users.where("plan_type = 'PREMIUM'").count() / 200 < 0.25
    clicks = generators.seed_clicks(generators.numbers(spark, 5000), urls, users, NOW, 14399)
    assert clicks.join(urls, "short_code", "left_semi").count() == 5000
    assert 0.27 < clicks.where("user_id IS NOT NULL").count() / 5000 < 0.33
    later = generators.seed_clicks(generators.numbers(spark, 200), urls, users, NOW, 180, clicks.agg(F.max("id") + 1).scalar(), 43)
    row = later.agg(F.min("id"), F.max("id"), F.min("occurred_at") >= F.lit(at("2026-09-01T09:00:00"))).first()
    assert tuple(row) == (5001, 5200, True)


def test_synthetic_clicks_and_the_hot_key(spark, seeds):
    urls, users = seeds
    rows = generators.numbers(spark, 1000)
    clicks = generators.source_clicks(rows, urls, users, NOW)
    assert clicks.where("user_id IS NULL").count() == 200
    assert clicks.agg(F.min("id"), F.max("id")).first()[:] == (900_000_000, 900_000_999)
    assert clicks.select("device_type").distinct().count() == 4
    assert clicks.select("short_code").distinct().count() > 300
    hot = generators.source_clicks(rows, urls, users, NOW, hot_key=True)
    assert hot.count() == 1000 and hot.select("short_code").distinct().count() == 1


def test_synthetic_star(spark):
    from clicklake.operators.dims import calendar, date_keys_of_year
    from clicklake.operators.facts import foreign_key_violations

    days = date_keys_of_year(calendar(spark), 2026)
    urls = generators.star_urls(generators.numbers(spark, 500), days)
    users = generators.star_users(generators.numbers(spark, 200))
    clicks = generators.star_clicks(generators.numbers(spark, 5000), 500, 200, days, NOW)
    assert clicks.count() == 5000
    assert 0.17 < clicks.where("user_key = -1").count() / 5000 < 0.23
    assert 0.85 < urls.where("is_active").count() / 500 < 0.95
    known = clicks.where("user_key <> -1")
    assert foreign_key_violations(known, {"url_key": urls, "user_key": users, "date_key": days}).where("violations > 0").isEmpty()
