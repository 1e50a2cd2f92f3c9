from pyspark.sql import functions as F

from clicklake.operators import silver
from clicklake.schemas import SILVER_CLICKS
from helpers import BRONZE_CLICK, at, plan_of

DIGEST = "a" * 64
TIME = at("2026-09-01T10:00:00")


def mixed(spark):
    """Every pair of a usable and an unusable value of the three required columns, ids from 100 up."""
    codes = ["ok", "\ttab kept", "c" * 4000, None, "\u00a0", "    "]
    times = [TIME, at("1969-12-31T23:59:59"), None]
    rows = [
        (100 + 10 * i + j, code, time, ("TABLET ", " mobile", "fridge")[j], (DIGEST, "A" * 64, "a" * 63)[j], (None, 12.0, 1e9)[j])
        for i, code in enumerate(codes)
        for j, time in enumerate(times)
    ]
    return spark.createDataFrame([*rows, (None, "ok", TIME, "mobile", DIGEST, 3.0)], BRONZE_CLICK)


def by_id(df):
    return {r["click_id"]: r for r in df.collect()}


def test_rows_without_id_time_or_code_are_dropped(spark):
    # Code 3 is null, 5 is blank; time 2 is null. A no-break space and a tab are text.
    want = [100 + 10 * i + j for i in (0, 1, 2, 4) for j in (0, 1)]
    assert sorted(by_id(silver.clean_clicks(mixed(spark)))) == want


def test_text_and_types_are_normalised(spark):
    rows = by_id(silver.clean_clicks(mixed(spark)))
    assert [rows[100]["device_type"], rows[101]["device_type"]] == ["tablet", "mobile"]
    assert (rows[100]["hashed_ip"], rows[101]["hashed_ip"]) == (DIGEST, None)
    assert (rows[100]["user_id"], rows[101]["user_id"]) == (None, 12)
    assert rows[110]["short_code"].strip() == "tab kept" and len(rows[120]["short_code"]) == 4000
    odd = spark.createDataFrame([(1, "a", TIME, "fridge", "a" * 63, 1e9)], BRONZE_CLICK)
    row = silver.clean_clicks(odd).first()
    assert (row["device_type"], row["hashed_ip"], row["user_id"]) == ("unknown", None, 10**9)


def test_output_columns_and_types_are_fixed(spark):
    extra = mixed(spark).withColumn("watermark_start", F.lit(1))
    out = silver.clean_clicks(extra)
    assert out.columns == SILVER_CLICKS.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in SILVER_CLICKS]


def test_missing_device_and_upper_case_digest(spark):
    rows = spark.createDataFrame([(1, "a", TIME, None, DIGEST.upper(), None)], BRONZE_CLICK)
    row = silver.clean_clicks(rows).first()
    assert (row["device_type"], row["hashed_ip"]) == ("unknown", None)


def test_bad_casts_drop_the_row_instead_of_failing(spark):
    rows = spark.createDataFrame(
        [("x1", "a", "2026-09-01 10:00:00", "mobile", None, "nan"), ("2", "a", "no time", "mobile", None, "5"),
         ("3", "a", "2026-09-01 10:00:00", "mobile", None, "oops")],
        "id string, short_code string, occurred_at string, device_type string, hashed_ip string, user_id string",
    )
    out = silver.clean_clicks(rows).collect()
    assert [(r["click_id"], r["user_id"]) for r in out] == [(3, None)]


def test_nan_user_is_anonymous(spark):
    rows = spark.createDataFrame([(1, "a", TIME, "mobile", None, float("nan"))], BRONZE_CLICK)
    assert silver.clean_clicks(rows).first()["user_id"] is None


def test_tabs_are_not_trimmed(spark):
    rows = spark.createDataFrame([(1, "\ta ", TIME, "mobile", None, None)], BRONZE_CLICK)
    assert silver.clean_clicks(rows).first()["short_code"] == "\ta"


def test_every_rejected_row_has_its_reason(spark):
    reasons = [r["reason"] for r in silver.rejected_clicks(mixed(spark)).collect()]
    assert sorted(reasons) == ["missing_code"] * 4 + ["missing_id"] + ["missing_time"] * 6


def test_rejects_and_clean_rows_add_up(spark):
    none_code = spark.createDataFrame([(8, None, TIME, "mobile", None, None)], BRONZE_CLICK)
    rows = mixed(spark).unionByName(none_code)
    assert silver.clean_clicks(rows).count() + silver.rejected_clicks(rows).count() == rows.count()


def _clicks(spark, ids):
    return silver.clean_clicks(
        spark.createDataFrame([(i, f"c{i}", TIME, "mobile", None, None) for i in ids], BRONZE_CLICK)
    )


def test_duplicates_keep_one_copy(spark):
    for ids, expected in (([1, 1, 2], [1, 2]), ([1, 2, 3], [1, 2, 3]), ([9, 9, 9], [9])):
        out = silver.deduplicate_clicks(_clicks(spark, ids))
        assert sorted(r["click_id"] for r in out.collect()) == expected


def test_copies_are_counted(spark):
    counted = silver.deduplicate_counting(_clicks(spark, [1, 1, 1, 2]))
    assert {r["click_id"]: r[silver.COPIES] for r in counted.collect()} == {1: 3, 2: 1}


def test_dedup_is_one_shuffle_and_merges_before_it(spark, sf):
    from clicklake import fixtures as fx

    plan = plan_of(silver.deduplicate_clicks(silver.clean_clicks(fx.src_clicks(spark, sf))))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_first" in plan[plan.index("Exchange hashpartitioning"):]


def test_stats(spark):
    rows = mixed(spark).unionByName(mixed(spark))
    assert silver.silver_stats(rows).first().asDict() == {
        "bronze_rows": 38, "invalid_rows_dropped": 22, "duplicate_rows_removed": 8, "silver_rows": 8,
    }
    empty = silver.silver_stats(mixed(spark).limit(0)).first().asDict()
    assert set(empty.values()) == {0}


def test_exploration_view(spark):
    rows = spark.createDataFrame(
        [(1, "a", "t", " Mobile"), (None, "b", "t", "x"), (3, "c", "t", "DESKTOP")],
        "id bigint, short_code string, occurred_at string, device_type string",
    )
    out = silver.valid_clicks(rows)
    assert out.columns == ["id", "short_code", "occurred_at", "device_type"]
    assert sorted((r["id"], r["device_type"]) for r in out.collect()) == [(1, " mobile"), (3, "desktop")]
