"""What the plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from clicklake import fixtures as fx
from clicklake import registry
from clicklake.plans import metrics
from clicklake.session import scratch_path
from clicklake.sources import relational
from helpers import plan_of


def test_watermark_reaches_the_scan(spark, sf):
    raw = fx.table(spark, sf, "events").withColumnRenamed("event_id", "id")
    plan = plan_of(relational.incremental_scan(raw, 500, 900).select("id"))
    assert "GreaterThan(event_id,500)" in plan and "LessThanOrEqual(event_id,900)" in plan
    assert "ReadSchema: struct<event_id:bigint>" in plan


def test_metrics_count_before_they_join(spark, sf):
    star = registry._star(spark, sf)
    for name in metrics.CATALOGUE:
        plan = plan_of(metrics.metric(name, star))
        scan = plan.index("fact_clicks") if "fact_clicks" in plan else len(plan)
        join = plan.index("Join")
        assert "partial_count(1)" in plan[join:scan], name


def test_fact_scan_of_a_metric_reads_one_column(spark, sf):
    star = registry._star(spark, sf)
    plan = plan_of(metrics.total_clicks_per_url(star["fact_clicks"], star["dim_url"]))
    assert "ReadSchema: struct<url_key:int>" in plan


def test_top_urls_need_no_full_sort(spark, sf):
    star = registry._star(spark, sf)
    assert "TakeOrderedAndProject" in plan_of(metrics.top_urls(star["fact_clicks"], star["dim_url"]))


@pytest.mark.parametrize("name", sorted(registry.REGISTRY))
def test_no_cross_join_and_no_python_in_any_query(spark, sf, name):
    plan = plan_of(registry.REGISTRY[name][0](spark, sf))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert word not in plan, word


def test_shared_folder_comes_from_the_session(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_one_url_with_a_third_of_the_clicks(spark):
    """A hot url is one row per input partition by the time it is shuffled."""
    fact = spark.range(0, 30_000, numPartitions=6).select(
        F.col("id").alias("click_id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 1000).cast("int").alias("url_key")
    )
    dim = spark.range(1000).selectExpr("CAST(id AS INT) AS url_key", "concat('p', id) AS short_code")
    top = metrics.top_urls(fact, dim).first()
    assert (top["short_code"], top["total_clicks"]) == ("p1", 10_000 + 20)
