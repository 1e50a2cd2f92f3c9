"""The metric catalogue over the star schema.

Each metric counts the fact per dimension key first and joins afterwards. Catalyst does not move
an aggregate below a join by itself; done by hand, the join and every shuffle carry one row per
key and input partition instead of one row per click, which also removes the effect of hot urls.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _per_key(fact: DataFrame, key: str, min_click_id: int | None) -> DataFrame:
    rows = fact if min_click_id is None else fact.where(F.col("click_id") >= min_click_id)
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))


def _clicks_by(
    fact: DataFrame, dim: DataFrame, key: str, attribute: str, name: str,
    min_click_id: int | None, only: Column | None = None,
) -> DataFrame:
    members = dim if only is None else dim.where(only)
    joined = _per_key(fact, key, min_click_id).join(members.select(key, attribute), key)
    return joined.groupBy(attribute).agg(F.sum("_n").alias(name))


def total_clicks_per_url(fact: DataFrame, dim_url: DataFrame, min_click_id: int | None = None) -> DataFrame:
    return _clicks_by(fact, dim_url, "url_key", "short_code", "total_clicks", min_click_id)


def clicks_over_time(fact: DataFrame, dim_date: DataFrame, min_click_id: int | None = None) -> DataFrame:
    return _clicks_by(fact, dim_date, "date_key", "full_date", "clicks", min_click_id).orderBy("full_date")


def clicks_by_device_type(fact: DataFrame, dim_device: DataFrame, min_click_id: int | None = None) -> DataFrame:
    return _clicks_by(fact, dim_device, "device_key", "device_type", "clicks", min_click_id)


def top_urls(fact: DataFrame, dim_url: DataFrame, k: int = 10, min_click_id: int | None = None) -> DataFrame:
    """The ``k`` most clicked codes; equal counts are ordered by code."""
    totals = total_clicks_per_url(fact, dim_url, min_click_id)
    return totals.orderBy(F.desc("total_clicks"), F.asc_nulls_last("short_code")).limit(k)


def anonymous_vs_attributed(fact: DataFrame, dim_user: DataFrame, min_click_id: int | None = None) -> DataFrame:
    return _clicks_by(fact, dim_user, "user_key", "is_known", "clicks", min_click_id)


def clicks_by_plan_type(fact: DataFrame, dim_user: DataFrame, min_click_id: int | None = None) -> DataFrame:
    return _clicks_by(fact, dim_user, "user_key", "plan_type", "clicks", min_click_id, F.col("is_known"))


def clicks_by_domain(fact: DataFrame, dim_url: DataFrame, min_click_id: int | None = None) -> DataFrame:
    return _clicks_by(fact, dim_url, "url_key", "original_url_domain", "clicks", min_click_id)


def active_vs_inactive(fact: DataFrame, dim_url: DataFrame, min_click_id: int | None = None) -> DataFrame:
    return _clicks_by(fact, dim_url, "url_key", "is_active", "clicks", min_click_id)


def additive_check(fact: DataFrame) -> DataFrame:
    """The additive measure against the row count; the two must be equal."""
    return fact.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum("click_count"), F.lit(0)).cast("bigint").alias("click_count"),
    )


# Each metric by name, with the dimension it needs.
CATALOGUE = {
    "total_clicks_per_url": (total_clicks_per_url, "dim_url"),
    "clicks_over_time": (clicks_over_time, "dim_date"),
    "clicks_by_device_type": (clicks_by_device_type, "dim_device"),
    "top_10_urls_by_clicks": (partial(top_urls, k=10), "dim_url"),
    "anonymous_vs_attributed_share": (anonymous_vs_attributed, "dim_user"),
    "clicks_by_plan_type": (clicks_by_plan_type, "dim_user"),
    "clicks_by_destination_domain": (clicks_by_domain, "dim_url"),
    "active_vs_inactive_url_share": (active_vs_inactive, "dim_url"),
}


def metric(name: str, star: dict[str, DataFrame], min_click_id: int | None = None) -> DataFrame:
    """One metric of the catalogue over a star given as table name -> DataFrame."""
    build, dimension = CATALOGUE[name]
    return build(star["fact_clicks"], star[dimension], min_click_id=min_click_id)
