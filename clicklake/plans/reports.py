"""Operational reports. Each returns its rows and whether the check passed; plain reports always pass."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from clicklake.operators import contracts as ct
from clicklake.operators import ledger as lg
from clicklake.operators import storage
from clicklake.operators.pii import pii_columns
from clicklake.plans.ingest import Ledger
from clicklake.schemas import SMALL_FILE_BYTES
from clicklake.sources.listing import bronze_objects, list_files, stored_keys

Report = tuple[DataFrame, bool]
# How the reports over a lake list its files: ``list_files``, or ``walk_files`` where there are very many.
Lister = Callable[[SparkSession, str], DataFrame]


def contracts_report(
    spark: SparkSession, tables: dict[str, DataFrame], folder: str = ct.CONTRACT_DIR, nullability: str = "data"
) -> Report:
    """Findings against every contract of a folder; passes when none is a violation."""
    findings = ct.validate_contracts(spark, ct.load_contracts(folder), tables, nullability)
    return findings, findings.where("severity = 'violation'").isEmpty()


def stale_report(ledger: Ledger, now: datetime, max_runtime_minutes: int = 60) -> Report:
    stale = lg.stale_runs(ledger.runs(), now, max_runtime_minutes)
    return stale, stale.isEmpty()


def reconcile_report(
    spark: SparkSession, lake: str, ledger: Ledger, pipeline: str, table: str | None = None, lister: Lister = list_files
) -> Report:
    """Drift between ledger and storage. The storage side covers all of Bronze, or one table of it."""
    folder = f"{lake}/bronze" + (f"/{table}" if table else "")
    stored, recorded = stored_keys(lister(spark, folder), lake=lake), lg.success_keys(ledger.runs(), pipeline)
    orphans = storage.orphaned_objects(stored, recorded).selectExpr("'orphaned' AS kind", "bronze_key")
    missing = storage.missing_objects(stored, recorded).selectExpr("'missing' AS kind", "bronze_key")
    drift = orphans.unionByName(missing)
    return drift, drift.isEmpty()


def storage_report(spark: SparkSession, lake: str, prefix: str = "bronze/", lister: Lister = list_files) -> Report:
    return storage.storage_stats(bronze_objects(lister(spark, f"{lake}/bronze"), lake=lake), prefix), True


def layout_of_table(
    spark: SparkSession, lake: str, table: str, small_file_bytes: int = SMALL_FILE_BYTES, lister: Lister = list_files
) -> Report:
    files = lister(spark, f"{lake}/bronze/{table}")
    return storage.layout_report(files, small_file_bytes), True


def history_report(ledger: Ledger, pipeline: str | None = None, table: str | None = None, limit: int = 20) -> Report:
    return lg.run_history(ledger.runs(), pipeline, table, limit), True


def summary_report(ledger: Ledger, pipeline: str | None = None) -> Report:
    return lg.summary(ledger.runs(), pipeline), True


def pii_report(spark: SparkSession, folder: str = ct.CONTRACT_DIR) -> Report:
    """Declared personal data. Raises when a column lacks a valid class."""
    return pii_columns(ct.contract_columns(spark, ct.load_contracts(folder))), True
