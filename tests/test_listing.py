"""Listings made level by level in tasks against Spark's own file index."""

import os

import pytest

from clicklake.plans import reports
from clicklake.sources.listing import list_files, walk_files


@pytest.fixture(scope="module")
def lake(tmp_path_factory):
    """Over a thousand load folders, three levels deep, some of them empty, hidden or oddly named."""
    root = tmp_path_factory.mktemp("wide lake")
    for table in ("clicks", "urls"):
        for k in range(600):
            folder = root / "bronze" / table / f"ingestion_date=2024-{k:04d}"
            folder.mkdir(parents=True)
            if k % 7:
                (folder / "part-0.parquet").write_bytes(b"x" * (k + 1))
            (folder / "_SUCCESS").write_bytes(b"")
    clicks = root / "bronze" / "clicks"
    odd = ["load=a b%20c/part é.parquet", "_staging/part-1.parquet", ".hidden/part-1.parquet", "_kept=1/part-1.parquet",
           "deep/er/and/deeper/part-1.parquet", "flat.parquet", "notes.txt", ".part.crc", "_metadata"]
    for name in odd:
        path = clicks / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"12345")
    (clicks / "empty.parquet").write_bytes(b"")
    return str(root)


def rows(frame):
    return sorted((r.path, r.modificationTime, r.length) for r in frame.collect())


@pytest.mark.parametrize("pattern", ["*.parquet", "part-*", "*"])
def test_walk_equals_the_file_index(spark, lake, pattern):
    found = rows(walk_files(spark, lake, pattern, folders_per_task=64))
    assert found == rows(list_files(spark, lake, pattern))
    assert len(found) > 1000 and not any("_staging" in p or "/.hidden" in p for p, _, _ in found)


def test_walk_has_the_schema_of_a_listing_also_without_files(spark, lake, tmp_path):
    assert walk_files(spark, lake).schema == list_files(spark, lake).schema
    (tmp_path / "a" / "b").mkdir(parents=True)
    assert walk_files(spark, str(tmp_path)).isEmpty()
    assert walk_files(spark, str(tmp_path / "none")).isEmpty()
    assert not os.path.exists(tmp_path / "none")


def test_reports_take_either_listing(spark, lake):
    for report in (
        lambda lister: reports.storage_report(spark, lake, lister=lister),
        lambda lister: reports.layout_of_table(spark, lake, "clicks", lister=lister),
    ):
        assert report(walk_files)[0].collect() == report(list_files)[0].collect()
