"""What several operators share: word patterns, the learning split, handing the code to Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import clicklake

# White space is the blank and the characters 9 to 13; a word is a run of anything else.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. Texts of one byte per character take the fast built-in, which does the same there."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """Words in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids nothing may be learned from; a null id belongs to it."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hands this package to the Python workers, once per application: they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(clicklake.__file__).parent
    path = Path(tempfile.mkdtemp(prefix="clicklake-code-"), "clicklake.zip")
    with zipfile.ZipFile(path, "w") as packed:
        for module in sorted(root.rglob("*.py")):
            packed.write(module, Path(root.name, module.relative_to(root)))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)
