"""Line deduplication over overlapping windows of three lines.

Every run of three consecutive lines is hashed. A window that occurs more than once keeps its first
occurrence, in the order of document id, text hash and line; all later ones go, by merging the positions
they cover. Two 64-bit hashes with different salts stand for a window, so that chance matches stay out of
reach at any corpus size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.session import stored

_KEY = ["w1", "w2"]


def _marked(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def repeated_windows(docs: DataFrame) -> DataFrame:
    """Later occurrences of windows: ``doc_id, text_hash, at`` with the place of the first of the three lines, from 0."""
    lines = _marked(docs).select("doc_id", "text_hash", F.split("text", "\n").alias("lines"))
    lines = lines.where(F.size("lines") >= 3)
    hashed = F.transform("lines", lambda x: F.struct(
        F.xxhash64(x).alias("a"), F.xxhash64(F.lit("salt"), x).alias("b"), x.rlike(r"[^\x20\x09-\x0D]").alias("spelt"),
    ))
    lines = lines.select("doc_id", "text_hash", hashed.alias("h"))
    window = lambda x, i: F.struct(
        F.xxhash64(x["a"], F.get("h", i + 1)["a"], F.get("h", i + 2)["a"]).alias("w1"),
        F.xxhash64(x["b"], F.get("h", i + 1)["b"], F.get("h", i + 2)["b"]).alias("w2"),
        (x["spelt"] | F.get("h", i + 1)["spelt"] | F.get("h", i + 2)["spelt"]).alias("spelt"),
        i.alias("at"),
    )
    spans = F.slice(F.transform("h", window), 1, F.greatest(F.size("h") - 2, F.lit(0)))
    found = lines.select("doc_id", "text_hash", F.inline(spans)).where("spelt").drop("spelt")
    found = stored(found, "line-windows")
    place = F.struct("doc_id", "text_hash", "at")
    # Counted before the shuffle, so a window in a third of all documents is one row per input task.
    often = found.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1")
    later = found.join(often.drop("n"), _KEY).where(~place.eqNullSafe(F.col("first")))
    return later.select("doc_id", "text_hash", "at")


def line_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, text, n_lines, n_removed, clean_text``.

    Lines are what newlines separate. Windows of three lines without any word are left alone, as are texts of
    fewer than three lines; null counts as empty and has one line. Rows that repeat a document with its id
    count as one document and get the same result. Null ids come first. A text whose lines all go becomes
    empty. An empty table gives no rows; further columns are not looked at.
    """
    gone = repeated_windows(docs).groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("at")).alias("at"))
    gone = gone.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "at")
    own = _marked(docs)
    joined = own.join(gone, own["doc_id"].eqNullSafe(gone["_doc"]) & (own["text_hash"] == gone["_hash"]), "left")
    split = joined.select("doc_id", "text", F.split("text", "\n").alias("lines"), "at")
    # What stays are the stretches between the covered positions: one before each window and one after the last.
    end = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.get("at", F.greatest(k - 1, F.lit(0))) + 3)
    stretch = lambda p, k: F.slice("lines", end(k) + 1, F.greatest(p - end(k), F.lit(0)))
    last = F.element_at("at", -1) + 3
    tail = F.slice("lines", last + 1, F.greatest(F.size("lines") - last, F.lit(0)))
    stay = F.flatten(F.concat(F.transform("at", stretch), F.array(tail)))
    split = split.select("doc_id", "text", "lines", F.when(F.col("at").isNull(), F.col("lines")).otherwise(stay).alias("stay"))
    return split.select(
        "doc_id", "text",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("stay")).cast("long").alias("n_removed"),
        F.array_join("stay", "\n").alias("clean_text"),
    )
