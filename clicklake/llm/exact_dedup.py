"""Exact deduplication by content sort.

Sampled splitters deal the normalised texts into ranges, each range is sorted (spilling to disk where it
must), and a single pass compares neighbours in full. The splitters see the first 64 bytes, a hash of the
whole text and the id: equal texts are neighbours in that order too, the sample stays small whatever the
length of the texts, and a text with any number of copies is cut into several ranges by id. Runs that touch
the border of a range are joined with their continuation afterwards, again on the full text; that table
has at most two rows per range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.llm.common import ascii_lower, ship
from clicklake.session import stored

_OUT = pa.schema([
    ("doc_id", pa.int64()), ("head", pa.bool_()), ("text_sha256", pa.string()), ("part", pa.int32()),
    ("run", pa.int64()), ("run_keep", pa.int64()), ("run_size", pa.int64()), ("edge", pa.binary()),
])
_OUT_SQL = (
    "doc_id long, head boolean, text_sha256 string, part int, run long, run_keep long, run_size long, edge binary"
)
_FLUSH = 20_000


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted range with the run of equal texts each belongs to. Holds one text and the ids of one run."""
    part, run, text, ids, rows = TaskContext.get().partitionId(), 0, None, [], []

    def close(last: bool) -> None:
        digest, size = hashlib.sha256(text).hexdigest(), len(ids)
        edge = text if last or run == 0 else None
        rows.extend((x, k == 0, digest, part, run, ids[0], size, edge if k == 0 else None) for k, x in enumerate(ids))

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _OUT, strict=True)], schema=_OUT
        )
        rows.clear()
        return batch

    for batch in batches:
        for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if value == text:
                ids.append(doc_id)
                continue
            if text is not None:
                close(False)
                run += 1
                if len(rows) >= _FLUSH:
                    yield flush()
            text, ids = value, [doc_id]
    if text is not None:
        close(True)
        yield flush()


def exact_dedup(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty, so null and empty texts
    form one group. The row with the smallest (or ``keep="largest"``) id of a group stays, null ids last.
    Exactly one row of a group stays, also where rows repeat with their id. An empty table gives no rows;
    further columns are not looked at.
    """
    ship(docs.sparkSession)
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("body"))
    order = F.col("doc_id").desc_nulls_last() if keep == "largest" else F.col("doc_id").asc_nulls_last()
    rows = rows.withColumns({"lead": F.expr("substring(body, 1, 64)"), "mark": F.xxhash64("body")})
    dealt = rows.repartitionByRange("lead", "mark", order)
    ordered = dealt.sortWithinPartitions("lead", "mark", "body", order)
    runs = stored(ordered.select("doc_id", "body").mapInArrow(_runs, _OUT_SQL), "exact-runs")

    borders = (
        runs.where("edge IS NOT NULL").groupBy("edge")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("run_size").alias("all_size"), F.min("part").alias("first_part"),
             F.min_by("run_keep", "part").alias("all_keep"), F.collect_list(F.struct("part", "run")).alias("at"))
        .where("n > 1")
        .select(F.inline("at"), "all_size", "all_keep", "first_part")
    )
    # At most two rows per range, so the table is small enough to send to every task.
    joined = runs.drop("edge").join(F.broadcast(borders), ["part", "run"], "left")
    crossing = F.col("first_part").isNotNull()
    return joined.select(
        "doc_id",
        F.when(crossing, F.col("all_keep")).otherwise(F.col("run_keep")).alias("keep_id"),
        F.coalesce("all_size", "run_size").alias("group_size"),
        (F.col("head") & F.coalesce(F.col("part") == F.col("first_part"), F.lit(True))).alias("kept"),
        "text_sha256",
    )


def kept_documents(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """The documents that stay, one of each group of equal texts, with their own columns as they were, whatever their names.

    See ``exact_dedup`` for null and empty texts and null ids. Of rows that repeat with id and text any one stays.
    """
    kept = exact_dedup(docs, keep).where("kept")
    # Ids as text, so that null ids meet; rows that repeat with id and text leave one.
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    chosen = kept.select(name.alias("_name"), F.col("text_sha256").alias("_digest"))
    digest = F.sha2(ascii_lower(F.coalesce(F.col("text"), F.lit(""))).cast("binary"), 256)
    # The row travels as one value, so that no name of a column is in the way.
    own = docs.select(name.alias("_name"), digest.alias("_digest"), F.struct(*docs.columns).alias("row"))
    found = own.join(chosen, ["_name", "_digest"], "left_semi")
    return found.dropDuplicates(["_name", "_digest"]).select("row.*")
