"""Near-duplicate groups of documents by HyperMinHash.

Documents with the same set of shingles are one class; everything after works on classes. A class's sketch is
cut into bands, and classes that share a band are compared: first by the estimate from their sketches, then on
their full sets. Inside a bucket only links that join something new are looked for, so a tight group costs one
comparison per member, and no pairs are written.

The first bands join most groups. Then the buckets of all bands whose classes are still apart are compared
in full. A bucket above ``chunk`` classes is cut: in the first round into parts, in the second its classes
outside the largest group are compared, in blocks, with the whole bucket. So every two classes that share a
band are linked, found unlike, or known to be connected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.llm import shingles as sh
from clicklake.llm.common import ship
from clicklake.llm.components import components
from clicklake.session import stored


def _signed(docs: DataFrame, width: int) -> DataFrame:
    """Per document: size and name of its shingle set, and the keys of its bands."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, bands = [], [], []
            for items in sh.shingle_sets(batch.column(2).to_pylist(), width):
                n.append(len(items))
                keys.append(sh.set_key(items) if len(items) else None)
                bands.append(sh.bands(sh.sketch(items)) if len(items) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "n_shingles", "set_key", "bands"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"))
    return rows.mapInArrow(sign, "doc_id long, text_hash long, n_shingles long, set_key binary, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """Full set and sketch of the wanted classes, from one document of each (``doc_id, text_hash, set_key``)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = list(sh.shingle_sets(batch.column(1).to_pylist(), width))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.tobytes() for x in items], pa.binary()), pa.array([sh.sketch(x).tobytes() for x in items], pa.binary())],
                names=["set_key", "items", "registers"],
            )

    own = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_hash"), F.col("text").cast("string"))
    same = own["_id"].eqNullSafe(wanted["doc_id"]) & (own["_hash"] == wanted["text_hash"])
    # Rows that repeat bring the same set again.
    texts = own.join(wanted, same).select("set_key", "text")
    return texts.mapInArrow(build, "set_key binary, items binary, registers binary").dropDuplicates(["set_key"])


_TASK = ["bucket", "block", "part"]


def _linked(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` found within each task of ``rows`` (``bucket, block, part, set_key, label``)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, members = None, {}

        def close() -> pa.RecordBatch:
            keys = sorted(members)
            items = [np.frombuffer(members[k][1], np.uint64) for k in keys]
            registers = np.stack([np.frombuffer(members[k][2], np.uint16) for k in keys])
            found = sh.links(items, registers, [members[k][0] for k in keys], percent)
            pairs = [(keys[i], keys[j]) for i, j in found]
            return pa.RecordBatch.from_arrays([pa.array([p[x] for p in pairs], pa.binary()) for x in (0, 1)], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(7)]
            for bucket, block, part, key, label, items, registers in zip(*columns, strict=True):
                if (bucket, block, part) != task:
                    if len(members) > 1:
                        yield close()
                    task, members = (bucket, block, part), {}
                members[key] = (label, items, registers)
        if len(members) > 1:
            yield close()

    full = rows.join(sets, "set_key").select(*_TASK, "set_key", "label", "items", "registers")
    dealt = full.repartition(*_TASK).sortWithinPartitions(*_TASK)
    return dealt.mapInArrow(compare, "a binary, b binary")


def _spread(n, size: int):
    """Part of a class when ``n`` are dealt into parts of about ``size``."""
    return F.pmod(F.xxhash64("set_key", "bucket"), F.ceil(n / size)).cast("int")


def _parts(n, size: int):
    """One row for every part that ``_spread`` deals ``n`` classes into."""
    return F.explode(F.sequence(F.lit(0), F.ceil(n / size).cast("int") - 1))


def _meet(rows: DataFrame, buckets: DataFrame, size: int) -> DataFrame:
    """Joins members of buckets to rows about their buckets, part by part, so that no task gets a large bucket.

    Both sides know the number ``n`` of a bucket's classes; the rows about it are repeated once per ``size`` of them.
    """
    dealt = buckets.withColumn("part", _parts(F.col("n"), size)).drop("n")
    return rows.withColumn("part", _spread(F.col("n"), size)).join(dealt, ["bucket", "part"])


def _members(in_bands: DataFrame, buckets: DataFrame, rows: int, heavy: int = 4096) -> DataFrame:
    """``bucket, n, band, set_key`` of the ``rows`` of ``in_bands`` that lie in one of ``buckets``.

    The members do not know yet how large their bucket is. Fewer than ``heavy`` buckets hold more than one in
    ``heavy`` of all rows; their numbers are sent to all tasks, and only they are dealt into parts.
    """
    size = max(rows // heavy, 1)
    large = buckets.where(F.col("n") > size)
    known = F.broadcast(large.select("bucket", "n"))
    asking = in_bands.join(known, "bucket", "left")
    asking = asking.withColumn("part", F.when(F.col("n").isNull(), 0).otherwise(_spread(F.col("n"), size))).drop("n")
    once = buckets.where(F.col("n") <= size).withColumn("part", F.lit(0))
    dealt = once.unionByName(large.withColumn("part", _parts(F.col("n"), size)))
    return asking.join(dealt, ["bucket", "part"]).select("bucket", "n", "band", "set_key")


def _tasks(rows: DataFrame, chunk: int) -> DataFrame:
    """Second-round tasks of buckets (``bucket, n, set_key, label``) whose classes are apart.

    Small buckets are one task. Of a large one, the classes outside its largest group are dealt into blocks,
    all classes into parts, and each block meets each part.
    """
    zero = F.lit(0).cast("int")
    small = rows.where(F.col("n") <= chunk).select("bucket", zero.alias("block"), zero.alias("part"), "set_key", "label")
    large = rows.where(F.col("n") > chunk)
    groups = large.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("k"))
    heads = groups.groupBy("bucket").agg(F.max(F.struct("k", "label")).alias("top"), F.sum("k").alias("n"))
    heads = heads.select("bucket", "n", F.col("top.label").alias("top"), (F.col("n") - F.col("top.k")).alias("others")).where("others > 0")
    large = _meet(large, heads, chunk)
    whole = large.select("bucket", _parts(F.col("others"), chunk).alias("block"), "part", "set_key", "label")
    apart = large.where(F.col("label") != F.col("top"))
    asking = apart.select(
        "bucket", _spread(F.col("others"), chunk).alias("block"), _parts(F.col("n"), chunk).alias("part"), "set_key", "label"
    )
    return small.unionByName(whole).unionByName(asking)


def _grouped(docs: DataFrame, shingle_words: int, percent: int, first_bands: int = 8, chunk: int = 512) -> DataFrame:
    """``near_groups`` with the name of each group, ``label``: the set key of one of its classes, null without words."""
    ship(docs.sparkSession)
    signed = stored(_signed(docs, shingle_words), "near-signed")
    spelt = signed.where(F.col("set_key").isNotNull())
    classes = spelt.groupBy("set_key").agg(
        F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "text_hash")).alias("one"), F.first("bands").alias("bands")
    )
    classes = stored(classes, "near-classes")
    in_bands = classes.select("set_key", F.posexplode("bands").alias("band", "bucket"))
    buckets = in_bands.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("band").alias("band"), F.min("set_key").alias("low"), F.bit_xor(F.xxhash64("set_key")).alias("mark")
    )
    # Bands that hold the same classes are compared once.
    buckets = buckets.where("n > 1").groupBy("n", "low", "mark").agg(F.min("band").alias("band"), F.min("bucket").alias("bucket"))
    buckets = stored(buckets.select("bucket", "n", "band"), "near-buckets")
    members = stored(_members(in_bands.drop("band"), buckets, sh.BANDS * classes.count()), "near-members")
    wanted = members.select("set_key").distinct().join(classes.select("set_key", "one"), "set_key")
    wanted = wanted.select("set_key", "one.doc_id", "one.text_hash")
    sets = stored(_sets(docs, wanted, shingle_words), "near-sets")

    first = members.where(F.col("band") < first_bands)
    first = first.select("bucket", F.lit(0).alias("block"), _spread(F.col("n"), chunk).alias("part"), "set_key", F.col("set_key").alias("label"))
    labels = stored(components(_linked(first, sets, percent)), "near-labels")

    labelled = members.join(labels.withColumnRenamed("node", "set_key"), "set_key", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "set_key"))
    apart = labelled.groupBy("bucket", "n").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l != h").select("bucket", "n")
    rest = stored(_meet(labelled, apart, chunk).select("bucket", "n", "set_key", "label"), "near-apart")
    more = _linked(_tasks(rest, chunk), sets, percent)
    known = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
    labels = components(known.unionByName(more))

    named = classes.select("set_key", "least_id").join(labels.withColumnRenamed("node", "set_key"), "set_key", "left")
    named = named.withColumn("label", F.coalesce("label", "set_key"))
    # Written down, so that the join below can split a label in a third of all classes.
    smallest = stored(named.groupBy("label").agg(F.min("least_id").alias("component_id")), "near-smallest")
    named = named.join(smallest, "label").select("set_key", "component_id", "label")
    out = signed.drop("bands").join(named, "set_key", "left")
    out = out.withColumn("component_id", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash", "label")


def near_groups(
    docs: DataFrame, shingle_words: int = 5, percent: int = 80, first_bands: int = 8, chunk: int = 512
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept, text_hash``.

    Words are separated by blanks and the characters 9 to 13, A-Z in lower case. A document's set is its
    distinct shingles of ``shingle_words`` words, or its words as one if it has fewer. Null, empty and blank
    texts have no set and are linked with nothing. Documents whose sets share ``percent`` of their union are
    linked; ``component_id`` is the smallest id reachable, ``kept`` marks the rows that carry it. Documents with
    equal sets are linked, also where rows repeat with their id. A null id is no smallest id; a group of null
    ids only has a null component and is kept. An empty table gives no rows; further columns are not looked at.

    A pair at 80 percent misses all 42 bands of six registers with a probability of about 8 in a million; sets of
    4 and 5 shingles, which crowd few registers, 15 in a million.
    """
    return _grouped(docs, shingle_words, percent, first_bands, chunk).drop("label")


def kept_documents(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """The documents that stay, one of each group, with their own columns as they were, whatever their names.

    Of a group the row with the smallest id stays, null ids last, and of rows that share it the one with the
    smallest text hash, once. Documents without words are groups of their own; such rows that repeat with id and
    text leave one.
    """
    kept = _grouped(docs, shingle_words, percent).where("kept")
    name = lambda i: F.coalesce(i.cast("string"), F.lit(""))
    # Groups with words go by their label alone; an id need not name a group, a null id never does.
    alone = F.when(F.col("label").isNull(), F.struct(name(F.col("doc_id")).alias("id"), "text_hash"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("one")
    chosen = kept.groupBy("label", alone.alias("alone")).agg(least)
    chosen = chosen.select(name(F.col("one.doc_id")).alias("_name"), F.col("one.text_hash").alias("_hash"))
    # The row travels as one value, so that no name of a column is in the way.
    own = docs.select(name(F.col("doc_id").cast("long")).alias("_name"), F.xxhash64("text").alias("_hash"), F.struct(*docs.columns).alias("row"))
    return own.join(chosen, ["_name", "_hash"], "left_semi").dropDuplicates(["_name", "_hash"]).select("row.*")
