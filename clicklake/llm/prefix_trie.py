"""Prefix trie of conversations by composable fingerprints.

A conversation is rebuilt from a head, the first turns of its base, and the rest of its own turns. Nothing of
it is put together: a prefix's fingerprint is the value of a polynomial whose coefficients are its turns, and
prefixes form a monoid under concatenation. So one pass stores every turn with the product of all turns up to
it, and the product of a head and a piece of a conversation follows from three stored values:
``head + (through - skipped) * base ** (len(head) - n_skipped)``.

Prefixes of one depth with one fingerprint are a node. Each points at the stored turn it ends with, and a node
is checked to have one last turn and one parent; from the root down that makes all its members equal. Should
a check fail, all is done again with other bases.

Every node belongs to its smallest member, so the nodes of a conversation are one chain down to its end. What a
subtree holds is then summed over members by their chains, and no level of the trie waits for the one below.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklake.llm.common import ship
from clicklake.session import stored

PRIME = (1 << 61) - 1
#: Bases of the two polynomials; a failed check moves on to the next pair.
BASES = ((911382323, 972663749), (1000003373, 688846502588399), (7145276159, 35742549198872617))
_FLUSH = 20_000
_CHUNK = 4096
_TURNS = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("local", pa.int64()), ("edge", pa.bool_()), ("f", pa.int64()), ("g", pa.int64()),
    ("pf", pa.int64()), ("pg", pa.int64()), ("t", pa.int64()), ("u", pa.int64()), ("chars", pa.int64()),
])
_TURNS_SQL = "conv_id long, part int, local long, edge boolean, f long, g long, pf long, pg long, t long, u long, chars long"
_KEY = ["depth", "f", "g"]


def head_turns(conv_id: Column) -> Column:
    """How many turns of its base a conversation starts with: 0 to 5."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 6).cast("int")


def base_of(conv_id: Column) -> Column:
    return conv_id - conv_id % 100


def stored_turns(conversations: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """Turns in order with ``place`` from 1, products before (``pf, pg``) and through (``f, g``) them, and size.

    Turns are dealt into ranges of (conversation, turn, digest) and multiplied within the range; a conversation
    that goes on in the next ranges is carried over by one value per range. So a conversation of any length
    is shared by many tasks. Of a text only its digest and size travel.
    """

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, first, rows = TaskContext.get().partitionId(), None, None, []
        f = g = n = 0
        pf = pg = 1

        def flush(keep: int) -> pa.RecordBatch:
            out, rows[:] = rows[: len(rows) - keep], rows[len(rows) - keep :]
            return pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*out, strict=True), _TURNS, strict=True)], schema=_TURNS)

        for batch in batches:
            for conv_id, digest, chars in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if conv_id != conv:
                    if rows and conv == first:
                        rows[-1][3] = True
                    conv, f, g, n, pf, pg = conv_id, 0, 0, 0, 1, 1
                    first = conv if first is None else first
                t, u = (int.from_bytes(digest[k : k + 8], "big", signed=True) for k in (0, 8))
                n, pf, pg = n + 1, pf * bases[0] % PRIME, pg * bases[1] % PRIME
                before = f, g
                f, g = (f + t * pf) % PRIME, (g + u * pg) % PRIME
                rows.append([conv, part, n, False, f, g, *before, t, u, chars])
            if len(rows) > _FLUSH:
                yield flush(1)
        if rows:
            rows[-1][3] = True
            yield flush(0)

    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.unhex(F.sha2(said, 256)).alias("digest"), F.length(text).cast("long").alias("chars"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "digest"]
    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(dealt.select("conv_id", "digest", "chars").mapInArrow(products, _TURNS_SQL), "trie-turns")


def placed(turns: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """``stored_turns`` with what a conversation had in earlier ranges multiplied in."""

    def carry(group: pd.DataFrame) -> pd.DataFrame:
        """Per range of one conversation, what came before. A group has a row per range at most."""
        out, n, f, g = [], 0, 0, 0
        for row in group.sort_values("part").itertuples():
            x, y = pow(bases[0], n, PRIME), pow(bases[1], n, PRIME)
            out.append((row.conv_id, row.part, n, f, g, x, y))
            n, f, g = n + row.local, (f + row.f * x) % PRIME, (g + row.g * y) % PRIME
        return pd.DataFrame(out, columns=["conv_id", "part", "skip", "cf", "cg", "xf", "xg"])

    edges = turns.where("edge").select("conv_id", "part", "local", "f", "g")
    carried = edges.groupBy("conv_id").applyInPandas(carry, "conv_id long, part int, skip long, cf long, cg long, xf long, xg long")
    # Two rows per range at most, so it can go to every task.
    joined = turns.join(F.broadcast(carried.where("skip > 0")), ["conv_id", "part"], "left")
    moved = lambda name, k: F.when(F.col("skip").isNull(), F.col(name)).otherwise(_join(F.col(f"c{k}"), F.col(name), F.col(f"x{k}"))).alias(name)
    return joined.select(
        "conv_id", (F.col("local") + F.coalesce("skip", F.lit(0))).alias("place"),
        moved("f", "f"), moved("g", "g"), moved("pf", "f"), moved("pg", "g"), "t", "u", "chars",
    )


def _join(head: Column, tail: Column, factor: Column) -> Column:
    """``(head + tail * factor) mod PRIME`` for values below PRIME; the product has 37 digits at most."""
    wide = lambda c: c.cast("decimal(19,0)")
    return ((wide(tail) * wide(factor) + wide(head)) % wide(F.lit(PRIME))).cast("long")


def _shifted(head: Column, through: Column, skipped: Column, shift: Column, base: int) -> Column:
    """Fingerprint of a head followed by the turns between two prefixes, moved by ``shift``, -5 to 0, places."""
    rest = F.pmod(through - skipped, F.lit(PRIME))
    factors = F.array(*[F.lit(pow(base, -k, PRIME)) for k in range(6)])
    near = F.pmod(head + rest, F.lit(PRIME))
    return F.when(shift == 0, near).otherwise(_join(head, rest, F.get(factors, -shift)))


def rebuilt_prefixes(turns: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """One row per rebuilt conversation and depth, 0 included: its fingerprint, its parent's, its last turn.

    ``ends`` marks the whole conversation.
    """
    fields = ["place", "f", "g", "pf", "pg", "t", "u", "chars"]
    # Five rows per base at most, and no base has more than 199 conversations.
    heads = turns.where((F.col("place") <= 5) & (F.col("conv_id") % 100 == 0)).groupBy("conv_id")
    heads = heads.agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("head")).withColumnRenamed("conv_id", "base")
    at_skip = lambda c: F.max(F.when(F.col("place") == head_turns(F.col("conv_id")), F.col(c)))
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("n"), at_skip("f").alias("sf"), at_skip("g").alias("sg"))
    convs = convs.withColumns({"base": base_of(F.col("conv_id")), "h": head_turns(F.col("conv_id"))})
    convs = convs.join(heads, "base", "left").withColumn("head", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("h")))
    zero = F.lit(0).cast("long")
    last = lambda c: F.coalesce(F.get("head", F.size("head") - 1)[c], zero)
    convs = convs.select(
        "conv_id", "head", "h", F.size("head").alias("k"), last("f").alias("hf"), last("g").alias("hg"),
        F.coalesce("sf", zero).alias("sf"), F.coalesce("sg", zero).alias("sg"),
        (F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("long").alias("whole"),
    )
    convs = stored(convs, "trie-convs")

    tail = ["pf", "pg", "t", "u", "chars"]
    root = convs.select("conv_id", zero.alias("depth"), zero.alias("f"), zero.alias("g"), *[zero.alias(c) for c in tail], "whole")
    from_head = convs.select("conv_id", "whole", F.inline("head")).withColumnRenamed("place", "depth")
    from_head = from_head.select("conv_id", "depth", "f", "g", *tail, "whole")
    own = turns.join(convs.drop("head"), "conv_id").where(F.col("place") > F.col("h"))
    shift = F.col("k") - F.col("h")
    composed = lambda name, k: _shifted(F.col(f"h{k}"), F.col(name), F.col(f"s{k}"), shift, bases["fg".index(k)]).alias(name)
    own = own.select(
        "conv_id", (F.col("place") + shift).alias("depth"), composed("f", "f"), composed("g", "g"),
        composed("pf", "f"), composed("pg", "g"), "t", "u", "chars", "whole",
    )
    rows = root.unionByName(from_head).unionByName(own)
    return stored(rows.withColumn("ends", F.col("depth") == F.col("whole")).drop("whole"), "trie-prefixes")


def _nodes(prefixes: DataFrame) -> DataFrame:
    same = [F.min(c).alias(c) for c in ("pf", "pg", "t", "u")] + [F.max(c).alias(f"{c}_max") for c in ("pf", "pg", "t", "u")]
    bucket = F.when(F.col("ends"), F.expr(f"conv_id div {_CHUNK}"))
    grouped = prefixes.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"), F.count_if("ends").alias("n_ends"),
        F.min(bucket).alias("low"), F.max(bucket).alias("high"), *same,
    )
    return stored(grouped, "trie-nodes")


def _end_digests(prefixes: DataFrame, nodes: DataFrame) -> DataFrame:
    """Digest of the conversations that end at each node.

    Ids are put together by ranges of the id, so a piece has a bounded number of them. Most nodes have one piece;
    the others' pieces go through the hash in order, one at a time.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []
        for batch in batches:
            for *own, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if own != key:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = own, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            if len(out) > _FLUSH:
                yield pa.RecordBatch.from_pylist([dict(zip((*_KEY, "ends_sha256"), r, strict=True)) for r in out])
                out = []
        if key is not None:
            out.append((*key, state.hexdigest()))
            yield pa.RecordBatch.from_pylist([dict(zip((*_KEY, "ends_sha256"), r, strict=True)) for r in out])

    ended = prefixes.where("ends").select(*_KEY, F.expr(f"conv_id div {_CHUNK}").alias("bucket"), "conv_id")
    pieces = ended.groupBy(*_KEY, "bucket").agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
    pieces = stored(pieces, "trie-ends")
    several = nodes.where("low < high").select(*_KEY)
    single = nodes.where("low = high").select(*_KEY).join(pieces, _KEY).select(*_KEY, F.sha2("ids", 256).alias("ends_sha256"))
    many = pieces.join(several, _KEY).repartition(*_KEY).sortWithinPartitions(*_KEY, "bucket")
    many = many.select(*_KEY, "ids").mapInArrow(stream, "depth long, f long, g long, ends_sha256 string")
    return single.unionByName(many)


def _above(nodes: DataFrame) -> DataFrame:
    """``saved_above``: what the nodes of the same conversation above a shared node save, summed by blocks of depths."""
    block = F.expr(f"depth div {_CHUNK}")
    rows = nodes.select("conv_id", "n_convs", *_KEY, ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"), block.alias("block"))
    shared = rows.where("n_convs > 1")
    over = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = shared.groupBy("conv_id", "block").agg(F.sum("saved").alias("sum"))
    blocks = blocks.withColumn("before", F.coalesce(F.sum("sum").over(over), F.lit(0))).drop("sum")
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    summed = shared.withColumn("inside", F.coalesce(F.sum("saved").over(inside), F.lit(0))).join(blocks, ["conv_id", "block"])
    return summed.select(*_KEY, (F.col("inside") + F.col("before")).alias("saved_above"))


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    ``conv_id`` is the smallest member, ``parent_conv_id`` the parent's (null for the root), ``n_convs`` counts
    members, ``n_children`` children, ``n_leaves`` childless nodes of the subtree, ``saved_tokens`` is
    the sum over it of each node's members but one times the code points of its last text, ``ends_sha256`` digests
    the ids of members that end here, in order, joined by commas.

    Turns are ordered by number, null first; equal numbers by the SHA-256 of role and text. Null roles and texts
    count as empty. Rows that repeat are turns of their own. Rows without a conv_id belong to no
    conversation and are left out. The base of a negative id is cut towards zero. An empty table has no members
    and so no nodes; further columns are not looked at. Texts are read once, whole.
    """
    ship(conversations.sparkSession)
    for bases in BASES:
        turns = placed(stored_turns(conversations, bases), bases)
        prefixes = rebuilt_prefixes(turns, bases)
        nodes = _nodes(prefixes)
        unlike = " OR ".join(f"{c} <> {c}_max" for c in ("pf", "pg", "t", "u"))
        if nodes.where(unlike).isEmpty():
            return _figures(prefixes, nodes)
    raise ArithmeticError("fingerprints met under all bases")


def _figures(prefixes: DataFrame, nodes: DataFrame) -> DataFrame:
    # A conversation owns its end if it is the smallest that ends there; nobody goes on if all end.
    per_conv = nodes.groupBy("conv_id").agg(
        F.sum((F.col("n_convs") - 1) * F.col("chars")).alias("saved"), F.max_by(F.col("n_convs") == F.col("n_ends"), "depth").cast("long").alias("leaf")
    )
    per_conv = stored(per_conv.where("saved > 0 OR leaf > 0"), "trie-chains")
    zero = F.lit(0).cast("long")
    below = prefixes.select("conv_id", *_KEY).join(per_conv, "conv_id").select(*_KEY, "saved", "leaf", zero.alias("child"))
    up = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("pf").alias("f"), F.col("pg").alias("g"), zero.alias("saved"), zero.alias("leaf"), F.lit(1).cast("long").alias("child"))
    sums = below.unionByName(up).groupBy(*_KEY).agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaves"), F.sum("child").alias("children"))
    sums = sums.join(_above(nodes), _KEY, "left")
    sums = stored(sums, "trie-sums")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("f").alias("pf"), F.col("g").alias("pg"), F.col("conv_id").alias("parent_conv_id"))
    own = nodes.select(*_KEY, "conv_id", "n_convs", "pf", "pg")
    whole = own.join(sums, _KEY).join(stored(_end_digests(prefixes, nodes), "trie-digests"), _KEY, "left")
    # Written down, so that the children of a common turn can be dealt to several tasks.
    whole = stored(whole, "trie-whole").join(stored(parents, "trie-parents"), ["depth", "pf", "pg"], "left")
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.when(F.col("n_convs") > 1, F.col("saved") - F.col("saved_above")).otherwise(F.lit(0)).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
