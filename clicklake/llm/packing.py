"""Best-fit packing by length patterns.

Documents become pieces of at most one sequence. The histogram of piece lengths, of fixed size whatever the
corpus, is fitted by non-negative least squares with patterns of two or three lengths that fill a sequence;
counts are rounded, and what is left is packed best fit, longest first, again by counts. The plan is a list of
patterns with repeat counts. Pieces are numbered within their length by task and place, and each number is
looked up in the plan, so no task sees more than its own pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicklake.llm.common import ship
from clicklake.llm.tokens import Vocabulary, encode
from clicklake.session import stored

Plan = list[tuple[tuple[int, ...], int]]
_RANK_BITS = 40


def patterns(lengths: list[int], room: int, most: int) -> list[tuple[int, ...]]:
    """Pairs and triples of present lengths that fill ``room`` up to a 64th, about ``most`` triples at most.

    Every length meets its largest partner; of the triples, every k-th by place is taken, so all lengths occur.
    """
    slack, lengths = room // 64, sorted(lengths)

    def largest(limit: int) -> int:
        k = bisect_right(lengths, limit)
        return lengths[k - 1] if k else 0

    found = set()
    for a in lengths:
        b = largest(room - a)
        if b and a + b >= room - slack:
            found.add((max(a, b), min(a, b)))
    stride = max(1, len(lengths) ** 2 // (4 * max(most, 1)))
    for i, c in enumerate(lengths):
        for j in range((i * 7) % stride, i + 1, stride):
            b = lengths[j]
            a = largest(min(b, room - b - c))
            if a and a + b + c >= room - slack and a + b + c <= room:
                found.add((c, b, a))
    return sorted(found, reverse=True)


def fitted(found: list[tuple[int, ...]], counts: dict[int, int], sweeps: int = 100) -> list[float]:
    """Non-negative least squares by coordinate descent: repeats of each pattern that come nearest to the counts.

    It ends when no repeat moves by a quarter of a sequence, or after ``sweeps``; what it leaves is packed best fit.
    """
    left = {k: float(v) for k, v in counts.items()}
    parts = [[(x, p.count(x)) for x in set(p)] for p in found]
    norms = [sum(m * m for _, m in part) for part in parts]
    repeats = [0.0] * len(found)
    for _ in range(sweeps):
        moved = 0.0
        for k, part in enumerate(parts):
            step = sum(left[x] * m for x, m in part) / norms[k]
            new = max(0.0, repeats[k] + step)
            step = new - repeats[k]
            if step:
                repeats[k] = new
                moved = max(moved, abs(step))
                for x, m in part:
                    left[x] -= step * m
        if moved < 0.25:
            break
    return repeats


def best_fit(counts: dict[int, int], room: int) -> Plan:
    """Best fit, longest first, on counts: sequences filled alike are moved together."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    free = np.zeros(room + 1, dtype=bool)

    def put(space: int, pattern: tuple[int, ...], n: int) -> None:
        if n:
            open_.setdefault(space, []).append((pattern, n))
            free[space] = True

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            spot = int(np.argmax(free[length:])) + length
            if free[spot]:
                pattern, bins = open_[spot].pop()
                free[spot] = bool(open_[spot])
            else:
                spot, pattern, bins = room, (), n
            each = spot // length
            full = min(bins, n // each)
            put(spot - each * length, pattern + (length,) * each, full)
            n, bins = n - full * each, bins - full
            if n and bins:
                put(spot - n * length, pattern + (length,) * n, 1)
                n, bins = 0, bins - 1
            if pattern:
                put(spot, pattern, bins)
    return [x for groups in open_.values() for x in groups]


def plan(counts: dict[int, int], room: int, most: int = 24_000) -> Plan:
    """Patterns of lengths with how often each is used; together they use every count exactly.

    Which patterns are tried depends on the lengths that occur alone, not on how many pieces there are.
    """
    left = {k: int(v) for k, v in counts.items() if v > 0}
    full = left.pop(room, 0)
    chosen: Plan = [((room,), full)] if full else []
    found = patterns(list(left), room, most)
    repeats = fitted(found, left)
    for k in sorted(range(len(found)), key=lambda k: (-repeats[k], k)):
        fits = min(left[x] // found[k].count(x) for x in set(found[k]))
        if n := min(round(repeats[k]), fits):
            chosen.append((found[k], n))
            for x in found[k]:
                left[x] -= n
    return chosen + best_fit({k: v for k, v in left.items() if v}, room)


def _slots(chosen: Plan) -> dict[str, np.ndarray]:
    """Per run of slots of one length: its first rank, packed with the length, its first sequence and its offset."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, n in chosen:
        offset = 0
        for length in pattern:
            rank = taken.get(length, 0)
            rows.append(((length << _RANK_BITS) + rank, sequence, offset))
            taken[length] = rank + n
            offset += length
        sequence += n
    rows.sort()
    first, begin, offset = (np.array(c, dtype=np.int64) for c in (zip(*rows, strict=True) if rows else ((), (), ())))
    return {"first": first, "sequence": begin, "offset": offset}


_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()), ("part", pa.int32()), ("nth", pa.int64()), ("ids", pa.binary()),
])
_PIECES_SQL = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long, ids binary"


def pieces(docs: DataFrame, vocabulary: Vocabulary, room: int, end_id: int, with_ids: bool) -> DataFrame:
    """Pieces of all documents; ``nth`` numbers those of a length within the task ``part``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(room + 1, dtype=np.int64)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or "", vocabulary), np.array([end_id], dtype="<u4"))
                first = len(ids) % room or room
                for k, start in enumerate([0, *range(first, len(ids), room)]):
                    piece = ids[start : first if k == 0 else start + room]
                    raw, n = piece.tobytes(), len(piece)
                    rows.append((doc_id, k, start, n, zlib.crc32(raw), part, int(seen[n]), raw if with_ids else None))
                    seen[n] += 1
            if rows:
                columns = zip(zip(*rows, strict=True), _PIECES, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=_PIECES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(cut, _PIECES_SQL)


_PLACED_SQL = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, ids binary"


def pack(
    docs: DataFrame, vocabulary: Vocabulary | None = None, room: int = 2048, end_id: int = 0, with_ids: bool = False
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``).

    A document is its token ids and ``end_id``; null text counts as empty, so it is one token. Documents longer
    than ``room`` are cut into pieces of ``room`` tokens, the first may be shorter; no text is shortened. Every
    row is a document of its own, also where rows repeat or have a null id. An empty table gives no rows;
    further columns are not looked at.
    """
    ship(docs.sparkSession)
    vocabulary = vocabulary or Vocabulary.public()
    cut = stored(pieces(docs, vocabulary, room, end_id, with_ids), "pieces")
    per_part = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    # One row per length, room at most.
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = docs.sparkSession.sparkContext.broadcast(_slots(plan(counts, room)))

    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = cut.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    keep = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value
        for batch in batches:
            key = (batch.column("length").to_numpy() << _RANK_BITS) + batch.column("rank").to_numpy()
            at = np.searchsorted(table["first"], key, side="right") - 1
            sequence = table["sequence"][at] + key - table["first"][at]
            columns = [*(batch.column(c) for c in keep), pa.array(sequence), pa.array(table["offset"][at]), batch.column("ids")]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "sequence_id", "offset", "ids"])

    placed = ranked.select(*keep, "rank", "ids").mapInArrow(place, _PLACED_SQL)
    return placed if with_ids else placed.drop("ids")
