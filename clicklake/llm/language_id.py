"""Language identification by prediction by partial matching over bytes.

Each language has a tree of byte contexts of up to three bytes. A context predicts the bytes it has seen by
their counts and passes the rest, by an escape probability (as many escapes as different bytes seen, "method
C"), to its shorter context, which shares it among the bytes not yet excluded; below the empty context stands
the uniform distribution. Statistics are frozen after learning, so every context is a fixed row of code lengths
per byte and language, and a text costs the sum of its bytes' code lengths. The shortest code wins.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicklake.llm.common import held_out, ship
from clicklake.session import stored

ORDER = 3
UNKNOWN = "und"
_START = b"\n" * ORDER
_LETTER = re.compile(r"[^\W\d_]")
_SLICE = 1 << 20


@dataclass(frozen=True)
class Model:
    """``contexts`` are (order, value) of the kept contexts; ``bits`` holds code lengths by context, byte and language."""

    languages: tuple[str, ...]
    orders: np.ndarray
    contexts: np.ndarray
    bits: np.ndarray

    def index(self) -> np.ndarray:
        """Longest kept context for every three bytes."""
        table = np.zeros(1 << 8 * ORDER, dtype=np.int32)
        for order in range(1, ORDER + 1):
            which = np.flatnonzero(self.orders == order)
            table.reshape(-1, 1 << 8 * order)[:, self.contexts[which]] = which
        return table


def normal(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def _grams(data: np.ndarray) -> np.ndarray:
    """Each byte with the three before it, as one number."""
    wide = data.astype(np.uint32)
    return (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]


def count_grams(texts: DataFrame) -> DataFrame:
    """``lang, gram, n`` over whole texts (``lang, text``), summed per batch before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                grams, n = np.unique(_grams(np.frombuffer(_START + normal(text or ""), np.uint8)), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n), pa.string()), pa.array(grams.astype(np.int64)), pa.array(n.astype(np.int64))],
                    names=["lang", "gram", "n"],
                )

    counted = texts.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def build(
    counts: dict[str, tuple[np.ndarray, np.ndarray]], max_contexts: int = 8192, least: int = 8, max_cells: int = 1 << 26
) -> Model:
    """Model from counts of four-byte grams per language.

    A longer context is kept when the languages together have seen it ``least`` times, up to ``max_contexts`` per
    order and ``max_cells`` code lengths in all, a quarter of a gigabyte. Each language first gets an equal part of
    the places for its own most frequent contexts; what is left goes to the most frequent of all. A text in any other
    context uses the shorter one.
    """
    languages = tuple(sorted(counts))
    max_contexts = max(1, min(max_contexts, max_cells // (256 * ORDER * max(1, len(languages)))))
    orders, contexts = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
    bits = [_rows(counts, languages, 0, contexts[0], None)]
    previous = contexts[0]
    for order in range(1, ORDER + 1):
        keys = np.concatenate([(g >> 8) & ((1 << 8 * order) - 1) for g, _ in counts.values()] or [np.zeros(0, np.int64)])
        found, at = np.unique(keys, return_inverse=True)
        total = np.bincount(at, weights=np.concatenate([n for _, n in counts.values()] or [np.zeros(0)]), minlength=len(found))
        shorter = found & ((1 << 8 * (order - 1)) - 1)
        allowed = np.flatnonzero((total >= least) & np.isin(shorter, previous))
        kept = np.sort(found[_fair(allowed, total, at, counts, max_contexts)])
        below = bits[-1][np.searchsorted(previous, kept & ((1 << 8 * (order - 1)) - 1))]
        bits.append(_rows(counts, languages, order, kept, below))
        orders.append(np.full(len(kept), order))
        contexts.append(kept)
        previous = kept
    return Model(languages, np.concatenate(orders), np.concatenate(contexts), np.concatenate(bits).astype(np.float32))


def _fair(allowed: np.ndarray, total: np.ndarray, at: np.ndarray, counts, places: int) -> np.ndarray:
    """Of the allowed contexts, an equal number of each language's most frequent, then the most frequent of all."""
    each, chosen, first = places // max(1, len(counts)), np.zeros(len(total), bool), 0
    for _, n in counts.values():
        own = np.bincount(at[first : first + len(n)], weights=n, minlength=len(total))[allowed]
        first += len(n)
        best = np.argsort(-own, kind="stable")[:each]
        chosen[allowed[best[own[best] > 0]]] = True
    rest = allowed[~chosen[allowed]]
    rest = rest[np.argsort(-total[rest], kind="stable")][: places - int(chosen.sum())]
    return np.concatenate([np.flatnonzero(chosen), rest])


def _rows(counts, languages: tuple[str, ...], order: int, kept: np.ndarray, below: np.ndarray | None) -> np.ndarray:
    """Code lengths (context, byte, language) of one order, given those of the contexts one byte shorter."""
    out = np.empty((len(kept), 256, len(languages)), np.float64)
    for k, lang in enumerate(languages):
        grams, n = counts[lang]
        context, byte = (grams >> 8) & ((1 << 8 * order) - 1), grams & 255
        at = np.minimum(np.searchsorted(kept, context), max(len(kept) - 1, 0))
        hit = kept[at] == context if len(kept) else np.zeros(len(grams), bool)
        seen = np.bincount(at[hit] * 256 + byte[hit], weights=n[hit], minlength=len(kept) * 256).reshape(-1, 256)
        shorter = np.full((len(kept), 256), 1 / 256) if below is None else np.exp2(-below[:, :, k])
        new = seen == 0
        different, total = (~new).sum(1, keepdims=True), seen.sum(1, keepdims=True)
        rest = np.where(new, shorter, 0)
        share = rest.sum(1, keepdims=True)
        scale = np.maximum(total + np.where(share > 0, different, 0), 1)
        p = np.where(new, different / scale * rest / np.maximum(share, 1e-300), seen / scale)
        out[:, :, k] = -np.log2(np.maximum(np.where(total == 0, shorter, p), 1e-30))
    return out


def code_lengths(texts: list[bytes], model: Model, index: np.ndarray) -> np.ndarray:
    """Bits per text and language; a slice of texts is worked at a time, long texts in several."""
    total = np.zeros((len(texts), len(model.languages)))
    table = model.bits.reshape(-1, len(model.languages))

    def bits(data: np.ndarray) -> np.ndarray:
        wide = data.astype(np.int32)
        context = (wide[:-3] << 16) | (wide[1:-2] << 8) | wide[2:-1]
        return np.take(table, index[context] * 256 + wide[3:], axis=0)

    def many(first: int, last: int) -> None:
        joined = np.frombuffer(b"".join(_START + t for t in texts[first:last]), np.uint8)
        lengths = np.array([len(t) for t in texts[first:last]])
        begins = np.cumsum(lengths + ORDER) - lengths - ORDER
        found = np.append(bits(joined), np.zeros((2, table.shape[1]), np.float32), axis=0)
        edges = np.stack([begins, begins + lengths], axis=1).ravel()
        sums = np.add.reduceat(found, edges, axis=0, dtype=np.float64)[::2]
        total[first:last] = np.where(lengths[:, None] > 0, sums, 0)

    first = size = 0
    for k, text in enumerate(texts):
        if len(text) > _SLICE:
            many(first, k)if k > first else None
            whole = np.frombuffer(_START + text, np.uint8)
            for at in range(0, len(text), _SLICE):
                total[k] += bits(whole[at : at + _SLICE + ORDER]).sum(0, dtype=np.float64)
            first, size = k + 1, 0
            continue
        size += len(text)
        if size >= _SLICE:
            many(first, k + 1)
            first, size = k + 1, 0
    if first < len(texts):
        many(first, len(texts))
    return total


def learn(docs: DataFrame, rows_per_language: int = 400, max_languages: int = 256) -> Model:
    """Model of the languages in ``lang`` from at most ``rows_per_language`` whole texts each, drawn by id hash.

    Rows of the held-out fifth, with a null language or a null text are left out. Of rows that share id and
    language, however many, the one with the smallest text hash counts, so every language with an id has a text.
    Equal draws go by id. Of more than ``max_languages`` languages those with the most ids are learned, equal
    numbers by name. Empty texts teach nothing but their language's name; an empty table gives an empty model, which
    knows no language; further columns are not looked at.
    """
    ship(docs.sparkSession)
    usable = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    named = F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("text_hash")
    ids = stored(usable.select(*named).groupBy("lang", "doc_id").agg(F.min("text_hash").alias("text_hash")), "language-ids")
    most = ids.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages)
    sizes = {r["lang"]: r["count"] for r in most.collect()}
    if not sizes:
        return build({})
    # Of ids with independent draws, more than wanted lie below four times the share and a margin; without the
    # others no task sees a whole language.
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, (4.0 * rows_per_language + 64) / n))])
    ids = ids.withColumn("draw", F.xxhash64("doc_id")).where(F.col("draw") / F.lit(2.0**64) + 0.5 <= share[F.col("lang")])
    drawn = Window.partitionBy("lang").orderBy("draw", "doc_id")
    chosen = ids.withColumn("n", F.row_number().over(drawn)).where(F.col("n") <= rows_per_language)
    chosen = chosen.select("lang", "doc_id", "text_hash")
    # At most ``rows_per_language`` times ``max_languages`` names, so they can go to every task.
    texts = usable.select(*named, "text").join(F.broadcast(chosen), ["lang", "doc_id", "text_hash"], "left_semi")
    rows = count_grams(texts.dropDuplicates(["lang", "doc_id"])).toPandas()
    counts = {
        lang: (part["gram"].to_numpy(np.int64), part["n"].to_numpy(np.int64)) for lang, part in rows.groupby("lang", sort=True)
    }
    return build(counts)


@functools.lru_cache(maxsize=1)
def _opened(shared) -> tuple[Model, np.ndarray]:
    return shared.value, shared.value.index()


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``, from the whole text alone.

    ``lang_pred`` is ``und`` with score 0 if the text is null or has no letter, or nothing could be learned;
    equal code lengths go to the first language by name. ``score`` is the share of the best code among all,
    each weighing two to the minus its length. Rows that repeat are judged alike; an empty table gives no rows;
    further columns are not looked at.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, index = _opened(shared)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            spelt = [t is not None and bool(known.languages) and _LETTER.search(t) is not None for t in texts]
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if any(spelt):
                at = [k for k, ok in enumerate(spelt) if ok]
                bits = code_lengths([normal(texts[k]) for k in at], known, index)
                best = bits.argmin(1)
                share = 1 / np.exp2(np.minimum(bits.min(1, keepdims=True) - bits, 0)).sum(1)
                for k, b, s in zip(at, best, share, strict=True):
                    names[k], scores[k] = known.languages[b], float(s)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names), pa.array(scores)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")
