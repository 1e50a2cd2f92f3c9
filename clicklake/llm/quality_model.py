"""Quality classifier: random-indexing word vectors, pooled per document, under a small calibrated network.

A word's vector is the sum of the sparse random index vectors of its neighbours over the learning texts; words
outside the vocabulary share the vector of their shape. A document is the mean of its words' vectors and the
share of words that echo the word before, drawn towards the average document where it is short. A network
with one hidden layer scores it, and a temperature fitted on rows the network did not learn from calibrates the
probability.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklake.llm.common import held_out, ship
from clicklake.session import stored

_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
SHAPES = ("lower", "upper", "title", "mixed", "digits", "signs")
_CHUNK = 1 << 16


def shape(token: str) -> str:
    if token.islower():
        return "lower"
    if token.isupper():
        return "upper"
    if token.istitle():
        return "title"
    if token.isalpha():
        return "mixed"
    return "digits" if token.isdigit() else "signs"


class Lexicon(dict):
    """Word to row of the vector table; unknown words map to the row of their shape and are remembered up to a bound."""

    def __init__(self, vocabulary: tuple[str, ...], remembered: int = 200_000):
        super().__init__((w, k) for k, w in enumerate(vocabulary))
        self.shapes = {s: len(vocabulary) + k for k, s in enumerate(SHAPES)}
        self.most = len(self) + remembered

    def __missing__(self, token: str) -> int:
        row = self.shapes[shape(token)]
        if len(self) < self.most:
            self[token] = row
        return row

    def rows(self, text: str) -> np.ndarray:
        return np.array([self[t] for t in _TOKEN.findall(text)], dtype=np.int64)

    def rows_and_echoes(self, text: str) -> tuple[np.ndarray, int]:
        """Rows of the words, and how many words equal the one before."""
        words = _TOKEN.findall(text)
        return np.array([self[t] for t in words], dtype=np.int64), sum(map(eq, words, words[1:]))


def index_vectors(names: list[str], dims: int, ones: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the few non-zero entries of each word's random vector, from the word alone."""
    places, signs = np.empty((len(names), ones), np.int64), np.empty((len(names), ones), np.int64)
    for k, name in enumerate(names):
        rng = np.random.default_rng(zlib.crc32(name.encode()))
        places[k] = rng.choice(dims, ones, replace=False)
        signs[k] = rng.choice((-1, 1), ones)
    return places, signs


@dataclass(frozen=True)
class Model:
    vocabulary: tuple[str, ...]
    vectors: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    weights: tuple[np.ndarray, np.ndarray, np.ndarray, float]
    temperature: float


@functools.lru_cache(maxsize=2)
def _lexicon(vocabulary: tuple[str, ...]) -> Lexicon:
    return Lexicon(vocabulary)


def pooled(texts: list[str | None], lexicon: Lexicon, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Summed word vectors of each text, with the words that echo the one before as last column, and word counts."""
    sums, counts = np.zeros((len(texts), vectors.shape[1] + 1), np.float32), np.zeros(len(texts))
    for k, text in enumerate(texts):
        rows, sums[k, -1] = lexicon.rows_and_echoes(text or "")
        counts[k] = len(rows)
        for at in range(0, len(rows), _CHUNK):
            sums[k, :-1] += vectors[rows[at : at + _CHUNK]].sum(0)
    return sums, counts


def features(sums: np.ndarray, counts: np.ndarray, centre: np.ndarray, spread: np.ndarray, prior: float = 10.0) -> np.ndarray:
    """Standardised mean vectors; ``prior`` words of the average document keep short texts from extremes."""
    return ((sums + prior * centre) / (counts + prior)[:, None] - centre) / spread


def train(x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 400, seed: int = 7) -> tuple:
    """Weights of the two layers by Adam on the whole sample, with weight decay."""
    rng = np.random.default_rng(seed)
    w = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), 0.0]
    m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    for t in range(1, epochs + 1):
        h = np.maximum(x @ w[0] + w[1], 0)
        error = (1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -30, 30))) - y) / len(y)
        back = np.outer(error, w[2]) * (h > 0)
        grads = [x.T @ back + 1e-4 * w[0], back.sum(0), h.T @ error + 1e-4 * w[2], error.sum()]
        for k, g in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            w[k] = w[k] - 0.02 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return tuple(w)


def logits(x: np.ndarray, weights: tuple) -> np.ndarray:
    return np.maximum(x @ weights[0] + weights[1], 0) @ weights[2] + weights[3]


def fit_temperature(z: np.ndarray, y: np.ndarray) -> float:
    """Temperature of the least cross-entropy on rows that were not learned from; 1 without such rows."""
    if not len(y):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 141))
    loss = [np.mean(np.logaddexp(0, -np.where(y == 1, z, -z) / t)) for t in grid]
    return float(grid[int(np.argmin(loss))])


def learn(
    docs: DataFrame, labels: DataFrame, max_rows: int = 6_000, max_words: int = 12_000, dims: int = 64, ones: int = 4, reach: int = 2
) -> Model | None:
    """Model from at most ``max_rows`` labelled rows, drawn by id hash; the held-out fifth is left out.

    None without usable labels. Ids labelled more than once count once, with their smallest label; ids with several
    documents give one of them, the text with the smallest hash.
    """
    ship(docs.sparkSession)
    known = labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # At most max_rows ids and labels are sent to the tasks; rows that repeat an id leave the text of the smallest hash.
    labelled = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality")
    labelled = labelled.agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one"))
    sample = stored(labelled.select("doc_id", "quality", "one.text"), "quality-sample").repartition(24, "doc_id")

    def document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = Counter(t for text in batch.column(0).to_pylist() for t in set(_TOKEN.findall(text)))
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

    frequent = sample.select("text").mapInArrow(document_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = tuple(r["word"] for r in frequent.where("n >= 3").orderBy(F.desc("n"), "word").limit(max_words).collect())
    places, signs = index_vectors([*vocabulary, *(f"<{s}>" for s in SHAPES)], dims, ones)
    n_rows = len(places)

    def neighbour_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, total = _lexicon(vocabulary), np.zeros(n_rows * dims, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def add() -> None:
            if held:
                word, near = (np.concatenate(side) for side in zip(*held, strict=True))
                for k in range(ones):
                    found = np.bincount(word * dims + places[near, k], weights=signs[near, k], minlength=n_rows * dims)
                    np.add(total, found.astype(np.int64), out=total)
                held.clear()

        size = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                rows = lexicon.rows(text)
                for gap in range(1, reach + 1):
                    held += [(rows[gap:], rows[:-gap]), (rows[:-gap], rows[gap:])]
                size += len(rows)
                if size > _CHUNK * 8:
                    add()
                    size = 0
        add()
        table = total.reshape(n_rows, dims)
        used = np.flatnonzero(table.any(1))
        yield pa.RecordBatch.from_pandas(pd.DataFrame({"row": used, "v": list(table[used])}), preserve_index=False)

    sums = sample.select("text").mapInArrow(neighbour_sums, "row long, v array<long>").groupBy("row")
    sums = sums.agg(F.array(*[F.sum(F.get("v", F.lit(k))) for k in range(dims)]).alias("v")).toPandas()
    vectors = np.zeros((n_rows, dims), np.float32)
    for row, v in zip(sums["row"], sums["v"], strict=True):
        vectors[row] = np.asarray(v, np.float64) / max(np.linalg.norm(np.asarray(v, np.float64)), 1e-9)

    def document_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, n = pooled(batch.column(2).to_pylist(), _lexicon(vocabulary), vectors)
            columns = [batch.column(0), batch.column(1), pa.array(list(sums)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "quality", "sums", "n"])

    kinds = "doc_id long, quality long, sums array<float>, n double"
    rows = sample.select("doc_id", F.col("quality").cast("long"), "text").mapInArrow(document_sums, kinds).toPandas()
    rows = rows.sort_values(["doc_id", "n"], kind="stable")
    if rows.empty:
        return None
    sums, n, y = np.stack(rows["sums"].to_numpy()).astype(np.float64), rows["n"].to_numpy(), rows["quality"].to_numpy(np.float64)
    aside = np.array([zlib.crc32(str(k).encode()) // 5 % 5 == 0 for k in rows["doc_id"]])
    if aside.all():
        aside[:] = False
    means = (sums / np.maximum(n, 1)[:, None])[~aside]
    centre, spread = means.mean(0), means.std(0) + 1e-6
    x = features(sums, n, centre, spread)
    weights = train(x[~aside], y[~aside])
    return Model(vocabulary, vectors, centre, spread, weights, fit_temperature(logits(x[aside], weights), y[aside]))


def probabilities(texts: list[str | None], model: Model) -> np.ndarray:
    x = features(*pooled(texts, _lexicon(model.vocabulary), model.vectors), model.centre, model.spread)
    return 1 / (1 + np.exp(-np.clip(logits(x, model.weights) / model.temperature, -500, 500)))


def quality_score(docs: DataFrame, model: Model | None) -> Column:
    """Probability of label 1 from the whole text alone; null and empty texts are scored as documents without words.

    Without a model every text scores 1, so that nothing is rejected unlearned.
    """
    if model is None:
        return F.lit(1.0)
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(probabilities(texts.tolist(), shared.value))

    return score(F.col("text").cast("string"))


def scored(docs: DataFrame, model: Model | None, threshold: float = 0.3) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Rows that repeat are judged alike; null ids belong to the held-out part; an empty table gives no rows;
    further columns are not looked at.
    """
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), quality_score(docs, model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, model: Model | None, threshold: float = 0.3) -> DataFrame:
    """The documents the classifier does not reject, with their own columns."""
    return docs.where(quality_score(docs, model) >= threshold)
