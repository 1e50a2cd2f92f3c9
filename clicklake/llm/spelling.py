"""Spelling variants: words one edit apart, found by pivotal grams.

Bigrams are ranked by the number of words that hold them, rare first. A word's prefix is its three rarest
bigrams; its pivots are two of them that do not overlap, chosen for the least total frequency by dynamic
programming. One edit can spoil one pivot only, so of two near words the one whose prefix ends earlier in the
ranking has a pivot that the other has too, in its prefix, at the same distance from the start (the edit is to
the right) or from the end (to the left).

Pivots are looked up in an index of the other words' prefixes. The position limit is part of the key: a bigram
at its distance from the near end comes with all that is between them, and with one half of what is
beyond it, as the edit spoils only the other half. Pairs that meet are verified by their edit distance. Nothing
but letter statistics of a bounded alphabet reaches the driver.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.llm.common import ship
from clicklake.session import stored

# Letters of a run, and those lower-cased; all others part runs.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256)
)
_FLUSH = 200_000
_GRAM = 2
_PREFIX = 3


def runs(text: str) -> list[bytes]:
    """Runs of letters in lower case (A-Z only), in Latin-1, one byte a code point."""
    return text.encode("latin-1", "replace").translate(_TABLE).split()


def altered(doc: int, run: bytes, divisor: int) -> bytes:
    """The run, without one letter where the check sum ``doc`` continues through it is a multiple of ``divisor``."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), doc)
    if h % divisor:
        return run
    return run[: (k := h % len(run))] + run[k + 1 :]


def count_words(docs: DataFrame, least_length: int = 5, least_count: int = 3, divisor: int = 97) -> DataFrame:
    """``word, n`` over whole texts; see ``variants``. Counts are summed per task before the shuffle."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in total], pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"]
            )
            total.clear()
            return out

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                doc = zlib.crc32(f"{name}:".encode())
                for run, n in Counter(runs(text)).items():
                    if len(run) >= least_length and len(word := altered(doc, run, divisor)) >= least_length:
                        total[word] += n
                if len(total) > _FLUSH:
                    yield flush()
        if total:
            yield flush()

    rows = docs.where(F.col("text").isNotNull()).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"), F.col("text").cast("string"))
    counted = rows.mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def gram_ranks(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Rank and frequency of every bigram, rare first. There are no more than letters squared, 8,100."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[str] = Counter()
            for word in batch.column(0).to_pylist():
                found.update({word[k : k + _GRAM] for k in range(len(word) - 1)})
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["gram", "n"])

    rows = words.select("word").mapInArrow(grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    return {r["gram"]: (k, r["n"]) for k, r in enumerate(sorted(rows, key=lambda r: (r["n"], r["gram"])))}


def prefix_grams(word: str, ranks: dict[str, tuple[int, int]]) -> tuple[list[int], list[int], int]:
    """Places of the pivots, places of the prefix others may meet, and the rank the prefix ends with.

    The own prefix is the first three places by rank and position. Of the bigram it ends with, an edit may put two
    more before one of these, so the first five places are open to others.
    """
    ordered = sorted((ranks[word[k : k + _GRAM]][0], k) for k in range(len(word) - 1))
    last = ordered[_PREFIX - 1][0]
    below = [k for rank, k in ordered if rank < last]
    level = [k for rank, k in ordered if rank == last]
    return choose_pivots(word, [k for _, k in ordered[:_PREFIX]], ranks), below + level[: _PREFIX + 2], last


def choose_pivots(word: str, places: list[int], ranks: dict[str, tuple[int, int]], wanted: int = 2) -> list[int]:
    """Places of ``wanted`` bigrams that do not overlap, of the least total frequency; ties to the left."""
    places = sorted(places)
    best: list[dict[int, tuple[int, list[int]]]] = [{0: (0, [])}]
    for i, at in enumerate(places):
        before = next((j for j in range(i, 0, -1) if places[j - 1] + _GRAM <= at), 0)
        row = dict(best[i])
        for n, (cost, chosen) in best[before].items():
            if n < wanted:
                took = (cost + ranks[word[at : at + _GRAM]][1], [*chosen, at])
                row[n + 1] = min(row.get(n + 1, took), took)
        best.append(row)
    return best[-1][wanted][1]


def half_keys(side: str, word: str, at: int, length: int) -> Iterator[str]:
    """Keys of a bigram at ``at`` of ``word``, for a word that has it in a pivot and is ``length`` long.

    Up to the bigram's end the words are equal; beyond it up to the middle, or from there on. The same holds from
    the other end with the words reversed.
    """
    end = at + _GRAM
    beyond = length - end
    if beyond < 0:
        return
    middle = end + (beyond + 1) // 2
    tag = f"{side}{length}"
    if len(word) >= middle:
        yield f"{tag}<{word[:middle]}"
    if beyond and (start := len(word) - (length - middle)) >= end:
        yield f"{tag}>{word[:end]}|{word[start:]}"


def pivot_keys(word: str, places: list[int]) -> set[str]:
    """Keys that look for near words."""
    back, n = word[::-1], len(word)
    return {x for k in places for x in (*half_keys("l", word, k, n), *half_keys("r", back, n - k - _GRAM, n))}


def prefix_keys(word: str, places: list[int]) -> set[str]:
    """Keys under which a word is found, one edit longer or shorter words looking for it included."""
    back, n = word[::-1], len(word)
    return {
        x for k in places for m in (n - 1, n, n + 1)
        for x in (*half_keys("l", word, k, m), *half_keys("r", back, n - k - _GRAM, m))
    }


def _keyed(words: DataFrame, ranks: dict[str, tuple[int, int]]) -> DataFrame:
    """``pivot, key, word, n, last``: every word under its pivot keys and its prefix keys."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 2_000):
                part = batch.slice(first, 2_000)
                rows = []
                for word, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    pivots, prefix, last = prefix_grams(word, ranks)
                    rows += [(True, x, word, n, last) for x in pivot_keys(word, pivots)]
                    rows += [(False, x, word, n, last) for x in prefix_keys(word, prefix)]
                kinds = (pa.bool_(), pa.string(), pa.string(), pa.int64(), pa.int32())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["pivot", "key", "word", "n", "last"])

    keyed = words.select("word", "n").mapInArrow(emit, "pivot boolean, key string, word string, n long, last int")
    # The key is only hashed: words that meet by chance fail the check.
    return stored(keyed.withColumn("key", F.xxhash64("key")), "spelling-keys")


def near_pairs(words: DataFrame) -> DataFrame:
    """Pairs ``word, n, other, other_n`` of words (``word, n``; 5 code points at least) one edit apart, both ways."""
    ship(words.sparkSession)
    keyed = _keyed(words, gram_ranks(words))
    asking = keyed.where("pivot").select("key", F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("last").alias("a_last"))
    found = keyed.where("NOT pivot").select("key", F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("last").alias("b_last"))
    met = asking.join(found, "key").where("a_last <= b_last AND a <> b AND levenshtein(a, b, 1) = 1")
    pairs = stored(met.select("a", "a_n", "b", "b_n"), "spelling-pairs")
    ways = pairs.union(pairs.select("b", "b_n", "a", "a_n")).toDF("word", "n", "other", "other_n")
    return ways.distinct()


def follow(forms: DataFrame) -> DataFrame:
    """``word, root``: forms (``word, form``) followed to the last, by doubling. Chains must not close."""
    steps = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on"))
        moved = stored(moved, "spelling-roots")
        steps = moved.drop("on")
        if moved.where("on").isEmpty():
            return steps


def variants(docs: DataFrame, least_length: int = 5, least_count: int = 3, divisor: int = 97, ratio: int = 2) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    Runs of A-Z, a-z and U+00C0 to U+00FF of whole texts, A-Z in lower case. Where ``divisor`` divides the CRC-32
    of ``<doc_id>:<run>``, the code point at its remainder by the run's length goes. Words have ``least_length``
    code points and ``least_count`` occurrences. ``form`` is the near word of the largest count, if that is
    ``ratio`` times the own at least; equal counts go to the first by code point. As counts grow along forms,
    chains end.

    A null text has no runs, a null id is an empty name; rows that repeat count again. Texts and words of any length
    are whole. A table without words gives no rows; further columns are not looked at.
    """
    if least_length < 5 or ratio < 2:
        raise ValueError("words need 5 letters for three bigrams, and forms twice the count to end")
    words = stored(count_words(docs, least_length, least_count, divisor), "spelling-words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    near = stored(near.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")), "spelling-near")
    rows = words.join(near, "word", "left")
    enough = F.col("form_n") >= ratio * F.col("n")
    rows = rows.select(
        "word", F.when(enough, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("form_n")).alias("form_n"),
    )
    rows = stored(rows, "spelling-forms")
    roots = follow(rows.where("form IS NOT NULL"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
