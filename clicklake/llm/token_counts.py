"""Token counts of a unigram vocabulary, worked out once per shared prefix of the words.

The distinct words of a batch are walked in sorted order, which is a walk through their trie: the forward
scores of the current path are on a stack, a word reuses those of the prefix it shares with the word before it
and adds its own. The score at a node is that of the best split of its prefix into pieces, with the tokens of
that split; a word's count is stored at its last node and kept for later batches, up to a bound.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.llm.common import ship

# The mark of a word's beginning, and the penalty of an unknown character below the worst piece.
MARK = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 400_000


@functools.lru_cache(maxsize=2)
def public_pieces(path: str) -> dict[str, float]:
    """Pieces of a public vocabulary file with log probabilities of Zipf's law by rank: it ships no unigram scores."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    names = [
        model.id_to_piece(k) for k in range(model.vocab_size())
        if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))
    ]
    total = math.log(sum(1 / k for k in range(1, len(names) + 1)))
    return {name: -math.log(k) - total for k, name in enumerate(names, 1)}


def trie_counts(words: list[str], pieces: dict[str, float]) -> list[int]:
    """Tokens of the best split of each word; ``words`` are sorted and distinct.

    Of equal scores the split with fewer tokens wins. An unknown character costs as many tokens as it has bytes.
    """
    longest = max(map(len, pieces), default=1)
    unknown = min(pieces.values(), default=0.0) - UNKNOWN_PENALTY
    scores, tokens = [0.0], [0]
    before, counts = "", []
    for word in words:
        shared = 0
        for a, b in zip(before, word):
            if a != b:
                break
            shared += 1
        del scores[shared + 1 :], tokens[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            best, fewest = scores[end - 1] + unknown, tokens[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass"))
            for start in range(max(0, end - longest), end):
                score = pieces.get(word[start:end])
                if score is not None:
                    score += scores[start]
                    n = tokens[start] + 1
                    if score > best or (score == best and n < fewest):
                        best, fewest = score, n
            scores.append(best)
            tokens.append(fewest)
        counts.append(tokens[-1])
        before = word
    return counts


@functools.lru_cache(maxsize=2)
def _memory(path: str) -> dict[bytes, int]:
    return {}


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_tokens``, over the whole text.

    Words are separated by blanks and the characters 9 to 13 and are split on their own. Null and empty texts
    have no words. Every row is counted, repeated ones alike; an empty table gives no rows; further columns are
    not looked at.
    """
    import public_tokenizers

    ship(docs.sparkSession)
    path = path or public_tokenizers.path("piece_bpe_32k.model")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, known = public_pieces(path), _memory(path)
        for batch in batches:
            # bytes.split() separates at exactly these characters.
            texts = [(t or "").encode("utf-8", "surrogatepass").split() for t in batch.column(1).to_pylist()]
            new = set().union(*texts) - known.keys()
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = set().union(*texts)
            ordered = sorted(new)
            spelt = [MARK + w.decode("utf-8", "surrogatepass") for w in ordered]
            known.update(zip(ordered, trie_counts(spelt, pieces), strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(w) for w in texts], pa.int64()), pa.array([sum(map(known.__getitem__, w)) for w in texts], pa.int64())],
                names=["doc_id", "n_words", "n_tokens"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return rows.mapInArrow(count, "doc_id long, n_words long, n_tokens long")
