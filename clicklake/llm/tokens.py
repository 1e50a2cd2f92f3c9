"""Token ids of a public byte-level vocabulary, in tasks.

The ids are those of the ``tokenizers`` file. They are made by ``tiktoken`` from the same vocabulary as ranks,
which is several times faster; texts that spell a special token go through ``tokenizers`` itself, which reads
it as one.
"""

from __future__ import annotations

import base64
import functools
from dataclasses import dataclass

import numpy as np

# Fixed value: the vocabulary's splitting pattern, with possessive runs so that the splitter never backtracks.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
SPECIAL = "<|endoftext|>"


@dataclass(frozen=True)
class Vocabulary:
    """Paths of one vocabulary as a ``tokenizers`` file and as ranks."""

    json_path: str
    ranks_path: str

    @staticmethod
    def public(name: str = "byte_bpe_50k") -> Vocabulary:
        import public_tokenizers

        return Vocabulary(public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken"))


@functools.lru_cache(maxsize=2)
def _fast(ranks_path: str):
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=2)
def _exact(json_path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(json_path)


def encode(text: str, vocabulary: Vocabulary) -> np.ndarray:
    """Ids of a text as little-endian unsigned 32-bit integers."""
    if SPECIAL in text:
        return np.array(_exact(vocabulary.json_path).encode(text, add_special_tokens=False).ids, dtype="<u4")
    return np.array(_fast(vocabulary.ranks_path).encode_ordinary(text), dtype="<u4")
