"""Mixing, packing and token counts against plain computations and round trips."""

import functools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models

from clicklake.llm import mixing, packing, token_counts
from clicklake.llm.tokens import Vocabulary, encode


def reshared(sizes, weights=(1, 2, 3)):
    """Targets by resharing the excess step by step."""
    w = [weights[k % len(weights)] for k in range(len(sizes))]
    total, capped = sum(sizes), set()
    while True:
        rest = total - sum(3 * sizes[k] for k in capped)
        free = sum(w[k] for k in range(len(sizes)) if k not in capped)
        t = [3.0 * sizes[k] if k in capped else rest * w[k] / free for k in range(len(sizes))]
        over = {k for k in range(len(sizes)) if k not in capped and t[k] > 3 * sizes[k]}
        if not over:
            return t
        capped |= over


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 1, 1000], [5, 500, 1, 1, 1, 90], [7], [3, 0, 4]])
def test_targets(spark, sizes):
    rows = [(k == len(sizes) - 1 and len(sizes) > 3, f"s{k}", n) for k, n in enumerate(sizes)]
    rows = [(no, "" if no else name, n) for no, name, n in rows]
    totals = spark.createDataFrame(rows, "no_source boolean, source_name string, source_size long")
    got = {(r.no_source, r.source_name): r.target for r in mixing.targets(totals).collect()}
    want = reshared(sizes)
    assert [got[no, name] for no, name, _ in rows] == pytest.approx(want)


def test_mix_meets_its_targets(make_docs, odd_rows):
    rng = random.Random(1)
    rows = [(k, " ".join(["w"] * rng.randrange(1, 60)), "en", "hot" if k % 3 == 0 else f"s{k % 7}") for k in range(3000)]
    docs = make_docs(rows + [(None, "null id here", None, None), (5000, None, "en", "hot"), (1, rows[1][1], "en", rows[1][3])])
    got = mixing.mix(docs, rows_per_cell=50).collect()
    assert len(got) == 3003
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        assert sum(r.size for r in own) == own[0].source_size
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
        epochs = int(own[0].target // own[0].source_size)
        assert {r.copies for r in own} <= {epochs, epochs + 1} and max(r.copies for r in own) <= 3
    again = mixing.mix(docs.repartition(7), rows_per_cell=900).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_repeated_returns_whole_documents(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    out = mixing.repeated(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r.copies for r in mixing.mix(docs).collect())
    empty = make_docs([])
    assert mixing.mix(empty).count() == 0 and mixing.repeated(empty).count() == 0


def test_heavier_documents_are_drawn_more_often(make_docs):
    from pyspark.sql import functions as F

    docs = make_docs([(k, "a b c d", "en", "a" if k < 2000 else "b") for k in range(3000)])
    got = mixing.mix(docs, (1, 5), quality=F.when(F.col("doc_id") % 2 == 0, 9.0).otherwise(1.0)).where("source = 'a' AND copies > 0")
    even = got.where("doc_id % 2 = 0").count()
    assert even > 2 * (got.count() - even)


def counted(chosen):
    used = {}
    for pattern, n in chosen:
        for length in pattern:
            used[length] = used.get(length, 0) + n
    return used


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_every_piece_once_and_packs_tightly(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip(rng.lognormal(5 + seed / 2, 1, 4000).astype(int), 1, 512)
    counts = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True), strict=True)}
    chosen = packing.plan(counts, 512)
    assert counted(chosen) == counts and all(sum(p) <= 512 for p, _ in chosen)
    bins, free = 0, []
    for x in sorted(lengths, reverse=True):  # best fit decreasing, one at a time
        fits = [f for f in free if f >= x]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - x)
        else:
            bins += 1
            free.append(512 - x)
    assert sum(n for _, n in chosen) <= 1.01 * bins + 1


def test_fit_is_a_least_squares_minimum():
    found, counts = [(3, 1), (2, 2), (2, 1, 1)], {1: 10, 2: 9, 3: 4}
    x = packing.fitted(found, counts, sweeps=4000)
    a = np.array([[p.count(k) for p in found] for k in (1, 2, 3)], float)
    gradient = a.T @ (a @ x - np.array([10, 9, 4]))
    assert all(abs(g) < 1 if v > 0 else g > -1 for g, v in zip(gradient, x, strict=True))


def test_pieces_round_trip(make_docs, odd_rows):
    vocabulary, tokenizer = Vocabulary.public(), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = [r for r in odd_rows if r[0] not in (1, 7, None)]
    got = packing.pack(make_docs(docs), vocabulary, room=64, with_ids=True).collect()
    for doc_id, text, *_ in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted((r for r in got if r.doc_id == doc_id), key=lambda r: r.piece)
        assert b"".join(bytes(r.ids) for r in own) == np.array(ids, "<u4").tobytes()
        assert [r.piece for r in own] == list(range(len(own))) and all(r.length == 64 for r in own[1:])
        assert [r.start for r in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
        assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) for r in own)
    filled = {}
    for r in sorted(got, key=lambda r: r.offset):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 64 and len(filled) <= 1.02 * sum(filled.values()) / 64 + 1
    every = packing.pack(make_docs(odd_rows), vocabulary)
    assert every.select("sequence_id", "offset").distinct().count() == every.count() >= len(odd_rows)
    assert packing.pack(make_docs([])).count() == 0


def test_ids_equal_the_tokenizer(sf):
    import duckdb

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [t for (t,) in duckdb.sql(f"SELECT text FROM '{sf}/documents.parquet' WHERE text IS NOT NULL").fetchall()]
    texts += ["a  b\n\n c\t\td ", "  ", "\n", "it's I'LL 'tis", "x\u00a0\u00a0y", "1234 ½ ٣", "日本語 テキスト", "\U0001f600\U0001f600", " <|endoftext|>x"]
    for text in texts:
        assert encode(text, Vocabulary.public()).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_trie_counts_equal_the_unigram_model():
    rng = random.Random(4)
    names = {"".join(rng.choices("abcdeé", k=rng.randrange(1, 5))) for _ in range(300)} | set("abcde") | {"▁"}
    pieces = {n: -rng.random() * 10 - 1 for n in sorted(names)}
    bytes_ = [(f"<0x{b:02X}>", -100.0) for b in range(256)]
    model = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces.items(), *bytes_], unk_id=0, byte_fallback=True))
    words = sorted({"▁" + "".join(rng.choices("abcdeéz日", k=rng.randrange(0, 14))) for _ in range(2000)})
    got = token_counts.trie_counts(words, pieces)
    wrong = [w for w, n in zip(words, got, strict=True) if "z" not in w and "日" not in w and n != len(model.encode(w).ids)]
    assert not wrong
    alone = {w: n for w, n in zip(words, got, strict=True)}
    assert all(token_counts.trie_counts([w], pieces)[0] == n for w, n in list(alone.items())[:300])
    assert token_counts.trie_counts(["日"], {"a": -1.0}) == [3]


def test_token_counts_of_documents(make_docs, odd_rows):
    pieces = token_counts.public_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    got = token_counts.count_tokens(make_docs(odd_rows)).collect()
    alone = functools.cache(lambda w: token_counts.trie_counts(["▁" + w], pieces)[0])
    want = []
    for doc_id, text, *_ in odd_rows:
        words = [w.decode() for w in (text or "").encode().split()]
        want.append((doc_id, len(words), sum(map(alone, words))))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
    assert token_counts.count_tokens(make_docs([])).count() == 0
