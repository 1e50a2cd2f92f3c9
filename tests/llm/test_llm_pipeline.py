"""The pipeline's stages, the mix, the classifier and the language model against plain computations."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clicklake.llm import exact_dedup, language_id, mixing, near_dedup, quality_model
from clicklake.llm.tokens import Vocabulary, encode
from test_llm_dedup import ASCII, brute_groups, family
from test_llm_mixing_packing import reshared

CLASHING = ("_hash", "_name", "_digest", "row", "label", "set_key", "mark", "salt", "copy", "key", "cell")


@pytest.fixture(scope="module")
def corpus():
    """Near and exact copies, rows without an id, one id on many texts, repeated rows, short, blank and long texts."""
    draw = random.Random(11)
    rows = [(i, t, "en", f"s{i % 4}") for i, t, _, _ in family(3)]
    rows += [(None, f"no id {k} " + " ".join(f"n{draw.randrange(50)}" for _ in range(30)), "en", "hot") for k in range(90)]
    rows += [(777, f"one id {k} " + " ".join(f"m{draw.randrange(60)}" for _ in range(25)), "en", "hot") for k in range(40)]
    rows += [(8000, "a text that repeats with its id", "en", "hot")] * 30 + [(None, "repeats without", None, None)] * 20
    rows += [(20 + k, rows[k][1].upper(), "en", "s1") for k in range(10)]
    rows += [(30, None, None, None), (31, "", "en", "s2"), (32, " \n", "en", "s2"), (33, "few words", "en", None), (34, " ".join(f"l{k}" for k in range(9000)), "en", "s3")]
    return [(*r, *[k + 7 for k, _ in enumerate(CLASHING)]) for r in rows]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    kinds = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} int" for c in CLASHING)
    return spark.createDataFrame(corpus, kinds).repartition(3)


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.mark.parametrize("keep", [exact_dedup.kept_documents, near_dedup.kept_documents])
def test_kept_rows_are_rows_of_the_input(docs, corpus, keep):
    """Whatever the columns are called: values and types are those that came."""
    kept = keep(docs)
    assert kept.dtypes == docs.dtypes
    given = Counter(map(repr, corpus))
    assert all(n <= given[r] for r, n in Counter(rows_of(kept)).items())


def lowest(ids):
    known = [i for i in ids if i is not None]
    return min(known) if known else None


def test_exact_stage_equals_brute_force(spark, docs, corpus):
    groups = {}
    for r in corpus:
        groups.setdefault((r[1] or "").translate(ASCII), []).append(r[0])
    kept = corpus_pipeline.exact(spark, docs, "").select("doc_id", "text").collect()
    assert Counter((r.doc_id, (r.text or "").translate(ASCII)) for r in kept) == Counter((lowest(ids), t) for t, ids in groups.items())


def test_near_stage_equals_brute_force(spark, docs, corpus):
    """One row of each group, the one with the smallest id; rows without words are groups of their own."""
    for k, r in enumerate(brute_groups([r[:2] for r in corpus], 5)):
        assert r[0] == corpus[k][0]
    rows = [r[:2] for r in corpus]
    at = list(range(len(rows)))
    from test_llm_dedup import shingle_set

    sets = [shingle_set(t, 5) for _, t in rows]
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                old, new = at[i], at[j]
                at = [new if x == old else x for x in at]
    groups = {}
    for k, (i, t) in enumerate(rows):
        groups.setdefault(at[k] if sets[k] else ("blank", i, t), []).append(k)
    kept = corpus_pipeline.near(spark, docs, "").select("doc_id", "text").collect()
    place = {}
    for g, members in groups.items():
        for k in members:
            place.setdefault(rows[k], set()).add(g)
    found = [place[r.doc_id, r.text] for r in kept]
    assert all(len(g) == 1 for g in found)
    found = Counter(next(iter(g)) for g in found)
    assert found == Counter(groups.keys())
    ids = {next(iter(place[r.doc_id, r.text])): r.doc_id for r in kept}
    assert ids == {g: lowest([rows[k][0] for k in members]) for g, members in groups.items()}


def slow_mix(rows, seed="mix"):
    """(doc_id, source, text) -> (doc_id, source, size, taken), by sorting every source."""
    seen, keyed = Counter(), {}
    for i, source, text in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        seen[i, source, text] += 1
        name = f"{'' if i is None else i}:{seen[i, source, text]}:{hashlib.md5(text.encode()).hexdigest()}:{seed}"
        u = (int(hashlib.md5(name.encode()).hexdigest()[:13], 16) + 1) / 2**52
        weight = max(len(set(words)) / len(words), 0.05) if words else 1.0
        keyed.setdefault(source, []).append((-math.log(u) / weight, i is None, i or 0, len(words), i))
    names = sorted(keyed, key=lambda s: (s is None, s or ""))
    sizes = [sum(k[3] for k in keyed[s]) for s in names]
    out = []
    for source, size, target in zip(names, sizes, reshared(sizes), strict=True):
        epochs, through = (int(target // size) if size else 0), 0
        rest = target - epochs * size
        for *_, n, i in sorted(keyed[source]):
            through += n
            out.append((i, source, n, (epochs + (2 * through - n <= 2 * rest and rest > 0)) * n))
    return sorted(out, key=repr)


def test_mix_equals_brute_force(docs, corpus):
    found = sorted(((r.doc_id, r.source, r.size, r.taken) for r in mixing.mix(docs, rows_per_cell=20).collect()), key=repr)
    assert found == slow_mix([(r[0], r[3], r[1]) for r in corpus])


def test_rows_without_an_id_are_drawn_one_by_one(make_docs):
    rows = [(None if k % 3 else k, f"w{k} x y z", "en", "s") for k in range(600)] + [(9, "the same", "en", "s")] * 300 + [(k, "big " * 40, "en", "t") for k in range(100)]
    out = mixing.mix(make_docs(rows), weights=(1, 20), rows_per_cell=30)
    own = [r.copies for r in out.where("source = 's' AND doc_id IS NULL").collect()]
    same = [r.copies for r in out.where("source = 's' AND doc_id = 9 AND size = 2").collect()]
    assert 0 < sum(own) < len(own) and 0 < sum(same) < len(same)
    cells = [len(own), len(same)]
    assert cells == [400, 300]


def test_mix_stage_repeats_whole_rows(spark, docs, corpus):
    copies = Counter()
    for r in mixing.mix(docs).collect():
        copies[r.doc_id, r.size] += r.copies
    out = corpus_pipeline.mix(spark, docs, "")
    assert out.dtypes == docs.dtypes and set(rows_of(out)) <= set(map(repr, corpus))
    got = Counter((r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in out.collect())
    assert got == +copies


def test_pack_stage_places_every_token_once(spark, docs, corpus):
    vocabulary = Vocabulary.public()
    want = Counter()
    for r in corpus:
        want[r[0], len(encode(r[1] or "", vocabulary)) + 1] += 1
    rows = corpus_pipeline.pack(spark, docs, "").collect()
    got, tokens, sequences = Counter(), 0, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        tokens += r.length
        got[r.doc_id] += r.length
    by_id = Counter()
    for (i, n), k in want.items():
        by_id[i] += n * k
    assert got == by_id
    for places in sequences.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:], strict=False)) and sum(places[-1]) <= 2048
    assert len(sequences) <= 1.03 * math.ceil(tokens / 2048) + 1


def test_empty_table_through_all_stages(spark, docs, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    docs.write.parquet(f"{tmp_path}/full/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/full/labels.parquet")
    # Nothing can be learned, so nothing is rejected.
    assert corpus_pipeline.quality(spark, docs, f"{tmp_path}/full").count() == docs.count()
    assert corpus_pipeline.run(spark, f"{tmp_path}/full").count() > 0


# --- Quality classifier --------------------------------------------------------------------------


def test_classifier_equals_a_naive_one(spark, make_docs):
    """Neighbour vectors, pooling and the forward pass, word by word."""
    draw = random.Random(2)
    rows = [(k, " ".join(draw.choices(["good", "fine", "Words"] if k % 2 else ["bad", "spam", "!!"], k=20)) + f" {k} x{k % 5}", "en", "s") for k in range(80)]
    rows += [(90, None, "en", "s"), (91, "", "en", "s"), (None, "good fine Words", "en", "s")]
    labels = spark.createDataFrame([(k, k % 2) for k in range(80)] + [(None, 1), (3, None)], "doc_id long, quality int")
    docs = make_docs(rows)
    model = quality_model.learn(docs, labels)
    sample = [t for i, t, *_ in rows if i is not None and i < 80 and zlib.crc32(str(i).encode()) % 5]
    token = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
    frequent = Counter(w for t in sample for w in set(token.findall(t)))
    assert set(model.vocabulary) == {w for w, n in frequent.items() if n >= 3}

    names = [*model.vocabulary, *(f"<{s}>" for s in quality_model.SHAPES)]
    row = {w: k for k, w in enumerate(model.vocabulary)}
    at = lambda w: row.get(w, len(row) + quality_model.SHAPES.index(quality_model.shape(w)))
    index = np.zeros((len(names), 64))
    for k, (places, signs) in enumerate(zip(*quality_model.index_vectors(names, 64, 4), strict=True)):
        for p, s in zip(places, signs, strict=True):
            index[k, p] += s
    vectors = np.zeros((len(names), 64))
    for t in sample:
        words = [at(w) for w in token.findall(t)]
        for k, w in enumerate(words):
            for near in (k - 2, k - 1, k + 1, k + 2):
                if 0 <= near < len(words):
                    vectors[w] += index[words[near]]
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    assert np.allclose(model.vectors, vectors, atol=1e-6)

    w1, b1, w2, b2 = model.weights
    for r, text in zip(quality_model.scored(docs, model).orderBy("doc_id").collect(), [t for _, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))], strict=True):
        words = token.findall(text or "")
        total = np.append(sum((vectors[at(w)] for w in words), np.zeros(64)), sum(a == b for a, b in zip(words, words[1:], strict=False)))
        x = ((total + 10 * model.centre) / (len(words) + 10) - model.centre) / model.spread
        hidden = [max(0.0, sum(x[i] * w1[i, j] for i in range(65)) + b1[j]) for j in range(w1.shape[1])]
        z = sum(h * v for h, v in zip(hidden, w2, strict=True)) + b2
        assert r.score == pytest.approx(1 / (1 + math.exp(-z / model.temperature)), abs=1e-4)
        assert r.predicted == int(r.score >= 0.3)
    assert rows_of(quality_model.accepted(docs, model)) == rows_of(
        docs.join(F.broadcast(quality_model.scored(docs, model).where("predicted = 0").select("doc_id").distinct()), "doc_id", "left_anti").select(*docs.columns)
    )


# --- Languages -----------------------------------------------------------------------------------


def test_a_language_under_one_id_is_learned(make_docs):
    learnable = [k for k in range(1, 40) if zlib.crc32(str(k).encode()) % 5][:7]
    english = [(100 + k, f"the house and the garden number {k}", "en", "s") for k in range(300)]
    for one in learnable[:3]:
        rows = english + [(one, f"das Haus und der Garten Nummer {k}", "de", "s") for k in range(2000)]
        model = language_id.learn(make_docs(rows), rows_per_language=10)
        assert model.languages == ("de", "en")
    same = language_id.learn(make_docs(english + [(one, min((r[1] for r in rows if r[2] == "de")), "de", "s")] * 5), rows_per_language=10)
    assert same.languages == ("de", "en")


def test_more_languages_than_wanted_leave_the_largest(make_docs):
    rows = [(k, f"text {k} of language {k % 10}", f"l{min(k % 10, 6)}", "s") for k in range(200)]
    model = language_id.learn(make_docs(rows), max_languages=3)
    assert len(model.languages) == 3 and "l6" in model.languages
    assert language_id.identify(make_docs(rows), model).count() == 200


def test_a_rare_language_keeps_its_contexts():
    def counts(text):
        data = np.frombuffer(b"\n\n\n" + text.encode(), np.uint8)
        grams, n = np.unique(language_id._grams(data), return_counts=True)
        return grams.astype(np.int64), n.astype(np.int64)

    draw = random.Random(8)
    common = " ".join("".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(20_000))
    model = language_id.build({"common": counts(common), "rare": counts("xyz zyx yzx " * 30)}, max_contexts=40)
    third = {int(c).to_bytes(3, "big") for c, o in zip(model.contexts, model.orders, strict=True) if o == 3}
    assert b"xyz" in third and b"zyx" in third and len(third) == 40
    assert all((model.orders == o).sum() <= 40 for o in (1, 2, 3))
    small = language_id.build({f"l{k}": counts(common[:3000]) for k in range(8)}, max_cells=256 * 3 * 8 * 5)
    assert all((small.orders == o).sum() <= 5 for o in (1, 2, 3))
