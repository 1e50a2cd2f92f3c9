"""Exact, near and line deduplication against brute force."""

import hashlib
import random

import numpy as np
import pytest

from clicklake.llm import components, exact_dedup, line_dedup, near_dedup, shingles

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_exact_groups_cross_ranges(make_docs, odd_rows):
    rows = odd_rows + [(100 + k, "Copied TEXT" if k % 2 else "copied text", "en", "s") for k in range(600)]
    for keep, pick in (("smallest", min), ("largest", max)):
        found = exact_dedup.exact_dedup(make_docs(rows), keep).collect()
        groups = {}
        for r in rows:
            groups.setdefault((r[1] or "").translate(ASCII), []).append(r[0])
        want = []
        for text, ids in groups.items():
            real = [i for i in ids if i is not None]
            want += [(i, pick(real) if real else None, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
        assert sorted(map(str, want)) == sorted(str((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in found)
        kept = [r for r in found if r.kept]
        assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


def test_exact_kept_documents(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    kept = exact_dedup.kept_documents(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({(r[1] or "").translate(ASCII) for r in odd_rows})


def shingle_set(text, width):
    w = (text or "").encode().lower().split()
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1))


def brute_groups(rows, width, percent=80):
    sets = [shingle_set(r[1], width) for r in rows]
    at = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and (a == b or (100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b))):
                old, new = at[i], at[j]
                at = [new if x == old else x for x in at]
    out = []
    for k, r in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if at[m] == at[k] and rows[m][0] is not None]
        out.append((r[0], len(sets[k]), (min(ids) if ids else None) if sets[k] else r[0]))
    return out


def family(seed=5):
    """Near copies of few bases: chains of small edits, a common passage, many copies, short texts."""
    rng, rows = random.Random(seed), []
    passage = [f"p{k}" for k in range(40)]
    for base in range(4):
        words = [f"b{base}x{rng.randrange(400)}" for _ in range(150)]
        for k in range(25):
            if k % 3 == 0:
                words = list(words)
                words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
            rows.append((1000 * base + k, " ".join(words), "en", "s"))
    for k in range(40):
        rows.append((9000 + k, " ".join([*passage, *(f"own{k}x{m}" for m in range(rng.randrange(4, 60)))]), "en", "s"))
    rows += [(9500 + k, " ".join(f"s{m}" for m in range(5 + k % 3)), "en", "s") for k in range(9)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("width", "first_bands", "chunk"), [(2, 8, 512), (5, 8, 512), (2, 0, 4), (2, 8, 3)])
def test_near_groups_equal_brute_force(make_docs, odd_rows, width, first_bands, chunk):
    rows = family() + odd_rows
    found = near_dedup.near_groups(make_docs(rows), width, first_bands=first_bands, chunk=chunk).collect()
    assert sorted(map(str, brute_groups(rows, width))) == sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in found)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_kept_documents(make_docs, odd_rows):
    rows = family() + odd_rows
    docs = make_docs(rows)
    kept = near_dedup.kept_documents(docs, 2)
    assert kept.columns == docs.columns
    want = brute_groups(rows, 2)
    with_words = {c for _, n, c in want if n}
    blank = {(r[0], r[1]) for r, w in zip(rows, want, strict=True) if not w[1]}
    assert kept.count() == len(with_words) + len(blank)


def test_estimate_is_collision_corrected():
    rng = np.random.default_rng(3)
    for share in (0.0, 0.5, 0.8):
        errors = []
        for _ in range(30):
            both = rng.integers(0, 2**63, 4000, dtype=np.uint64)
            cut = int(4000 * 2 * share / (1 + share))
            a = np.unique(both)
            b = np.unique(np.concatenate([both[:cut], rng.integers(0, 2**63, 4000 - cut, dtype=np.uint64)]))
            truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            got, _ = shingles.estimates(shingles.sketch(a), shingles.sketch(b)[None], len(a), np.array([len(b)]))
            errors.append(got[0] - truth)
        assert abs(np.mean(errors)) < 0.02


def test_words_and_sets_match_plain_python():
    texts = ["A b\tc\x0bd", "", " \n", "one", "é É\u00a0x y", "x " * 3000, None, "a b a b a b", "\u2028 q"]
    for width in (1, 2, 5):
        sizes = [len(s) for s in shingles.shingle_sets(texts, width, slice_bytes=16)]
        assert sizes == [len(shingle_set(t, width)) for t in texts]
    one, two = shingles.shingle_sets(["P Q r s t", "p q  R\ns t"], 2)
    assert np.array_equal(one, two)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 80)] + [(500, 500), (160, 40)]
    labels = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {labels[k] for k in range(61)} == {0} and {labels[100 + k] for k in range(80)} == {0} and 500 not in labels
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_lines_go_once_they_repeat(make_docs):
    rows = [(1, "a\nb\nc\nd\nx"), (2, "q\na\nb\nc\nd\ny"), (3, "b\nc"), (4, "a\nb\nc\na\nb\nc"), (5, "\n\n\n\n")]
    got = {r.doc_id: (r.clean_text, r.n_removed) for r in line_dedup.line_dedup(make_docs(rows)).collect()}
    assert got == {1: ("a\nb\nc\nd\nx", 0), 2: ("q\ny", 4), 3: ("b\nc", 0), 4: ("", 6), 5: ("\n\n\n\n", 0)}


def test_line_plan_stays_native(make_docs):
    plan = line_dedup.line_dedup(make_docs([(1, "a\nb\nc")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_empty_tables(make_docs):
    docs = make_docs([])
    for out in (exact_dedup.exact_dedup(docs), near_dedup.near_groups(docs), line_dedup.line_dedup(docs)):
        assert out.count() == 0
    assert exact_dedup.kept_documents(docs).count() == near_dedup.kept_documents(docs).count() == 0


def test_short_pairs_share_a_band(make_docs):
    rng, rows, pairs = random.Random(11), [], 1500
    for kind, (shared, union) in enumerate(((4, 5), (5, 6), (8, 10))):
        for k in range(pairs):
            words = [f"{kind}x{k}x{rng.randrange(10**9)}x{m}" for m in range(union)]
            at = 2 * (kind * pairs + k)
            rows += [(at, " ".join(words), "en", "s"), (at + 1, " ".join(words[:shared]), "en", "s")]
    want = {i: c for k in range(0, len(rows), 2) for i, _, c in brute_groups(rows[k : k + 2], 1)}
    assert all(c == i - i % 2 for i, c in want.items())
    found = near_dedup.near_groups(make_docs(rows), 1).collect()
    assert {r.doc_id: r.component_id for r in found} == want


def test_kept_documents_of_ids_that_do_not_name_a_group(make_docs):
    apart = lambda k: " ".join(f"u{k}x{m}" for m in range(12))
    near = " ".join(["changed", *apart(0).split()[1:]])
    rows = [(None, apart(k), "en", "s") for k in range(20)] + [(None, near, "en", "s"), (None, apart(3), "en", "s")]
    rows += [(7, apart(30), "en", "s"), (7, apart(31), "en", "s"), (7, apart(31), "en", "s"), (8, apart(30), "en", "s")]
    rows += [(None, "", "en", "s"), (None, None, "en", "s"), (9, " ", "en", "s"), (5, apart(4), "en", "s")]
    kept = [(r.doc_id, r.text) for r in near_dedup.kept_documents(make_docs(rows), 1).collect()]
    alone = [(None, apart(k)) for k in range(1, 20) if k != 4] + [(5, apart(4)), (7, apart(30)), (7, apart(31))]
    alone += [(None, ""), (None, None), (9, " ")]
    assert len(kept) == len(alone) + 1 and set(alone) <= set(kept)
    assert len(set(kept) & {(None, apart(0)), (None, near)}) == 1
