import hashlib
import random

import numpy as np
import pytest

from ctxanomaly.llm.suffix_dedup import deep_shallow_sort, suffix_dedup


def brute(texts, length):
    seen = {}
    for n, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            seen.setdefault(t[i : i + length], []).append((n, i))
    marks = [bytearray(len(t)) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for n, i in places:
                marks[n][i : i + length] = b"\x01" * length
    out = []
    for t, m in zip(texts, marks, strict=True):
        kept = bytes(x for x, gone in zip(t, m, strict=True) if not gone)
        runs = sum(1 for i, gone in enumerate(m) if gone and (i == 0 or not m[i - 1]))
        out.append((len(t), sum(m), runs, hashlib.sha256(kept).hexdigest()))
    return out


def rows_of(df):
    cols = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted(((r["doc_id"], *[r[c] for c in cols]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("limits", [{}, {"chunk_rows": 3}, {"group_rows": 2}])
def test_equals_brute_force(make_docs, corpus, limits):
    docs = make_docs(corpus)
    got = rows_of(suffix_dedup(docs, length=40, shallow=16, **limits))
    texts = [(t or "").encode() for _, t, _ in corpus]
    want = [(d, *r) for (d, _, _), r in zip(corpus, brute(texts, 40), strict=True)]
    assert got == sorted(want, key=repr)
    assert sum(r[2] for r in got) > 1000


def test_default_length_on_periodic_and_long_texts(make_docs):
    rng = random.Random(1)
    block = "".join(rng.choices("abcde ", k=700))
    texts = [block, "x" + block[100:] + "y", block[:399], block[:400], "ab" * 900, "z" * 399, "z" * 400, "z" * 401]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    got = rows_of(suffix_dedup(make_docs(rows)))
    want = [(i, *r) for i, r in enumerate(brute([t.encode() for t in texts], 400))]
    assert got == sorted(want, key=repr)


def passage_words(texts, n):
    """Words under sequences of ``n`` words that start twice or more."""
    seen = {}
    words = [(t or "").encode().split() for t in texts]
    for d, w in enumerate(words):
        for i in range(len(w) - n + 1):
            seen.setdefault(tuple(w[i : i + n]), []).append((d, i))
    under = [set() for _ in texts]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                under[d].update(range(i, i + n))
    return [len(u) for u in under]


@pytest.mark.parametrize("limits", [{}, {"chunk_rows": 3}, {"group_rows": 2}])
def test_passages_equal_brute_force(make_docs, corpus, limits):
    got = suffix_dedup(make_docs(corpus), length=40, shallow=16, passage=9, shallow_words=3, **limits)
    want = passage_words([t for _, t, _ in corpus], 9)
    told = [(r["doc_id"], r["n_passage_words"]) for r in got.collect()]
    assert sorted(told, key=repr) == sorted(((d, n) for (d, _, _), n in zip(corpus, want, strict=True)), key=repr)
    assert sum(want) > 100


def test_passages_of_over_50_words_under_400_bytes(make_docs):
    """They are told, whatever stands between their words; no byte is removed."""
    rng = random.Random(3)

    def words(n):
        return ["".join(rng.choices("abcdefg", k=rng.randrange(2, 7))) for _ in range(n)]

    shared, short = words(51), words(50)
    held = [(words(30), shared, words(40)), (words(8), shared, []), (words(90), short, words(5)), ([], short, words(3)), (words(200), [], [])]
    texts = [("\n" if i == 1 else " ").join(a + b + c) for i, (a, b, c) in enumerate(held)]
    assert len(" ".join(shared)) < 400
    got = suffix_dedup(make_docs([(i, t, "s") for i, t in enumerate(texts)])).collect()
    assert {r["doc_id"]: (r["n_passage_words"], r["n_removed"]) for r in got} == {0: (51, 0), 1: (51, 0), 2: (0, 0), 3: (0, 0), 4: (0, 0)}


def test_empty_table(make_docs):
    assert suffix_dedup(make_docs([])).count() == 0


def test_sort_orders_and_measures():
    rng = random.Random(2)
    heads = [bytes(rng.choices(b"ab", k=8)) for _ in range(4)]
    strings = [rng.choice(heads) + bytes(rng.choices(b"ab", k=rng.randrange(9))) for _ in range(300)]
    order, lcp = deep_shallow_sort(strings, shallow=8)
    assert [strings[i] for i in order] == sorted(strings)
    for a, b, n in zip(order, order[1:], lcp[1:], strict=False):
        x, y = strings[a], strings[b]
        true = next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
        assert n == (true if true >= 8 else 0)
    assert np.array_equal(np.sort(order), np.arange(300))
