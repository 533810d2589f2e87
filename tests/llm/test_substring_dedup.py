import hashlib
import random

import numpy as np
import pytest

from ctxanomaly.llm.substring_dedup import OPEN, SETTLED, combine_anchors, substring_dedup


def brute(rows, size=13):
    docs = [(d, (t or "").encode().split()) for d, t, _ in rows]
    first = {}
    rank = lambda d: float("inf") if d is None else d
    for d, words in docs:
        for i in range(len(words) - size + 1):
            w = tuple(words[i : i + size])
            first[w] = min(first.get(w, float("inf")), rank(d))
    out = []
    for d, words in docs:
        gone = set()
        for i in range(len(words) - size + 1):
            if first[tuple(words[i : i + size])] < rank(d):
                gone.update(range(i, i + size))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((d, len(words), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("size,seed", [(13, 5), (6, 2)])
def test_equals_brute_force(make_docs, corpus, size, seed):
    got = substring_dedup(make_docs(corpus), size, seed)
    assert rows_of(got) == brute(corpus, size)
    assert sum(r["n_removed"] for r in got.collect()) > 500
    for r in got.collect():
        assert all(s["end"] - s["start"] >= size for s in r["spans"])


def test_reordered_and_self_repeats(make_docs):
    a = [f"w{i}" for i in range(30)]
    rows = [
        (5, " ".join(a), "s"),
        (2, " ".join(a[12:] + a[:14]), "s"),
        (9, " ".join(a[:13] + ["x"] + a[:12] + a[:13]), "s"),
        (9, " ".join(a), "s"),
        (1, " ".join(["r"] * 40), "s"),
        (3, " ".join(["r"] * 12), "s"),
        (4, " ".join(["r"] * 14), "s"),
    ]
    assert rows_of(substring_dedup(make_docs(rows))) == brute(rows)


def test_partner_in_another_batch_whose_territories_are_all_its_own(spark, make_docs):
    rng = random.Random(11)
    text = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    core = text(13)
    low, mid, high = (f"{text(20)} {core} {text(20)}" for _ in range(3))
    rows = [(5, low, "s"), (7, mid, "s"), (9, high, "s"), (3, f"{low} {text(20)} {high}", "s")]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")  # the first three documents, then the fourth
    try:
        got = rows_of(substring_dedup(make_docs(rows).coalesce(1)))
    finally:
        spark.conf.set(key, before)
    assert got == brute(rows)
    assert {r[0]: r[2] for r in got} == {3: 0, 5: 53, 7: 13, 9: 53}


def test_empty_table(make_docs):
    assert substring_dedup(make_docs([])).count() == 0


def test_combining_leaves_few_rows_of_a_hot_seed():
    rng = np.random.default_rng(3)
    n = 4000
    seed = rng.integers(0, 40, n) * np.int64(1 << 40)
    whole, d = rng.integers(0, 6, n), rng.integers(0, 300, n)
    own, state = combine_anchors(seed, whole, d)
    kept = own == seed
    for s in np.unique(seed):
        mine = seed == s
        assert kept[mine].sum() == 2  # the smallest and the largest document that is not settled
        docs = d[mine & (state != SETTLED)]
        assert set(d[mine & kept]) == {docs.min(), docs.max()}
        for w in np.unique(whole[mine]):
            group = mine & (whole == w)
            assert (state[group] == np.where(d[group] > d[group].min(), SETTLED, OPEN)).all()
    alone = combine_anchors(np.array([5, 5, 9]), np.array([1, 2, 1]), np.array([7, 7, 3]))
    assert alone[0].tolist() == [5, 5, 9] and alone[1].tolist() == [0, 0, 0]
    assert len(np.unique(own[~kept])) == (~kept).sum()
