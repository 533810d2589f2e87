import math
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import SF001
from ctxanomaly.llm.neural_lm import END, REST, Corpus, LogBilinear, Trainer, contexts, gather, score, token_counts


def held_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 == 2


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def brute(rows):
    counts = Counter(w for d, t, *_ in rows if not held_out(d) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t, *_ in rows:
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t))
        out.append((d, held_out(d), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, round(base, 6)))
    return sorted(out, key=repr)


def plain(df):
    keys = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    return sorted(((*[r[k] for k in keys], round(r["base_score"], 6)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("lexicon,model_words", [(200_000, 2048), (40, 16), (3, 16)])
def test_counts_and_base_scores_equal_brute_force(make_docs, corpus, lexicon, model_words):
    got = score(make_docs(corpus), dim=4, rounds=2, lexicon=lexicon, model_words=model_words)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert plain(got) == brute(corpus)


def test_scores_do_not_depend_on_how_counts_are_found(make_docs, corpus):
    """A word outside the lexicon is scored as one inside it."""
    docs = make_docs(corpus).coalesce(1)
    a, b = ({(r["doc_id"], r["n_tokens"]): r["score"] for r in score(docs, dim=4, rounds=1, lexicon=n, model_words=12).collect()} for n in (10**6, 40))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], rel=1e-3) for k in a)


def test_better_than_base_on_held_out_texts(spark):
    rows = score(spark.read.parquet(f"{SF001}/documents.parquet")).collect()
    for held in (False, True):
        mine = [r for r in rows if r["held_out"] == held]
        assert mine and sum(r["score"] for r in mine) > sum(r["base_score"] for r in mine)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)


def test_nothing_to_learn_and_empty(make_docs):
    ids = [i for i in range(60) if held_out(i)][:5]
    rows = [(i, "some words here", "a") for i in ids] + [(None, None, "b")]
    got = score(make_docs(rows)).collect()
    assert len(got) == 6 and all(r["base_score"] == 0 and r["n_known"] == 0 and r["train_tokens"] == 0 for r in got)
    assert all(math.isfinite(r["score"]) for r in got)
    assert score(make_docs([])).count() == 0


def test_long_text_nulls_and_repeats(make_docs):
    rows = [(i, "the cat sat on the mat", "a") for i in range(20)] + [(30, "dog " * 60_000, "a"), (31, None, "a"), (31, None, "a"), (32, "", "b")]
    assert plain(score(make_docs(rows), dim=4, rounds=1)) == brute(rows)


def test_lexicon_is_bounded_and_holds_the_most_frequent(spark):
    text = " ".join(f"w{i} " * (i + 1) for i in range(60))
    counts = token_counts(spark.createDataFrame([(text.encode(),)], "text binary"))
    corpus = gather(counts, lexicon=20, model_words=8)
    assert corpus.tokens == 60 * 61 // 2 + 1 and corpus.distinct == 61
    assert 10 <= len(corpus.lexicon) <= 21 and b"" in corpus.lexicon
    assert set(corpus.entries) == {b"", *[f"w{i}".encode() for i in range(54, 60)]}
    assert corpus.entry_counts().sum() == corpus.tokens


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    model = LogBilinear.start(rng.integers(1, 50, 30).astype(float), dim=5)
    model.context[:] = rng.normal(size=model.context.shape)
    model.target[:] = rng.normal(size=model.target.shape)
    t = model.tables()
    every = np.arange(30)
    for one, two in rng.integers(0, 30, (20, 2)):
        logs = t.log_probs(every, np.full(30, one), np.full(30, two))
        assert np.exp(logs).sum() == pytest.approx(1, rel=1e-5)
        q = model.context[one] @ model.turn[0] + model.context[two] @ model.turn[1]
        s = (model.target @ q + model.bias).astype(float)
        assert np.allclose(logs, s - np.log(np.exp(s).sum()), atol=1e-4)
    lexicon = {b"a": 7, b"b": 5, b"": 4, b"c": 2}
    corpus = Corpus(tokens=21, distinct=6, lexicon=lexicon, model_words=4)  # a and b are entries; c and two others are rest
    rest = corpus.entry_counts()[REST]
    assert rest == 5 and corpus.rest_total() == rest + 3 + 1
    assert corpus.entries[b""] == END


def test_contexts_do_not_cross_texts():
    ids = np.array([5, 6, 0, 0, 7, 0], np.uint16)  # "5 6", "", "7"
    one, two = contexts(ids, np.array([0, 3, 4]))
    assert one.tolist() == [0, 5, 6, 0, 0, 7] and two.tolist() == [0, 0, 5, 0, 0, 0]


def test_gradient_is_that_of_the_objective():
    """A step follows the noise-contrastive objective, by finite differences."""
    rng = np.random.default_rng(3)
    counts = rng.integers(1, 9, 6).astype(float)
    noise = counts / counts.sum()
    start = LogBilinear.start(counts, dim=3)
    w, one, two, drawn = (rng.integers(0, 6, k) for k in (8, 8, 8, 4))

    def objective(m):
        q = m.context[one].astype(float) @ m.turn[0] + m.context[two].astype(float) @ m.turn[1]
        ln = np.log(4 * noise)
        real = (q * m.target[w]).sum(1) + m.bias[w] - ln[w]
        fake = q @ m.target[drawn].T + m.bias[drawn] - ln[drawn]
        return -(np.log1p(np.exp(-real)).sum() + np.log1p(np.exp(fake)).sum()) / 8

    class Recorder(Trainer):
        def _step(self, name, at, gradient):
            full = np.zeros(getattr(self.m, name).shape)
            full[at] = gradient
            self.seen = {**getattr(self, "seen", {}), name: full}

    r = Recorder(start, noise, k=4, batch=8)
    r._batch(w, one, two, drawn)
    for name in ("context", "target", "bias", "turn"):
        values = getattr(start, name)
        for at in [tuple(rng.integers(0, s) for s in values.shape) for _ in range(5)]:
            kept, h = values[at], 1e-3
            values[at] = kept + h
            up = objective(start)
            values[at] = kept - h
            down = objective(start)
            values[at] = kept
            assert r.seen[name][at] == pytest.approx((up - down) / (2 * h), rel=2e-2, abs=2e-4)
