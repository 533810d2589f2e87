import random
from collections import defaultdict

import pandas as pd
import pytest

from ctxanomaly.llm.packing import OpenBins, merge_shard, pack, pack_shard, pieces


def check(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r["bin_id"]].append(r)
    for held in bins.values():
        at = 0
        for r in sorted(held, key=lambda r: (r["bin_start"], r["n_words"])):
            assert r["bin_start"] == at
            at += r["n_words"]
        assert at <= capacity
        sources = [r["source"] for r in held]
        assert len(sources) == len(set(sources))
    return bins


@pytest.mark.parametrize("shard_rows", [20_000, 30])
def test_whole_texts_and_no_conflicts(make_docs, corpus, shard_rows):
    docs = make_docs(corpus)
    cut = pieces(docs, 100)
    rows = pack(cut, 100, shard_rows).collect()
    check(rows, 100)
    words = defaultdict(int)
    for d, t, _ in corpus:
        words[d] += len((t or "").encode().split())
    got = defaultdict(int)
    for r in rows:
        got[r["doc_id"]] += r["n_words"]
    assert got == words and len(rows) == cut.count()
    long = sorted((r["piece"], r["start_word"], r["n_words"]) for r in rows if r["doc_id"] == 206)
    assert long == [(i, 100 * i, 100) for i in range(30)]


def brute(frame, capacity):
    """Best fit by scanning all bins; ties take the bin that got its residual first."""
    bins, out = [], []
    order = frame.sort_values(["n_words", "doc_id", "text_key", "piece"], ascending=[False, True, True, True], kind="stable")
    for r in order.itertuples():
        fit = [b for b in bins if b["room"] >= r.n_words and r.source not in b["s"] and r.cluster not in b["c"]]
        if fit:
            b = min(fit, key=lambda b: (b["room"], b["at"]))
        else:
            b = {"room": capacity, "s": set(), "c": set(), "id": len(bins)}
            bins.append(b)
        b["room"] -= r.n_words
        b["at"] = len(out)
        b["s"].add(r.source)
        b["c"].add(r.cluster)
        out.append(b["id"])
    return out


def test_takes_the_tightest_compatible_bin():
    rng = random.Random(6)
    for _ in range(20):
        n = 200
        frame = pd.DataFrame(
            {
                "doc_id": range(n), "text_key": 0, "piece": 0, "shard": 0, "n_words": [rng.randrange(0, 51) for _ in range(n)],
                "source": [rng.choice(["hot", "hot", "a", "b", "c", None]) for _ in range(n)],
                "cluster": [rng.randrange(30) for _ in range(n)],
            }
        )
        assert pack_shard(frame, 50)["bin_id"].tolist() == brute(frame, 50)


def test_open_bins_pass_over_conflicts():
    bins = OpenBins(10)
    bins.put(0, 3, 0b1, 0)
    bins.put(1, 5, 0b1, 0)
    bins.put(2, 9, 0b10, 0b1)
    assert bins.take(2, 0b1, 0)[0] == 2
    assert bins.take(2, 0b1, 0) is None
    assert bins.take(4, 0b10, 0)[0] == 1
    assert bins.take(0, 0, 0)[0] == 0


def test_empty_table(make_docs):
    assert pack(pieces(make_docs([]))).count() == 0


def test_loose_bins_of_shards_are_merged(make_docs):
    """Fill of shards with the second pass against one packing of all."""
    rng = random.Random(8)
    rows = [(i, " ".join(["w%d" % (i % 7)] + ["x"] * rng.randrange(1, 60)), f"s{rng.randrange(200)}") for i in range(1500)]
    cut = pieces(make_docs(rows), 100)
    total = sum(r["n_words"] for r in cut.collect())
    fill = {}
    for shard_rows in (20_000, 300, 60):
        bins = check(pack(cut, 100, shard_rows).collect(), 100)
        fill[shard_rows] = total / (100 * len(bins))
    one_pass = check(pack(cut, 100, 60, loose=1.0).collect(), 100)
    assert fill[20_000] > 0.97
    assert fill[300] > fill[20_000] - 0.01 and fill[60] > fill[20_000] - 0.02
    assert fill[60] > total / (100 * len(one_pass)) + 0.01


def test_merged_bins_share_no_source_or_cluster():
    rng = random.Random(9)
    rows = [(100 + i, rng.randrange(0, 40), [{"source": s} for s in rng.sample(["hot", "a", "b", "c", None], 2)], rng.sample(range(60), 3))
            for i in range(80)]
    frame = pd.DataFrame(rows, columns=["bin_id", "fill", "sources", "clusters"])
    moved = merge_shard(frame, 50)
    held = defaultdict(list)
    by_id = {r[0]: r for r in rows}
    for old, new, offset in moved.itertuples(index=False):
        held[new].append((offset, by_id[old]))
    assert sorted(moved["old_id"]) == sorted(by_id) and len(held) < 60
    for parts in held.values():
        at = 0
        for offset, (_, fill, _, _) in sorted(parts, key=lambda p: (p[0], p[1][1])):
            assert offset == at
            at += fill
        assert at <= 50
        for k in (2, 3):
            values = [repr(v) for _, r in parts for v in r[k]]
            assert len(values) == len(set(values))
    assert merge_shard(frame.iloc[:0], 50).empty
