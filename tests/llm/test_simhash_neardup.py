import random
from collections import Counter

import pytest
import xxhash

from ctxanomaly.llm.components import connected_components
from ctxanomaly.llm.simhash_neardup import fingerprint, keep_one, links, simhash_classes


def brute_fingerprint(text):
    import re

    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, bits=4):
    left, out = set(prints), {}
    while left:
        root = min(left)
        front, left = [root], left - {root}
        out[root] = root
        while front:
            x = front.pop()
            near = {y for y in left if (x ^ y).bit_count() <= bits}
            out |= dict.fromkeys(near, root)
            left -= near
            front += near
    return out


def test_fingerprints(corpus):
    for _, text, _ in corpus:
        assert fingerprint((text or "").encode()) == brute_fingerprint(text)


def test_classes_equal_brute_force(make_docs, corpus):
    got = simhash_classes(make_docs(corpus)).collect()
    prints = {i: brute_fingerprint(t) for i, (_, t, _) in enumerate(corpus)}
    roots = brute_classes(set(prints.values()))
    low = {}
    for i, (d, _, _) in enumerate(corpus):
        r = roots[prints[i]]
        low[r] = min((x for x in (low.get(r), d) if x is not None), default=None)
    want = Counter((d, prints[i], low[roots[prints[i]]]) for i, (d, _, _) in enumerate(corpus))
    assert Counter((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got) == want
    kept = keep_one(make_docs(corpus))
    assert kept.columns == make_docs(corpus).columns
    assert kept.count() == len(low)
    named = [r["doc_id"] for r in kept.collect() if r["doc_id"] is not None]
    assert sorted(named) == sorted(x for x in low.values() if x is not None)


@pytest.mark.parametrize("bucket_rows", [4096, 4])
def test_links_lose_nothing(spark, bucket_rows):
    rng = random.Random(3)
    prints = {0, 1, (1 << 64) - 1}
    for _ in range(12):
        x = rng.getrandbits(64)
        prints.add(x)
        for _ in range(25):
            for b in rng.sample(range(64), rng.randrange(1, 7)):
                x ^= 1 << b
            prints.add(x)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in prints]
    edges = links(spark.createDataFrame(signed, "fp long"), 4, bucket_rows)
    roots = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in connected_components(edges).collect()}
    got = {}
    for x in prints:
        got.setdefault(roots.get(x, x), set()).add(x)
    want = {}
    for x, r in brute_classes(prints).items():
        want.setdefault(r, set()).add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 100)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: 0 for x in [*range(1, 41), *range(100, 130)]}


def test_empty_table(make_docs):
    assert simhash_classes(make_docs([])).count() == 0
    assert keep_one(make_docs([])).count() == 0
