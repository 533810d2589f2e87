import math
import random
import re
from collections import Counter

import pytest

from ctxanomaly.llm.queries import SQL
from ctxanomaly.llm.ranked_search import SharingPlan, search, terms
from llm.oracle import by_spark, by_sql

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def brute_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, best=10):
    held = [(d, Counter(brute_terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in held:
            m = 25 + 75 * sum(c.values()) * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                    for t in brute_terms(text) if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(scores)[:best])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def tables(spark, make_docs, corpus):
    rng = random.Random(3)
    items = [(i, " ".join(rng.sample(corpus[rng.randrange(len(corpus) - 1)][1].split() or ["x"], 1) * 2 + corpus[i][1].split()[:12]))
             for i in range(25)]
    items += [(90, None), (91, ""), (92, "?!"), (93, "the THE of"), (93, "the THE of"), (None, items[0][1]), (94, "nowhereatall"),
              (95, "Émigré ß naïve"), (96, "again " * 50), (97, " ".join(items[1][1].split()[:6] + items[2][1].split()[:6]))]
    bench = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, score string, rank int")
    return make_docs(corpus), bench, [(d, t) for d, t, _ in corpus], items


def rows(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_equals_brute_force_at_any_block_size(tables):
    docs, bench, d, items = tables
    want = brute(d, items)
    assert rows(search(docs, bench)) == want
    assert rows(search(docs.repartition(7), bench, block_bytes=900)) == want  # several blocks
    assert rows(search(docs, bench, best=3)) == brute(d, items, 3)


def test_equals_sql(tables):
    docs, bench, _, _ = tables
    assert by_spark(search(docs, bench)) == by_sql(SQL["op12_ranked_search"], documents=docs, benchmark=bench)


def test_ties_go_to_the_smaller_id(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in (5, 3, 9, 3, None)] + [(7, "other")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "same")], "item_id long, text string")
    got = sorted((r["rank"], r["doc_id"]) for r in search(docs, bench).collect() if r["rank"] < 5)
    assert got == [(1, 3), (2, 3), (3, 5), (4, 9)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert search(docs, bench).count() == 0
    assert search(spark.createDataFrame([(1, "a")], "doc_id long, text string"), bench.limit(0)).count() == 0


def test_terms_are_those_of_the_pattern():
    text = "".join(map(chr, range(128))) + "É ß x ǅ 漢字 ÀB1c_D\x85e f"
    assert [t.decode() for t in terms(text.encode())] == brute_terms(text)


def test_plan_shares_sums_and_keeps_items():
    rng = random.Random(4)
    phrases = [[rng.randrange(400) for _ in range(rng.randrange(2, 9))] for _ in range(30)]
    bags = []
    for _ in range(120):
        words = [w for p in rng.sample(phrases, 4) for w in p] + [rng.randrange(400, 3000) for _ in range(5)]
        bags.append(dict(Counter(words)))
    plan = SharingPlan(bags)
    assert all(dict(plan.flatten(i)) == bag for i, bag in enumerate(bags))
    shared, flat = plan.additions()
    assert plan.pairs and shared < 0.75 * flat
    one_per_set = Counter(tuple(p) for p in plan.pairs)
    assert max(one_per_set.values()) == 1  # a pair is filled once
    assert SharingPlan([]).size == 0 and SharingPlan([{}]).items == [[]]
