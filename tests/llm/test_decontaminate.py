import random
import tracemalloc

from ctxanomaly.llm.decontaminate import SeedIndex, decontaminate, drop_leaks, tile, words_of

rng = random.Random(8)
ITEM = [f"w{i}" for i in range(30)]
LONG = [rng.choice("abcdefghij") + str(rng.randrange(40)) for _ in range(400)]
FILL = [f"f{i}" for i in range(3000)]


def brute_tiles(item, doc, size):
    """Greedy string tiling as defined: mark the longest free match, first in
    the item and then in the document, until none of ``size`` words is left."""
    a, b = [False] * len(item), [False] * len(doc)
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not a[i + n] and not b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < size:
            return sum(a)
        a[i : i + n], b[j : j + n] = [True] * n, [True] * n


def test_tiling_equals_brute_force():
    r = random.Random(1)
    for _ in range(200):
        item = [r.choice("abc") for _ in range(r.randrange(5, 25))]
        doc = [r.choice("abc") for _ in range(r.randrange(5, 40))]
        if r.random() < 0.7:
            cut = r.randrange(len(item))
            doc[5:5] = item[cut:] + ["z"] + item[:cut]
        size = 3
        pairs = [(i, j) for i in range(len(item) - size + 1) for j in range(len(doc) - size + 1)
                 if item[i : i + size] == doc[j : j + size]]
        assert (tile(pairs, size, len(item)) if pairs else 0) == brute_tiles(item, doc, size)


def test_index_equals_brute_force():
    r = random.Random(2)
    seen = 0
    for _ in range(150):
        items = [[r.choice("abc") for _ in range(r.randrange(3, 20))] for _ in range(4)]
        doc = [r.choice("abcd") for _ in range(r.randrange(3, 40))]
        for item in items[: r.randrange(4)]:
            cut = r.randrange(len(item))
            doc[5:5] = item[cut:] + ["z"] + item[:cut]
        want = [(k, len(w), brute_tiles(w, doc, 3)) for k, w in enumerate(items) if len(w) >= 3]
        want = [m for m in want if m[2] >= 0.8 * m[1]]
        index = SeedIndex([(k, " ".join(w)) for k, w in enumerate(items)], 3)
        assert sorted(index.matches(" ".join(doc), 0.8)) == want
        seen += len(want)
    assert seen > 100


def test_frequent_seeds_take_no_memory_for_pairs():
    common = "one two three four five"
    items = [(k, " ".join(f"{common} x{k}y{i} x{k}z{i} x{k}w{i} x{k}v{i}" for i in range(10))) for k in range(60)]
    index = SeedIndex([*items, (99, "again " * 300)], 5)
    doc = " ".join([f"{common} f{i}" for i in range(500)]) + " again" * 3000  # 300,000 and 886,816 pairs
    tracemalloc.start()
    got = index.matches(doc, 0.8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == [(99, 300, 300)]
    assert peak < 16 << 20


def rows(make_docs):
    j = " ".join
    return make_docs(
        [
            (1, j(FILL[:50] + ITEM + FILL[50:90]), "a"),
            (2, j(FILL[:50] + ITEM[15:] + FILL[50:90] + ITEM[:15]), "a"),  # in another order
            (3, j(FILL[100:150] + ITEM[:20]), "a"),  # two thirds only
            (4, j(FILL[:2000]), "a"),
            (5, None, "a"),
            (6, "", None),
            (7, ", ".join(ITEM).upper() + "!", "a"),
            (None, j(ITEM), "a"),
            (8, j(LONG), "b"),
            (8, j(LONG), "b"),
            (9, j(FILL) + " " + j(ITEM[3:27]), "b"),  # exactly 24 of 30
        ]
    )


BENCH = [(10, " ".join(ITEM), "x"), (11, " ".join(LONG), "x"), (12, "a b c", "x"), (13, None, "x"), (10, " ".join(ITEM), "x")]


def test_finds_leaks_in_any_order(spark, make_docs):
    docs, bench = rows(make_docs), spark.createDataFrame(BENCH, "item_id long, text string, doc_id string")
    for limits in ({}, {"block_bytes": 200}):
        got = decontaminate(docs, bench, **limits)
        assert got.count() == docs.count()
        bad = sorted(((r["doc_id"], r["item_ids"]) for r in got.filter("not kept").collect()), key=repr)
        assert bad == sorted([(1, "10"), (2, "10"), (7, "10"), (8, "11"), (8, "11"), (9, "10"), (None, "10")], key=repr)
    kept = drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6]


def test_empty_tables(spark, make_docs):
    docs, bench = rows(make_docs), spark.createDataFrame(BENCH, "item_id long, text string, doc_id string")
    assert decontaminate(docs.limit(0), bench).count() == 0
    assert decontaminate(docs, bench.limit(0)).filter("kept").count() == docs.count()
    assert drop_leaks(docs, bench.limit(0)).count() == docs.count()


def test_words_and_short_items():
    assert words_of("Ab, c_d\u2019 É") == ["ab", "c_d", "é"]
    assert SeedIndex([(1, "a b c d")], 5).matches("a b c d", 0.8) == []
