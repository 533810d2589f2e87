"""Ranked lexical search of many items at once, sharing common subexpressions.

An item's score for a document is a sum over its terms, so items that share
terms share partial sums.  ``SharingPlan`` mines them: terms that the same
items hold equally often form one node; then, with each item's nodes in
falling order of the items that hold them, neighbouring nodes that stand
together in several items are replaced by one new node, again and again,
until no pair repeats.  The nodes are a graph without cycles: a node is a set
of terms, a pair of smaller nodes or the leaf of its own terms.  For a batch
of documents every node's partial accumulator is filled once, in the order of
the graph, and items add up the few nodes they are left with.

Documents are read once per block of items: one pass finds each document's
length and the occurrences of the block's terms (a table), sums over it give
N, L and the terms' documents, and a second pass over that table scores.
Each task keeps the best documents of every item, so what is shuffled is
items x best x tasks; the final order is taken in two levels.  Items come to
the driver in blocks of at most ``block_bytes`` of text (or one item), and a
block's plan is released when its results are written.

Defined results: a null or empty text has no terms, as document (not counted
in N) and as item (no rows); a null doc_id ranks behind equal scores; repeated
documents are ranked one by one; repeated items are answered one by one;
empty tables give an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from ctxanomaly.llm.common import arrow_rows, body, cut, prepare

BEST = 10
BLOCK_BYTES = 4 << 20
#: Documents scored at a time, fewer where the plan's accumulators (8 bytes x
#: nodes x documents) would take more than SCORE_BYTES.
SCORE_ROWS = 512
SCORE_BYTES = 64 << 20
_SALTS = 64
_SPACE = 0x20
# A term's bytes: digits, letters (A-Z lower-cased) and all of UTF-8 beyond ASCII.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else _SPACE for c in range(256))
_NO_ID = np.iinfo(np.int64).max


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class SharingPlan:
    """Nodes of the items' shared term sets and the order to fill them in.

    ``leaves[k]`` are the (term, times) of leaf k, ``pairs[j]`` the two nodes
    that node ``len(leaves) + j`` adds up, ``items[i]`` the nodes of item i.
    """

    def __init__(self, bags: list[dict[int, int]]):
        holders: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for i, bag in enumerate(bags):
            for term, times in bag.items():
                holders[term].append((i, times))
        alike: dict[tuple, list[int]] = defaultdict(list)
        for term, held in holders.items():
            alike[tuple(held)].append(term)
        self.leaves: list[list[tuple[int, int]]] = []
        rows: list[list[int]] = [[] for _ in bags]
        for held, group in sorted(alike.items(), key=lambda kv: (-len(kv[0]), kv[0])):
            by_times: dict[int, int] = {}  # items may hold the same terms a different number of times
            for i, times in held:
                if times not in by_times:
                    by_times[times] = len(self.leaves)
                    self.leaves.append([(term, times) for term in sorted(group)])
                rows[i].append(by_times[times])
        self.pairs: list[tuple[int, int]] = []
        while True:
            seen: Counter = Counter()
            for row in rows:
                seen.update(set(zip(row, row[1:], strict=False)))
            new: dict[tuple[int, int], int] = {}
            merged = []
            for row in rows:
                out, k = [], 0
                while k < len(row):
                    pair = tuple(row[k : k + 2])
                    # the best of overlapping pairs: this one, unless the next is more frequent
                    here = seen.get(pair, 0)
                    if here > 1 and here >= seen.get(tuple(row[k + 1 : k + 3]), 0):
                        out.append(new.setdefault(pair, len(self.leaves) + len(self.pairs) + len(new)))
                        k += 2
                    else:
                        out.append(row[k])
                        k += 1
                merged.append(out)
            if not new:
                break
            rows = merged
            self.pairs += new
        self.items = rows

    @property
    def size(self) -> int:
        return len(self.leaves) + len(self.pairs)

    def additions(self) -> tuple[int, int]:
        """Sums of two per document with the plan, and without sharing."""
        parts = [len(x) for x in (*self.leaves, *self.items) if x]
        flat = [sum(1 for _ in self.flatten(i)) - 1 for i, nodes in enumerate(self.items) if nodes]
        return sum(parts) - len(parts) + len(self.pairs), sum(flat)

    def flatten(self, item: int) -> Iterator[tuple[int, int]]:
        """(term, times) of an item, read back from the graph."""
        todo = list(self.items[item])
        while todo:
            node = todo.pop()
            if node < len(self.leaves):
                yield from self.leaves[node]
            else:
                todo += self.pairs[node - len(self.leaves)]

    def scores(self, shares: dict[int, tuple[np.ndarray, np.ndarray]], rows: int) -> Iterator[tuple[int, np.ndarray]]:
        """(item, score of every document of the batch) of the items that some
        document meets.  ``shares[term]``: (documents, their shares)."""
        acc: list[np.ndarray | None] = []  # None: no document holds a term of the node
        for leaf in self.leaves:
            total = None
            for term, times in leaf:
                if term in shares:
                    at, share = shares[term]
                    total = np.zeros(rows, np.int64) if total is None else total
                    total[at] += times * share
            acc.append(total)
        for a, b in self.pairs:
            a, b = acc[a], acc[b]
            acc.append(b if a is None else a if b is None else a + b)
        for i, nodes in enumerate(self.items):
            parts = [acc[k] for k in nodes if acc[k] is not None]
            if parts:
                total = parts[0].copy() if len(parts) > 1 else parts[0]
                for more in parts[1:]:
                    total += more
                yield i, total


def occurrences(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, at, tf`` of every document with a term: its number of
    terms, and the places in the vocabulary of those it holds with their
    occurrences.  Whole texts are read once."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for ids, texts in arrow_rows(batches, "doc_id", "text"):
            rows = []
            for doc_id, text in zip(ids, texts, strict=True):
                words = terms(text)
                if words:
                    held = Counter(filter(known.__contains__, words))
                    rows.append((doc_id, len(words), [known[w] for w in held], list(held.values())))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else ([],) * 4, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "at", "tf"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body().alias("text"))
    found = cut(rows.mapInArrow(find, "doc_id long, n long, at array<int>, tf array<long>"), "occurrences")
    shared.unpersist()
    return found


def best_of(docs: DataFrame, items: list[Row], best: int) -> DataFrame:
    """``item, rank, doc_id, score`` of one block of items (their places)."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    bags = []
    for item in items:
        counts = Counter(terms(bytes(item["text"])))
        bags.append({vocabulary.setdefault(w, len(vocabulary)): times for w, times in counts.items()})
    found = occurrences(docs, vocabulary)
    total = found.agg(F.count("n").alias("n_docs"), F.sum("n").alias("length")).first()
    n_docs, length = total["n_docs"], total["length"] or 0
    holding = found.select(F.explode("at").alias("at")).groupBy("at").count().toArrow()
    df = dict(zip(holding.column("at").to_pylist(), holding.column("count").to_pylist(), strict=True))
    weight = {at: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for at, d in df.items()}
    plan = spark.sparkContext.broadcast((SharingPlan(bags), weight))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan_, weight_ = plan.value
        step = max(1, min(SCORE_ROWS, SCORE_BYTES // (8 * max(plan_.size, 1))))
        top: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # item -> scores and ids, best first
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                ids = part.column(0).fill_null(_NO_ID).to_numpy()
                m = np.array([25 + 75 * n * n_docs // length for n in part.column(1).to_pylist()], np.int64)
                doc = np.repeat(np.arange(len(ids)), part.column(2).value_lengths().to_numpy())
                at, tf = part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy()
                # all numbers are positive: // is div
                share = 1_000_000_000 * tf // (1000 * tf + 8 * m[doc])
                order = np.argsort(at, kind="stable")
                cuts = np.flatnonzero(np.diff(at[order])) + 1
                groups = np.split(order, cuts) if at.size else []
                shares = {int(at[g[0]]): (doc[g], weight_[int(at[g[0]])] * share[g]) for g in groups}
                for item, scores in plan_.scores(shares, len(ids)):
                    old, old_ids = top.get(item, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                    least = old[-1] if len(old) == best else 1
                    new = np.flatnonzero(scores >= least)
                    if new.size:
                        s, d = np.concatenate([old, scores[new]]), np.concatenate([old_ids, ids[new]])
                        keep = np.lexsort((d, -s))[:best]
                        top[item] = s[keep], d[keep]
        if top:
            sizes = [len(s) for s, _ in top.values()]
            columns = [
                pa.array(np.repeat(np.array(list(top), np.int32), sizes)),
                pa.array(np.concatenate([d for _, d in top.values()])),
                pa.array(np.concatenate([s for s, _ in top.values()])),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    rows = found.filter(F.size("at") > 0).mapInArrow(score, "item int, doc_id long, score long")
    rows = rows.withColumn("salt", F.spark_partition_id() % _SALTS)
    order = [F.col("score").desc(), F.col("doc_id")]
    for level in (["item", "salt"], ["item"]):
        rank = F.row_number().over(Window.partitionBy(*level).orderBy(*order))
        rows = rows.withColumn("rank", rank).filter(F.col("rank") <= best)
    rows = cut(rows.withColumn("doc_id", F.nullif("doc_id", F.lit(_NO_ID))), "best_documents")
    plan.unpersist()
    return rows


def blocks(items: DataFrame, block_bytes: int) -> Iterator[list[Row]]:
    """Items with a term in blocks of at most ``block_bytes`` of text each (or
    one item), streamed to the driver."""
    block, size = [], 0
    for item in items.toLocalIterator(prefetchPartitions=False):
        if block and size + len(item["text"]) > block_bytes:
            yield block
            block, size = [], 0
        block.append(item)
        size += len(item["text"])
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, best: int = BEST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the best documents of every item."""
    spark = docs.sparkSession
    prepare(spark)
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), body().alias("text"))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in blocks(asked, block_bytes):
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)], "item int, item_id long")
        rows = best_of(docs, block, best).join(names, "item")
        out = out.unionByName(rows.select("item_id", "rank", "doc_id", "score"))
    return out
