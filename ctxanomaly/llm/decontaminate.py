"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are sequences of lower-cased words.  A running
Karp-Rabin hash over ``min_match`` words finds the places where a document
shares a seed with an item; hits are verified, joined to maximal matches
along their diagonals, and tiled greedily: the longest match is marked
first, and what overlaps marked words is cut back to its free parts.  An
item's coverage is the share of its words under tiles, wherever these stand
in the document, so passages in another order count in full.  A document is
contaminated when an item's coverage reaches ``min_coverage``.

The benchmark is a stated query set.  Its items come to the driver in blocks
of at most ``block_bytes`` of text (or one item), one at a time; a block is
broadcast, run against all documents, its matches are written, and it is
released before the next one is read.  So neither the driver nor a task holds
more than a block, however large the benchmark is or often an item repeats.

Defined results: null texts are empty; items of fewer than ``min_match``
words share no seed and match nothing; repeated items and documents are
judged one by one; an empty table on either side leaves every document as it
is; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ctxanomaly.llm.common import arrow_rows, cut, own_name, prepare, text_key

MIN_MATCH = 5
MIN_COVERAGE = 0.8
BLOCK_BYTES = 8 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def running_hash(ids: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``size`` ids, modulo 2**64."""
    m = ids.size - size + 1
    out = np.zeros(max(m, 0), dtype=np.uint64)
    for j in range(size):
        out = out * _BASE + ids[j : j + m].astype(np.uint64) + np.uint64(1)
    return out


def tile(pairs: list[tuple[int, int]], size: int, item_words: int) -> int:
    """Words of an item under greedy tiles, from verified seed hits (item
    position, document position)."""
    return tile_runs(diagonal_runs(pairs, size), size, item_words)


def diagonal_runs(pairs: list[tuple[int, int]], size: int) -> list[tuple[int, int, int]]:
    """Maximal matches as (-length, item position, document position)."""
    by_diagonal: dict[int, list[int]] = defaultdict(list)
    for i, j in pairs:
        by_diagonal[j - i].append(i)
    runs = []
    for d, starts in by_diagonal.items():
        starts.sort()
        first = last = starts[0]
        for i in [*starts[1:], -1]:
            if i != last + 1:
                runs.append((-(last - first + size), first, first + d))
                first = i
            last = i
    return runs


def tile_runs(heap: list[tuple[int, int, int]], size: int, item_words: int) -> int:
    """Words of an item under greedy tiles, from its maximal matches."""
    heapify(heap)
    in_item, in_doc = bytearray(item_words), set()
    while heap:
        n, i, j = heappop(heap)
        free = [not in_item[i + k] and (j + k) not in in_doc for k in range(-n)]
        if all(free):
            in_item[i : i - n] = b"\x01" * -n
            in_doc.update(range(j, j - n))
            continue
        k = 0
        while k < -n:
            start = k
            while k < -n and free[k]:
                k += 1
            if k - start >= size:
                heappush(heap, (start - k, i + start, j + start))
            k += 1
    return sum(in_item)


class SeedIndex:
    """Seeds of a block of benchmark items."""

    def __init__(self, items: list[tuple[object, str | None]], size: int):
        self.size, self.vocabulary = size, {}
        self.items = []
        seeds, item_of, word_of = [], [], []
        for item_id, text in items:
            words = words_of(text)
            if len(words) < size:
                continue
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words], dtype=np.int64)
            h = running_hash(ids, size)
            seeds.append(h)
            item_of.append(np.full(h.size, len(self.items), dtype=np.int32))
            word_of.append(np.arange(h.size, dtype=np.int32))
            self.items.append((item_id, ids))
        joined = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
        every = joined(seeds, np.uint64)
        order = np.argsort(every, kind="stable")
        self.hashes, self.first = np.unique(every[order], return_index=True)
        self.last = np.r_[self.first[1:], every.size].astype(np.int64)
        self.lengths = np.array([ids.size for _, ids in self.items], dtype=np.int64)
        self.item_of, self.word_of = joined(item_of, np.int32)[order], joined(word_of, np.int32)[order]

    def matches(self, text: str | None, min_coverage: float) -> list[tuple[object, int, int]]:
        """(item_id, item words, tiled words) of the items that ``text`` covers."""
        words = words_of(text)
        if len(words) < self.size or not self.hashes.size:
            return []
        get = self.vocabulary.get
        ids = np.array([get(w, -1) for w in words], dtype=np.int64)
        known = np.concatenate([[0], np.cumsum(ids >= 0)])
        at = np.flatnonzero(known[self.size :] - known[: -self.size] == self.size)
        if not at.size:
            return []
        h = running_hash(ids, self.size)[at]
        slot = np.minimum(np.searchsorted(self.hashes, h), self.hashes.size - 1)
        hit = self.hashes[slot] == h
        if not hit.any():
            return []
        at, slot = at[hit], slot[hit]
        order = np.argsort(slot, kind="stable")
        at = at[order]
        used, begin = np.unique(slot[order], return_index=True)
        places = np.split(at, begin[1:])  # of each seed in the document
        held = self.last[used] - self.first[used]
        entry = np.arange(held.sum()) + np.repeat(self.first[used] - np.cumsum(held) + held, held)
        seed_of = np.repeat(np.arange(used.size), held)
        order = np.argsort(self.item_of[entry], kind="stable")
        entry, seed_of = entry[order], seed_of[order]
        items, begin, count = np.unique(self.item_of[entry], return_index=True, return_counts=True)
        # items whose hit positions would not reach the coverage as disjoint seeds go before any pair is made
        n = self.lengths[items]
        near = np.minimum(count * self.size, n) >= min_coverage * n
        found = []
        for item, a, c in zip(items[near].tolist(), begin[near].tolist(), count[near].tolist(), strict=True):
            item_id, item_ids = self.items[item]
            hits = zip(self.word_of[entry[a : a + c]].tolist(), seed_of[a : a + c].tolist(), strict=True)
            verified, runs = self._runs(item_ids, ids, [(i, places[s]) for i, s in hits])
            n = item_ids.size
            if min(verified * self.size, n) < min_coverage * n:
                continue
            tiled = tile_runs(runs, self.size, n)
            if tiled >= min_coverage * n:
                found.append((item_id, n, tiled))
        return found

    def _runs(
        self, item: np.ndarray, doc: np.ndarray, hits: list[tuple[int, np.ndarray]]
    ) -> tuple[int, list[tuple[int, int, int]]]:
        """Item positions with a verified hit, and the maximal matches as
        (-length, item position, document position).  Only the ends of matches
        are kept, so pairs inside them take no memory."""
        size, verified = self.size, 0
        starts, ends = [], []
        for i, at in hits:
            for k in range(size):
                at = at[doc[at + k] == item[i + k]]
            if not at.size:
                continue
            verified += 1
            before = at > 0 if i > 0 else np.zeros(at.size, bool)
            if i > 0:
                before &= doc[at - 1] == item[i - 1]
            after = at + size < doc.size if i + size < item.size else np.zeros(at.size, bool)
            if i + size < item.size:
                after &= doc[np.minimum(at + size, doc.size - 1)] == item[i + size]
            for into, j in ((starts, at[~before]), (ends, at[~after])):
                if j.size:
                    into.append(np.stack([j - i, np.full(j.size, i)]))
        if not verified:
            return 0, []
        # on each diagonal starts and ends take turns
        starts, ends = (x[:, np.lexsort((x[1], x[0]))] for x in (np.concatenate(starts, 1), np.concatenate(ends, 1)))
        length = ends[1] - starts[1] + size
        return verified, list(zip((-length).tolist(), starts[1].tolist(), (starts[0] + starts[1]).tolist(), strict=True))


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = MIN_MATCH,
    min_coverage: float = MIN_COVERAGE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, text_key, item_id, item_words, tiled_words`` for every
    document and item over the coverage."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select("doc_id", text_key().alias("text_key"), F.col("text").cast("string").alias("text"))
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    id_type = items.schema["item_id"].dataType
    doc_type = rows.schema["doc_id"].dataType
    schema = f"doc_id {doc_type.simpleString()}, text_key long, item_id {id_type.simpleString()}, item_words long, tiled_words long"

    def against(part: list[Row]) -> DataFrame:
        index = spark.sparkContext.broadcast(SeedIndex([tuple(r) for r in part], min_match))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seeds = index.value
            for batch in batches:
                found = []
                for doc_id, key, text in zip(*next(arrow_rows([batch], "doc_id", "text_key", "text")), strict=True):
                    found += [(doc_id, key, *m) for m in seeds.matches(text, min_coverage)]
                if found:
                    columns = list(zip(*found, strict=True))
                    typed = [pa.array(columns[0], type=batch.schema.field("doc_id").type)]
                    typed += [pa.array(c) if any(x is not None for x in c) else pa.array(c, pa.int64()) for c in columns[1:]]
                    yield pa.RecordBatch.from_arrays(
                        typed, names=["doc_id", "text_key", "item_id", "item_words", "tiled_words"]
                    )

        found = cut(rows.mapInArrow(run, schema), "item_matches")
        index.unpersist()
        return found

    none = spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, map(against, blocks(items, block_bytes)), none)


def blocks(items: DataFrame, block_bytes: int) -> Iterator[list[Row]]:
    """Items in blocks of at most ``block_bytes`` of text each (or one item),
    streamed to the driver."""
    block, size = [], 0
    for item in items.toLocalIterator(prefetchPartitions=False):
        more = len((item["text"] or "").encode())
        if block and size + more > block_bytes:
            yield block
            block, size = [], 0
        block.append(item)
        size += more
    if block:
        yield block


def decontaminate(docs: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """One row per document: ``doc_id, n_items, item_ids`` (covered items,
    ascending, comma-joined), ``coverage`` (the best) and ``kept``."""
    found = matches(docs, benchmark, **limits)
    rows = docs.select("doc_id", text_key().alias("text_key"))
    per_doc = found.groupBy("doc_id", "text_key").agg(
        F.array_join(F.transform(F.array_sort(F.collect_set("item_id")), lambda x: x.cast("string")), ",").alias("ids"),
        F.count_distinct("item_id").alias("n"),
        F.max(F.col("tiled_words") / F.col("item_words")).alias("best"),
    )
    per_doc = per_doc.withColumnsRenamed({"doc_id": "_d", "text_key": "_k"})
    joined = rows.join(per_doc, rows["doc_id"].eqNullSafe(per_doc["_d"]) & (rows["text_key"] == per_doc["_k"]), "left")
    return joined.select(
        "doc_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("ids", F.lit("")).alias("item_ids"),
        F.coalesce("best", F.lit(0.0)).alias("coverage"),
        F.col("best").isNull().alias("kept"),
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """The documents that cover no benchmark item, with their own columns."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    leaks = cut(
        matches(docs, benchmark, **limits).select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k")).distinct(),
        "leaking_docs",
    )
    tk = own_name(docs, "_tk")
    rows = docs.withColumn(tk, text_key())
    same = rows["doc_id"].eqNullSafe(leaks["_d"]) & (rows[tk] == leaks["_k"])
    return rows.join(leaks, same, "left_anti").select(*columns)
