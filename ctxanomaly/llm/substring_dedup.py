"""Substring dedup by seed and extend over winnowed anchors.

A document is a sequence of words.  Every window of ``min_words`` words picks
a winnowed anchor (see ``anchors``); documents are joined on the anchors'
hashes, and each match is extended both ways over the windows that the anchor
stands for:

1. *whole territory*: the words from the first to the last window of an
   anchor are hashed too.  Inside long repeats anchor and territory agree, so
   the smallest document of an (anchor, territory) group settles all its
   windows at once: no pairs, whatever the size of the group.  Each task
   combines its own documents' anchors first, so that an anchor which a third
   of all documents hold reaches the join with a few rows of each task;
2. *part of it*: at a repeat's ends territories differ.  Of each territory
   only its smallest document goes on; it is extended window by window to
   both sides, and a window that a smaller document has (a minimum by window
   hash, combined on the map side) is part of a repeat.

Touching windows are joined to maximal repeats; all are over the length
threshold by construction.

Defined results: a null text has no words; a null doc_id counts as larger
than all others; documents with equal ids do not remove each other's words;
repeated rows give repeated result rows; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ctxanomaly.llm.anchors import gram_hashes, merge_spans, mix, territories
from ctxanomaly.llm.common import arrow_rows, body, cut, prepare, text_key

MIN_WORDS = 13
SEED_WORDS = 5
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_LAST = (1 << 63) - 1


def word_hashes(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """64-bit hashes of words; ``known`` keeps those of words seen before."""
    out = []
    for w in words:
        h = known.get(w)
        if h is None:
            h = known[w] = xxhash.xxh64_intdigest(w)
        out.append(h)
    if len(known) > 1 << 17:
        known.clear()
    return np.array(out, dtype=np.uint64)


def word_anchors(units: np.ndarray, min_words: int, seed_words: int):
    """Seeds (signed), territory hashes (signed), first and last window."""
    grams = mix(gram_hashes(units, seed_words, _BASES[0]))
    at, first, last = territories(grams, min_words - seed_words + 1)
    with np.errstate(over="ignore"):
        sums = np.r_[np.uint64(0), np.cumsum(mix(units) * _powers(units.size))]
        whole = (sums[last + min_words] - sums[first]) * _inverse_powers(units.size)[first]
        whole = mix(whole + at.astype(np.uint64) - first.astype(np.uint64))
    return grams[at].view(np.int64), whole.view(np.int64), first, last


_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _grown(way: str, base: int, n: int) -> np.ndarray:
    table = _POWERS[way]
    while table.size < n:
        step = np.uint64(pow(base, table.size, 1 << 64))
        with np.errstate(over="ignore"):
            table = np.concatenate([table, table * step])
        _POWERS[way] = table
    return table[:n]


def _powers(n: int) -> np.ndarray:
    return _grown("up", _BASES[1], n)


def _inverse_powers(n: int) -> np.ndarray:
    return _grown("down", pow(_BASES[1], -1, 1 << 64), n)


def _anchor_rows(min_words: int, seed_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            d, k = (batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in ("d", "k"))
            found, who = [], []
            for i, (text,) in enumerate(zip(*next(arrow_rows([batch], "body")), strict=True)):
                words = text.split()
                if len(words) >= min_words:
                    found.append(word_anchors(word_hashes(words, known), min_words, seed_words))
                    who.append(np.full(found[-1][0].size, i))
            if found:
                seed, whole, first, last = (np.concatenate(x) for x in zip(*found, strict=True))
                rows = np.concatenate(who)
                seed, state = combine_anchors(seed, whole, d[rows])
                columns = [seed, whole, state, d[rows], k[rows], first.astype(np.int32), last.astype(np.int32)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=["seed", "whole", "state", "d", "k", "first", "last"]
                )

    return run


UNDECIDED, SETTLED, OPEN = 0, 1, 2


def combine_anchors(seed: np.ndarray, whole: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Map-side combine of a batch's anchors: decide what the batch can, and
    leave at most two rows of a seed that several documents share under it.

    A territory that a smaller document of the batch has is settled.  Other
    anchors of a seed that two documents of the batch share are open; the
    smallest and the largest document keep the seed, to tell other tasks of
    it, which then keep all their territories of that seed.  All further
    decided rows get seeds of their own, which spreads them.
    """
    order = np.lexsort((d, whole, seed))
    s, w, doc = seed[order], whole[order], d[order]
    new_seed = np.r_[True, s[1:] != s[:-1]]
    new_pair = new_seed | np.r_[True, w[1:] != w[:-1]]
    low = doc[np.flatnonzero(new_pair)][np.cumsum(new_pair) - 1]
    state = np.where(doc > low, SETTLED, UNDECIDED).astype(np.int8)
    loose = state == SETTLED
    left = np.flatnonzero(~loose)  # not empty: every territory has a smallest document
    by_doc = left[np.lexsort((doc[left], s[left]))]
    starts = np.flatnonzero(np.r_[True, s[by_doc][1:] != s[by_doc][:-1]])
    size = np.diff(np.r_[starts, by_doc.size])
    lo, hi = by_doc[starts], by_doc[starts + size - 1]
    shared = np.repeat(doc[lo] < doc[hi], size)
    state[by_doc[shared]] = OPEN
    loose[by_doc[shared]] = True
    kept = doc[lo] < doc[hi]
    loose[lo[kept]] = loose[hi[kept]] = False
    own = mix(np.arange(seed.size, dtype=np.uint64) * np.uint64(_BASES[0]) ^ s.view(np.uint64) ^ mix(doc.view(np.uint64)))
    out_seed, out_state = np.empty_like(seed), np.empty_like(state)
    out_seed[order] = np.where(loose, own.view(np.int64), s)
    out_state[order] = state
    return out_seed, out_state


def _window_rows(min_words: int):
    """Batches of (d, k, body, parts) to one row per window of the parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            found = []
            for d, k, text, parts in zip(*next(arrow_rows([batch], "d", "k", "body", "parts")), strict=True):
                units = word_hashes(text.split(), known)
                one, two = (mix(gram_hashes(units, min_words, b)).view(np.int64) for b in _BASES)
                at = np.concatenate([np.arange(p["first"], p["last"] + 1) for p in parts])
                found.append((one[at], two[at], np.full(at.size, d), np.full(at.size, k), at.astype(np.int32)))
            if found:
                columns = [pa.array(np.concatenate(x)) for x in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["w1", "w2", "d", "k", "at"])

    return run


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("d"), text_key().alias("k"), body().alias("body")
    )


def repeats(docs: DataFrame, min_words: int = MIN_WORDS, seed_words: int = SEED_WORDS) -> DataFrame:
    """Windows with an earlier twin, as ``d, k, first, last`` (runs of window
    starts; not merged)."""
    prepare(docs.sparkSession)
    texts = _documents(docs)
    schema = "seed long, whole long, state tinyint, d long, k long, first int, last int"
    rows = texts.mapInArrow(_anchor_rows(min_words, seed_words), schema).repartition("seed")
    territory, seed = Window.partitionBy("seed", "whole"), Window.partitionBy("seed")
    rows = rows.withColumn("low", F.min("d").over(territory))
    # open rows with seeds of their own are not seen here, so one open row keeps all territories of its seed
    some_open = F.max(F.col("state") == OPEN).over(seed)
    rows = rows.withColumns(
        {"seed_low": F.min("low").over(seed), "seed_high": F.max("low").over(seed), "seed_open": some_open}
    )
    settled = (F.col("state") == SETTLED) | (F.col("low") < F.col("d"))
    rows = cut(
        rows.filter(settled | F.col("seed_open") | (F.col("seed_low") < F.col("seed_high"))).select(
            settled.alias("settled"), "d", "k", "first", "last"
        ),
        "anchor_matches",
    )
    parts = rows.filter(~F.col("settled")).groupBy("d", "k").agg(F.collect_set(F.struct("first", "last")).alias("parts"))
    open_windows = texts.join(parts, ["d", "k"]).mapInArrow(
        _window_rows(min_words), "w1 long, w2 long, d long, k long, at int"
    )
    open_windows = cut(open_windows, "open_windows")
    low = open_windows.groupBy("w1", "w2").agg(F.min("d").alias("low"), F.max("d").alias("high")).filter("low < high")
    extended = open_windows.join(low.select("w1", "w2", "low"), ["w1", "w2"]).filter("low < d")
    return rows.filter("settled").select("d", "k", "first", "last").unionByName(
        extended.select("d", "k", F.col("at").alias("first"), F.col("at").alias("last"))
    )


def substring_dedup(docs: DataFrame, min_words: int = MIN_WORDS, seed_words: int = SEED_WORDS) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256`` and
    ``spans`` (maximal repeats as [from, to) words, in order)."""
    runs = repeats(docs, min_words, seed_words)
    spans = runs.distinct().groupBy("d", "k").agg(F.collect_list("first").alias("starts"), F.collect_list("last").alias("ends"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = _documents(docs).withColumn("doc_id", F.when(F.col("d") != _LAST, F.col("d")))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:int,end:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, bodies, starts, ends in arrow_rows(batches, "doc_id", "body", "starts", "ends"):
            out = []
            for doc_id, text, a, b in zip(doc_ids, bodies, starts, ends, strict=True):
                words = text.split()
                merged = merge_spans(a, [x + min_words for x in b]) if a else []
                kept, at = [], 0
                for x, y in merged:
                    kept += words[at:x]
                    at = y
                kept += words[at:]
                digest = hashlib.sha256(b" ".join(kept)).hexdigest()
                out.append((doc_id, len(words), len(words) - len(kept), digest, [{"start": x, "end": y} for x, y in merged]))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(),
                         pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_sha256", "spans"])

    return texts.join(spans, ["d", "k"], "left").mapInArrow(run, schema).withColumn("doc_id", F.col("doc_id").cast(kind))
