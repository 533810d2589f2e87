"""SimHash near-duplicates by multi-index hashing.

A 64-bit SimHash is made of word shingles; two fingerprints link when they
differ in at most ``max_bits`` bits, and a class is what links reach.

Search: a fingerprint is cut into two halves of 32 bits.  Two fingerprints
that differ in four bits or fewer differ in at most two bits of one half, so
the balls of radius one around those halves meet.  Every distinct
fingerprint is entered in the tables under all 33 values of the ball of each
half, matches are fetched by shuffling on the table key, and the complete
distance is verified.  Inside one table entry links are followed breadth
first in numpy and only a star per class is passed on.  Entries with more
than ``bucket_rows`` fingerprints never enter one task: their members are
keyed by all 2,081 values within two bits of the whole fingerprint instead.
Two fingerprints are within four bits exactly if they share such a value, so
each value's members form one class (a plain minimum per key): the same
result, in rows that grow with the members alone.

Defined results: a null text has no words (fingerprint zero, linked like any
other); a null doc_id is never a class's smallest id, and a class with no
other id has a null component_id; repeated rows give repeated result rows;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctxanomaly.llm.common import body, cut, own_name, partitions_for, prepare, text_key
from ctxanomaly.llm.components import connected_components

SEED = 42
MAX_BITS = 4
SHINGLE_WORDS = 4
BUCKET_ROWS = 4096


def fingerprint(text: bytes, size: int = SHINGLE_WORDS) -> int:
    """Unsigned SimHash of a text given in UTF-8."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(len(words) - size + 1, 1)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = ends[min(size, len(words)) - 1 :]
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 16):
        spans = zip(starts[at : min(at + (1 << 16), n)].tolist(), last[at : at + (1 << 16)].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits((2 * ones > n).astype(np.uint8), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_key, fp`` (the fingerprint as a signed long)."""
    prepare(docs.sparkSession)

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(x, size) for x in texts], dtype=np.uint64).view(np.int64))

    return docs.select("doc_id", text_key().alias("text_key"), fp(body()).alias("fp"))


def star_edges(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Classes of the links among a few fingerprints, as (smallest, member)."""
    left = np.sort(fps)
    edges: list[tuple[int, int]] = []
    while left.size:
        root, front, left = int(left[0]), left[:1], left[1:]
        while front.size and left.size:
            near = np.zeros(left.size, dtype=bool)
            for f in front:
                near |= np.bitwise_count((left ^ f).view(np.uint64)) <= max_bits
            front, left = left[near], left[~near]
            edges += [(root, int(x)) for x in front]
    return edges


def _links_in_tables(max_bits: int, bucket_rows: int):
    """Batches of (key, fp), sorted by key, to edges (a, b).  Entries over
    ``bucket_rows`` give (fp, fp) marks for their members instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fps, marked = np.empty(0, np.int64), np.empty(0, np.int64), None

        def out(pairs: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        def groups(key: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
            cuts = np.flatnonzero(np.diff(key)) + 1
            first, size = np.r_[0, cuts], np.diff(np.r_[0, cuts, key.size])
            two = first[size == 2]
            a, b = fps[two], fps[two + 1]
            near = np.bitwise_count((a ^ b).view(np.uint64)) <= max_bits
            edges = [np.stack([np.minimum(a, b)[near], np.maximum(a, b)[near]], axis=1)]
            for f, n in zip(first[size > 2].tolist(), size[size > 2].tolist(), strict=True):
                part = fps[f : f + n]
                if n > bucket_rows:
                    edges.append(np.stack([part, part], axis=1))
                elif star := star_edges(part, max_bits):
                    edges.append(np.array(star, dtype=np.int64))
            found = np.unique(np.concatenate(edges), axis=0)
            if found.size:
                yield out(found)

        for batch in batches:
            k, f = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            if not k.size:
                continue
            if marked is not None:  # more of an entry that is known to be large
                same = int(np.searchsorted(k, marked, side="right"))
                if same:
                    yield out(np.stack([f[:same]] * 2, axis=1))
                k, f = k[same:], f[same:]
                if not k.size:
                    continue
                marked = None
            key, fps = np.concatenate([key, k]), np.concatenate([fps, f])
            last = int(np.searchsorted(key, key[-1], side="left"))
            if last:
                yield from groups(key[:last], fps[:last])
                key, fps = key[last:], fps[last:]
            if key.size > bucket_rows:
                yield out(np.stack([fps, fps], axis=1))
                marked, key, fps = key[0], key[:0], fps[:0]
        if key.size:
            yield from groups(key, fps)

    return run


def table_keys(distinct: DataFrame) -> DataFrame:
    """``key, fp``: each fingerprint under the radius-one balls of its halves."""
    flips = F.array(*[F.lit(m).cast("long") for m in [0, *(1 << i for i in range(32))]])
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)
    keys = F.concat(
        F.transform(flips, lambda m: low.bitwiseXOR(m)),
        F.transform(flips, lambda m: high.bitwiseXOR(m).bitwiseOR(F.lit(1 << 32))),
    )
    return distinct.select(F.explode(keys).alias("key"), "fp")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def ball_links(members: DataFrame, half: int) -> DataFrame:
    """Edges (a, b) among ``members`` (fp), linking all that share a value
    within ``half`` bits of the whole fingerprint."""
    masks = [_signed(sum(1 << i for i in c)) for r in range(half + 1) for c in combinations(range(64), r)]
    flips = F.array(*[F.lit(m).cast("long") for m in masks])
    near = members.select(F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("z"), "fp")
    low = near.groupBy("z").agg(F.min("fp").alias("a"), F.max("fp").alias("top")).filter("a < top").select("z", "a")
    return near.join(low, "z").filter("a < fp").select("a", F.col("fp").alias("b")).distinct()


def links(distinct: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Edges (a, b), a < b, whose classes are the classes of all links."""
    if max_bits not in (0, 2, 4):
        # two tables of radius one find links of at most 4 bits; half of them must be whole for the large entries
        raise ValueError("max_bits is 0, 2 or 4")
    prepare(distinct.sparkSession)
    # a fingerprint becomes 66 rows: spread them over tasks before they do
    tasks = partitions_for(distinct.sparkSession, distinct.count(), 50_000)
    spread = table_keys(distinct.repartition(tasks, "fp")).repartition("key").sortWithinPartitions("key")
    found = cut(
        spread.mapInArrow(_links_in_tables(max_bits, bucket_rows), "a long, b long").distinct(), "simhash_links"
    )
    edges = found.filter("a < b")
    marked = found.filter("a = b").select(F.col("a").alias("fp"))
    if marked.isEmpty():
        return edges
    return edges.unionByName(ball_links(marked, max_bits // 2)).distinct()


def simhash_classes(
    docs: DataFrame, size: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """One row per document: ``doc_id, text_key, fp, root, component_id``.

    ``root`` is the class's smallest fingerprint (signed), ``component_id``
    its smallest doc_id."""
    fps = cut(fingerprints(docs, size), "fingerprints")
    distinct = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct_fps")
    roots = connected_components(links(distinct.select("fp"), max_bits, bucket_rows))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = rooted.join(ids, "root").select(F.col("fp").alias("_fp"), "root", "component_id")
    return fps.join(classes, fps["fp"] == classes["_fp"]).drop("_fp")


def keep_one(docs: DataFrame, size: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each class (its smallest doc_id; among rows that share
    it, the smallest text digest), with the columns of ``docs``."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    classes = cut(simhash_classes(docs, size, max_bits), "classes")
    first = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("text_key").alias("k"))
    chosen = cut(
        classes.groupBy("root").agg(F.min(first).alias("f")).select(F.col("f.d").alias("_d"), F.col("f.k").alias("_k")),
        "chosen",
    ).hint("merge")  # texts are shuffled once at any size; the plan does not turn on the number of classes
    tk = own_name(docs, "_tk")
    rows = docs.withColumn(tk, text_key())
    kept = rows.join(chosen, rows["doc_id"].eqNullSafe(chosen["_d"]) & (rows[tk] == chosen["_k"]), "left_semi")
    if not classes.groupBy("doc_id", "text_key").count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", tk])  # rows that repeat; else texts need no second shuffle
    return kept.select(*columns)
