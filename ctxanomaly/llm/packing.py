"""Conflict-constrained best-fit packing of documents into sequences.

Documents are cut at ``capacity`` words; pieces are packed best-fit
decreasing.  A bin never holds two pieces of one duplicate cluster (a
document's own pieces included) nor two of one source.  Open bins are ordered
by residual capacity and carry bitmaps of their sources and clusters; the
search goes from the tightest residual upwards and continues until a
compatible bin is found.  A tree over the residuals holds the intersection of
the source bitmaps below each node, so runs of bins that all hold the
piece's source are passed over in one step and a hot source costs no more
than any other.

Pieces are dealt by hash into shards of about ``shard_rows`` pieces, each
packed by one task; the shards' number follows the input.  Best fit holds
within a shard, so bins that a shard leaves loose (more than ``loose`` of the
capacity free) are dealt anew, across shards and whole, and packed once more
by the same search: a loose bin goes into the tightest one that has room for
it and shares none of its sources and clusters.  Both passes run at every
size.

Defined results: a null or empty text is a piece of zero words; a null source
is a source of its own; a row that repeats is in its twin's cluster, hence in
another bin; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctxanomaly.llm.common import body, cut, partitions_for, prepare, text_key

CAPACITY = 2048
SHARD_ROWS = 20_000
LOOSE = 1 / 16


def count_words(texts: Column) -> Column:
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([len(x.split()) for x in texts], dtype="int64")

    return run(texts)


def pieces(docs: DataFrame, capacity: int = CAPACITY, source: str = "source", cluster: str | None = None) -> DataFrame:
    """``doc_id, piece, start_word, n_words, source, cluster``: every document
    in pieces of at most ``capacity`` words.  Without a cluster column the
    clusters are texts that are equal but for the case of letters."""
    prepare(docs.sparkSession)
    own = F.xxhash64(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    rows = docs.select(
        "doc_id",
        text_key().alias("text_key"),
        F.col(source).cast("string").alias("source"),
        (own if cluster is None else F.xxhash64(F.col(cluster))).alias("cluster"),
        count_words(body()).alias("doc_words"),
    )
    last = F.greatest(F.ceil(F.col("doc_words") / F.lit(capacity)) - 1, F.lit(0).cast("long"))
    cutup = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return cutup.withColumn("start_word", F.col("piece") * capacity).withColumn(
        "n_words", F.least(F.lit(capacity).cast("long"), F.col("doc_words") - F.col("start_word"))
    ).drop("doc_words")


class OpenBins:
    """Bins by residual, with a tree of source bitmaps over the residuals."""

    def __init__(self, capacity: int):
        self.size = 1 << (capacity + 1).bit_length()
        self.slots: list[dict[int, tuple[int, int]]] = [{} for _ in range(capacity + 1)]
        self.tree: list[int | None] = [None] * (2 * self.size)  # None: no bin below

    def _refresh(self, residual: int) -> None:
        value = None
        for sources, _ in self.slots[residual].values():
            value = sources if value is None else value & sources
        node = residual + self.size
        while node:
            self.tree[node] = value
            node >>= 1
            if node:
                a, b = self.tree[2 * node], self.tree[2 * node + 1]
                value = b if a is None else a if b is None else a & b

    def put(self, bin_id: int, residual: int, sources: int, clusters: int) -> None:
        self.slots[residual][bin_id] = (sources, clusters)
        self._refresh(residual)

    def _next(self, start: int, source: int) -> int:
        """Smallest residual from ``start`` that may have a bin without the
        sources, or -1."""
        if start >= len(self.slots):
            return -1
        node = start + self.size
        while True:
            held = self.tree[node]
            if held is not None and not held & source:
                if node >= self.size:
                    return node - self.size
                node *= 2  # of several sources each child may hold another one: then its neighbour is next
                continue
            while node & 1:  # a right child: go up
                node >>= 1
                if not node:
                    return -1
            node += 1

    def take(self, need: int, source: int, cluster: int) -> tuple[int, int, int, int] | None:
        """Remove and return the tightest compatible bin."""
        at = self._next(need, source)
        while at >= 0:
            for bin_id, (sources, clusters) in self.slots[at].items():
                if not sources & source and not clusters & cluster:
                    del self.slots[at][bin_id]
                    self._refresh(at)
                    return bin_id, at, sources, clusters
            at = self._next(at + 1, source)
        return None


def _bits(values: pd.Series) -> list[int]:
    """A bit for each value that occurs twice or more (others cannot conflict)."""
    return _set_bits([[v] for v in pd.factorize(values, use_na_sentinel=False)[0].tolist()])


def _set_bits(sets: list[list]) -> list[int]:
    """The bits of sets of values: one for each value that occurs twice or more."""
    counts = Counter(v for values in sets for v in values)
    bit = {v: 1 << i for i, v in enumerate(v for v, n in counts.items() if n > 1)}
    return [sum(bit.get(v, 0) for v in values) for values in sets]


def best_fit(needs: list[int], sources: list[int], clusters: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and place in it of each need, taken in the given order."""
    bins, opened = OpenBins(capacity), 0
    ids, starts = [], []
    for need, source, cluster in zip(needs, sources, clusters, strict=True):
        found = bins.take(need, source, cluster)
        if found is None:
            found, opened = (opened, capacity, 0, 0), opened + 1
        bin_id, residual, held, groups = found
        ids.append(bin_id)
        starts.append(capacity - residual)
        bins.put(bin_id, residual - need, held | source, groups | cluster)
    return ids, starts


def pack_shard(shard: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Best-fit decreasing over one shard; adds ``bin_id`` and ``bin_start``."""
    rows = shard.sort_values(
        ["n_words", "doc_id", "text_key", "piece"], ascending=[False, True, True, True], kind="stable"
    ).reset_index(drop=True)
    ids, starts = best_fit(rows["n_words"].tolist(), _bits(rows["source"]), _bits(rows["cluster"]), capacity)
    shard_id = int(rows["shard"].iloc[0]) if len(rows) else 0
    return rows.assign(bin_id=np.array(ids, dtype=np.int64) + (shard_id << 32), bin_start=np.array(starts, dtype=np.int64))


def merge_shard(shard: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Best-fit decreasing over loose bins (``bin_id, fill, sources,
    clusters``): ``old_id, new_id, offset``."""
    rows = shard.sort_values(["fill", "bin_id"], ascending=[False, True], kind="stable")
    sources = _set_bits([[s["source"] for s in held] for held in rows["sources"]])
    clusters = _set_bits([list(held) for held in rows["clusters"]])
    places, offsets = best_fit(rows["fill"].tolist(), sources, clusters, capacity)
    old, first = rows["bin_id"].tolist(), {}
    new = [first.setdefault(p, i) for p, i in zip(places, old, strict=True)]  # a merged bin keeps its first one's id
    return pd.DataFrame({"old_id": old, "new_id": new, "offset": offsets}, dtype="int64")


def pack(rows: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS, loose: float = LOOSE) -> DataFrame:
    """``doc_id, piece, start_word, n_words, source, bin_id, bin_start`` for
    the rows of :func:`pieces`."""
    spark = rows.sparkSession
    prepare(spark)
    rows = cut(rows, "pieces")
    n = max(1, -(-rows.count() // shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text_key", "piece"), F.lit(n)))
    kind = rows.schema["doc_id"].dataType.simpleString()
    fields = ["doc_id", "piece", "start_word", "n_words", "source", "cluster", "bin_id", "bin_start"]
    schema = f"doc_id {kind}, piece long, start_word long, n_words long, source string, cluster long, bin_id long, bin_start long"

    def run(shard: pd.DataFrame) -> pd.DataFrame:
        return pack_shard(shard, capacity)[fields]

    shards = dealt.repartition(partitions_for(spark, n, 1), "shard").groupBy("shard")
    packed = cut(shards.applyInPandas(run, schema), "packed")
    bins = packed.groupBy("bin_id").agg(
        F.sum("n_words").alias("fill"),
        F.collect_set(F.struct("source")).alias("sources"),  # a struct, as a set leaves plain nulls out
        F.collect_set("cluster").alias("clusters"),
    )
    bins = cut(bins.filter(F.col("fill") < F.lit(capacity * (1 - loose))), "loose_bins")
    m = max(1, -(-bins.count() // shard_rows))

    def merge(shard: pd.DataFrame) -> pd.DataFrame:
        return merge_shard(shard, capacity)

    again = bins.withColumn("shard", F.pmod(F.xxhash64("bin_id"), F.lit(m))).repartition(partitions_for(spark, m, 1), "shard")
    moved = cut(again.groupBy("shard").applyInPandas(merge, "old_id long, new_id long, offset long"), "moved_bins")
    out = packed.join(moved, packed["bin_id"] == moved["old_id"], "left")
    return out.select(
        "doc_id", "piece", "start_word", "n_words", "source",
        F.coalesce("new_id", "bin_id").alias("bin_id"),
        (F.col("bin_start") + F.coalesce("offset", F.lit(0))).alias("bin_start"),
    )
