"""Exact order statistics of a non-negative bigint column, distributed.

The value at rank r is found by refining a histogram over the bits of the
value: each pass is one aggregate (``groupBy(bucket).count()``, at most
4096 groups, partial aggregation) restricted to the current prefix.  It
stops when the chosen bucket holds at most ``max_rows`` rows; only that
bounded remainder is ordered.  No pass brings more than 4096 counts to the
driver, whatever the table size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVEL_BITS = 12


@dataclass(frozen=True)
class RankBucket:
    lo: int  # bucket covers lo <= v < hi
    hi: int
    below: int  # rows with v < lo
    inside: int  # rows with lo <= v < hi


def rank_bucket(df: DataFrame, col: str, rank: int, bits: int, max_rows: int = 100_000) -> RankBucket:
    """Bucket [lo, hi) of values containing the ``rank``-th smallest value (1-based).

    ``bits``: every value is < 2**bits.
    """
    if rank < 1:
        raise ValueError("rank is 1-based")
    v = F.col(col)
    prefix, width, below = 0, bits, 0
    inside = None
    while True:
        step = min(LEVEL_BITS, width)
        shift = width - step
        lo = prefix << width
        hi = (prefix + 1) << width
        rows = (
            df.filter((v >= F.lit(lo)) & (v < F.lit(hi)))
            .groupBy(F.shiftright(v - F.lit(lo), shift).alias("b"))
            .count()
            .collect()
        )
        counts = sorted((r["b"], r["count"]) for r in rows)
        seen = below
        chosen = None
        for b, cnt in counts:
            if seen + cnt >= rank:
                chosen = (b, cnt)
                break
            seen += cnt
        if chosen is None:
            raise ValueError(f"rank {rank} exceeds the {seen} rows of {col}")
        b, inside = chosen
        below = seen
        prefix = (prefix << step) | b
        width = shift
        if inside <= max_rows or width == 0:
            break
    return RankBucket(prefix << width, (prefix + 1) << width, below, inside)


def value_at_rank(df: DataFrame, col: str, rank: int, bits: int, max_rows: int = 100_000) -> int:
    """Exact ``rank``-th smallest value (1-based) of ``col``."""
    bucket = rank_bucket(df, col, rank, bits, max_rows)
    if bucket.hi - bucket.lo == 1:
        return bucket.lo
    v = F.col(col)
    # At most max_rows values are left: order them and take one.
    row = (
        df.filter((v >= F.lit(bucket.lo)) & (v < F.lit(bucket.hi)))
        .select(v.alias("v"))
        .orderBy("v")
        .offset(rank - bucket.below - 1)
        .first()
    )
    return int(row["v"])
