"""Host-level quality rules.

Each document gets rule metrics from its whole text; failures are then
aggregated by host, the failure rates are shrunk with an empirical beta
prior, and the verdicts of the hosts are joined back to the documents.

Defined results: a null text has no words (all counts 0, base rule failed);
null hosts are one host of their own; rows that repeat are judged one by one
and each counts for its host; an empty table gives an empty table; columns
other than the named ones are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctxanomaly.llm.common import body, cut, own_name, prepare, same_row

METRICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
WINDOW_WORDS = 5

# Byte classes: 0 first byte of any other character, 1 white space, 2 symbol,
# 3 continuation byte of a character.
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = 1
_CLASS[list(b"#*$%&|<>")] = 2
_CLASS[0x80:0xC0] = 3


@dataclass(frozen=True)
class HostRules:
    """Limits of the rules.  ``base`` rules reject a document by themselves;
    all rules count as failures of its host.  A host is rejected when its
    shrunk failure rate is over ``max_host_rate``."""

    min_words: int = 10
    max_repeat_percent: int = 20
    max_symbol_percent: int = 10
    max_dup_line_percent: int = 30
    max_host_rate: float = 0.5
    max_prior_strength: float = 1000.0


def repeated_window_words(words: list[bytes], size: int = WINDOW_WORDS) -> int:
    """Words inside windows of ``size`` words that occur twice or more."""
    n = len(words)
    if n <= size:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    k, m = max(len(seen), 2), n - size + 1
    code, base = ids[:m], k
    for j in range(1, size):
        if base > (1 << 62) // k:  # the exact code would overflow: rank what there is
            _, code = np.unique(code, return_inverse=True)
            base = m
        code, base = code * k + ids[j : j + m], base * k
    _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
    repeated = (counts[inverse] > 1).astype(np.int64)
    edge = np.zeros(n + 1, dtype=np.int64)
    edge[:m] += repeated
    edge[size : size + m] -= repeated
    return int((np.cumsum(edge)[:n] > 0).sum())


def text_metrics(text: bytes) -> tuple[int, int, int, int, int, int]:
    words = text.split()  # bytes.split() parts at 0x20 and 0x09-0x0D only
    kinds = np.bincount(_CLASS[np.frombuffer(text, dtype=np.uint8)], minlength=4)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (
        len(words),
        int(kinds[0] + kinds[2]),
        int(kinds[2]),
        len(lines) - len(set(lines)),
        repeated_window_words(words),
        len(lines),
    )


def metrics(texts: Column) -> Column:
    """:func:`text_metrics` of a binary column, as a struct."""

    @F.pandas_udf(METRICS)
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = [text_metrics(x) for x in texts]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in METRICS.split(", ")])

    return run(texts)


def base_failed(m: str, rules: HostRules) -> Column:
    words = F.col(f"{m}.n_words")
    return (words < rules.min_words) | (100 * F.col(f"{m}.n_repeat_words") > rules.max_repeat_percent * words)


def any_failed(m: str, rules: HostRules) -> Column:
    symbols = 100 * F.col(f"{m}.n_symbols") > rules.max_symbol_percent * F.col(f"{m}.word_chars")
    lines = 100 * F.col(f"{m}.n_dup_lines") > rules.max_dup_line_percent * F.col(f"{m}.n_lines")
    return base_failed(m, rules) | symbols | lines


def measured(docs: DataFrame, host: str, keep: list[str], rules: HostRules) -> DataFrame:
    """``keep`` columns, ``_host``, ``_m`` (metrics), ``_base``, ``_any``."""
    prepare(docs.sparkSession)
    m = docs.select(*keep, F.col(host).alias("_host"), metrics(body()).alias("_m"))
    return m.withColumns({"_base": base_failed("_m", rules), "_any": any_failed("_m", rules)})


def host_verdicts(judged: DataFrame, rules: HostRules = HostRules()) -> DataFrame:
    """One row per host: documents, failures, shrunk rate and verdict.

    The beta prior comes from the mean and variance of the hosts' rates
    (method of moments); those two numbers are all that the driver sees.
    """
    hosts = cut(
        judged.groupBy("_host").agg(
            F.count(F.lit(1)).alias("host_docs"), F.sum(F.col("_any").cast("long")).alias("host_failed")
        ),
        "hosts",
    )
    rate = F.col("host_failed") / F.col("host_docs")
    mean, var = hosts.agg(F.avg(rate), F.var_pop(rate)).first()
    alpha, beta = beta_prior(mean or 0.0, var or 0.0, rules.max_prior_strength)
    shrunk = (F.col("host_failed") + F.lit(alpha)) / (F.col("host_docs") + F.lit(alpha + beta))
    return hosts.withColumn("host_rate", shrunk).withColumn("host_kept", F.col("host_rate") <= rules.max_host_rate)


def beta_prior(mean: float, var: float, max_strength: float) -> tuple[float, float]:
    """Beta prior with the given mean and variance, its strength (pseudo
    documents) between 1 and ``max_strength``."""
    strength = max_strength if var <= 0 else mean * (1 - mean) / var - 1
    strength = min(max(strength, 1.0), max_strength)
    return mean * strength, (1 - mean) * strength


def quality(docs: DataFrame, host: str = "source", rules: HostRules = HostRules()) -> DataFrame:
    """One row per document: metrics, rule results, host figures and ``kept``.

    The metrics (numbers only, no texts) are written once; hosts are
    aggregated from them with map-side sums, so a host with a third of all
    documents costs one row per task.
    """
    judged = cut(measured(docs, host, ["doc_id"], rules), "quality")
    hosts = host_verdicts(judged, rules)
    return judged.join(hosts, same_row(judged, hosts, "_host"), "left").select(
        "doc_id",
        "_m.n_words",
        "_m.word_chars",
        "_m.n_symbols",
        "_m.n_dup_lines",
        "_m.n_repeat_words",
        F.col("_base").alias("base_failed"),
        (~F.col("_base") & F.col("host_kept")).alias("kept"),
        F.col("_any").alias("any_failed"),
        "host_docs",
        "host_failed",
        "host_rate",
        "host_kept",
    )


def keep_good(docs: DataFrame, host: str = "source", rules: HostRules = HostRules()) -> DataFrame:
    """The documents that :func:`quality` keeps, with their own columns.

    Texts are not shuffled while the table of hosts is small (Spark decides
    from the written table's size)."""
    columns = docs.columns
    judged = cut(measured(docs, host, [], rules).select("_host", "_any"), "quality")
    hosts = cut(host_verdicts(judged, rules).filter("host_kept").select("_host"), "good_hosts")
    prepare(docs.sparkSession)
    m = own_name(docs, "_m")
    rows = docs.withColumn(m, metrics(body()))
    good = rows.filter(~base_failed(m, rules)).select(*[F.col(f"`{c}`") for c in columns])
    return good.join(hosts, good[host].eqNullSafe(hosts["_host"]), "left_semi")
