"""Language identification with error-correcting output codes.

Every language gets a codeword; for each bit of the words a binary
naive-Bayes classifier over hashed byte n-grams tells the languages whose bit
is set from the others.  A text's language is the one whose codeword has the
smallest loss against the bits' margins, each bit weighted by its accuracy on
the rows learned from; a small gap between the best two flags ambiguity.

Counts cover all rows to learn from: each task adds its own up and passes on
sums by language and n-gram bucket, so what reaches the driver is bounded by
languages x ``buckets`` whatever the input.

Defined results: a text that is null or has no letter is ``und`` with score
0; rows without a language are not learned from; with no row to learn from
every text is ``und``; repeated rows count each time; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctxanomaly.llm.common import arrow_rows, prepare

BUCKETS = 1 << 14
UNDETERMINED = "und"
_SCALE = 8.0  # turns mean log-odds into margins
MIN_GAP = 0.1


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def ngram_counts(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Hashed counts of the byte bigrams and trigrams of the lower-cased text."""
    a = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace"), dtype=np.uint8).astype(np.uint32)
    two = a[:-1] << np.uint32(8) | a[1:]
    three = two[:-1] << np.uint32(8) | a[2:] | np.uint32(1 << 24)
    shift = np.uint32(32 - buckets.bit_length() + 1)
    keys = (np.concatenate([two, three]) * np.uint32(2654435761)) >> shift
    return np.bincount(keys, minlength=buckets)


def codewords(k: int, seed: int = 11) -> np.ndarray:
    """(k, bits) of -1 and 1: all dichotomies for up to six languages, and
    distinct random ones, balanced in the mean, beyond."""
    if k < 2:
        return np.ones((k, 1))
    if k <= 6:
        rest = [x for x in product((1, -1), repeat=k - 1) if -1 in x]
        return np.array([[1, *x] for x in rest], dtype=float).T
    rng, columns = np.random.default_rng(seed), set()
    while len(columns) < 10 * int(np.ceil(np.log2(k))):
        x = tuple(rng.choice((-1, 1), size=k).tolist())
        if len(set(x)) == 2 and tuple(-v for v in x) not in columns:
            columns.add(x)
    return np.array(sorted(columns), dtype=float).T


class CodeModel:
    """Binary classifiers by bit, and decoding."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        """counts: (languages, buckets) n-gram counts."""
        self.langs, self.code = langs, codewords(len(langs))
        self.buckets = counts.shape[1]
        if not langs:
            return
        share = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * self.buckets)
        bits = []
        for column in self.code.T:
            yes, no = share[column > 0].mean(axis=0), share[column < 0]
            bits.append(np.log(yes) - np.log(no.mean(axis=0)) if len(no) else np.zeros(self.buckets))  # one language
        self.log_odds = np.array(bits, dtype=np.float32).T
        self.weight = np.ones(self.code.shape[1])

    def margins(self, text: str) -> np.ndarray:
        counts = ngram_counts(text, self.buckets)
        used = np.flatnonzero(counts)
        return (counts[used].astype(np.float32) @ self.log_odds[used]).astype(float) * (_SCALE / counts.sum())

    def decode(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score (0 to 1) and whether the two best are close."""
        if not self.langs or text is None or not has_letter(text):
            return UNDETERMINED, 0.0, True
        loss = np.logaddexp(0, -self.code * self.margins(text)) @ self.weight
        chance = np.exp(loss.min() - loss)
        chance /= chance.sum()
        best = np.sort(chance)[::-1]
        return self.langs[int(loss.argmin())], float(best[0]), bool(len(best) > 1 and best[0] - best[1] < MIN_GAP)


def is_held_out(doc_id: Column) -> Column:
    """CRC-32 of the id as text, modulo 4, is 2; a null id is held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def learn(rows: DataFrame, buckets: int = BUCKETS) -> CodeModel:
    """Model of ``text, lang`` rows (all of them; lang is not null)."""
    spark = rows.sparkSession
    prepare(spark)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for texts, langs in arrow_rows(batches, "text", "lang"):
            for text, lang in zip(texts, langs, strict=True):
                if has_letter(text):
                    n = ngram_counts(text, buckets)
                    sums[lang] = sums[lang] + n if lang in sums else n
        for lang, n in sums.items():
            used = np.flatnonzero(n)
            columns = [pa.array([lang] * used.size), pa.array(used.astype(np.int32)), pa.array(n[used].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])

    texts = rows.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    texts = texts.filter("text is not null and lang is not null")
    sums = texts.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = sums.toPandas()
    langs = sorted(table["lang"].unique())
    counts = np.zeros((len(langs), buckets))
    counts[np.searchsorted(langs, table["lang"]) if langs else [], table["bucket"].astype(int)] = table["n"]
    model = CodeModel(langs, counts)
    if len(langs) < 2:
        return model
    shared = spark.sparkContext.broadcast(model)

    def judge_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        row = {lang: i for i, lang in enumerate(m.langs)}
        right, total = np.zeros(m.code.shape[1], dtype=np.int64), 0
        for some, langs in arrow_rows(batches, "text", "lang"):
            for text, lang in zip(some, langs, strict=True):
                if has_letter(text):
                    right += m.margins(text) * m.code[row[lang]] > 0
                    total += 1
        columns = [pa.array(np.arange(right.size, dtype=np.int32)), pa.array(right), pa.array([total] * right.size, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["bit", "right", "total"])

    bits = texts.mapInArrow(judge_bits, "bit int, right long, total long").groupBy("bit")
    accuracy = bits.agg((F.sum("right") / F.sum("total")).alias("a")).toPandas().sort_values("bit")["a"].to_numpy()
    skill = np.clip(accuracy - 0.5, 0.01, None)
    model.weight = skill / skill.mean()
    return model


def identify(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score,
    ambiguous``.  Learned from the rows that are not held out."""
    spark = docs.sparkSession
    out = is_held_out(F.col("doc_id"))
    model = spark.sparkContext.broadcast(learn(docs.filter(~out).select("text", "lang"), buckets))

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        m = model.value
        return pd.DataFrame([m.decode(x) for x in texts], columns=["lang_pred", "score", "ambiguous"])

    rows = docs.select("doc_id", out.alias("held_out"), predict(F.col("text").cast("string")).alias("p"))
    return rows.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.ambiguous")
