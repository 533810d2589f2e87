"""Log-bilinear language model, trained in numpy by noise-contrastive
estimation, with exactly normalised token log-probabilities.

Tokens are words and one end per text.  The model's vocabulary is the end, the
most frequent words and one entry for the rest.  The two tokens before a
position predict a vector ``q = r1 C1 + r2 C2``; an entry scores ``q . t + b``.
Training tells each token from noise drawn by frequency (shared by a batch of
positions, so that all its scores are one matrix product).  Every training
document is seen once: documents are dealt to rounds by a hash, in a round
each task improves the model on its own rows, and the tasks' parameters are
averaged, each row weighted by how often the task met its entry.

Scores of a pair of context tokens add up, so the normaliser of every pair is
one entry of a product of two matrices, ``exp(S1) exp(S2 + b)'``, and a token's
log-probability is three table entries.  A word of the rest has the
probability of the rest times its add-one share among the words of the rest,
unseen ones included, so the probabilities of all words sum to one.

Counts cover all training documents.  Tokens are counted by a sum with
map-side combine; the most frequent ones, at most ``LEXICON``, are broadcast
and give the counts of most tokens in place; the others are joined by shuffle,
once per document and token.  The driver receives the lexicon and the model,
both bounded by parameters.

Defined results: a null or empty text is its end alone; a null doc_id is held
out; repeated rows count, and are scored, one by one; with nothing to learn
from every count is 0 and the base score too; an empty table gives an empty
table; other columns are ignored.  Scores depend on how rows are dealt to
tasks, as the order of training does; counts and base scores do not.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctxanomaly.llm.common import arrow_rows, body, cut, prepare

MODEL_WORDS = 2048
LEXICON = 200_000
DIM = 32
ROUNDS = 4
BATCH = 1024
NOISE = 32
RATE = 0.3
#: A task's counts go on when they hold so many tokens.
FLUSH = 400_000
TABLE_ROWS = 256
END, REST = 0, 1
_END_KEY = b""  # no word is empty


def words(text: bytes) -> list[bytes]:
    return text.lower().split()


def is_held_out(doc_id: Column) -> Column:
    """CRC-32 of the id as text, modulo 7, is 2; a null id is held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(True))


def contexts(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens one and two before each position of concatenated texts that
    all close with an end; before a text there are ends."""
    one = np.concatenate([[END], ids[:-1]]).astype(ids.dtype)
    two = np.concatenate([[END], one[:-1]]).astype(ids.dtype)
    two[starts] = END
    return one, two


def add_rows(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places and the sums of their rows."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], np.add.reduceat(rows[order], first, axis=0)


@dataclass
class LogBilinear:
    """Parameters: context rows, target rows, biases, and the two matrices
    that turn the context rows into a prediction."""

    context: np.ndarray
    target: np.ndarray
    bias: np.ndarray
    turn: np.ndarray  # (2, dim, dim)

    @classmethod
    def start(cls, counts: np.ndarray, dim: int = DIM, seed: int = 7) -> LogBilinear:
        """Small random rows; the biases give the add-one unigram model."""
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        bias = np.log((counts + 1) / (counts.sum() + len(counts))).astype(np.float32)
        turn = np.stack([np.eye(dim), 0.5 * np.eye(dim)]).astype(np.float32)
        return cls(draw(len(counts), dim), draw(len(counts), dim), bias, turn)

    def tables(self) -> Tables:
        """Score tables and normalisers of all context pairs, some rows of the
        product at a time."""
        c, t = self.context.astype(float), self.target.astype(float)
        one = (c @ self.turn[0] @ t.T).astype(np.float32)
        two = (c @ self.turn[1] @ t.T + self.bias).astype(np.float32)
        top = two.max(axis=1)
        second = np.exp(two.astype(float) - top[:, None]).T
        z = np.empty((len(c), len(c)), np.float32)
        for at in range(0, len(c), TABLE_ROWS):
            rows = one[at : at + TABLE_ROWS].astype(float)
            first = rows.max(axis=1, keepdims=True)
            z[at : at + TABLE_ROWS] = np.log(np.exp(rows - first) @ second) + first + top
        return Tables(one, two, z)


@dataclass
class Tables:
    one: np.ndarray  # (context, entry)
    two: np.ndarray
    z: np.ndarray  # (context one before, context two before)

    def log_probs(self, ids: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Natural log-probability of each entry after its two contexts."""
        return self.one[one, ids].astype(float) + self.two[two, ids] - self.z[one, two]


_KEPT: dict[str, Tables] = {}


def tables_of(key: str, model: LogBilinear) -> Tables:
    """The tables of a model, computed once in a worker process: they are
    many times the size of the parameters, which alone are broadcast."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = model.tables()
    return _KEPT[key]


class Trainer:
    """Noise-contrastive estimation by AdaGrad."""

    def __init__(self, model: LogBilinear, noise: np.ndarray, rate: float = RATE, k: int = NOISE, batch: int = BATCH):
        """noise: probabilities of the entries as noise."""
        self.m = LogBilinear(*[p.copy() for p in (model.context, model.target, model.bias, model.turn)])
        self.rate, self.k, self.batch = rate, k, batch
        self.cumulated = np.cumsum(noise)
        self.log_noise = np.log(k * noise).astype(np.float32)
        self.squares = LogBilinear(*[np.full(p.shape, 1e-2, np.float32) for p in (model.context, model.target, model.bias, model.turn)])
        self.met = np.zeros((2, len(noise)))  # as context, as target

    def _step(self, name: str, at: np.ndarray | slice, gradient: np.ndarray) -> None:
        squares, values = getattr(self.squares, name), getattr(self.m, name)
        squares[at] += gradient * gradient
        values[at] += self.rate * gradient / np.sqrt(squares[at])

    def train(self, ids: np.ndarray, one: np.ndarray, two: np.ndarray, rng: np.random.Generator) -> None:
        order = rng.permutation(len(ids))
        n = len(self.log_noise)
        self.met[0] += np.bincount(one, minlength=n) + np.bincount(two, minlength=n)
        self.met[1] += np.bincount(ids, minlength=n)
        for start in range(0, len(order), self.batch):
            pick = order[start : start + self.batch]
            drawn = np.searchsorted(self.cumulated, rng.random(self.k) * self.cumulated[-1], side="right")
            self._batch(ids[pick], one[pick], two[pick], np.minimum(drawn, n - 1).astype(ids.dtype))

    def _batch(self, w: np.ndarray, one: np.ndarray, two: np.ndarray, drawn: np.ndarray) -> None:
        m, scale = self.m, np.float32(1 / len(w))
        r1, r2 = m.context[one], m.context[two]
        q = r1 @ m.turn[0] + r2 @ m.turn[1]
        tw, tn = m.target[w], m.target[drawn]
        real = np.einsum("bd,bd->b", q, tw) + m.bias[w] - self.log_noise[w]
        fake = q @ tn.T + (m.bias[drawn] - self.log_noise[drawn])
        up = scale / (1 + np.exp(np.clip(real, -30, 30)))
        down = -scale / (1 + np.exp(np.clip(-fake, -30, 30)))
        dq = up[:, None] * tw + down @ tn
        entries = np.concatenate([w, drawn])
        at, rows = add_rows(entries, np.vstack([np.hstack([up[:, None] * q, up[:, None]]), np.hstack([down.T @ q, down.sum(0)[:, None]])]))
        places, inner = add_rows(np.concatenate([one, two]), np.vstack([dq @ m.turn[0].T, dq @ m.turn[1].T]))
        turn = np.stack([r1.T @ dq, r2.T @ dq])
        self._step("target", at, rows[:, :-1])
        self._step("bias", at, rows[:, -1])
        self._step("context", places, inner)
        self._step("turn", slice(None), turn)


def token_counts(docs: DataFrame) -> DataFrame:
    """``token, c`` of all tokens of ``text`` (bytes); each task adds its own up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()

        def flush() -> pa.RecordBatch:
            columns = [pa.array(list(sums), pa.binary()), pa.array(list(sums.values()), pa.int64())]
            sums.clear()
            return pa.RecordBatch.from_arrays(columns, names=["token", "n"])

        for (texts,) in arrow_rows(batches, "text"):
            for text in texts:
                sums.update(words(text))
                if len(sums) >= FLUSH:
                    yield flush()
            sums[_END_KEY] += len(texts)
        yield flush()

    return docs.select("text").mapInArrow(count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("c"))


@dataclass
class Corpus:
    """Figures of the training tokens."""

    tokens: int  # N
    distinct: int  # V
    lexicon: dict[bytes, int]  # the most frequent tokens, by falling count
    model_words: int

    @property
    def entries(self) -> dict[bytes, int]:
        """The model's words and their entries; all others are the rest."""
        plain = [w for w in self.lexicon if w != _END_KEY]
        return {_END_KEY: END, **{w: REST + 1 + i for i, w in enumerate(plain[: self.model_words - 2])}}

    def entry_counts(self) -> np.ndarray:
        own = self.entries
        counts = np.zeros(len(own) + 1)
        for word, entry in own.items():
            counts[entry] = self.lexicon.get(word, 0)
        counts[REST] = self.tokens - counts.sum()
        return counts

    def rest_total(self) -> float:
        """What add-one counts of the words of the rest add up to, with one
        more for all unseen words."""
        own = self.entries
        seen = sum(1 for w in own if w in self.lexicon)
        return float(self.entry_counts()[REST] + self.distinct - seen + 1)


def gather(counts: DataFrame, lexicon: int = LEXICON, model_words: int = MODEL_WORDS) -> Corpus:
    """Totals, and the end with all tokens above the count that leaves at most
    ``lexicon`` of them.

    The count is found from sums by its logarithm (a few hundred rows)."""
    level = F.floor(F.log2("c") * 16)
    levels = counts.groupBy(level.alias("level")).agg(F.count("c").alias("v"), F.sum("c").alias("n")).collect()
    least, held = 1 << 40, 0
    for row in sorted(levels, key=lambda r: -r["level"]):
        held += row["v"]
        if held > lexicon:
            break
        least = row["level"]
    common = counts.filter((level >= F.lit(least)) | (F.octet_length("token") == 0)).collect()
    common.sort(key=lambda r: (-r["c"], bytes(r["token"])))
    found = {bytes(r["token"]): r["c"] for r in common}
    return Corpus(sum(r["n"] for r in levels), sum(r["v"] for r in levels), found, model_words)


def names_of(schema: str) -> list[str]:
    return [c.split(" ")[0] for c in schema.split(", ")]


_ENCODED = (
    "row_id long, doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, rest_logs double, "
    "ids binary, rare array<binary>, times array<long>"
)


def encode(docs: DataFrame, corpus: Corpus) -> DataFrame:
    """One row per text: its entries, and the sums of log10(c + 1) over the
    lexicon's tokens (``log_counts``) and over those of them that belong to
    the rest (``rest_logs``).  Tokens outside the lexicon are listed."""
    entries = corpus.entries
    shared = docs.sparkSession.sparkContext.broadcast((list(corpus.lexicon), list(corpus.lexicon.values()), entries))
    names = names_of(_ENCODED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, counts, own = shared.value
        place = _Places((w, i) for i, w in enumerate(tokens))
        # the last place stands for the tokens outside
        entry = np.array([own.get(w, REST) for w in tokens] + [REST], np.uint16)
        logs = np.append(np.log10(np.array(counts, float) + 1), 0.0)
        rest = np.where(entry == REST, logs, 0.0)
        for ids, held, docs_, texts in arrow_rows(batches, "row_id", "held_out", "doc_id", "text"):
            rows = []
            for text in texts:
                found = words(text)
                found.append(_END_KEY)
                at = np.fromiter(map(place.__getitem__, found), np.int32, len(found))
                out = np.flatnonzero(at < 0)
                rare = Counter(found[i] for i in out if found[i])  # an end is no word
                mine = entry[at]
                mine[-1] = END
                rows.append((
                    len(found), len(found) - out.size, logs[at].sum(), rest[at].sum(), mine.tobytes(),
                    list(rare), list(rare.values()),
                ))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()))
            columns = [pa.array(ids, pa.int64()), pa.array(docs_, pa.int64()), pa.array(held, pa.bool_())]
            columns += [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else ([],) * len(kinds), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    found = cut(docs.mapInArrow(run, _ENCODED), "encoded")
    shared.unpersist()
    return found

_PLAIN = names_of(_ENCODED)[:-3]
_JUDGED = ", ".join(_ENCODED.split(", ")[:-3]) + ", model double, n_rest long"


class _Places(dict):
    """Places of the lexicon's tokens, -1 for any other."""

    def __missing__(self, key: bytes) -> int:
        return -1


def texts_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Entries of the texts of a batch (column ``ids``), and where they start."""
    texts = batch.column(batch.schema.get_field_index("ids")).to_pylist()
    ids = np.frombuffer(b"".join(texts), np.uint16)
    return ids, np.cumsum([0] + [len(t) // 2 for t in texts[:-1]])


def fit(encoded: DataFrame, corpus: Corpus, dim: int = DIM, rounds: int = ROUNDS) -> LogBilinear:
    """Model of the encoded training texts."""
    counts = corpus.entry_counts()
    n = len(counts)
    noise = (counts + 1) / (counts.sum() + n)
    model = LogBilinear.start(counts, dim)
    names = ["kind", "at", "weight", *[f"v{k}" for k in range(dim + 1)]]
    schema = "kind int, at int, weight double, " + ", ".join(f"v{k} double" for k in range(dim + 1))
    sc = encoded.sparkSession.sparkContext
    training = encoded.filter(~F.col("held_out")).select("row_id", "ids", F.pmod(F.xxhash64("doc_id"), F.lit(rounds)).alias("round"))
    for k in range(rounds):
        shared = sc.broadcast(model)

        def improve(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(shared.value, noise)
            for batch in batches:
                if batch.num_rows:
                    ids, starts = texts_of(batch)
                    trainer.train(ids, *contexts(ids, starts), np.random.default_rng(batch.column(0)[0].as_py()))
            if trainer.met.any():
                yield parameters(trainer)

        def parameters(trainer: Trainer) -> pa.RecordBatch:
            """Rows of the parameters, times their weights."""
            m, met = trainer.m, trainer.met + 1e-6
            pad = lambda a: np.hstack([a, np.zeros((len(a), 1), np.float32)])
            weight = np.concatenate([met[0], met[1], np.full(2 * dim, met[1].sum())])
            values = np.vstack([pad(m.context), np.hstack([m.target, m.bias[:, None]]), pad(m.turn.reshape(2 * dim, dim))])
            kind, at = np.repeat([0, 1, 2], [n, n, 2 * dim]), np.concatenate([np.arange(n), np.arange(n), np.arange(2 * dim)])
            columns = [pa.array(kind, pa.int32()), pa.array(at, pa.int32()), pa.array(weight)]
            columns += [pa.array(np.ascontiguousarray(c)) for c in (values * weight[:, None]).T]
            return pa.RecordBatch.from_arrays(columns, names=names)

        rows = training.filter(F.col("round") == k).mapInArrow(improve, schema).groupBy("kind", "at")
        means = rows.agg(*[(F.sum(f"v{j}") / F.sum("weight")).cast("float").alias(f"v{j}") for j in range(dim + 1)])
        got = means.orderBy("kind", "at").toArrow()
        shared.unpersist()
        if got.num_rows:
            values = np.stack([got.column(f"v{j}").to_numpy() for j in range(dim + 1)], axis=1).astype(np.float32)
            model = LogBilinear(
                values[:n, :dim], values[n : 2 * n, :dim], values[n : 2 * n, dim],
                values[2 * n :, :dim].reshape(2, dim, dim),
            )
    return model


def score(docs: DataFrame, dim: int = DIM, rounds: int = ROUNDS, lexicon: int = LEXICON, model_words: int = MODEL_WORDS) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score`` (log10 probabilities of the text)."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"),
        is_held_out(F.col("doc_id")).alias("held_out"), body().alias("text"),
    )
    counts = cut(token_counts(rows.filter(~F.col("held_out"))), "token_counts")
    corpus = gather(counts, lexicon, model_words)
    encoded = encode(rows, corpus)
    model = spark.sparkContext.broadcast(fit(encoded, corpus, dim, rounds))
    key = uuid.uuid4().hex

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = tables_of(key, model.value)
        for batch in batches:
            if batch.num_rows:
                ids, starts = texts_of(batch)
                logs = tables.log_probs(ids, *contexts(ids, starts)) / math.log(10)
                columns = [*batch.columns[:-1], pa.array(np.add.reduceat(logs, starts))]
                columns.append(pa.array(np.add.reduceat((ids == REST).astype(np.int64), starts)))
                yield pa.RecordBatch.from_arrays(columns, names=[*_PLAIN, "model", "n_rest"])

    judged = encoded.select(*_PLAIN, "ids").mapInArrow(judge, _JUDGED)
    rare = encoded.select("row_id", F.explode(F.arrays_zip(F.col("rare").alias("token"), F.col("times").alias("n"))).alias("r"))
    rare = rare.select("row_id", "r.token", "r.n").join(counts, "token", "left").groupBy("row_id").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("rare_logs"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known"),
    )
    rare_logs, n_tokens = F.coalesce("rare_logs", F.lit(0.0)), F.col("n_tokens")
    base = F.col("log_counts") + rare_logs - n_tokens * F.lit(math.log10(corpus.tokens + corpus.distinct + 1))
    rest = F.col("rest_logs") + rare_logs - F.col("n_rest") * F.lit(math.log10(corpus.rest_total()))
    return judged.join(rare, "row_id", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(corpus.tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("model") + rest).alias("score"),
    )
