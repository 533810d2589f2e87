"""Substring dedup over bytes with a deep-shallow suffix sort.

A byte goes if a string of ``length`` bytes that covers it also starts
anywhere else.  Suffixes are taken at winnowed anchors (see ``anchors``):
every string of that length picks one, so equal strings meet at anchors of
equal content.

1. Anchors are joined by hash.  Where the whole territory of an anchor (all
   bytes of the strings it stands for) occurs twice, all these strings
   repeat; no sorting is needed, whatever the size of the group.
2. One anchor of each different territory goes on with its bytes.  In tasks
   dealt by anchor hash, the suffixes from the anchors onwards, and those
   read backwards, are sorted: multikey quicksort to a shallow depth (the
   anchor itself), then blind tries order the groups that still agree, which
   have long common prefixes.  Both give order and longest common prefixes;
   two anchors share the string at an offset exactly if they are in one run
   of either order with prefixes of at least the two parts' lengths.
3. Anchors with more than ``group_rows`` different territories are not
   gathered in a task: their strings are compared by 128-bit hash with sums
   that combine on the map side.

The same steps run over words, whatever bytes they take: a word of eight
bytes, its hash, is the unit, and a passage of ``passage`` words that also
starts anywhere else is told (``n_passage_words``), not removed.  The kinds'
anchors are joined one after the other; the lowest bit of a seed is its kind.

Defined results: a null text is empty; equal rows are two documents, so their
long strings repeat; repeated rows give repeated result rows; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctxanomaly.llm.anchors import gram_hashes, merge_spans, mix, territories
from ctxanomaly.llm.common import BATCH_ROWS, arrow_rows, body, cut, prepare, text_key
from ctxanomaly.llm.substring_dedup import word_hashes
from ctxanomaly.session import checkpoint_root, remove_folder, run_folder

LENGTH = 400
SHALLOW = 64
PASSAGE = 51
SHALLOW_WORDS = 8
GROUP_ROWS = 10_000
CHUNK_ROWS = 4_000
_BASE = 0x9E3779B97F4A7C15
_WORDS = 1  # the kind; bytes are 0
_WIDTH = (1, 8)


# --- deep-shallow sorting ------------------------------------------------------


def multikey_quicksort(words: np.ndarray) -> list[np.ndarray]:
    """Row numbers of ``words`` (n x depth, eight bytes a word, big-endian) in
    order, rows that agree in all words as one group."""
    out, depth = [], words.shape[1]
    stack = [(np.arange(len(words)), 0)]
    while stack:
        rows, at = stack.pop()
        if rows.size < 2 or at == depth:
            if rows.size:
                out.append(rows)
            continue
        keys = words[rows, at]
        pivot = np.sort(keys[[0, rows.size // 2, -1]])[1]
        below, above = keys < pivot, keys > pivot
        stack += [(rows[above], at), (rows[~below & ~above], at + 1), (rows[below], at)]
    return out


class BlindTrie:
    """Strings that share a long prefix, kept by the bytes where they part.

    A node is [depth, {byte: child}]; a leaf is a list of equal strings'
    numbers.  A descent looks at branching bytes only; the string found is
    then compared in full, once."""

    def __init__(self, strings: list[bytes], shared: int):
        self.strings, self.shared, self.root = strings, shared, None

    def _key(self, i: int, depth: int) -> int:
        s = self.strings[i]
        return s[depth] if depth < len(s) else -1

    @staticmethod
    def _any_leaf(node):
        while isinstance(node, tuple):
            node = next(iter(node[1].values()))
        return node

    def insert(self, i: int) -> None:
        if self.root is None:
            self.root = [i]
            return
        node = self.root
        while isinstance(node, tuple) and (child := node[1].get(self._key(i, node[0]))) is not None:
            node = child
        leaf = self._any_leaf(node)
        lcp = common_prefix(self.strings[i], self.strings[leaf[0]], self.shared)
        if lcp == len(self.strings[i]) == len(self.strings[leaf[0]]):
            leaf.append(i)
            return
        parent, key, node = None, None, self.root
        while isinstance(node, tuple) and node[0] < lcp:
            parent, key = node, self._key(i, node[0])
            node = node[1][key]
        if isinstance(node, tuple) and node[0] == lcp:
            node[1][self._key(i, lcp)] = [i]
            return
        old = self._any_leaf(node)[0]
        split = (lcp, {self._key(old, lcp): node, self._key(i, lcp): [i]})
        if parent is None:
            self.root = split
        else:
            parent[1][key] = split

    def ordered(self) -> Iterator[tuple[int, int]]:
        """(string, common prefix with the one before) in order."""
        stack, before = [(self.root, 0)], True
        while stack:
            node, lcp = stack.pop()
            if isinstance(node, tuple):
                children = [node[1][k] for k in sorted(node[1])]
                stack += [(c, node[0]) for c in children[:0:-1]]
                stack.append((children[0], lcp))
                continue
            yield node[0], 0 if before else lcp
            before = False
            for twin in node[1:]:
                yield twin, len(self.strings[twin])


def common_prefix(a: bytes, b: bytes, start: int) -> int:
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    x, y = (np.frombuffer(s, dtype=np.uint8, count=n - start, offset=start) for s in (a, b))
    return start + int(np.argmax(x != y))


def deep_shallow_sort(strings: list[bytes], shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of strings of at least ``shallow`` bytes, and each one's common
    prefix with the one before (0 where that is under ``shallow`` bytes)."""
    heads = np.frombuffer(b"".join(s[:shallow] for s in strings), dtype=">u8").reshape(len(strings), -1)
    order, lcp = [], []
    for group in multikey_quicksort(heads.astype(np.uint64)):
        if group.size == 1:
            order.append(int(group[0]))
            lcp.append(0)
            continue
        trie = BlindTrie(strings, shallow)
        for i in group.tolist():
            trie.insert(i)
        for i, n in trie.ordered():
            order.append(i)
            lcp.append(n)
    return np.array(order, dtype=np.int64), np.array(lcp, dtype=np.int64)


def repeated_offsets(
    strings: list[bytes], left: np.ndarray, low: np.ndarray, length: int, shallow: int, width: int = 1
) -> np.ndarray:
    """(offset, member) marks: the string of ``length`` units that starts
    ``offset`` units before the member's anchor occurs at another member.

    ``strings`` are the members' bytes, ``width`` to a unit, anchors at
    ``left``, whose offsets run from ``low`` to ``left``."""
    ahead = [s[n * width :] for s, n in zip(strings, left.tolist(), strict=True)]
    behind = [s[: (n + shallow) * width][::-1] for s, n in zip(strings, left.tolist(), strict=True)]
    forward, forward_lcp = deep_shallow_sort(ahead, shallow * width)
    backward, backward_lcp = deep_shallow_sort(behind, shallow * width)
    forward_lcp, backward_lcp = forward_lcp // width, backward_lcp // width
    n = len(strings)
    marks = np.zeros((int(left.max()) + 1, n), dtype=bool)
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(int(low.min()), marks.shape[0]):
        active = np.flatnonzero((low <= o) & (o <= left))
        if active.size < 2:
            continue
        right_class[forward] = np.cumsum(forward_lcp < length - o)
        left_class[backward] = np.cumsum(backward_lcp < shallow + o)
        pair = right_class[active] * (n + 1) + left_class[active]
        _, inverse, counts = np.unique(pair, return_inverse=True, return_counts=True)
        marks[o, active] = counts[inverse] > 1
    return marks


# --- Spark ---------------------------------------------------------------------


def anchors_of(units: np.ndarray, length: int, shallow: int, kind: int):
    """Seeds (signed), territory digests (signed), anchors, first and last start."""
    grams = mix(gram_hashes(units, shallow, _BASE))
    at, first, last = territories(grams, length - shallow + 1)
    digest, view, width = xxhash.xxh3_64_intdigest, memoryview(units).cast("B"), units.itemsize
    spans = zip(at.tolist(), first.tolist(), last.tolist(), strict=True)
    whole = np.array([digest(view[f * width : (s + length) * width], a - f) for a, f, s in spans], dtype=np.uint64)
    seed = grams[at] & ~np.uint64(1) | np.uint64(kind)
    return seed.view(np.int64), whole.view(np.int64), at, first, last


def units_of(text: bytes, kind: int, known: dict[bytes, int]) -> np.ndarray:
    """A text's bytes, or the hashes of its words."""
    return word_hashes(text.split(), known) if kind == _WORDS else np.frombuffer(text, dtype=np.uint8)


def _anchor_rows(kind: int, length: int, shallow: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            d, k = (batch.column(batch.schema.get_field_index(n)) for n in ("d", "k"))
            found, who = [], []
            for i, (text,) in enumerate(zip(*next(arrow_rows([batch], "body")), strict=True)):
                units = units_of(text, kind, known)
                if units.size >= length:
                    found.append(anchors_of(units, length, shallow, kind))
                    who.append(np.full(found[-1][0].size, i))
            if found:
                rows = pa.array(np.concatenate(who))
                seed, whole, *at = (np.concatenate(x) for x in zip(*found, strict=True))
                columns = [pa.array(seed), pa.array(whole), d.take(rows), k.take(rows)]
                columns += [pa.array(x.astype(np.int32)) for x in at]
                yield pa.RecordBatch.from_arrays(columns, names=["seed", "whole", "d", "k", "at", "first", "last"])

    return run


_CONTEXT = "seed long, n long, d long, k long, at int, first int, last int, context binary"


def _contexts(sizes: tuple[tuple[int, int], ...]):
    """Batches of (d, k, body, parts) to one row per part, with its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _CONTEXT.split(", ")]
        kinds = [pa.int64()] * 4 + [pa.int32()] * 3 + [pa.binary()]
        known: dict[bytes, int] = {}
        for batch in batches:
            rows = []
            for d, k, text, parts in zip(*next(arrow_rows([batch], "d", "k", "body", "parts")), strict=True):
                units = {kind: units_of(text, kind, known) for kind in {p["seed"] & 1 for p in parts}}
                for p in parts:
                    kind = p["seed"] & 1
                    context = units[kind][p["first"] : p["last"] + sizes[kind][0]].tobytes()
                    rows.append((p["seed"], p["n"], d, k, p["at"], p["first"], p["last"], context))
            for at in range(0, len(rows), 4 * BATCH_ROWS):
                part = zip(*rows[at : at + 4 * BATCH_ROWS], strict=True)
                columns = [pa.array(c, t) for c, t in zip(part, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


_SPANS = "d long, k long, kind long, start int, end int"


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 3 + [pa.int32()] * 2
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["d", "k", "kind", "start", "end"])


def _sorted_groups(sizes: tuple[tuple[int, int], ...], chunk_rows: int):
    """Context rows, sorted by seed, to spans of repeated units."""

    def spans(held: list[tuple]) -> list[tuple]:
        out = []
        for kind, (length, shallow) in enumerate(sizes):
            rows = [r for r in held if r[0] & 1 == kind]
            if not rows:
                continue
            at, first, last = (np.array([r[j] for r in rows], dtype=np.int64) for j in (4, 5, 6))
            marks = repeated_offsets([r[7] for r in rows], at - first, at - last, length, shallow, _WIDTH[kind])
            for i in np.flatnonzero(marks.any(axis=0)).tolist():
                starts = np.sort(at[i] - np.flatnonzero(marks[:, i]))
                breaks = np.flatnonzero(np.diff(starts) > 1)
                for a, b in zip(starts[np.r_[0, breaks + 1]], starts[np.r_[breaks, starts.size - 1]], strict=True):
                    out.append((rows[i][2], rows[i][3], kind, int(a), int(b) + length))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        names = [x.split()[0] for x in _CONTEXT.split(", ")]
        for columns in arrow_rows(batches, *names):
            for row in zip(*columns, strict=True):
                if len(held) >= chunk_rows and row[0] != held[-1][0]:
                    if found := spans(held):
                        yield _span_batch(found)
                    held = []
                held.append(row)
        if held and (found := spans(held)):
            yield _span_batch(found)

    return run


def _string_hashes(sizes: tuple[tuple[int, int], ...]):
    """Context rows to one row per string, by 128-bit hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in arrow_rows(batches, "seed", "d", "k", "first", "last", "context"):
            for seed, d, k, first, last, context in zip(*columns, strict=True):
                kind = seed & 1
                view, n, width = memoryview(context), last - first + 1, _WIDTH[kind]
                size = sizes[kind][0] * width
                h = b"".join(xxhash.xxh3_128_digest(view[i : i + size], kind) for i in range(0, n * width, width))
                w = np.frombuffer(h, dtype="<i8").reshape(n, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w[:, 0]), pa.array(w[:, 1]), *(pa.array([x] * n, pa.int64()) for x in (d, k, kind)),
                     pa.array(np.arange(first, last + 1, dtype=np.int32))],
                    names=["w1", "w2", "d", "k", "kind", "start"],
                )

    return run


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("d"), text_key().alias("k"), body().alias("body"))


def _anchor_groups(texts: DataFrame, kind: int, length: int, shallow: int) -> DataFrame:
    """The anchors of one kind whose seed occurs twice, with the copies of
    their territory and the seed's number of territories.  The files that
    only this step reads go with it."""
    spark = texts.sparkSession
    own = f"{checkpoint_root(spark)}/ctxanomaly/anchors-{uuid.uuid4().hex}"
    schema = "seed long, whole long, d long, k long, at int, first int, last int"
    with run_folder(spark, own):  # inside a caller's folder they stay, and go with that
        anchors = texts.mapInArrow(_anchor_rows(kind, length, shallow), schema)
        anchors = cut(anchors.withColumn("i", F.monotonically_increasing_id()), "anchors")
        # Sums that combine on the map side, and joins whose skewed keys Spark can
        # split: an anchor that most documents hold is no task's alone.
        groups = anchors.groupBy("seed", "whole").agg(F.count(F.lit(1)).alias("copies"), F.min("i").alias("chosen"))
        groups = cut(groups, "territories")
    several = groups.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    useful = groups.join(several, "seed", "left").filter("copies > 1 or n > 1")
    rows = cut(anchors.join(useful, ["seed", "whole"]).drop("whole"), "anchor_groups")
    remove_folder(spark, own)
    return rows


def repeated_spans(
    docs: DataFrame,
    length: int = LENGTH,
    shallow: int = SHALLOW,
    group_rows: int = GROUP_ROWS,
    chunk_rows: int = CHUNK_ROWS,
    passage: int = PASSAGE,
    shallow_words: int = SHALLOW_WORDS,
) -> DataFrame:
    """``d, k, kind, start, end``: spans under repeated strings (not merged),
    of bytes (kind 0) and of words (kind 1)."""
    if shallow % 8 or not 0 < shallow <= length:
        raise ValueError("shallow must be a multiple of 8 and at most length")
    if not 0 < shallow_words <= passage:
        raise ValueError("shallow_words must be at least 1 and at most passage")
    sizes = ((length, shallow), (passage, shallow_words))
    prepare(docs.sparkSession)
    texts = _documents(docs)
    rows = _anchor_groups(texts, 0, *sizes[0]).unionByName(_anchor_groups(texts, _WORDS, *sizes[_WORDS]))
    parts = rows.filter("i = chosen and n > 1").groupBy("d", "k").agg(
        F.collect_list(F.struct("seed", "n", "at", "first", "last")).alias("parts")
    )
    # rows that repeat give their contexts twice, and rightly so: all their strings repeat
    once = texts.join(parts, texts["d"].eqNullSafe(parts["d"]) & (texts["k"] == parts["k"])).select(
        texts["d"], texts["k"], "body", "parts"
    )
    contexts = cut(once.mapInArrow(_contexts(sizes), _CONTEXT), "contexts")
    usual = contexts.filter(F.col("n") <= group_rows).repartition("seed").sortWithinPartitions("seed")
    found = usual.mapInArrow(_sorted_groups(sizes, chunk_rows), _SPANS)
    hashed = contexts.filter(F.col("n") > group_rows).mapInArrow(
        _string_hashes(sizes), "w1 long, w2 long, d long, k long, kind long, start int"
    )
    twice = hashed.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("w1", "w2")
    more = hashed.join(twice, ["w1", "w2"]).select("d", "k", "kind", "start", _end("start", sizes))
    kind = F.col("seed").bitwiseAND(F.lit(1)).alias("kind")
    whole = rows.filter("copies > 1").select("d", "k", kind, "first", "last")
    whole = whole.select("d", "k", "kind", F.col("first").alias("start"), _end("last", sizes))
    return whole.unionByName(found).unionByName(more)


def _end(start: str, sizes: tuple[tuple[int, int], ...]) -> Column:
    """End of the string that starts at ``start``."""
    return (F.col(start) + F.when(F.col("kind") == _WORDS, sizes[_WORDS][0]).otherwise(sizes[0][0])).alias("end")


def suffix_dedup(docs: DataFrame, length: int = LENGTH, **limits) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans,
    kept_sha256``, ``n_passage_words`` (words under passages of ``passage``
    words that also start anywhere else; they stay) and ``spans`` (maximal
    removed runs as [start, end))."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = repeated_spans(docs, length, **limits).distinct().groupBy("d", "k").agg(
        *(F.collect_list(F.when(F.col("kind") == kind_, F.col(c))).alias(f"{c}s{kind_}") for kind_ in (0, _WORDS) for c in ("start", "end"))
    )
    texts, lists = _documents(docs), ["starts0", "ends0", "starts1", "ends1"]
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
    schema += "n_passage_words long, spans array<struct<start:int,end:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4 + [pa.string(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_words", "spans"]
        for columns in arrow_rows(batches, "d", "body", *lists):
            out = []
            for doc_id, text, a, b, p, q in zip(*columns, strict=True):
                merged = merge_spans(a, b) if a else []
                digest, at = hashlib.sha256(), 0
                for x, y in merged:
                    digest.update(text[at:x])
                    at = y
                digest.update(text[at:])
                spans = [{"start": x, "end": y} for x, y in merged]
                told = sum(y - x for x, y in merge_spans(p, q)) if p else 0
                out.append((doc_id, len(text), sum(y - x for x, y in merged), len(merged), digest.hexdigest(), told, spans))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names
                )

    joined = texts.join(found, texts["d"].eqNullSafe(found["d"]) & (texts["k"] == found["k"]), "left").select(
        texts["d"], "body", *lists
    )
    return joined.mapInArrow(run, schema).withColumn("doc_id", F.col("doc_id").cast(kind))
