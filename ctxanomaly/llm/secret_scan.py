"""Corpus-wide secret scan, in DataFrame expressions only.

Three base kinds are found in every text (assignments, access keys, long hex
runs), and long mixed tokens are candidates besides.  The values' hashes are
counted over the corpus by distinct repositories and owners: a value that
more than ``max_owners`` owners and at least ``min_repositories`` repositories
hold is a widely copied example, others are owner-specific.  Owner-specific tokens that look live (digits, both cases
and enough different characters) add a span of kind ``token`` unless a base
span overlaps it; base spans always stay.

Positions are code points, end exclusive.  They come from the lengths of the
matches and of the pieces between them, so no Python is needed.

Defined results: a null text is empty (no spans); a null owner or repository
counts as one owner or repository of its own; repeated rows are scanned one
by one and count once for their owner and repository; an empty table gives
an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctxanomaly.llm.common import cut, own_name, text_key

# The patterns of the base kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
MIN_ASSIGN = 6
#: Candidates of the corpus-wide method.
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "token")
MAX_OWNERS = 1
#: A value of several owners is an example only from so many repositories on:
#: a copy or two of a live token do not publish it.
WIDELY_COPIED = 10
MIN_DISTINCT = 10
BLOCK = 64

_EMPTY = "array<struct<start:long,rank:int,end:long,value:string>>"
_HOLDERS = "array<struct<value:string,n_owners:long,n_repositories:long>>"


def _spans(text: Column, pattern: str, rank: int) -> Column:
    """Leftmost non-overlapping matches as (start, rank, end, value).  Only
    texts with a match pay for more than one pass."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.transform(found, lambda m: m).alias("m"), F.slice(between, 1, F.size(found)).alias("gap"))
    return F.when(text.rlike(pattern), _placed(pairs, rank)).otherwise(F.array().cast(_EMPTY))


def _placed(pairs: Column, rank: int) -> Column:
    """(start, rank, end, value) of (match, text before it) pairs.  Starts are
    running sums; an array that grows by one is copied each time, so they are
    made in blocks of BLOCK pairs, and the blocks' own starts after that: work
    grows with the matches, not with their square."""
    zero = F.lit(0).cast("long")
    length = lambda p: (F.length(p["gap"]) + F.length(p["m"])).cast("long")

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = (start + F.length(pair["m"])).cast("long")
        one = F.struct(start.cast("long").alias("start"), F.lit(rank).alias("rank"), end.alias("end"), pair["m"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def place(pairs: Column) -> Column:
        first = F.sequence(F.lit(1), F.greatest(F.size(pairs), F.lit(1)), F.lit(BLOCK))
        return _once(F.transform(first, lambda i: F.slice(pairs, i, F.lit(BLOCK))), join)

    def join(blocks: Column) -> Column:
        sizes = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda at, p: at + length(p)))
        starts = F.aggregate(sizes, F.array(zero), lambda at, n: F.concat(at, F.array(F.element_at(at, -1) + n)))
        begin = lambda at: F.struct(at.alias("at"), F.array().cast(_EMPTY).alias("out"))
        placed = lambda b, at: F.aggregate(b, begin(at), step, lambda acc: acc["out"])
        return F.flatten(F.zip_with(blocks, F.slice(starts, F.lit(1), F.size(blocks)), placed))

    return _once(pairs, place)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, as a lambda's argument."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _apart(kinds: list[Column], tokens: Column) -> Column:
    """The tokens that overlap no span of the kinds (spans of one kind are in
    order and apart).  Each kind is written as a line of 0 and 1 per character,
    of which a token's stretch is cut out, so work grows with the text."""

    def line(spans: Column) -> Column:
        def stretch(s: Column, i: Column) -> Column:
            before = F.coalesce(F.get(spans, i - 1)["end"], F.lit(0))
            run = lambda c, n: F.repeat(F.lit(c), n.cast("int"))
            return F.concat(run("0", s["start"] - before), run("1", s["end"] - s["start"]))

        return F.array_join(F.transform(spans, stretch), "").cast("binary")

    def free(lines: Column) -> Column:
        cut_out = lambda m, t: F.substring(m, (t["start"] + 1).cast("int"), (t["end"] - t["start"]).cast("int"))
        hit = lambda t: F.exists(lines, lambda m: F.instr(cut_out(m, t).cast("string"), "1") > 0)
        return F.filter(tokens, lambda t: ~hit(t))

    some = reduce(Column.__or__, [F.size(k) > 0 for k in kinds])
    return F.when(some & (F.size(tokens) > 0), _once(F.array(*map(line, kinds)), free)).otherwise(tokens)


def _assignments(text: Column) -> Column:
    value = lambda s: F.regexp_extract(s["value"], ASSIGN, 2)
    kept = F.filter(_spans(text, ASSIGN, 0), lambda s: F.length(value(s)) >= MIN_ASSIGN)
    return F.transform(kept, lambda s: s.withField("value", value(s)))


def _looks_live(value: Column) -> Column:
    mixed = value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")
    return mixed & (F.size(F.array_distinct(F.split(value, ""))) >= MIN_DISTINCT)


def _written(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    kind = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["rank"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"], s["end"])), ",")


def scanned(docs: DataFrame, owner: str, repository: str) -> DataFrame:
    """One row per document with its base spans and token candidates (values
    as hashes).  Texts are read once; only spans go on."""
    # the text is scanned as one column of its own, else the optimizer would copy its expression into each pass
    text = F.col("_text")
    rows = docs.select(
        "doc_id",
        F.col(owner).cast("string").alias("owner"),
        F.col(repository).cast("string").alias("repository"),
        text_key().alias("text_key"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"),
    )
    hashed = lambda spans: F.transform(spans, lambda s: s.withField("value", F.sha2(s["value"], 256)))
    found = rows.select(
        "doc_id", "owner", "repository", "text_key",
        _assignments(text).alias("k0"), _spans(text, ACCESS, 1).alias("k1"), _spans(text, HEX, 2).alias("k2"),
        F.filter(_spans(text, TOKEN, 3), lambda s: _looks_live(s["value"])).alias("tokens"),
    )
    kinds = [F.col(f"k{i}") for i in range(3)]
    return found.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", "owner", "repository", "text_key",
        hashed(F.array_sort(F.concat(*kinds))).alias("base"), hashed(_apart(kinds, F.col("tokens"))).alias("tokens"),
    )


def ownership(candidates: DataFrame) -> DataFrame:
    """``value, n_owners, n_repositories`` from (value, owner, repository).

    Each level is a sum that combines on the map side, so a value held by a
    third of all rows never meets in one task."""
    pairs = candidates.groupBy("value", "owner", "repository").agg(F.lit(1).alias("one"))
    repos = (
        pairs.groupBy("value", "repository").agg(F.lit(1).alias("one"))
        .groupBy("value").agg(F.count("one").alias("n_repositories"))
    )
    owners = (
        pairs.groupBy("value", "owner").agg(F.lit(1).alias("one"))
        .groupBy("value").agg(F.count("one").alias("n_owners"))
    )
    return owners.join(repos, "value")


def secrets(
    docs: DataFrame,
    owner: str = "source",
    repository: str = "doc_id",
    max_owners: int = MAX_OWNERS,
    min_repositories: int = WIDELY_COPIED,
) -> DataFrame:
    """One row per document: ``doc_id, text_key, base, added`` (arrays of
    spans in order, with value hashes), ``n_copied`` and ``n_owned`` (values
    of the document that are widely copied, and owner-specific) and ``holders``
    (value, n_owners and n_repositories of its distinct values)."""
    rows = cut(scanned(docs, owner, repository), "secret_spans")
    some = (F.size("base") > 0) | (F.size("tokens") > 0)
    held = rows.filter(some).select(
        "row_id", "owner", "repository", F.explode(F.concat("base", "tokens")).alias("s")
    )
    held = held.select("row_id", "owner", "repository", "s", F.col("s.value").alias("value"))
    counted = cut(ownership(held.select("value", "owner", "repository")), "ownership")
    owned = (F.col("n_owners") <= max_owners) | (F.col("n_repositories") < min_repositories)
    per_row = (
        held.join(counted, "value").groupBy("row_id")
        .agg(
            F.array_sort(F.collect_list(F.when(owned & (F.col("s.rank") == 3), F.col("s")))).alias("added"),
            F.count_if(~owned).alias("n_copied"),
            F.count_if(owned).alias("n_owned"),
            F.array_sort(F.collect_set(F.struct("value", "n_owners", "n_repositories"))).alias("holders"),
        )
    )
    none = F.array().cast(_EMPTY)
    zero = F.lit(0).cast("long")
    full = rows.filter(some).join(per_row, "row_id").select(
        "doc_id", "text_key", "base", "added", "n_copied", "n_owned", "holders"
    )
    bare = rows.filter(~some).select(
        "doc_id", "text_key", none.alias("base"), none.alias("added"), zero.alias("n_copied"), zero.alias("n_owned"),
        F.array().cast(_HOLDERS).alias("holders"),
    )
    return full.unionByName(bare)


def report(found: DataFrame) -> DataFrame:
    """The scan as one flat row per document."""
    count = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")
    most = lambda c: F.coalesce(F.array_max(F.transform("holders", lambda h: h[c])), F.lit(0).cast("long"))
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
        "n_copied",
        "n_owned",
        most("n_owners").alias("most_owners"),
        most("n_repositories").alias("most_repositories"),
    )


def redact(
    docs: DataFrame,
    mark: str = "[SECRET]",
    owner: str = "source",
    repository: str = "doc_id",
    min_repositories: int = WIDELY_COPIED,
) -> DataFrame:
    """``docs`` with every span of the scan replaced by ``mark`` (overlapping
    spans once) and ``n_chars``, if there, counted anew.  No row is dropped."""
    columns = docs.columns
    d, k, own, tk, cleaned = (own_name(docs, n) for n in ("_d", "_k", "_s", "_tk", "_clean"))
    spans = secrets(docs, owner, repository, min_repositories=min_repositories).select(
        F.col("doc_id").alias(d), F.col("text_key").alias(k), F.array_sort(F.concat("base", "added")).alias(own)
    )
    spans = cut(spans.filter(F.size(own) > 0).dropDuplicates([d, k]), "spans_to_redact")
    spans = spans.hint("merge")  # texts are shuffled once at any size
    rows = docs.withColumn(tk, text_key())
    text = F.col("text")
    begin = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        gap = text.substr((acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        piece = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"])
        return F.struct(piece.alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    def finish(acc: Column) -> Column:
        return F.concat(acc["out"], text.substr((acc["at"] + 1).cast("int"), F.length(text)))

    joined = rows.join(spans, rows["doc_id"].eqNullSafe(spans[d]) & (rows[tk] == spans[k]), "left")
    clean = F.when(F.col(own).isNull(), text).otherwise(F.aggregate(own, begin, step, finish))
    out = joined.withColumn(cleaned, clean)
    kinds = dict(docs.dtypes)
    new = {"text": F.col(cleaned)}
    if "n_chars" in columns:
        new["n_chars"] = F.when(F.col(own).isNull(), F.col("n_chars")).otherwise(
            F.length(cleaned).cast(kinds["n_chars"])
        )
    return out.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in columns])
