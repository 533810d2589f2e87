"""URL filter: rules first, gradient-boosted trees on lexical features else.

The longest rule whose host (or a parent of the url's host) and path prefix
fit decides.  Urls without a rule are judged by boosted trees over lengths,
depths, digit and letter shares, character entropy, parameter counts and
statistics of the host's suffix, trained on labelled urls: those that rules
decide, or a labelled table of the caller's.  At most ``max_training_rows``
labelled rows (chosen by hash, the one bound here) train the trees; suffix
statistics and verdicts cover all rows.

Defined results: null urls and urls without ``://`` have an empty host and
path, hence no rule; without labelled rows every url is allowed, and with
labels of one kind the model repeats it; repeated rows are judged one by
one; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctxanomaly.llm.common import cut

BLOCK, ALLOW = "block", "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains and a path prefix."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule("net", "/", BLOCK),
    Rule("example.net", "/en/", ALLOW),
    Rule("example.com", "/de/", BLOCK),
    Rule("org", "/fr/", ALLOW),
)

MAX_TRAINING_ROWS = 20_000
TREES, DEPTH, SEED = 10, 4, 7


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(text, pattern, 1), UPPER, LOWER), F.regexp_extract(text, pattern, 2)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):  # the longest is outermost
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _entropy(text: Column) -> Column:
    chars = F.array_distinct(F.split(text, ""))
    n = F.length(text).cast("double")

    def part(c: Column) -> Column:
        share = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return F.when(share > 0, -share * F.log2(share)).otherwise(0.0)

    total = F.aggregate(F.transform(chars, part), F.lit(0.0), lambda a, x: a + x)
    return F.when(n > 0, total).otherwise(0.0)


FEATURES = (
    "url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "upper_ratio", "mark_count",
    "entropy", "parameters", "query_length", "has_fragment", "longest_word", "suffix_pages", "suffix_hosts",
    "domain_pages",
)


def lexical(rows: DataFrame) -> DataFrame:
    """Lexical features of ``url, host, path``."""
    url, host, path = (F.col(c) for c in ("url", "host", "path"))
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    words = F.split(url, "[^A-Za-z0-9]+")
    tail = F.regexp_extract(url, r"\?([^#]*)", 1)
    return rows.withColumns(
        {
            "url_length": F.length(url).cast("double"),
            "host_length": F.length(host).cast("double"),
            "path_length": F.length(path).cast("double"),
            "depth": _count(path, "/"),
            "labels": _count(host, r"[^.]+"),
            "digit_ratio": _count(url, "[0-9]") / n,
            "upper_ratio": _count(url, "[A-Z]") / n,
            "mark_count": _count(url, "[-_%@~+]"),
            "entropy": _entropy(url),
            "parameters": _count(tail, "[^&]+"),
            "query_length": F.length(tail).cast("double"),
            "has_fragment": url.contains("#").cast("double"),
            "longest_word": F.array_max(F.transform(words, lambda w: F.length(w))).cast("double"),
        }
    )


def suffix_statistics(rows: DataFrame, key: str, prefix: str) -> DataFrame:
    """Pages and hosts (logarithms) of each value of ``key``.  The first sum
    is by host, so a hot suffix is one row per host and task."""
    hosts = rows.groupBy(key, "host").agg(F.count(F.lit(1)).alias("n"))
    return hosts.groupBy(key).agg(
        F.log1p(F.sum("n")).alias(f"{prefix}_pages"), F.log1p(F.count(F.lit(1))).alias(f"{prefix}_hosts")
    )


def featured(pages: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``page_id, url, host, path, rule, rule_verdict`` and the features."""
    rows = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"))
    host, path = url_parts(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns(
        {
            "rule": name,
            "rule_verdict": verdict,
            "suffix": F.regexp_extract("host", r"([^.]*)$", 1),
            "domain": F.regexp_extract("host", r"([^.]*\.[^.]*|[^.]*)$", 1),
        }
    )
    suffixes = cut(suffix_statistics(rows.select("suffix", "host"), "suffix", "suffix"), "suffixes")
    domains = cut(suffix_statistics(rows.select("domain", "host"), "domain", "domain"), "domains")
    joined = lexical(rows).join(suffixes, "suffix").join(domains, "domain")
    return joined.select("page_id", "url", "host", "path", "rule", "rule_verdict", *FEATURES)


def judge(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    labelled: DataFrame | None = None,
    max_training_rows: int = MAX_TRAINING_ROWS,
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, block_score``.

    ``labelled`` (``url, verdict``) replaces the urls that rules decide as
    training rows."""
    rows = cut(featured(pages, rules), "url_features")
    if labelled is None:
        train = rows.filter(F.col("rule_verdict").isNotNull()).withColumn("verdict", F.col("rule_verdict"))
    else:
        given = labelled.select(F.lit(None).cast("long").alias("page_id"), "url", F.col("verdict").alias("_label"))
        named = given.withColumn("page_id", F.monotonically_increasing_id())
        train = cut(named, "labelled_urls")
        train = featured(train, rules).join(train.select("page_id", F.col("_label").alias("verdict")), "page_id")
    train = train.withColumn("label", (F.col("verdict") == BLOCK).cast("double"))
    counts = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        scored = rows.withColumn("block_score", F.lit(next(iter(counts), 0.0)))
    else:
        space = 1 << 30
        bound = F.lit(min(space, space * max_training_rows // sum(counts.values())))
        chosen = train.filter(F.pmod(F.xxhash64("url", "page_id"), F.lit(space)) < bound)
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        trees = GBTClassifier(
            featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, maxBins=32, stepSize=0.3, seed=SEED
        )
        model = trees.fit(cut(vectors.transform(chosen).select("features", "label"), "url_training"))
        blocked = vector_to_array("probability").getItem(1)
        scored = model.transform(vectors.transform(rows)).withColumn("block_score", blocked)
    own = F.when(F.col("block_score") > 0.5, BLOCK).otherwise(ALLOW)
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"), "block_score"
    )
