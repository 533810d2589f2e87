"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ctxanomaly.llm.common import table
from ctxanomaly.llm.decontaminate import decontaminate
from ctxanomaly.llm.language_id import identify
from ctxanomaly.llm.neural_lm import score
from ctxanomaly.llm.packing import pack, pieces
from ctxanomaly.llm.quality_rules import quality
from ctxanomaly.llm.ranked_search import search
from ctxanomaly.llm.secret_scan import report, secrets
from ctxanomaly.llm.simhash_neardup import simhash_classes
from ctxanomaly.llm.substring_dedup import substring_dedup
from ctxanomaly.llm.suffix_dedup import suffix_dedup
from ctxanomaly.llm.url_filter import judge
from ctxanomaly.llm.warc import read_archives, write_archives
from ctxanomaly.llm.whitening import whiten


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(secrets(table(spark, sf_dir, "documents")))


def op2_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_classes(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_archives(write_archives(table(spark, sf_dir, "pages")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "host_docs", "host_failed",
    )


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).drop("spans")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).drop("spans")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(table(spark, sf_dir, "documents")))


def op11_neural_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in list(globals().items()) if name.startswith("op") and name[2].isdigit()
}

_OP4 = r"""
with d as (
  select row_number() over () as rid, doc_id, source, coalesce(text, '') as t from documents
), w as (
  select rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws from d
), win as (
  select rid, p, array_to_string(ws[p:p + 4], ' ') as g
  from (select rid, ws, unnest(generate_series(1, len(ws) - 4)) as p from w)
), rep as (
  select rid, p from (select rid, p, count(*) over (partition by rid, g) as c from win) where c > 1
), repeated as (
  select rid, count(distinct p + k) as n from rep, (select unnest(generate_series(0, 4)) as k) group by rid
), lines as (
  select rid, unnest(string_split(t, chr(10))) as line from d
), dup as (
  select rid, count(*) as n_lines, count(*) - count(distinct line) as n_dup
  from lines where regexp_matches(line, '[^\x20\x09-\x0D]') group by rid
), m as (
  select d.rid, doc_id, source,
    cast(len(ws) as bigint) as n_words,
    cast(length(array_to_string(ws, '')) as bigint) as word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(coalesce(n_dup, 0) as bigint) as n_dup_lines,
    cast(coalesce(r.n, 0) as bigint) as n_repeat_words,
    coalesce(n_lines, 0) as n_lines
  from d join w using (rid) left join repeated r using (rid) left join dup using (rid)
), j as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from m
), a as (
  select *, base_failed or 100 * n_symbols > 10 * word_chars or 100 * n_dup_lines > 30 * n_lines as any_failed from j
), h as (
  select source, count(*) as host_docs, cast(sum(cast(any_failed as int)) as bigint) as host_failed from a group by source
), prior as (
  select avg(host_failed / host_docs) as m, var_pop(host_failed / host_docs) as v from h
), strength as (
  select m, least(greatest(case when v <= 0 then 1000.0 else m * (1 - m) / v - 1 end, 1.0), 1000.0) as s from prior
), v as (
  select source, host_docs, host_failed, (host_failed + m * s) / (host_docs + s) <= 0.5 as host_kept from h, strength
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and host_kept as kept, host_docs, host_failed
from a join v on a.source is not distinct from v.source
"""

_OP1_KINDS = (
    (0, "assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""),
    (1, "access", "AKIA[A-Z0-9]{16,}"),
    (2, "hex", "[0-9a-f]{24,}"),
    (3, "token", "[A-Za-z0-9+/_-]{20,}"),
)


def _op1_spans(rank: int, kind: str, pattern: str) -> str:
    value = f"regexp_extract(m, '{pattern}', 2)" if rank == 0 else "m"
    return f"""
  select rid, {rank} as rank, '{kind}' as kind, s as start, s + length(m) as stop, {value} as value from (
    select rid, m, sum(length(gap) + length(m)) over (partition by rid order by i) - length(m) as s from (
      select rid, unnest(regexp_extract_all(t, '{pattern}')) as m,
        unnest(string_split_regex(t, '{pattern}')[:len(regexp_extract_all(t, '{pattern}'))]) as gap,
        unnest(generate_series(1, len(regexp_extract_all(t, '{pattern}')))) as i from d
    )
  )"""


_OP1 = (
    """
with d as (
  select row_number() over () as rid, doc_id, source, coalesce(text, '') as t from documents
), found as ("""
    + " union all ".join(_op1_spans(*k) for k in _OP1_KINDS)
    + """
), base as (
  select * from found where rank = 1 or rank = 2 or rank = 0 and length(value) >= 6
), tokens as (
  select * from found f where rank = 3
    and regexp_matches(value, '[0-9]') and regexp_matches(value, '[A-Z]') and regexp_matches(value, '[a-z]')
    and len(list_distinct(string_split(value, ''))) >= 10
    and not exists (select 1 from base b where b.rid = f.rid and b.start < f.stop and f.start < b.stop)
), held as (
  select x.*, d.doc_id, d.source from (from base union all from tokens) x join d using (rid)
), owners as (
  select value, count(*) as n_owners from (select distinct value, source from held) group by value
), repositories as (
  select value, count(*) as n_repositories from (select distinct value, doc_id from held) group by value
), marked as (
  select held.*, n_owners, n_repositories, n_owners > 1 and n_repositories >= 10 as copied
  from held join owners using (value) join repositories using (value)
), per as (
  select rid,
    count(*) filter (rank = 0) as n_assign, count(*) filter (rank = 1) as n_access, count(*) filter (rank = 2) as n_hex,
    string_agg(kind || ':' || cast(start as bigint) || ':' || cast(stop as bigint), ',' order by start, rank)
      filter (rank < 3) as base_spans,
    string_agg(kind || ':' || cast(start as bigint) || ':' || cast(stop as bigint), ',' order by start, rank)
      filter (rank < 3 or not copied) as spans,
    count(*) filter (rank = 3 and not copied) as n_added,
    count(*) filter (copied) as n_copied, count(*) filter (not copied) as n_owned,
    max(n_owners) as most_owners, max(n_repositories) as most_repositories
  from marked group by rid
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base_spans, '')) as base_sha256, coalesce(spans, '') as spans,
  coalesce(n_added, 0) as n_added, coalesce(n_copied, 0) as n_copied, coalesce(n_owned, 0) as n_owned,
  coalesce(most_owners, 0) as most_owners, coalesce(most_repositories, 0) as most_repositories
from d left join per using (rid)
"""
)

_OP3 = """
with p as (
  select row_number() over () as rid, page_id, coalesce(html, '') as h from pages
), digits as (
  select rid, i, cast(list_sum([
      (instr('0123456789abcdef', substr(sha1(h), 5 * (i // 4) + 1 + k, 1)) - 1) * (1 << (4 * (4 - k)))
      for k in [0, 1, 2, 3, 4]]) as bigint) as v
  from p, (select unnest(generate_series(0, 31)) as i)
), base32 as (
  select rid, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> (15 - 5 * (i % 4))) & 31), 1), ''
    order by i) as digest from digits group by rid
), first as (
  select h, min(page_id) as f from p group by h
)
select page_id, cast(strlen(h) as bigint) as payload_bytes, digest as payload_digest,
  case when page_id is not distinct from f then 'response' else 'revisit' end as record_type,
  case when page_id is not distinct from f then null else f end as refers_to
from p join base32 using (rid) join first using (h)
"""

_OP12_TERMS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

_OP12 = f"""
with d as (
  select *, len(ts) as n from (select row_number() over () as rid, doc_id, {_OP12_TERMS} as ts from documents)
  where len(ts) > 0
), total as (
  select count(*) as n_docs, cast(sum(n) as bigint) as length from d
), tf as (
  select rid, term, count(*) as tf from (select rid, unnest(ts) as term from d) group by rid, term
), w as (
  select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) as bigint) as w
  from (select term, count(*) as df from tf group by term), total
), m as (
  select rid, doc_id, 25 + (75 * n * n_docs) // length as m from d, total
), q as (
  select iid, item_id, unnest(ts) as term
  from (select row_number() over () as iid, item_id, {_OP12_TERMS} as ts from benchmark)
), s as (
  select iid, item_id, rid, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
  from q join w using (term) join tf using (term) join m using (rid) group by all
)
select item_id, cast(rank as int) as rank, doc_id, score from (
  select *, row_number() over (partition by iid order by score desc, doc_id nulls last) as rank from s where score > 0
) where rank <= 10
"""

SQL: dict[str, str] = {
    "op1_secret_scans": _OP1, "op3_warc": _OP3, "op4_quality_rules": _OP4, "op12_ranked_search": _OP12,
}
