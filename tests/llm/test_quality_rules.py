import re

from ctxanomaly.llm.quality_rules import beta_prior, keep_good, quality, repeated_window_words, text_metrics
from ctxanomaly.llm.queries import SQL
from llm.oracle import by_spark, by_sql

CONTRACT = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
            "host_docs", "host_failed")


def test_equals_sql_on_edge_rows(make_docs, corpus):
    rows = [*corpus, (300, "# $ % & | < > " * 4, "src7"), (301, "a line\nb\na line\n\n \n\n" * 3, "src7")]
    rows += [(302, "one two three four five one two three four five six seven", "src7"), (303, "x" * 60_000, "src7")]
    rows += [(400 + i, "few", "bad") for i in range(30)] + [(440, " ".join(f"fine{i}" for i in range(40)), "bad")]
    docs = make_docs(rows)
    got = quality(docs)
    assert by_spark(got.select(*CONTRACT)) == by_sql(SQL["op4_quality_rules"], documents=docs)
    bad = got.filter("doc_id = 440").first()
    assert not bad["base_failed"] and not bad["kept"], "a host that fails as a rule takes its documents along"
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.filter("doc_id is not null").collect()) == sorted(
        r["doc_id"] for r in got.filter("kept and doc_id is not null").collect()
    )


def test_windows_against_brute_force():
    def brute(words):
        wins = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        hit = {i + k for i, w in enumerate(wins) if wins.count(w) > 1 for k in range(5)}
        return len(hit)

    for text in (b"", b"a", b"a " * 5, b"a " * 6, b"a b c d e x a b c d e", b"a b a b a b a b a", b"p q r s t u v"):
        assert repeated_window_words(text.split()) == brute(text.split())
    many = [str(i).encode() for i in range(9000)]  # too many different words for one exact code
    assert repeated_window_words(many + many[100:105]) == 10


def test_metrics_count_code_points():
    text = "É é\x0bñ#\u00a0x <\n"
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    m = text_metrics(text.encode())
    assert m[:3] == (len(words), sum(map(len, words)), 2)


def test_prior_is_bounded():
    assert beta_prior(0.2, 0.0, 1000) == (200.0, 800.0)
    a, b = beta_prior(0.5, 0.25, 1000)
    assert a + b == 1.0
    assert beta_prior(0.0, 0.0, 1000) == (0.0, 1000.0)


def test_empty_table(make_docs):
    assert quality(make_docs([])).count() == 0
    assert keep_good(make_docs([])).count() == 0
