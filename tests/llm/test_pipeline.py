import hashlib

import corpus_pipeline as P
from ctxanomaly.llm.decontaminate import words_of
from ctxanomaly.llm.quality_rules import text_metrics
from llm.test_decontaminate import brute_tiles
from llm.test_packing import check
from llm.test_secret_scan import brute_base
from llm.test_simhash_neardup import brute_classes, brute_fingerprint


def brute_pipeline(rows, items):
    """(doc_id, words) of what reaches the last stage; base rules only, as no
    host of the fixture fails as a rule."""

    def good(text):
        n, _, _, _, repeated, _ = text_metrics((text or "").encode())
        return n >= 10 and 100 * repeated <= 20 * n

    rows = [r for r in rows if good(r[1])]
    prints = [brute_fingerprint(r[1]) for r in rows]
    roots, first = brute_classes(set(prints)), {}
    for r, p in zip(rows, prints, strict=True):
        key = (r[0] is None, r[0] if r[0] is not None else 0)
        if roots[p] not in first or key < first[roots[p]][0]:
            first[roots[p]] = (key, r)
    rows = [r for _, r in first.values()]
    clean = []
    for r in rows:
        doc = words_of(r[1])
        near = [w for w in items if len(set(w) & set(doc)) >= 0.8 * len(set(w))]
        if not any(brute_tiles(w, doc, 5) >= 0.8 * len(w) for w in near):
            clean.append(r)
    out = []
    for d, text, _ in clean:
        spans = sorted((int(x.split(":")[1]), int(x.split(":")[2])) for x in brute_base(text))
        done, at = "", 0
        for a, b in spans:
            if a >= at:
                done += text[at:a] + "[SECRET]"
            at = max(at, b)
        out.append((d, len((done + text[at:]).encode().split())))
    return sorted(out, key=repr)


def test_equals_brute_force(spark, make_docs, corpus, tmp_path):
    secret = hashlib.sha1(b"x").hexdigest()
    item = "an unusual benchmark question with exactly twelve plain words in it here"
    rows = [r for r in corpus if r[0] != 206]
    rows += [(500 + i, f"{rows[i][1]} token = {secret} and {rows[i + 40][1]}", "src8") for i in range(3)]
    rows += [(600, f"{corpus[9][1]} {item} {corpus[10][1]}", "src8"), (601, rows[8][1] + " " + item.upper(), "src8")]
    make_docs(rows, clash=False).write.parquet(f"{tmp_path}/documents.parquet")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = P.run(spark, str(tmp_path)).collect()
    check(got, 2048)
    want = brute_pipeline(rows, [words_of(item)])
    assert sorted(((r["doc_id"], r["n_words"]) for r in got), key=repr) == want
    ids = {r["doc_id"] for r in got}
    assert {600, 601}.isdisjoint(ids) and len(ids) > 40


def test_stages_keep_the_columns_of_documents(spark, make_docs, corpus, tmp_path):
    bench = spark.createDataFrame([(1, "no such words at all here")], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (corpus[:20], []):
        docs = make_docs(rows)
        for _, stage in P.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.dtypes == docs.dtypes
        assert P.STAGES[-1][1](spark, docs, str(tmp_path)).count() >= len(rows)


def test_clashing_names_keep_their_values(spark, corpus, tmp_path):
    """Columns named like the operators' own pass every stage unchanged."""
    names = ["_m", "_tk", "_s", "_d", "_k", "_clean", "_host", "_base", "_any", "_text", "f", "fp", "row", "_M_"]
    rows = [r for r in corpus if r[0] is not None and r[0] < 60] + [(300, "token = 0123456789abcdef0123456789abcdef and " + corpus[3][1], "src2")]
    docs = spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", *[f"concat('{n}:', doc_id) as `{n}`" for n in names])
    bench = spark.createDataFrame([(1, corpus[11][1])], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.dtypes == docs.dtypes, name
        kept = out.collect()
        assert kept and all(r[n] == f"{n}:{r['doc_id']}" for r in kept for n in names), name
    assert P.STAGES[-1][1](spark, docs, str(tmp_path)).count() >= len(rows)
