import math
import zlib

import numpy as np

from conftest import SF001
from ctxanomaly.llm.language_id import MIN_GAP, CodeModel, codewords, has_letter, identify, learn, ngram_counts


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = {r["doc_id"]: r for r in identify(docs).collect()}
    rows = docs.collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert held and all(got[r["doc_id"]]["held_out"] for r in held)
    assert sum(g["held_out"] for g in got.values()) == len(held)
    lettered = [r for r in held if r["text"] and any(c.isalpha() for c in r["text"])]
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in lettered) >= 0.95 * len(lettered)
    assert all(0 <= g["score"] <= 1 for g in got.values())


def test_und_nulls_and_repeats(spark):
    rows = [(i, "the cat and the dog " * 5, "en", "s") for i in range(20)]
    rows += [(i, "der hund und die katze " * 5, "de", "s") for i in range(20, 40)]
    rows += [(50, None, "en", "s"), (51, "", "en", "s"), (52, "123 !? 456_ ²½", "en", "s"), (53, "é", None, "s"),
             (None, "the dog", None, "s"), (54, "the cat " * 50_000, None, "s"), (54, "the cat " * 50_000, None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = identify(docs).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (50, 51, 52))
    assert by[53]["lang_pred"] in ("en", "de") and by[54]["lang_pred"] == "en"
    assert by[None]["held_out"] and by[None]["lang_pred"] == "en"


def test_lang_of_held_out_rows_is_not_used(spark):
    rows = [(i, f"word{i} text", "en", "s") for i in range(40)]
    held = [zlib.crc32(str(i).encode()) % 4 == 2 for i in range(40)]
    rows = [(i, t, "xx" if h else "en", s) for (i, t, _, s), h in zip(rows, held, strict=True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert {r["lang_pred"] for r in identify(docs).collect()} == {"en"}


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert identify(docs).first()["lang_pred"] == "und"
    assert identify(docs.limit(0)).count() == 0
    assert learn(docs.select("text", "lang")).langs == []


def test_codewords_are_distinct():
    for k in (2, 3, 4, 6, 9, 40):
        code = codewords(k)
        assert code.shape[0] == k and len({tuple(x) for x in code}) == k
        assert all(np.abs(c.sum()) < k for c in code.T)


def brute_counts(texts, buckets):
    """Hashed byte bigrams and trigrams, one at a time."""
    out = [0] * buckets
    shift = 32 - (buckets.bit_length() - 1)
    for text in texts:
        a = (" " + text.lower() + " ").encode()
        grams = [a[i] << 8 | a[i + 1] for i in range(len(a) - 1)]
        grams += [a[i] << 16 | a[i + 1] << 8 | a[i + 2] | 1 << 24 for i in range(len(a) - 2)]
        for g in grams:
            out[(g * 2654435761 % (1 << 32)) >> shift] += 1
    return out


def brute_decode(model_texts, text, buckets):
    """Bits, margins and loss-weighted decoding in plain arithmetic."""
    langs = sorted(model_texts)
    code = codewords(len(langs)).tolist()
    share = []
    for lang in langs:
        n = brute_counts(model_texts[lang], buckets)
        total = sum(n)
        share.append([(c + 0.5) / (total + 0.5 * buckets) for c in n])

    def margins(t):
        n = brute_counts([t], buckets)
        out = []
        for bit in range(len(code[0])):
            yes = [s for s, w in zip(share, code, strict=True) if w[bit] > 0]
            no = [s for s, w in zip(share, code, strict=True) if w[bit] < 0]
            odds = [math.log(sum(s[b] for s in yes) / len(yes)) - math.log(sum(s[b] for s in no) / len(no)) for b in range(buckets)]
            out.append(8.0 * sum(c * o for c, o in zip(n, odds, strict=True)) / sum(n))
        return out

    seen = [(t, k) for k, lang in enumerate(langs) for t in model_texts[lang]]
    every = [(margins(t), k) for t, k in seen]
    skill = [max(sum(m[bit] * code[k][bit] > 0 for m, k in every) / len(every) - 0.5, 0.01) for bit in range(len(code[0]))]
    weight = [s * len(skill) / sum(skill) for s in skill]
    m = margins(text)
    loss = [sum(w * math.log1p(math.exp(-c * x)) for w, c, x in zip(weight, row, m, strict=True)) for row in code]
    best = min(loss)
    chance = [math.exp(best - x) for x in loss]
    chance = sorted((c / sum(chance) for c in chance), reverse=True)
    return langs[loss.index(best)], chance[0], chance[0] - chance[1] < MIN_GAP


def test_counts_margins_and_decoding_equal_brute_force(spark):
    texts = {
        "de": ["der hund und die katze", "das haus ist alt", "wir gehen in den wald"],
        "en": ["the dog and the cat", "the house is old", "we walk into the woods"],
        "es": ["el perro y el gato", "la casa es vieja", "vamos al bosque ni\u00f1o"],
        "fr": ["le chien et le chat", "la maison est vieille", "nous allons au bois"],
    }
    buckets = 1 << 8
    assert ngram_counts("The Ni\u00f1o", buckets).tolist() == brute_counts(["The Ni\u00f1o"], buckets)
    rows = [(i, t, lang) for i, (lang, t) in enumerate((lang, t) for lang, ts in texts.items() for t in ts)]
    model = learn(spark.createDataFrame(rows, "doc_id long, text string, lang string").select("text", "lang"), buckets)
    assert isinstance(model, CodeModel) and model.langs == sorted(texts)
    for probe in ["the cat is old", "die alte katze", "le vieux chat", "gato viejo", "x", "zzz qqq", "la", "chat cat gato katze"]:
        assert has_letter(probe)
        lang, score, ambiguous = model.decode(probe)
        want = brute_decode(texts, probe, buckets)
        assert (lang, ambiguous) == (want[0], want[2]) and abs(score - want[1]) < 1e-3, probe
