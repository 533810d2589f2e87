import random

import pytest

CLASHES = ("d", "k", "body", "text_key", "fp", "row_id", "base", "value", "piece", "seed", "root", "n_words")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, source) rows, with columns whose names
    clash with the operators' own."""

    def make(rows, clash=True):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        df = spark.createDataFrame([(d, t, "en", s, None if t is None else len(t)) for d, t, s in rows], schema)
        if clash:
            df = df.selectExpr("*", *[f"cast(doc_id as string) as `{c}`" for c in CLASHES])
        return df

    return make


WORDS = "the of and to in is that it was for on as with his they at be this from have or by one had".split()


@pytest.fixture(scope="session")
def corpus():
    """Rows with copies, near copies, shared passages, null and empty texts,
    repeated rows, a null id and a hot source."""
    rng = random.Random(5)
    word = lambda: rng.choice(WORDS) if rng.random() < 0.3 else "".join(rng.choices("abcdefgh", k=5))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, other = text(40), text(90)
    rows = []
    for i in range(120):
        t = text(rng.choice((3, 12, 60, 200)))
        if i % 7 == 0:
            t = t + " " + passage + "\n" + text(5)
        if i % 11 == 0:
            t = text(9) + "  " + other + " " + t
        rows.append((i, t, "src0" if i % 3 else f"src{i % 5}"))
    for i in range(120, 160):
        words = rows[i - 117][1].split(" ")
        if i % 2:
            words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words), "src1"))
    rows += [(200, None, "src0"), (201, "", None), (202, "  \n\t ", "src2"), (203, "Émigré ÀÉ naïve ß " * 30, "src2")]
    rows += [(204, "again " * 400, "src3"), (205, "again " * 400, "src3"), (None, text(80), "src0"), rows[3], rows[3]]
    rows += [(None, rows[5][1], "src9"), (206, text(3000), "src4")]
    return rows
