import random

import pytest

#: Columns of documents, and others whose names the operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, row string, key string, copy int, band int, ids string, ld_lines string, mix_rate double"


def make(spark, rows):
    """rows: (doc_id, text, lang, source)."""
    full = [(i, t, lang, src, len(t) if t is not None else None, 1, "r", "k", 2, 3, "x", "l", 0.5) for i, t, lang, src in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


def corpus() -> list[tuple]:
    """Copies, near copies, nulls, empty and long texts, repeated rows and ids, odd characters."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    text = lambda n: "\n".join(" ".join(rng.choices(words, k=rng.randint(4, 14))) for _ in range(max(1, n // 9)))
    base = [text(rng.randint(20, 300)) for _ in range(40)]
    rows = [(k, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", "c"])) for k, t in enumerate(base)]
    for k in range(40, 60):
        t = base[k % 7].split(" ")
        t[rng.randrange(len(t))] = "changed"
        rows.append((k, " ".join(t), "en", "a"))
    rows += [(60, base[0], "en", "a"), (61, base[0], "de", "b"), (62, None, None, None), (63, "", "en", "a"), (64, " \n\t ", "en", "b"), (65, "one", "fr", "c"), (66, "one two", "fr", "c"), (67, "One TWO", "fr", None)]
    rows += [(68, "É Ünï x\x85y <|endoftext|> 'll it's \U0001f642 １２", "fr", "c"), (69, "word " * 30_000, "en", "a"), (70, text(20_000), "en", "a")]
    rows += [(5, base[5], "en", "a"), (5, "another text under the id five, with words enough for it", "en", "b"), (None, base[3], "en", None), (None, None, None, "b")]
    passage = "\n".join(" ".join(rng.choices(words, k=9)) for _ in range(40))
    rows += [(100 + k, text(60) + "\n" + passage + "\n" + text(60), "en", "b") for k in range(6)]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    df = make(spark, corpus())
    df.cache()
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return make(spark, []).limit(0)
