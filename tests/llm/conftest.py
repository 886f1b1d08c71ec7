import random

import pytest

WORDS = [f"w{i}" for i in range(300)]


@pytest.fixture(scope="session")
def corpus():
    """doc_id, text, lang, source, n_chars: clean, shouting, toxic, empty, missing, repeated and very long texts."""
    rng = random.Random(1)
    rows = []
    for i in range(400):
        words = rng.choices(WORDS, k=rng.randint(20, 120))
        if i % 5 == 1:
            words = [w.upper() + "!!" for w in words]
        if i % 7 == 2:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum", "moron"]))
        rows.append((i, " ".join(words), "en", "s0", None))
    rows = [(a, t, lang, s, len(t)) for a, t, lang, s, _ in rows]
    rows += [(1000, None, None, None, None), (1001, "", "en", "s1", 0), (1002, " \n\t ", "en", "s1", 4), (None, "no id here", "en", "s1", 10), (5, rows[5][1], "en", "s0", rows[5][4]), (1003, "long " * 30_000, "de", "s2", 150_000)]
    return rows


@pytest.fixture(scope="session")
def labels():
    return [(i, int(i % 5 != 1), int(i % 7 == 2)) for i in range(400)] + [(1, None, None), (None, 1, 1), (5000, 1, 0), (3, 1, 0)]


@pytest.fixture(scope="session")
def docs_df(spark, corpus):
    clash = "doc_id long, text string, lang string, source string, n_chars long, score string, rate int, spans int, fp string, p int, tokens string"
    return spark.createDataFrame([(*r, "x", 1, 2, "y", 3, "z") for r in corpus], clash)


@pytest.fixture(scope="session")
def labels_df(spark, labels):
    return spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, y string")
