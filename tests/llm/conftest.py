import random

import pytest

LABELS = "doc_id long, toxic int"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, target string, _size int"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing names."""
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(400)]
    long_ = " ".join(rng.choice(vocab) for _ in range(30_000))
    base = " ".join(rng.choice(vocab) for _ in range(300))
    near = base.split()
    near[150] = "changed"
    shared = "this very line is found in many documents"
    rows = [
        (1, None, "en", "a"), (2, "", "en", None), (3, "   \n\t ", None, "a"), (4, long_, "de", "b"), (5, base, "en", "b"),
        (6, base, "en", "a"), (7, " ".join(near), None, None), (8, "one two three", "en", "c"), (9, "ONE  two\nthree", "en", "c"),
        (10, f"x\n{shared}\ny", "en", "a"), (11, f"{shared}  \nz\n{shared}", "en", "a"), (12, shared.upper(), "en", "b"),
        (13, "naïve café — 日本語 текст\u00a0nbsp " * 30, "fr", "d"), (13, "naïve café — 日本語 текст\u00a0nbsp " * 30, "fr", "d"),
        (14, "a" * 5000, "en", "a"), (None, "no id here " * 20, "en", "e"), (15, "\ud7ff\U0001f600 emoji \x00 nul", "en", "e"),
    ]
    rows += [(100 + i, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 300))), "en", rng.choice("abc")) for i in range(60)]
    return spark.createDataFrame([(i, t, l, s, len(t or ""), "clash", 9) for i, t, l, s in rows], DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
