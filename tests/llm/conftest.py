import random

import pytest

# Names that operators use inside, as columns of the input.
CLASH = ", row long, id string, fp long, word string, kept string, quality double, rank int"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long" + CLASH
CLASHING = (7, "x", 8, "y", "z", 0.5, 3)


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(300)]


@pytest.fixture(scope="session")
def edge_docs(spark, words):
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing names."""
    rng = random.Random(1)
    plain = [" ".join(rng.choice(words) for _ in range(rng.randint(12, 60))) for _ in range(30)]
    rows = [(i, t, rng.choice(["en", "de"]), f"src{i % 5}", len(t)) for i, t in enumerate(plain)]
    rows += [
        rows[3],
        rows[3],
        (100, plain[4], "en", "src1", 1),
        (101, plain[4] + " and", "en", "src1", 1),
        (102, None, "en", "src1", None),
        (103, "", None, "src1", 0),
        (104, " \n\t\x0b ", "fr", None, 5),
        (None, plain[5], None, None, None),
        (None, None, None, None, None),
        (105, " ".join(rng.choice(words) for _ in range(30_000)), "en", "src2", 9),
        (106, "x" * 50_000, "en", "src2", 9),
        (107, "▁ 日本語 \x00 \U0001f600 ﬁ\r\nÀÉ  two  spaces ", "fr", "odd", 9),
        (108, "one", "fr", "src3", 3),
    ]
    return spark.createDataFrame([(*r, *CLASHING) for r in rows], SCHEMA).coalesce(2)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
