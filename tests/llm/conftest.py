import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in any column, empty, blank and long texts, copies, ties, repeated rows."""
    rng = random.Random(3)
    prose = " ".join(rng.choice(["alpha", "Beta", "gamma,", "delta", "épsilon", "zeta.", "eta", "theta"]) + str(rng.randrange(60)) for _ in range(120))
    near = prose.replace("delta", "Delta", 1) + " tail"
    rows = [
        (1, prose, "en", "a", 10), (2, prose, None, None, None), (3, near, "en", "a", 3), (3, near, "en", "a", 3),
        (4, None, "en", "a", None), (5, "", "en", "a", 0), (6, " \n\t\n", "en", "a", 4), (None, prose, "en", "a", 1),
        (None, None, None, None, None), (7, "one two three", "en", "a", 13), (8, "ONE two  three", "en", "a", 14),
        (9, "word " * 30_000, "en", "b", 150_000), (10, "x" * 100_000, "en", "b", 100_000),
        (11, "日本語のテキスト 😀👍 ß İ \x00 end", "ja", "b", 20), (12, "a line that repeats\nunique one here\na line that repeats", "en", "b", 1),
        (13, "  A LINE that repeats\t\nother words follow", "en", "b", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
