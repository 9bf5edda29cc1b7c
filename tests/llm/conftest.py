import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, id long, fp long, ids string, v int, h long"


def frame(spark, texts, ids=None):
    """Documents with columns whose names clash with those that operators use inside."""
    ids = ids or list(range(len(texts)))
    return spark.createDataFrame([(i, t, "en", "src0", len(t or ""), 7.0, -1, -2, "x", 3, 9) for i, t in zip(ids, texts, strict=True)], SCHEMA)


@pytest.fixture(scope="session")
def edge_texts():
    """Null, empty, blank, one word, repeated rows, ties, one long run and one very long text."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgéß") for _ in range(rng.randint(1, 8)))
    prose = [" ".join(word() for _ in range(n)) for n in (3, 34, 35, 36, 80, 200)]
    long = " ".join(word() for _ in range(30_000))
    near = prose[5].split()
    near[100] = "changed"
    shared = "start " + " ".join(prose[4].split()[10:60]) + " end of it"
    return [None, "", " \t\n", "word", *prose, prose[4], prose[4], prose[5], " ".join(near), shared, "same " * 120, "Same, same.\n" * 40, long, long[: len(long) // 2], "x y  z\0q", "a" * 5_000]
