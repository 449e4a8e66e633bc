import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """A documents table of (doc_id, text[, source]) rows."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)

    return make


@pytest.fixture(scope="session")
def lorem():
    """Deterministic words: lorem(seed, n) gives n words joined by spaces."""
    import random

    def make(seed, n, vocabulary=5000):
        rng = random.Random(seed)
        return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))

    return make
