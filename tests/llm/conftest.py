import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that operators use inside, to clash with theirs.
EXTRA = (
    "label score bucket key hash class size rep value copies taken text_id spans matches held_out "
    "follows at n_bytes wanted threshold whole times of sketch n_words"
).split()


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows):
        full = [(i, t, lang, source, len(t or "")) for i, t, lang, source in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def prose():
    """Words of an invented language, the same for the same seed."""

    def make(seed, words):
        rng = random.Random(seed)
        syllables = ["ba", "ke", "li", "mo", "nu", "ra", "se", "ti", "vo", "zu"]
        return " ".join(
            "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(words)
        )

    return make


@pytest.fixture(scope="session")
def odd_rows(prose):
    """Null ids and texts, empty and very long texts, ties and repeated rows."""
    long_text = prose(99, 60_000)
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", None),
        (3, "   \n\t ", None, "a"),
        (4, prose(4, 80), "en", "b"),
        (4, prose(4, 80), "en", "b"),
        (5, prose(4, 80), "fr", None),
        (5, prose(5, 80), "fr", "a"),
        (None, prose(6, 80), "fr", "a"),
        (None, prose(6, 80), None, "a"),
        (None, None, None, None),
        (7, long_text, "en", "c"),
        (8, "aaaa" * 300, "en", "c"),
        (9, "x", "de", "c"),
        (10, "5.5.5.5 +1 " * 50, "de", "c"),
        (11, "ééé 漢字 🙂 " * 40, "de", "c"),
    ]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, docs_of, odd_rows):
    from pyspark.sql import functions as F

    docs = docs_of(odd_rows)
    return docs.withColumns({name: F.lit("clash") for name in EXTRA})


@pytest.fixture(scope="session")
def labels_of(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def benchmark_of(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")
