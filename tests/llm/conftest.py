import numpy as np
import pytest


@pytest.fixture()
def docs(spark):
    """(doc_id, text) rows as a DataFrame of the documents' types, with extra columns that clash with inner names."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "src", len(t or ""), 1, "x") for i, t in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long, name int, key string")
    return make


@pytest.fixture(scope="session")
def writing():
    """Invented prose of n words, alike for a seed."""
    def make(n, seed):
        rng = np.random.default_rng(seed)
        syllables = ["an", "ble", "wh", "the", "of", "ti", "on", "er", "ing", "es", "re", "st", "and", "ou", "ed"]
        return " ".join("".join(rng.choice(syllables, rng.integers(1, 5))) for _ in range(n))
    return make
