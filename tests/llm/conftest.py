import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """Rows of (doc_id, text) or (doc_id, text, source)."""
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)
    return make


@pytest.fixture(scope="session")
def vocabulary():
    rng = random.Random(3)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8))) for _ in range(4000)]


@pytest.fixture(scope="session")
def prose(vocabulary):
    def text(seed, n):
        rng = random.Random(seed)
        return " ".join(rng.choice(vocabulary) for _ in range(n))
    return text
