import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small(spark):
    """Documents of the smallest table as (doc_id, text)."""
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return [(r[0], r[1]) for r in rows]


@pytest.fixture(scope="session")
def odd():
    """Copies, near copies, shared passages, nulls, empty and very long texts, repeated rows."""
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, base = text(60), text(120)
    docs = [(0, None), (1, ""), (2, "   \n\t "), (3, "one two"), (4, "ONE  two"), (5, base), (6, base), (7, base.upper())]
    docs += [(8 + k, " ".join(w if rng.random() > 0.01 else "x" for w in base.split())) for k in range(25)]
    docs += [(40 + k, f"{text(rng.randrange(5, 40))} {passage} {text(rng.randrange(5, 40))}") for k in range(15)]
    docs += [(60, "a " * 3000), (61, "a " * 50), (62, "é" * 40 + " " + text(20)), (63, text(20_000)), (64, "  \x00 b")]
    docs += [(70 + k, text(n)) for k, n in enumerate((1, 2, 3, 4, 5, 6, 7, 12, 13, 14, 30))]
    docs += [(81 + k, " ".join(base.split()[:n])) for k, n in enumerate((96, 97, 98, 99, 100, 101, 102))]
    docs += [(-5, passage)]
    return docs


@pytest.fixture
def frame(spark):
    """(doc_id, text) with columns whose names clash with what the operators use inside."""
    def make(docs, **more):
        rows = [(i, t, "src", "x", 1, 2.0) for i, t in docs]
        return spark.createDataFrame(rows, "doc_id long, text string, source string, id string, row int, score double")
    return make
