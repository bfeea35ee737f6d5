import random

import pytest
from helpers import without_repeats as brute

from pitwall.llm import substring


def result(df):
    return {r.row.doc_id: (r.n_words, r.n_removed, r.kept) for r in df.collect()}


@pytest.mark.parametrize("crowd,chunk_rows", [(4096, 4096), (3, 7)])
def test_equals_brute_force(frame, odd, crowd, chunk_rows):
    df = frame(odd).coalesce(1).repartitionByRange(3, "doc_id")
    assert result(substring.remove_repeats(df, crowd=crowd, chunk_rows=chunk_rows)) == brute(odd)


def test_small_table_equals_brute_force(frame, small):
    assert result(substring.remove_repeats(frame(small))) == brute(small)


def test_repeated_rows_null_ids_and_empty_table(frame):
    long = " ".join(f"v{k}" for k in range(20))
    got = substring.remove_repeats(frame([(3, long), (3, long), (4, long), (None, long)])).collect()
    assert sorted(((r.row.doc_id, r.n_removed) for r in got), key=str) == sorted([(3, 0), (3, 0), (4, 20), (None, 0)], key=str)
    assert substring.remove_repeats(frame([])).collect() == []


def test_long_windows_equal_brute_force(frame):
    """Texts around an anchor have more words than a byte counts."""
    rng = random.Random(3)
    text = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    passage = text(700)
    docs = [(i, f"{text(rng.randrange(100))} {passage} {text(rng.randrange(100))}") for i in range(5)]
    assert result(substring.remove_repeats(frame(docs), window=200)) == brute(docs, 200)
    with pytest.raises(ValueError):
        substring.remove_repeats(frame(docs), window=1 << 15, gram=0)


def test_first_documents_of_random_texts():
    rng = random.Random(3)
    for _ in range(200):
        texts = [[rng.randrange(3) for _ in range(rng.randrange(4, 14))] for _ in range(rng.randrange(1, 7))]
        docs = sorted(rng.randrange(5) for _ in texts)
        want = [min(d for t, d in zip(texts, docs) if any(t[j:j + 4] == text[k:k + 4] for j in range(len(t) - 3)))
                for text in texts for k in range(len(text) - 3)]
        assert substring.first_documents(texts, docs, 4) == want


def test_an_id_in_several_chunks(spark):
    """Rows that share an id lose nothing to each other, wherever they lie."""
    rng = random.Random(8)
    text = lambda n: " ".join(f"w{rng.randrange(300)}" for _ in range(n))
    passage, other = text(13), text(30)
    rows = [[(1, passage)], [(1, f"x {passage} y"), (9, f"a {passage} b")], [(2, other), (1, f"q {other}")], [(2, f"{other} z"), (7, f"{other} r"), (1, passage)]]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 4).flatMap(lambda x: x), "doc_id long, text string")
    docs = [r for part in rows for r in part]
    first = {}
    for i, t in docs:
        w = t.split()
        for k in range(len(w) - 12):
            first[tuple(w[k:k + 13])] = min(first.get(tuple(w[k:k + 13]), i), i)
    want = []
    for i, t in docs:
        w = t.split()
        gone = {p for k in range(len(w) - 12) if first[tuple(w[k:k + 13])] < i for p in range(k, k + 13)}
        want.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    got = [(r.row.doc_id, r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(df).collect()]
    assert sorted(got) == sorted(want)
