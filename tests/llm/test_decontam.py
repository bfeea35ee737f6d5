import hashlib

import pytest
from helpers import alnum, benchmark_hits
from hypothesis import given, settings
from hypothesis import strategies as st

from pitwall.llm import decontam
from pitwall.llm.words import ALNUM, words


def result(df):
    return {r.row.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()}


def want(docs, items):
    out = {}
    for i, t in docs:
        n, hit, found = benchmark_hits(t, items)
        out[i] = (n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), hit > 0)
    return out


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 200])
def test_equals_brute_force(spark, frame, odd, broadcast_bytes):
    base = dict(odd)
    items = [(1, " ".join(base[5].split()[3:17])), (2, "one TWO"), (3, ""), (4, None), (5, base[40][10:200]), (5, base[41][5:150]),
             (10, "a a a a a a a a a a a a"), (11, "w1")]
    table = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, row string")
    got = decontam.decontaminate(frame(odd), table, broadcast_bytes=broadcast_bytes)
    assert result(got) == want(odd, [(i, t) for i, t in items if t])


def test_empty_tables(spark, frame):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.decontaminate(frame([]), none).collect() == []
    assert result(decontam.decontaminate(frame([(1, "a b")]), none))[1][1:3] == (0, 0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.lists(st.lists(st.integers(0, 3), max_size=25), max_size=4))
def test_index_equals_brute_force(doc, items):
    import pyarrow as pa
    texts = [(k, " ".join(map(str, i))) for k, i in enumerate(items)]
    text = " ".join(map(str, doc))
    mask, found = decontam.Index(texts, 10, 5).hits(words(pa.array([text]), ALNUM).hash)
    n, hit, names = benchmark_hits(text, texts)
    assert (len(alnum(text)), int(mask.sum()), sorted(str(k) for k in found)) == (n, hit, names)
