import math
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import fold, lower, spaced, suffix_tree_scores, unigram

from pitwall.llm import suffix_tree


@pytest.mark.parametrize("head_words", [1 << 19, 4, 0])
def test_base_equals_brute_force(frame, odd, head_words):
    docs = [*odd, (None, "one two"), (3, "one two")]
    total, types, counts = unigram(docs)
    rows = suffix_tree.score(frame(docs), head_words=head_words).collect()
    assert len(rows) == len(docs)
    want = {}
    for i, t in docs:
        w = [*spaced(lower(t)), None]
        base = sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (types + 1))) for x in w)
        want[i] = (i is not None and fold(i, 5) == 1, len(w), sum(counts[x] > 0 for x in w), total, base)
    for r in rows:
        held, n, known, train, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, train)
        assert r.base_score == pytest.approx(base) and r.score < 0 and math.isfinite(r.score)


def test_tree_equals_brute_force():
    """Probabilities from the tree's own definition, symbol by symbol, and distributions that sum to one."""
    rng = random.Random(2)
    texts = [" ".join(rng.choice(("ab", "abc", "ba", "cab", "the")) for _ in range(rng.randrange(0, 30))) for _ in range(40)]
    keys, _ = suffix_tree.spelled(pa.array(texts))
    k, n = np.unique(keys, return_counts=True)

    levels = []
    for depth in range(suffix_tree.DEPTH + 1):
        own = k & np.uint64((1 << 8 * (depth + 1)) - 1)
        entries, at = np.unique(own, return_inverse=True)
        counts = np.bincount(at, weights=n)
        contexts, where = np.unique(entries >> np.uint64(8), return_inverse=True)
        levels.append((contexts, np.bincount(where, weights=counts), entries, counts))
    tree = suffix_tree.Tree(levels, 4.0)

    def p(history, symbol):
        out = 1 / suffix_tree.SYMBOLS
        for d in range(suffix_tree.DEPTH + 1):
            context = history[len(history) - d:]
            seen = [b"%s" % (b" " * 5 + t.encode() + (b" \n" if t else b"\n")) for t in texts]
            total = sum(s[j - d:j] == context for s in seen for j in range(5, len(s)))
            if not total:
                break
            both = sum(s[j - d:j] == context and s[j] == symbol for s in seen for j in range(5, len(s)))
            out = (both + 4.0 * out) / (total + 4.0)
        return out

    for history in (b"     ", b"ab ab", b"zz ca"):
        packed = np.array([sum(c << 8 * (5 - j) for j, c in enumerate(history)) | s for s in range(256)], np.uint64)
        got = tree.probability(packed)
        assert got.sum() == pytest.approx(1)
        for s in (32, 97, 98, 10):
            assert got[s] == pytest.approx(p(history, s))
    assert np.allclose(tree.logs(keys), np.log10(tree.probability(keys)), atol=1e-5)
    assert np.allclose(tree.logs(keys), np.log10(tree.probability(keys)), atol=1e-5)  # now from what was kept


def test_retained_contexts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").toPandas().text
    keys, n = np.unique(suffix_tree.spelled(pa.array(docs, pa.string()))[0], return_counts=True)

    def grown(divergence):
        levels, keep = suffix_tree._candidates(keys, n, [], suffix_tree.DEPTH, 64, divergence, 8.0)
        return suffix_tree._close(levels, keep, np.zeros(0, np.uint64))

    few, many = grown(1e5), grown(2.0)
    for levels in (few, many):
        for depth in range(1, suffix_tree.DEPTH + 1):  # every state's suffix is a state
            shorter = levels[depth][0] & np.uint64((1 << 8 * (depth - 1)) - 1)
            assert np.isin(shorter, levels[depth - 1][0]).all()
    assert sum(len(x[0]) for x in few) < sum(len(x[0]) for x in many)


def test_better_than_the_base_on_enough_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    r = suffix_tree.score(docs).where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert r.s > r.b


def test_empty_table(frame):
    assert suffix_tree.score(frame([])).collect() == []


@pytest.mark.parametrize("head_grams", [1 << 20, 500, 0])
def test_scores_are_those_of_the_whole_tree(frame, odd, small, head_grams):
    docs = [*odd, (None, "one two"), *((1000 + i, t) for i, t in small)]
    want = suffix_tree_scores([t for i, t in docs if i is None or fold(i, 5) != 1], [t for _, t in docs])
    got = {r.doc_id: r.score for r in suffix_tree.score(frame(docs), head_grams=head_grams).collect()}
    for (i, _), score in zip(docs, want):
        assert got[i] == pytest.approx(score, rel=1e-5), i


def test_the_bar_does_not_rise_with_the_table(frame):
    """A passage seen nine times is learned alike beside little and beside much other text."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    passage = "qqzx vvkjw xqzzy wwvqx"
    ids = [i for i in range(200) if fold(i, 5) != 1]
    held = next(i for i in range(200) if fold(i, 5) == 1)
    known = [(i, passage) for i in ids[:9]] + [(held, passage)]

    def learned(words):
        docs = [*known, *((i, " ".join(word() for _ in range(words))) for i in ids[12:132])]
        return next(r.score for r in suffix_tree.score(frame(docs)).collect() if r.doc_id == held)

    assert learned(7000) == pytest.approx(learned(20), abs=3)
