"""Hard negatives against brute force."""

import numpy as np
import pytest

from pitwall.llm.negatives import mine, products, spanning_tree, walked

SCHEMA = "vec_id long, embedding array<{}>, label int, id string, anchor int, scores string, v double"


def brute(rows, every=100):
    good = []
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not np.isfinite(x) or not np.isfinite(256 * x) for x in v):
            continue
        good.append((i, label, tuple(int(np.floor(256 * x)) for x in v), v))
    out, seen = [], set()
    for i, label, a, raw in good:
        if i % every or (i, label, tuple(raw)) in seen:
            continue
        seen.add((i, label, tuple(raw)))
        own = [(-sum(x * y for x, y in zip(a, b)), j, other) for j, other, b, _ in good if len(b) == len(a)]
        for top, j, other in sorted((o for o in own if o[2] == label and o[1] != i))[:5]:
            window = sorted(o for o in own if o[2] != label and 80 * -top <= 100 * -o[0] <= 100 * -top)
            out += [(i, j, rank, k, -top, -score) for rank, (score, k, _) in enumerate(window[:5], 1)]
    return sorted(out)


def result(spark, rows, kind="float", **more):
    df = spark.createDataFrame([(*r, "x", 1, "y", 2.0) for r in rows], SCHEMA.format(kind))
    return sorted(tuple(r) for r in mine(df, **more).collect())


def clustered(n, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dim))
    v = centres[rng.integers(0, 6, n)] + 0.2 * rng.standard_normal((n, dim))
    v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
    return [(k, [float(x) for x in row], int(rng.integers(0, 3))) for k, row in enumerate(v)]


@pytest.mark.parametrize("sizes", [{}, {"group_anchors": 7, "chunk_rows": 40}])
def test_matches_brute_force(spark, sizes):
    rows = clustered(600)
    rows += [(1000 + 5 * k, rows[k][1], 1) for k in range(40)]                       # copies: ties
    rows += [(None, rows[0][1], 1), (2000, None, 1), (2100, rows[0][1], None), (2200, [], 1), (2300, [0.0] * 8, 1),
             (2400, [None] + [1.0] * 7, 0), (2500, [float("nan")] * 8, 0), (2600, [1.0, 2.0], 0), (2601, [2.0, 1.0], 0),
             (2602, [1.5, 1.0], 1), (-100, rows[3][1], 2)]
    assert result(spark, rows, every=20, **sizes) == brute(rows, 20)


def test_repeated_rows(spark):
    rows = clustered(120, seed=2)
    rows += rows[:30] + [(20, rows[50][1], 1)]                                        # equal rows, and one id with two vectors
    assert result(spark, rows, every=20) == brute(rows, 20)


def test_numbers_beyond_doubles(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rng.integers(-2**20, 2**20, 4) + rng.integers(0, 256, 4) / 256], k % 2) for k in range(60)]
    rows += [(60, [1e308] * 4, 0)]
    assert result(spark, rows, "double", every=10) == brute(rows, 10)


def test_empty_table(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, [1.0], 1)]) == []


def test_bounds_spare_candidates():
    """Near an anchor's parent few candidates are scored again, and all that matter are."""
    rng = np.random.default_rng(4)
    anchors = np.floor(256 * (rng.standard_normal(16) + 0.001 * rng.standard_normal((32, 16))))
    rows = np.floor(256 * rng.standard_normal((4000, 16)))
    norms = np.linalg.norm(rows, axis=1)
    tree = spanning_tree(anchors)
    assert len(tree) == 32 and sorted(a for a, _, _ in tree) == list(range(32)) and tree[0][1] == -1
    scored = 0
    for place, some, scores in walked(anchors, rows, norms, lambda p, low, high: np.flatnonzero(high >= 250_000)):
        exact = products(rows, norms, anchors[place])
        assert set(np.flatnonzero(exact >= 250_000)) <= set(some)
        assert (exact[some] == scores).all()
        scored += len(some)
    assert scored < 0.2 * len(rows) * len(anchors)
