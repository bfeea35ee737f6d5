import numpy as np
from helpers import smallest_reachable

from pitwall.llm import embed


def brute(rows, threshold=0.93):
    good = {}
    for k, (i, v, label) in enumerate(rows):
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[k] = np.array(v, float)
            good[k] = good[k] / np.abs(good[k]).max()
    links = [(a, b) for a in good for b in good if a < b and rows[a][2] == rows[b][2] and len(good[a]) == len(good[b])
             and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= threshold]
    ids = {k: r[0] for k, r in enumerate(rows)}
    label = smallest_reachable({i for i in ids.values() if i is not None}, [(ids[a], ids[b]) for a, b in links])
    n = [sum(k in x for x in links) for k in range(len(rows))]
    return sorted(((i, n[k], label.get(i), i == label.get(i)) for k, i in ids.items()), key=str)


def rows_of(seed, dim):
    rng = np.random.default_rng(seed)
    rows, base = [], rng.standard_normal((8, dim))
    for k in range(160):
        v = base[rng.integers(8)] + rng.choice([0.0, 0.02, 0.15, 0.25, 0.4, 3.0]) * rng.standard_normal(dim)
        rows.append((int(1000 - k), [float(x) for x in v.astype(np.float32)], int(rng.integers(2))))
    return rows


def got(spark, rows, kind="float", **more):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").selectExpr("*", "1 AS block", "'x' AS rep")
    return sorted((tuple(r) for r in embed.near_duplicates(df, **more).collect()), key=str)


def test_equals_brute_force(spark):
    rows = rows_of(1, 64)
    assert got(spark, rows) == brute(rows)


def test_tiles_and_few_dimensions(spark):
    rows = rows_of(2, 3)
    assert got(spark, rows, tile_rows=7) == brute(rows)


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, v, 0), (3, v, 0), (4, v, 1), (5, v, None), (None, v, 0), (6, None, 0), (7, [0.0, 0.0, 0.0], 0), (8, [], 0),
            (9, [1.0, None, 3.0], 0), (10, [1.0, float("nan"), 3.0], 0), (11, [float("inf"), 1.0, 1.0], 0), (12, [1.0, 2.0], 0), (13, [2.0, 4.0, 6.0], 0)]
    want = sorted([(1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), (13, 3, 1, False), (4, 0, 4, True), (5, 0, 5, True), (None, 0, None, True),
                   *((k, 0, k, True) for k in range(6, 13))], key=str)
    assert got(spark, rows) == want
    assert got(spark, rows[:0]) == []


def test_doubles_of_any_size_and_ids_with_several_vectors(spark):
    rows = [(1, [1e300, 0.0], 0), (2, [1e300, 1e299], 0), (3, [1e-60, 0.0], 0), (4, [0.0, 1e-60], 0), (5, [0.0, 1e-300], 0), (6, [1.0 + 1e-9, 1.0], 0),
            (7, [0.0, -1.0], 1), (7, [1.0, 0.0], 1), (8, [1.0, 0.1], 1), (9, [0.0, -2.0], 1), (10, [0.1, -2.0], 1)]
    assert got(spark, rows, "double") == brute(rows)
