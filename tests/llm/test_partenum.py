import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import jaccard_components as brute

from pitwall.llm import partenum


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_equals_brute_force(frame, odd):
    assert result(partenum.jaccard_components(frame(odd).repartition(3))) == brute(odd)


def test_small_table_equals_brute_force(frame, small):
    assert result(partenum.jaccard_components(frame(small))) == brute(small)


def test_repeated_rows_null_ids_and_empty_table(frame):
    same = "a b c d e f g"
    got = partenum.jaccard_components(frame([(3, same), (3, same), (4, same), (None, same)])).collect()
    want = [(3, 3, 3), (3, 3, 3), (4, 3, 3), (None, 3, None)]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == sorted(want, key=str)
    assert partenum.jaccard_components(frame([])).collect() == []


def test_text_broadcast_bound_has_another_way(frame, odd, monkeypatch):
    monkeypatch.setattr(partenum, "BROADCAST_IDS", 0)
    assert result(partenum.jaccard_components(frame(odd))) == brute(odd)


@pytest.mark.parametrize("percent", [75, 80, 95])
def test_similar_sets_share_a_signature(percent):
    rng = random.Random(percent)
    for _ in range(600):
        n = rng.choice((4, 5, 6, 8, 11, 25, 60, 200, 700))
        more = n * (100 - percent) // percent  # as different as they may be: 100 * n >= percent * (n + more)
        left = rng.randrange(more + 1)
        values = [rng.getrandbits(64) for _ in range(n + more)]
        if not more or 100 * n < percent * (n + more):
            continue
        a, b = values[:n + left], values[:n] + values[n + left:]
        one, two = (partenum.signatures(np.array(sorted(s), np.uint64), percent) for s in (a, b))
        assert np.intersect1d(one, two).size, (len(a), len(b), n)


def test_packing_round_trip():
    rng = np.random.default_rng(1)
    for high in (10, 1 << 20, 1 << 62):
        ids = np.sort(rng.integers(-high, high, 1000))
        values = rng.integers(0, 1 << 40, 1000, np.uint64)
        got = partenum.unpack(partenum.pack(ids, values))
        assert (got[0] == ids).all() and (got[1] == values).all()


def family(n, seed=3):
    """Texts of 60 words that share a part of 45 to 58 of them at the start: many near the threshold, on both sides of it."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(60)]
    return [(k, " ".join(base[:cut] + [f"x{k}_{j}" for j in range(60 - cut)])) for k in range(n) for cut in [rng.randrange(45, 59)]]


@pytest.mark.parametrize("block", [4, 1024])
def test_second_round_in_small_blocks_equals_brute_force(frame, monkeypatch, block):
    monkeypatch.setattr(partenum, "BLOCK", block)
    monkeypatch.setattr(partenum, "TASK_ROWS", 16)
    rows = family(40) + [(k + 100, t.replace("w", "v")) for k, t in family(25, seed=4)]
    assert result(partenum.jaccard_components(frame(rows))) == brute(rows)


def test_rows_of_the_second_round_grow_with_the_documents():
    """Documents that are all candidates of each other, in three groups: no row a pair, and of the links only those that join components."""
    made = []
    for m in (20, 80):
        common = np.arange(300, dtype=np.uint64) << np.uint64(55)
        sets = [np.unique(np.concatenate((common, np.arange(1, 31 if k % 2 else 91, dtype=np.uint64) * np.uint64(1 << 20) + np.uint64(k << 40)))) for k in range(m)]
        counts = [np.bincount((s >> np.uint64(57)).astype(np.int64), minlength=128).astype(np.uint8).tobytes() for s in sets]
        zero, ids, n = np.zeros(m, np.int32), np.arange(m), np.array([len(s) for s in sets])
        group = lambda g: pa.table({"g": np.full(m, g), "low": zero, "high": zero, "i": zero, "id": ids, "n": n, "c": ids, "hub": ids, "task": np.zeros(m, np.int64), "counts": counts})
        marked = partenum.with_partners(80)(pa.concat_tables([group(g) for g in range(3)]))
        held = pa.table({"id": ids, "s": [(v := s >> np.uint64(16)).astype(np.uint32).tobytes() + (v >> np.uint64(32)).astype(np.uint16).tobytes() for s in sets]})
        links = partenum.tested(80)(marked, held)
        assert set(links.column("a").to_pylist()) <= set(ids.tolist()) and links.num_rows < m
        made.append(marked.num_rows)
    assert made[0] == 20 and made[1] == 80
