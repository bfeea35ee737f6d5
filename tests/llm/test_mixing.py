from collections import defaultdict

from helpers import spaced

from pitwall.llm import mixing


def filled(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    budget, capped = share * sum(sizes.values()), {}
    while True:  # the excess is dealt again until none is above
        free = [s for s in names if s not in capped]
        level = (budget - sum(capped.values())) / max(1, sum(weight[s] for s in free))
        above = [s for s in free if weight[s] * level >= epochs * sizes[s]]
        if not above:
            return {**capped, **{s: weight[s] * level for s in free}}
        capped |= {s: epochs * sizes[s] for s in above}


def test_targets_and_budgets(spark):
    rows = [(k, " ".join(["w"] * (k % 17)), "src0" if k % 3 else f"src{k % 11}") for k in range(900)]
    rows += [(2000, None, "src0"), (2001, "a b", None), (None, "x y z", "src1"), (2003, "", "only empty"), (5, "a b c d e", "src0"), (5, "a b c d e", "src0")]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, source string, key string, part int")
    got = mixing.mix(df, range_rows=16).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    assert sorted(r.size for r in got) == sorted(len(spaced(t)) for _, t, _ in rows)
    assert all(r.source_size == sizes[r.source] for r in got)
    want = filled(sizes)
    assert all(abs(target[s] - want[s]) < 1e-6 for s in sizes)
    assert all(taken[s] == int(target[s]) for s in sizes)
    again = mixing.mix(df.repartition(5), range_rows=64).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []


def test_native(spark):
    df = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    plan = mixing.mix(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
