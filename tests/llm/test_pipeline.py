"""Every stage against its brute-force form, on what the stage before it kept."""

from helpers import alnum, benchmark_hits, jaccard_components, spaced, without_repeats

import corpus_pipeline
from pitwall.llm.shared import fresh_path

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = spark.createDataFrame([(10_001, None, "en", "s", 0), (10_002, "12 34 !", "en", "s", 7), (10_003, "the only one", None, None, 12)], docs.schema)
    docs, columns = docs.unionByName(extra), docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "substring_dedup", "decontamination", "mixing"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        texts = [(i, r.text) for i, r in before.items()]
        path = fresh_path(spark, "test-stage")
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        after = {r.doc_id: r for r in docs.collect()}
        if name != "mixing":
            assert docs.columns == columns
        if name == "language_id":
            assert set(before) - set(after) == {10_001, 10_002}
            assert all(r.lang in {"en", "de", "fr", "es"} for r in after.values())
            assert all(r.text == before[i].text for i, r in after.items())
        elif name == "near_duplicates":
            assert set(after) == {i for i, (_, c) in jaccard_components(texts).items() if c == i}
        elif name == "substring_dedup":
            assert set(after) == set(before)
            for i, (_, n_removed, kept) in without_repeats(texts).items():
                assert after[i].text == (kept if n_removed else before[i].text)
                assert after[i].n_chars == (len(kept) if n_removed else before[i].n_chars)
        elif name == "decontamination":
            assert set(after) == {i for i, t in texts if not benchmark_hits(t, items)[1]} and len(after) < len(before)
        else:
            assert {i: r.size for i, r in after.items()} == {i: len(spaced(t)) for i, t in texts}
            assert sum(r.taken for r in after.values()) > sum(r.size for r in after.values())
    assert alnum("A-b") == ["a", "b"]


def test_run_is_the_stages_in_order(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert {"doc_id", "size", "source_size", "target", "taken"} <= set(got.columns) and got.count() > 100
    again = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, again.collect()), key=str)


def stages_of(spark, docs):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        path = fresh_path(spark, "test-odd-stage")
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, docs))
    return out


def test_empty_and_null_only_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for rows in ([], [(1, None, "en", "a", 0), (2, None, None, None, None), (None, None, "en", "a", 0), (3, "", "en", "a", 0)]):
        for name, docs in stages_of(spark, spark.createDataFrame(rows, schema)):
            assert docs.count() == 0, name


def test_null_ids_and_columns_whose_names_clash(spark):
    text = "the cat and the dog went to the house by the river and then they came back home again"
    rows = [(k, f"{text} number {k} " + " ".join(f"w{k}x{j}" for j in range(60)), "en", "s", 1, "r", 2, "c", 0.5, "t") for k in (1, 2, 3)]
    rows += [(None, rows[0][1], "en", "s", 1, "r", 2, "c", 0.5, "t")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, chunk int, id string, score double, lang_pred string"
    stages = stages_of(spark, spark.createDataFrame(rows, schema))
    for name, docs in stages[:-1]:
        assert docs.columns == [c.split()[0] for c in schema.split(", ")] and docs.count() == 4, name
        assert {r.row for r in docs.collect()} == {"r"}
    assert stages[-1][1].count() == 4
