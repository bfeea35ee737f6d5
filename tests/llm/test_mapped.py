"""License scan, token counts, language ID: operators that judge each row by itself."""

import pytest
from helpers import alnum, fold
from pyspark.sql import functions as F

from pitwall.llm import langid, license, tokens


def brute_base(text):
    w = alnum(text)
    places = [(k, label) for phrase, label in license.BASE for k in range(len(w)) if w[k:k + len(phrase.split())] == phrase.split()]
    starts = [k for k, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_base_places(frame, odd):
    docs = [*odd, (200, "CC-BY cc by, cc  by cc"), (201, "all rights, RESERVED. General Public License general public"), (202, "ccé by")]
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in license.scan_licenses(frame(docs)).collect()}
    assert got == {i: brute_base(t) for i, t in docs}
    assert license.scan_licenses(frame([])).collect() == []


@pytest.mark.parametrize("text,labels", [
    ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc"),
    ("Released under the MIT License.", "mit"),
    ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
    ("All rights reserved.", "reserved"),
    ("GNU Lesser General Public License version 2.1", "gpl,lgpl-2.1"),
    ("It is a permit of the admitted limit.", ""),
])
def test_labels(text, labels):
    assert license.scan(text.encode())[5] == labels


def test_suppression_keeps_no_interval_within_another():
    text = license.normalised(b"licensed under the terms of the gnu general public license version 2 or the mit license; see the mit license")
    kept = license.detections(text)
    assert len(license.rules()) > 200
    for k, (a, b, _) in enumerate(kept):
        assert not any(x <= a and b <= y for x, y, _ in kept[:k])
    assert [r.label for _, _, r in kept][0] == "gpl-2.0"


PATH = tokens.vocabulary_path("byte_bpe_50k.json")


def library(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    return [len(e.ids) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


TEXTS = ["<|endoftext|>x <|endoftext|>", "  \n\n  a", "a" * 3000, "ab" * 500 + "    " * 300, "日本語テキスト😀😀", "é" * 500, "\x00\x01",
         "don't we'll 123456 !!!???---====", "xyzzy" * 800, "tab\t\tand  spaces   ", "<|endoftext", "Ünïcödé ǅ ﬁ ​　x"]


def test_counts_equal_the_library(frame, odd, small):
    docs = [*odd, *((1000 + i, t) for i, t in small), *enumerate(TEXTS, 5000)]
    got = {r.doc_id: r for r in tokens.count_tokens(frame(docs), PATH, 64).collect()}
    for (i, t), n in zip(docs, library([t for _, t in docs])):
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 64), t
    assert tokens.count_tokens(frame([]), PATH, 64).collect() == []


def test_every_prefix_and_budget():
    v = tokens.vocabulary(PATH)
    for text in TEXTS[4:9]:
        p = tokens.Prefixes(v, text)
        assert p.tokens(1 << 40) == v.count(text)
        if " " not in text and "'" not in text:  # a piece's prefix is a text of its own
            ends = [len(text[:k].encode()) for k in range(1, min(len(text), 60))]
            assert [p.tokens(e) for e in ends] == library([text[:k] for k in range(1, len(ends) + 1)])
        for budget in (0, 1, 7):
            assert p.tokens(len(p.fit(budget).encode())) <= budget


def test_fit_bytes_needs_no_second_encoding(frame, small):
    texts = dict(small)
    rows = tokens.count_tokens(frame(small), PATH, 64).where("over_limit").collect()
    cut = [texts[r.doc_id].encode()[:r.fit_bytes].decode() for r in rows]
    assert rows and all(n <= 64 for n in library(cut))


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("lang_pred", F.lit("clash")).withColumn("row", F.lit(1))
    rows = langid.identify(docs).select("row.doc_id", "row.lang", "held_out", "lang_pred", "lang_score").collect()
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.lang_score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_language_odd_rows(spark):
    rows = [(1, "the cat", "en"), (2, "der hund", "de"), (3, None, "en"), (4, "123 !?", "en"), (5, "", None), (None, "the", "en"),
            (7, "the the", None), (8, "the dog", "en"), (9, "die katze", "de"), (9, "die katze", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [(r.row.doc_id, r.held_out, r.lang_pred, r.lang_score) for r in langid.identify(df).collect()]
    assert len(got) == len(rows)
    for (i, held, lang, score), (_, text, _) in zip(got, rows):
        assert (lang == "und" and score == 0) == (text is None or not any(c.isalpha() for c in text))
        assert held == (i is not None and fold(i, 4) == 2)
    empty = langid.identify(df.where("false"))
    assert empty.collect() == []
    unlabelled = langid.identify(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def test_language_of_long_letter_runs():
    """Runs of any length back off to their n-grams, and are not kept."""
    rows = [(0, "the", "en", 9), (0, "der", "de", 9), (4, "_the", "en", 9), (4, "nder", "de", 9), (1, "w", "en", 9), (1, "z", "de", 9)]
    model = langid.Model(["de", "en"], rows, {(k, lang): (9, 1) for k in (0, 1, 4) for lang in ("de", "en")})
    for n in (30, 101, 5000):
        assert model.predict("w" * n)[0] == "en" and model.predict("z" * n)[0] == "de"
        assert model.predict("w" * n)[1] == pytest.approx(model.predict("w" * 30)[1])
        assert model.predict("the " + "x" * 500 + "nder" * 300)[0] == model.predict("the xnder")[0]
    assert max(map(len, model.kept)) <= 100


def forms(parsed):
    """Texts of every alternative of a parsed regex, optional parts without and with."""
    out = [""]
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            own = [chr(arg)]
        elif name == "NOT_LITERAL":
            own = ["q"]
        elif name == "IN":
            own = [chr(arg[0][1] if str(arg[0][0]) == "LITERAL" else arg[0][1][0] if str(arg[0][0]) == "RANGE" else ord("q"))]
        elif name == "BRANCH":
            own = [f for branch in arg[1] for f in forms(branch)]
        elif name == "SUBPATTERN":
            own = forms(arg[3])
        elif name == "MAX_REPEAT":
            once = forms(arg[2])
            own = [""] * (arg[0] == 0) + [f * max(arg[0], 1) for f in once]
        else:
            raise ValueError(name)
        out = [a + b for a in out for b in own]
    return out


def test_every_form_of_a_rule_passes_the_prefilter():
    from re import _parser

    parts = [(key, name) for _, key, name in license.NAMES] + [(key, pattern) for _, _, key, pattern, _ in license.SINGLE]
    for keys, pattern in parts:
        for form in forms(_parser.parse(pattern)):
            assert set(keys.split()) & set(form.split()), (keys, form)


@pytest.mark.parametrize("text,labels", [
    ("the FreeBSD license", "bsd-2-clause"),
    ("the end user license agreement", "end-user-agreement"),
    ("noncommercial use only", "non-commercial"),
    ("for noncommercial use", "non-commercial"),
    ("as is without warranties of any kind", "warranty-disclaimer"),
    ("licenced under it", "license-mention"),
    ("it may not be copied here", "proprietary"),
])
def test_labels_of_forms_without_the_first_keyword(text, labels):
    assert license.scan(text.encode())[5] == labels
    assert license.scan(text.encode())[6] > 0


def test_language_words_are_cut_alike_at_every_size(monkeypatch):
    text = "\u0130stanbul I\u0307zmir \u03a3\u0391\u03a3 Stra\u00dfe " * 3
    whole = [w for part in langid.letters(text) for w in part]
    monkeypatch.setattr(langid, "STRETCH", 16)
    assert [w for part in langid.letters(text) for w in part] == whole


def test_language_evidence_of_kept_and_long_words(monkeypatch):
    rows = [(0, "ab", "x", 5), (0, "cd", "y", 3), (1, "a", "x", 9), (1, "c", "y", 9), (1, "z", "y", 2)]
    sums = {(0, "x"): (5, 1), (0, "y"): (3, 1), (1, "x"): (9, 1), (1, "y"): (11, 2)}
    text = "ab cd " + "z" * 150 + " aa cc ab ad"
    whole = langid.Model(["x", "y"], rows, sums)
    monkeypatch.setattr(langid, "KEPT_WORDS", 3)
    few = langid.Model(["x", "y"], rows, sums)
    a, b = whole.predict(text), few.predict(text)
    assert a[0] == b[0] and abs(a[1] - b[1]) < 1e-12
    assert abs(whole.evidence(["z" * 150])[0] - whole.word("z" * 150)).max() == 0
