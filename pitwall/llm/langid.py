"""Language identification by word-first backoff.

The model has, for each language, log frequencies of words and of character n-grams of 4 down to 1 letters. A text's
words are lower-cased runs of letters. A known word adds its log frequency per language; an unseen word backs off to
its longest n-grams of which at least one is known (padded with its borders), and adds their mean. The language with the largest sum
wins; the score is its posterior under the mean evidence of a word, so that long texts do not all score 1.

Learning: languages, words and n-grams come from rows with a language and a text, outside the held-out fold
(crc32 of the id as text modulo ``folds`` equal to ``held``). At most about ``sample_rows`` such rows are learned
from (the documented bound of the classifier's sample), chosen by a hash of the id, an equal share of every language
that has so many, so a rare language is learned beside frequent ones. They are counted in Spark, and of each language and
length the most frequent entries are kept, cut at a power of two of the count so that at most ``max_words`` or
``max_grams`` are; that bounds the model that is broadcast. Prediction covers every row and whole texts and reads the
text only.

Defined cases: null texts and texts without a letter are ``und`` with score 0; a null id is neither learned from nor
held out; without a learnable row every text is ``und``; ties go to the language that sorts first; repeated rows are
learned from and judged each; an empty table gives an empty result; texts of any length are read whole, in lists of
bounded size; the input's columns travel in a struct, so none can clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import arrow_map, checkpointed, cut, steps

LETTERS = regex.compile(r"\p{L}+")
ORDERS = (4, 3, 2, 1)
UNKNOWN = "und"
#: Words whose scores a worker keeps.
KEPT_WORDS = 1 << 17
#: Letters of the longest word that is kept; longer ones are scored each time.
KEPT_LETTERS = 100
#: Characters that one step of a long text covers; cut between words.
STRETCH = 1 << 20


def in_fold(id_col: Column, folds: int, held: int) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % folds == held, F.lit(False))


def letters(text: str) -> Iterator[list[str]]:
    """The words of a text, in lists of bounded size; texts of any length are lower-cased first, then cut."""
    text = text.lower()
    if len(text) <= STRETCH:
        yield LETTERS.findall(text)
        return
    found = []
    for m in LETTERS.finditer(text):
        found.append(m.group())
        if len(found) >= STRETCH // 8:
            yield found
            found = []
    yield found


def padded_grams(word: str, n: int) -> list[str]:
    if n == 1:
        return list(word)
    word = f"_{word}_"
    return [word[k:k + n] for k in range(len(word) - n + 1)]


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str, folds: int, held: int, sample_rows: int,
          max_words: int, max_grams: int) -> tuple[list[str], list[tuple[int, str, str, int]], dict]:
    """Languages; (length, 0 for words; entry; language; count) of the entries kept; totals by (length, language)."""
    usable = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
                        & ~in_fold(F.col(id_col), folds, held))
    lang = F.col(lang_col).cast("string")
    numbers = {r[0]: r[1] for r in usable.groupBy(lang.alias("lang")).count().collect()}  # a row for each language of the model
    if not numbers:
        return [], [], {}
    spark = docs.sparkSession
    share = sample_rows / len(numbers)
    rates = spark.createDataFrame([(k, int(min(1.0, share / n) * (1 << 20) + 0.999)) for k, n in numbers.items()], "lang string, rate int")
    at = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 20))
    sample = usable.select(lang.alias("lang"), F.col(text_col).alias("text"), at.alias("at")) \
        .join(F.broadcast(rates), "lang").where(F.col("at") < F.col("rate")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, str], Counter] = {}

        def out() -> pa.RecordBatch:
            rows = [(k, e, lang, c) for (k, lang), own in counts.items() for e, c in own.items()]
            k, e, lang, c = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(k, pa.int32()), pa.array(e, pa.string()), pa.array(lang, pa.string()), pa.array(c, pa.int64())],
                names=["length", "entry", "lang", "n"])

        for step in steps(batches, "text"):
            for lang, text in zip(step.column("lang").to_pylist(), step.column("text").to_pylist()):
                for found in letters(text):
                    own = counts.setdefault((0, lang), Counter())
                    local = Counter(found)
                    own.update(local)
                    for k in ORDERS:
                        own = counts.setdefault((k, lang), Counter())
                        for word, c in local.items():
                            for g in padded_grams(word, k):
                                own[g] += c
            if sum(map(len, counts.values())) > 1 << 18:
                yield out()
                counts.clear()
        if any(counts.values()):
            yield out()

    totals = arrow_map(sample, count, "length int, entry string, lang string, n long") \
        .groupBy("length", "entry", "lang").agg(F.sum("n").alias("n"))
    totals = checkpointed(totals)
    power = F.floor(F.log2(F.col("n").cast("double") + 0.25))
    sizes: dict[tuple[int, str], dict[int, tuple[int, int]]] = {}
    for k, own, p, entries, n in totals.groupBy("length", "lang", power.alias("p")).agg(F.count("*"), F.sum("n")).collect():
        sizes.setdefault((k, own), {})[p] = entries, n
    cuts = spark.createDataFrame([(k, own, 1 << cut(by, max_grams if k else max_words)) for (k, own), by in sizes.items()],
                                 "length int, lang string, least long")
    kept = totals.join(F.broadcast(cuts), ["length", "lang"]).where(F.col("n") >= F.col("least"))
    rows = [tuple(r) for r in kept.select("length", "entry", "lang", "n").collect()]
    sums = {key: (sum(n for _, n in by.values()), sum(c for c, _ in by.values())) for key, by in sizes.items()}
    return sorted({own for _, own in sums}), rows, sums


class Model:
    """Log frequencies per language, by word and by n-gram."""

    def __init__(self, langs: list[str], rows, sums: dict):
        self.langs = langs
        place = {lang: k for k, lang in enumerate(langs)}
        counts: dict[int, dict[str, np.ndarray]] = {k: {} for k in (0, *ORDERS)}
        for k, entry, lang, n in rows:
            counts[k].setdefault(entry, np.zeros(len(langs)))[place[lang]] = n
        self.tables = {}
        for k, own in counts.items():
            total, types = (np.array([sums.get((k, lang), (0, 0))[j] for lang in langs], float) for j in (0, 1))
            self.tables[k] = {e: np.log((c + 0.5) / (total + 0.5 * (types + 1))) for e, c in own.items()}
        self.nothing = np.zeros(len(langs))
        self.kept: dict[str, int] = {}
        self.rows = np.empty((KEPT_WORDS, len(langs)))

    def word(self, word: str) -> np.ndarray:
        known = self.tables[0].get(word)
        if known is not None:
            return known
        for n in ORDERS:
            table = self.tables[n]
            found = [v for g in padded_grams(word, n) if (v := table.get(g)) is not None]
            if found:
                return sum(found) / len(found)
        return self.nothing

    def evidence(self, words: list[str]) -> np.ndarray:
        """A row for each of at most ``KEPT_WORDS`` different words; known ones are taken from the kept rows."""
        at = [self.kept.get(w, -1) for w in words]
        new = at.count(-1)
        if len(self.kept) + new > KEPT_WORDS:
            self.kept.clear()
            at, new = [-1] * len(words), len(words)
        if not new:
            return self.rows[at]
        free, long = len(self.kept), {}
        for k, w in enumerate(words):
            if at[k] < 0:
                if len(w) > KEPT_LETTERS:
                    long[k] = self.word(w)
                    at[k] = 0
                    continue
                self.kept[w] = at[k] = free
                self.rows[free] = self.word(w)
                free += 1
        out = self.rows[at]
        for k, v in long.items():
            out[k] = v
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        total, n = self.nothing.copy(), 0
        for found in letters(text or ""):
            counts = Counter(found)
            words = list(counts)
            for k in range(0, len(words), KEPT_WORDS):
                part = words[k:k + KEPT_WORDS]
                total += np.fromiter(map(counts.__getitem__, part), float, len(part)) @ self.evidence(part)
            n += len(found)
        if not n or not self.langs:
            return UNKNOWN, 0.0
        mean = total / math.sqrt(n)
        weights = np.exp(mean - mean.max())
        best = int(np.argmax(total))
        return self.langs[best], float(weights[best] / weights.sum())


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4,
             held: int = 2, sample_rows: int = 20_000, max_words: int = 20_000, max_grams: int = 20_000) -> DataFrame:
    """``docs`` with held_out, lang_pred and score; the model is learned when this is called."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(learn(docs, id_col, text_col, lang_col, folds, held, sample_rows, max_words, max_grams))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*model.value)
        for step in steps(batches, "text"):
            found = [m.predict(t) for t in step.column("text").to_pylist()]
            out = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*step.columns[1:], *out], names=[*step.schema.names[1:], "lang_pred", "lang_score"])

    # the input's columns travel in one struct, so that no name of theirs can clash
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       in_fold(F.col(id_col), folds, held).alias("held_out"))
    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType
    schema = StructType([StructField("row", docs.schema), StructField("held_out", BooleanType()),
                         StructField("lang_pred", StringType()), StructField("lang_score", DoubleType())])
    return arrow_map(rows, run, schema)


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every whole document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return identify(docs).select("row.doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))
