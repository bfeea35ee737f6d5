"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct runs of 2 to 5 characters of its lower-cased form, hashed into 2^18 buckets. Over all
labelled training rows Spark counts in how many toxic and clean texts each bucket occurs; the logarithm of the ratio
of the smoothed shares is the bucket's scale. A logistic regression with a squared penalty is then fitted on the scaled
features (each text's divided by the root of their number) and scores every whole text.

Learning: rows outside the held-out fold (crc32 of the id as text modulo ``folds`` equal to ``held``) that have a
label of 0 or 1. The ratios count all of them. The regression's weights are fitted in one task on a sample of at most about
``sample_rows`` rows, half of them of each label where there are enough, chosen by a hash of the id (the documented
bound of the classifier's sample); the intercept is set back to the labels' true shares. Labels are joined by a
broadcast behind a check of their size, otherwise by a shuffle.

Defined cases: a null text counts as an empty one; texts without a run of two characters (empty ones too) score by the
intercept alone; a null id is neither learned from nor held out; of several labels of one id the larger counts; other
labels than 0 and 1 are ignored; repeated rows count each; without rows of both labels every text scores the toxic share,
0.5 when there are none; an empty table gives an empty result; texts of any length are scored whole, in stretches; the
input's columns travel in a struct, so none can clash.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from pitwall.operators.scope import sized_broadcast

from .langid import in_fold
from .shared import arrow_map, checkpointed, steps
from .words import mixed

BITS = 18
ORDERS = (2, 3, 4, 5)
#: Characters hashed at a time.
STRETCH = 1 << 20
#: Ranges of buckets in which counts travel.
RANGES = 64
#: Weight of the squared penalty, and what a text's features are scaled to.
PENALTY, SCALE = 1.0, 10.0
_FACTORS = np.random.Generator(np.random.PCG64(77)).integers(1, 1 << 63, max(ORDERS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Features:
    """The distinct buckets of texts; holds one scratch table."""

    def __init__(self):
        self.last = np.zeros(1 << BITS, np.int64)

    def of(self, text: str | None) -> np.ndarray:
        text = (text or "").lower()
        if len(text) <= STRETCH:
            return self.distinct(hashed(text))
        found = [self.distinct(hashed(text[k:k + STRETCH + ORDERS[-1] - 1])) for k in range(0, len(text), STRETCH)]
        return self.distinct(np.concatenate(found))

    def distinct(self, buckets: np.ndarray) -> np.ndarray:
        """Every bucket once, where it occurs last: no sort."""
        place = np.arange(len(buckets))
        self.last[buckets] = place
        return buckets[self.last[buckets] == place]


def hashed(text: str) -> np.ndarray:
    """The bucket of every n-gram."""
    letters = mixed(np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1))
    out, total = [], np.zeros(len(letters), np.uint64)
    for n in range(1, ORDERS[-1] + 1):
        if len(letters) < n:
            break
        total = total[:len(letters) - n + 1] + letters[n - 1:] * _FACTORS[n - 1]
        if n in ORDERS:
            out.append((mixed(total) >> np.uint64(64 - BITS)).astype(np.int32))
    return np.concatenate(out) if out else np.zeros(0, np.int32)


def ratios(counts: np.ndarray) -> np.ndarray:
    """Of every bucket, the log ratio of its smoothed shares among toxic and clean texts' features; 0 where it never occurs."""
    shares = (counts + 1.0) / (counts + 1.0).sum(axis=1, keepdims=True)
    return np.where(counts.any(axis=0), np.log(shares[1]) - np.log(shares[0]), 0.0)


def fitted(texts: list[np.ndarray], toxic: np.ndarray, ratio: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Weights of the scaled features and the intercept: penalised logistic regression by limited-memory quasi-Newton steps."""
    sizes = np.array([len(t) for t in texts])
    buckets = np.concatenate([np.zeros(0, np.int32), *texts])
    start = np.cumsum(sizes) - sizes
    value = ratio[buckets] * np.repeat(SCALE / np.sqrt(np.maximum(sizes, 1)), sizes)
    sign = np.where(toxic > 0, -1.0, 1.0)

    def cost(x: np.ndarray) -> tuple[float, np.ndarray]:
        sums = np.concatenate(([0.0], np.cumsum(value * x[buckets])))
        z = sums[start + sizes] - sums[start] + x[-1]
        slope = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - toxic
        grad = np.bincount(buckets, weights=value * np.repeat(slope, sizes), minlength=len(ratio))
        weights = x[:-1]
        return (float(np.logaddexp(0, sign * z).sum() + PENALTY / 2 * weights @ weights),
                np.append(grad + PENALTY * weights, slope.sum()))

    x = np.zeros(len(ratio) + 1)
    f, g = cost(x)
    recent: deque = deque(maxlen=8)
    for _ in range(rounds):
        step, back = -g, []
        for s, y in reversed(recent):
            back.append(s @ step / (y @ s))
            step = step - back[-1] * y
        step = step * (recent[-1][0] @ recent[-1][1] / (recent[-1][1] @ recent[-1][1]) if recent else 1 / max(1.0, float(np.linalg.norm(g))))
        for (s, y), a in zip(recent, reversed(back)):
            step = step + s * (a - y @ step / (y @ s))
        length, falls = 1.0, float(g @ step)
        while True:
            new, (fn, gn) = x + length * step, cost(x + length * step)
            if fn <= f + 1e-4 * length * falls or length < 1e-6:
                break
            length /= 2
        done = f - fn < 1e-6 * abs(f)
        if (gn - g) @ (new - x) > 1e-12:
            recent.append((new - x, gn - g))
        x, f, g = (new, fn, gn) if fn <= f else (x, f, g)
        if done:
            break
    return x[:-1], float(x[-1])


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, toxic, picked) -> part, toxic, blob: a range's counts of texts by bucket, or (part -1) a picked text's buckets."""
    features, counts = Features(), np.zeros((2, 1 << BITS), np.int32)

    def out(part: list[int], toxic: list[int], blob: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(toxic, pa.int32()), pa.array(blob, pa.binary())],
                                          names=["part", "toxic", "blob"])

    for step in steps(batches, "text"):
        labels, picks, blobs = [], [], []
        for text, toxic, picked in zip(step.column("text"), step.column("toxic").to_pylist(), step.column("picked").to_pylist()):
            own = features.of(text.as_py())
            counts[toxic][own] += 1
            if picked:
                picks.append(-1)
                labels.append(toxic)
                blobs.append(own.tobytes())
        if picks:
            yield out(picks, labels, blobs)
    for toxic in (0, 1):
        parts = counts[toxic].reshape(RANGES, -1)
        some = np.flatnonzero(parts.any(axis=1)).tolist()
        if some:
            yield out(some, [toxic] * len(some), [parts[p].tobytes() for p in some])


def added(table: pa.Table) -> pa.Table:
    """The sum of one range's counts, as 64-bit numbers."""
    total = np.zeros((1 << BITS) // RANGES, np.int64)
    for blob in table.column("blob").to_pylist():
        total += np.frombuffer(blob, np.int32)
    return pa.table({"part": table.column("part")[:1], "toxic": table.column("toxic")[:1], "blob": pa.array([total.tobytes()], pa.binary())})


def learn(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int, held: int, sample_rows: int,
          broadcast_rows: int | None) -> tuple[np.ndarray, float]:
    """The weight of every bucket, its ratio included, and the intercept."""
    known = F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~in_fold(F.col("id"), folds, held)
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where(known) \
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
    numbers = {r[0]: r[1] for r in marks.groupBy("toxic").count().collect()}  # two rows at most
    n = [numbers.get(k, 0) for k in (0, 1)]
    rate = [min(1.0, sample_rows / 2 / max(k, 1)) for k in n]
    at = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("sample")), F.lit(1 << 20))
    texts = docs.where(F.col(id_col).isNotNull() & ~in_fold(F.col(id_col), folds, held)) \
        .select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(sized_broadcast(marks, broadcast_rows), "id").select(
        "text", "toxic", (at < F.when(F.col("toxic") == 1, int(rate[1] * (1 << 20) + 0.999)).otherwise(int(rate[0] * (1 << 20) + 0.999))).alias("picked"))
    found = checkpointed(arrow_map(rows, counted, "part int, toxic int, blob binary"))
    counts = np.zeros((2, RANGES, (1 << BITS) // RANGES), np.int64)
    sums = found.where("part >= 0").groupBy("part", "toxic").applyInArrow(added, "part int, toxic int, blob binary")
    for part, toxic, blob in sums.toLocalIterator():  # of fixed size: two counts a bucket
        counts[toxic][part] = np.frombuffer(blob, np.int64)
    counts = counts.reshape(2, -1)
    shared = docs.sparkSession.sparkContext.broadcast(ratios(counts))

    def fit(table: pa.Table) -> pa.Table:
        toxic, blobs = table.column("toxic").to_pylist(), table.column("blob").to_pylist()
        if len(set(toxic)) < 2:
            return pa.table({"weights": pa.array([], pa.binary()), "intercept": pa.array([], pa.float64())})
        order = sorted(range(len(blobs)), key=lambda k: (toxic[k], blobs[k]))  # sums of doubles in one order
        weights, intercept = fitted([np.frombuffer(blobs[k], np.int32) for k in order], np.array([float(toxic[k]) for k in order]), shared.value)
        return pa.table({"weights": pa.array([(weights * shared.value).tobytes()], pa.binary()), "intercept": [intercept]})

    # one task: the sample's bound is its bound
    model = found.where("part = -1").groupBy("part").applyInArrow(fit, "weights binary, intercept double").first()
    shared.unpersist()
    if model is None:  # not both labels: their share alone
        share = min(max(n[1] / sum(n), 1e-6), 1 - 1e-6) if sum(n) else 0.5
        return np.zeros(1 << BITS), float(np.log(share / (1 - share)))
    return np.frombuffer(model["weights"]), model["intercept"] - float(np.log(rate[1] / rate[0]))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                   folds: int = 5, held: int = 0, sample_rows: int = 4096, broadcast_rows: int | None = None) -> DataFrame:
    """The rows of ``docs`` as a struct ``row``, with held_out, score and predicted; the model is learned when this is called."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, id_col, text_col, label_col, folds, held, sample_rows, broadcast_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercept = model.value
        features = Features()
        for step in steps(batches, "text"):
            z = np.empty(step.num_rows)
            for k, text in enumerate(step.column("text")):
                own = features.of(text.as_py())
                z[k] = intercept + (weights[own].sum() * SCALE / np.sqrt(len(own)) if len(own) else 0.0)
            score = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays([*step.columns[1:], pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                                             names=[*step.schema.names[1:], "score", "predicted"])

    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       in_fold(F.col(id_col), folds, held).alias("held_out"))
    return arrow_map(rows, run, StructType([StructField("row", docs.schema), StructField("held_out", BooleanType()),
                                            StructField("score", DoubleType()), StructField("predicted", IntegerType())]))


def op12_toxicity(spark, sf_dir: str) -> DataFrame:
    """The toxicity of every whole document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_toxicity(docs, labels).select("row.doc_id", "held_out", "score", "predicted")
