"""Target-distribution importance resampling over hashed word n-grams.

Features are all runs of 1 to 3 consecutive words; a feature's bucket is the CRC-32 of its bytes modulo ``buckets``. The
logarithm of a bucket's smoothed share among the target's features over its share among the documents' is its gain, a
document's weight is the sum over its features, and a Gumbel draw from a hash of the id turns weights into scores whose
highest are a sample without replacement, drawn in proportion to importance.

CRCs are computed for a step of texts at a time: its words are written one behind the other with single spaces, so every
feature is a slice; equal features (by a 64-bit hash of their words) are taken once, grouped by length into
two-dimensional byte arrays, all CRCs of a group move on column by column through the byte table, and the buckets are
scattered back to the features. Features of over ``LONG_FEATURE`` bytes are few and take zlib's form of the same function.

Bucket counts are summed in Spark (at most ``buckets`` rows come to the driver); the documents are read twice, once for the
counts and once for the weights, so nothing but ids and numbers is shuffled. The drawn documents are ranked by a range
partitioning over score and id with prefix sums of its parts' counts.

Defined cases: null and empty texts have no words and no features (weight 0); a null id draws as an empty text behind
``seed:``; documents of fewer than ``least_words`` words are never drawn; equal scores go to the smaller id, null last;
repeated rows are documents of their own; an empty target or empty documents give results by the same formula; texts of any
length are taken whole (one text at least makes a step); other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import arrow_map, checkpointed, steps
from .words import ALNUM, grams, rows_of, words

LENGTHS = (1, 2, 3)
LONG_FEATURE = 256
#: Bytes of one two-dimensional array.
MATRIX_BYTES = 1 << 22
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _byte_table() -> np.ndarray:
    """What one byte does to a reflected CRC-32."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & np.uint32(1), (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


BYTE_TABLE = _byte_table()


def crcs(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The CRC-32 of every slice of ``data``, by length groups."""
    out = np.zeros(len(start), np.uint32)
    order = np.argsort(length, kind="stable")
    edge = np.flatnonzero(np.diff(length[order], prepend=-1, append=-1))
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        size = int(length[order[a]])
        if size > LONG_FEATURE:
            for k in order[a:b].tolist():
                out[k] = zlib.crc32(data[start[k]:start[k] + size])
            continue
        for low in range(a, b, max(1, MATRIX_BYTES // max(size, 1))):
            own = order[low:min(b, low + max(1, MATRIX_BYTES // max(size, 1)))]
            matrix = data[start[own] + np.arange(size)[:, None]]  # a column of the features' bytes is a row here
            value = np.full(len(own), 0xFFFFFFFF, np.uint32)
            for column in matrix:
                value = BYTE_TABLE[(value ^ column) & np.uint32(0xFF)] ^ (value >> np.uint32(8))
            out[own] = ~value
    return out


def featured(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of every text; then the text and the bucket of every feature."""
    w = words(column, ALNUM)
    sizes = w.end - w.start
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    data = np.full(int((sizes + 1).sum()), 0x20, np.uint8)
    k = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(k)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    data[begin[k] + inside] = _LOWER[w.data[w.start[k] + inside]]
    text = rows_of(w.first)
    hashes, starts, lengths, owners = [], [], [], []
    for n in LENGTHS:
        if len(sizes) < n:
            break
        whole = np.flatnonzero(text[n - 1:] == text[:len(text) - n + 1])  # not beyond the text's end
        hashes.append(grams(w.hash, n)[whole] ^ np.uint64(n * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        starts.append(begin[whole])
        lengths.append((begin + sizes)[whole + n - 1] - begin[whole])
        owners.append(text[whole])
    if not hashes:
        return w.count, np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, length = np.concatenate(starts), np.concatenate(lengths)
    _, once, back = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    bucket = crcs(data, start[once], length[once]).astype(np.int64) % buckets
    return w.count, np.concatenate(owners), bucket[back]


def bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """How many features of all texts (column text) are in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for step in steps(batches, "text"):
            total += np.bincount(featured(step.column("text"), buckets)[2], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in arrow_map(texts, run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():  # ``buckets`` rows at most
        out[bucket] = n
    return out


def gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of every bucket's smoothed shares, rounded down."""
    n = len(docs)
    ratio = (target + 1.0) * (float(docs.sum()) + n) / ((docs + 1.0) * (float(target.sum()) + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their place (from 1) in ``order``, without one task that sees all: parts of a range partitioning are
    pinned by a checkpoint, and each adds the counts of the parts before it (a table of one row a part)."""
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pinned = checkpointed(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = pinned.groupBy(part.alias("_part")).agg(F.min("_at").alias("_low"), F.count("*").alias("_n")) \
        .select("_part", "_low", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return pinned.join(F.broadcast(spans), part == F.col("_part")) \
        .withColumn(name, F.col("_before") + F.col("_at") - F.col("_low") + 1).drop("_at", "_part", "_low", "_before")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             buckets: int = 10_000, percent: int = 5, least_words: int = 20, seed: int = 42) -> DataFrame:
    """``id_col``, n_features, weight, score and rank (null where a document isn't drawn) of every row."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    gain = gains(bucket_counts(texts.select("text"), buckets),
                 bucket_counts(target.select(F.col(target_col).cast("string").alias("text")), buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            count, text, bucket = featured(step.column("text"), buckets)
            weight = np.bincount(text, weights=gain[bucket], minlength=step.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [step.column("id"), pa.array(count.astype(np.int64)), pa.array(np.bincount(text, minlength=step.num_rows).astype(np.int64)), pa.array(weight)],
                names=["id", "n_words", "n_features", "weight"])

    id_type = docs.schema[id_col].dataType.simpleString()
    draw = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10)
    noise = F.floor(-1000 * F.log(-F.log((draw.cast("double") + 0.5) / 4294967296.0)))
    scored = checkpointed(arrow_map(texts, run, f"id {id_type}, n_words long, n_features long, weight long")
                          .select("id", "n_words", "n_features", "weight", (F.col("weight") + noise).alias("score")))
    long_enough = F.col("n_words") >= least_words
    drawn = math.floor(percent * scored.where(long_enough).count() / 100)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    placed = ranked(scored.where(long_enough), order, "rank").withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    return placed.unionByName(rest).select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")


def op13_importance_resampling(spark, sf_dir: str) -> DataFrame:
    """All documents resampled towards the benchmark's texts: five percent of those of 20 words or more."""
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: The byte table by recursion, then a fold over the bytes of every distinct feature.
OP13_SQL = r"""
WITH RECURSIVE step(b, c, k) AS (
  SELECT b, b::UBIGINT, 0 FROM range(256) r(b)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM step WHERE k < 8),
tab AS (SELECT list(c ORDER BY b) AS t FROM step WHERE k = 8),
texts AS (
  SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, NULL, text FROM benchmark),
split AS (
  SELECT row_number() OVER () AS n, kind, id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
features AS (
  SELECT n, kind, array_to_string(w[s:s + g - 1], ' ') AS f
  FROM (SELECT n, kind, w, g, unnest(generate_series(1, len(w) - g + 1)) AS s FROM split, range(1, 4) r(g))),
counted AS (SELECT n, kind, f, count(*) AS c FROM features GROUP BY ALL),
crcs AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(regexp_extract_all(hex(encode(f)), '..'), lambda h: ('0x' || h)::UBIGINT)),
                            lambda a, x: xor(t[(xor(a, x) & 255)::INTEGER + 1], a >> 8)), 4294967295::UBIGINT) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM counted), tab),
b AS (SELECT kind, bucket, sum(c)::DOUBLE AS c FROM counted JOIN crcs USING (f) GROUP BY ALL),
total AS (SELECT coalesce(sum(c) FILTER (kind = 0), 0) AS s, coalesce(sum(c) FILTER (kind = 1), 0) AS t FROM b),
gain AS (
  SELECT x.bucket, floor(1000 * ln((coalesce(y.c, 0) + 1) * (s + 10000) / ((x.c + 1) * (t + 10000)))) AS gain
  FROM (SELECT * FROM b WHERE kind = 0) x LEFT JOIN (SELECT * FROM b WHERE kind = 1) y USING (bucket), total),
weights AS (SELECT n, sum(c * gain)::BIGINT AS weight, sum(c)::BIGINT AS n_features FROM counted JOIN crcs USING (f) JOIN gain USING (bucket) WHERE kind = 0 GROUP BY n),
scored AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('42:' || coalesce(id::VARCHAR, '')), 8))::UBIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM split LEFT JOIN weights USING (n) WHERE kind = 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
         floor(5 * (count(*) FILTER (n_words >= 20) OVER ()) / 100) AS drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= drawn THEN place END::BIGINT AS rank FROM placed
"""
