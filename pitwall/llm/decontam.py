"""Benchmark decontamination by winnowing.

Items and documents are cut into words (``ALNUM``, lower-cased). A *window* is ``window`` consecutive item words; an
item of fewer words, but not none, is one window. Of every ``window - gram + 1`` consecutive gram hashes the smallest
is kept (winnowing), so two texts that share a window share a kept hash inside it. Kept hashes of test and training
texts are joined, and every hit is extended in both directions while the words agree: a shared span of at least a
window marks its document words, and the item counts as occurring. Items shorter than a window use the same scheme
with their own length as the window.

The benchmark is read as a fixed test set: up to ``broadcast_bytes`` of item text it is broadcast and the documents
are one narrow pass. Beyond it, items are dealt into blocks of about half that size, each block is a step of the same pass and
adds its spans to those of the blocks before it.

Defined cases: null or empty documents have no words and are never hit; null or empty items occur nowhere; a repeated
item_id counts once in ``n_items``, a null item_id marks words but has no name to count; repeated document rows are
judged each; no benchmark rows leave all documents clean; an empty table of documents gives an empty result; a text is
taken whole (its words' hashes are held at once, about 40 bytes a byte of a single text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import arrow_map, steps
from .words import ALNUM, grams, words

#: Item text that one broadcast holds; its index takes about 8 bytes per byte of text.
BROADCAST_BYTES = 8 << 20


def winnowed(hashes: np.ndarray, span: int) -> np.ndarray:
    """Positions of the smallest of every ``span`` consecutive hashes (all of them when there are fewer), leftmost on ties."""
    n = len(hashes) - span + 1
    if n <= 0:
        return np.array([int(np.argmin(hashes))]) if len(hashes) else np.zeros(0, np.int64)
    low, at = hashes[:n].copy(), np.arange(n)
    for k in range(1, span):
        other = hashes[k:k + n]
        less = other < low
        low[less] = other[less]
        at[less] = np.flatnonzero(less) + k
    return at[np.concatenate(([True], at[1:] != at[:-1]))] if n else at


class Index:
    """The items' words and their kept hashes, by window length."""

    def __init__(self, items: list[tuple[object, str]], window: int, gram: int):
        self.ids = [i for i, _ in items]
        w = words(pa.array([t or "" for _, t in items], pa.large_string()), ALNUM)
        self.words, self.first = w.hash, w.first
        self.kept: list[tuple[int, int, int, np.ndarray, np.ndarray]] = []  # window, gram, span, sorted hashes, their places in words
        for n in sorted({min(int(c), window) for c in w.count if c}):
            k = min(gram, n)
            span = n - k + 1
            hashes, places = [], []
            for i in np.flatnonzero(w.count >= window if n == window else w.count == n):
                own = grams(w.hash[w.of(i)], k)
                at = winnowed(own, span)
                hashes.append(own[at])
                places.append(at + w.first[i])
            hashes, places = np.concatenate(hashes), np.concatenate(places)
            order = np.argsort(hashes, kind="stable")
            self.kept.append((n, k, span, hashes[order], places[order]))

    def hits(self, own: np.ndarray) -> tuple[np.ndarray, set[int]]:
        """Marked words of a document, and the items with occurring windows."""
        marked, found = np.zeros(len(own) + 1, np.int32), set()
        for n, k, span, hashes, places in self.kept:
            if len(own) < n:
                continue
            doc = grams(own, k)
            # a kept hash is the smallest of some window: first drop what no item keeps, then see which are smallest
            left = np.searchsorted(hashes, doc, side="left")
            left[left == len(hashes)] = 0
            maybe = hashes[left] == doc
            if not maybe.any():
                continue
            at = winnowed(doc, span)
            at = at[maybe[at]]
            if not len(at):
                continue
            lo, hi = np.searchsorted(hashes, doc[at], side="left"), np.searchsorted(hashes, doc[at], side="right")
            counts = hi - lo
            mine = np.repeat(at, counts)
            theirs = places[np.repeat(lo, counts) + (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))]
            order = np.lexsort((mine, theirs - mine))
            done_on, done_to = None, -1
            for d, i in zip(mine[order].tolist(), theirs[order].tolist()):
                if done_on == i - d and d < done_to:  # inside the span found before on this alignment
                    continue
                item = int(np.searchsorted(self.first, i, side="right")) - 1
                low, high = int(self.first[item]), int(self.first[item + 1])
                back = min(d, i - low)
                same = own[d - back:d][::-1] == self.words[i - back:i][::-1]
                back = int(np.argmin(same)) if not same.all() else back
                ahead = min(len(own) - d, high - i)
                same = own[d:d + ahead] == self.words[i:i + ahead]
                ahead = int(np.argmin(same)) if not same.all() else ahead
                done_on, done_to = i - d, d + ahead
                if back + ahead >= n:
                    marked[d - back] += 1
                    marked[d + ahead] -= 1
                    found.add(item)
        return np.cumsum(marked[:-1]) > 0, found


def runs(mask: np.ndarray) -> list[int]:
    """Starts and ends of the runs of True, in turn."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return edges.tolist()


def united(spans: list[int]) -> list[int]:
    """Starts and ends, in turn, of the union of such spans."""
    out: list[int] = []
    for a, b in sorted(zip(spans[::2], spans[1::2])):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, gram: int = 5, text_col: str = "text",
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of ``docs`` as a struct ``row``, with n_words, n_hit, n_items, items_sha256, contaminated and spans (starts and ends
    of marked words, in turn)."""
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total * 2 // broadcast_bytes)) if total > broadcast_bytes else 1
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.lit(0).cast("long").alias("n_words"),
                        F.array().cast("array<long>").alias("spans"), F.array().cast("array<string>").alias("items"))
    schema = found.schema
    for b in range(blocks):  # each adds its spans and items to the rows' own
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b)
        index = spark.sparkContext.broadcast(([tuple(r) for r in own.collect()], window, gram))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            table = Index(*index.value)
            for batch in batches:
                batch = pa.RecordBatch.from_arrays([batch.column("row").field(text_col).cast(pa.string()), *batch.columns],
                                                   names=["text", *batch.schema.names])
                for step in steps([batch], "text"):
                    w = words(step.column("text"), ALNUM)
                    marks, names = [], []
                    for i, (had, known) in enumerate(zip(step.column("spans").to_pylist(), step.column("items").to_pylist())):
                        mask, hit = table.hits(w.hash[w.of(i)])
                        marks.append(united(had + runs(mask)) if hit else had)
                        names.append(sorted({*known, *(str(table.ids[k]) for k in hit if table.ids[k] is not None)}))
                    yield pa.RecordBatch.from_arrays(
                        [step.column("row"), pa.array(w.count, pa.int64()), pa.array(marks, pa.list_(pa.int64())),
                         pa.array(names, pa.list_(pa.string()))], names=["row", "n_words", "spans", "items"])

        found = arrow_map(found, run, schema)
    total_of = lambda first: F.aggregate(
        F.filter("spans", lambda x, k: k % 2 == first), F.lit(0).cast("long"), lambda s, x: s + x)
    return found.select("row", "n_words", (total_of(1) - total_of(0)).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"), "spans")


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Documents against the benchmark's windows of 10 words."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return decontaminate(docs.select("doc_id", "text"), items).select(
        "row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP5_SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS s FROM item WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM wins),
doc_wins AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM doc, lens WHERE len(w) >= n)),
hit AS (SELECT d.doc_id, d.n, d.s, i.item_id FROM doc_wins d JOIN wins i ON d.n = i.n AND d.g = i.g),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM hit) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(n.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(n.ids, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN covered c USING (doc_id) LEFT JOIN named n USING (doc_id)
"""
