"""Language-model scores by a probabilistic suffix tree over bytes, beside the unigram base over words.

A text's tokens are its words (``SPACED``, lower-cased) and one end. For the tree they are spelled out: every word's
bytes and a space, then a newline as the end (neither can be in a word), after ``DEPTH`` spaces as the start. So the
tree's probability of that string is a probability of the token sequence.

Learning is one pass over the rows that counts words and (DEPTH + 1)-grams of bytes, combined in the tasks and summed
in Spark; training counts cover all training rows and grow with them. Shorter contexts' counts are sums of the longest
ones. A context is a candidate if at least ``min_count`` training symbols follow it, whatever the size of the table. It
is retained if its next-symbol distribution diverges from its parent's (count times Kullback-Leibler divergence of at
least ``divergence`` nats), or if a longer retained context ends in it. A state's distribution is smoothed with its
parent's at weight ``smoothing``, the root's with the uniform one over ``SYMBOLS``. Each symbol is scored in the state
of the longest retained suffix.

Contexts of up to ``TOP`` bytes (so at most 2 ** 24 entries) are grown on the driver. All longer contexts that end in
the same TOP + 1 bytes are grown in one task, which needs of the shorter ones only those they end in: they are retained
with them. The task gives the score of every gram, of held-out rows too, that ends in a retained context longer than
``TOP``. Scores of the ``head_grams`` most frequent ones (cut like the words) are broadcast, with a bit for each of the
2 ** 24 endings that says if such a context ends in it; grams without that bit are scored by the shorter contexts, the
rest are joined on the gram.

The base needs the training count of every word. Counts of the ``head_words`` most frequent ones (cut at a power of
two of the count, so at most that many) are broadcast; the rest are joined on the word's hash.

Defined cases: null and empty texts are the end token alone; a null id is learned from and not held out; without any
training row every count is 0 and the base of a token is 0 (log10 of (0.5 / 0.5)); repeated rows are learned and scored
each; an empty table gives an empty result; a text is scored whole (its symbols' keys are held at once, about 40 bytes a
byte of a single text); equal counts need no order; other columns are ignored, and none can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .langid import in_fold
from .shared import arrow_map, checkpointed, cut, steps
from .words import SPACED, raw, words

DEPTH = 5
TOP = 2        # the longest context that reaches the driver
SYMBOLS = 256  # a word's 250 bytes, space and newline, rounded up
END = 0        # the end token's key among the word hashes
WORD, GRAM, HELD = 0, 1, 2
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_CACHE_BITS = 21
_GROWN_ROWS = 1 << 20  # grams that a task grows at once, if no ending has more


def spelled(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the (DEPTH + 1)-grams that end in each scored symbol, and the number of symbols of each text."""
    data, offsets = raw(column)
    body = data.tobytes().translate(_LOWER)
    parts, counts = [], []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        text = b" ".join(body[a:b].split())
        parts.append(b" " * DEPTH + text + (b" \n" if text else b"\n"))
        counts.append(len(parts[-1]) - DEPTH)
    flat = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
    n = len(flat) - DEPTH
    keys = np.zeros(max(n, 0), np.uint64)
    for k in range(DEPTH + 1):
        keys |= flat[DEPTH - k:DEPTH - k + n] << np.uint64(8 * k)
    counts = np.array(counts, np.int64)
    scored = np.ones(len(keys), bool)  # all but the starts of the second and later texts
    for k in range(DEPTH):
        scored[(np.cumsum(counts + DEPTH) - DEPTH)[:-1] + k] = False
    return keys[scored], counts


class _Counts:
    """Counts of keys, merged now and then."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        k, n = np.unique(keys, return_counts=True)
        self.parts.append((k, n))
        self.size += len(k)
        if self.size > 1 << 21:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.parts) > 1:
            k, at = np.unique(np.concatenate([p[0] for p in self.parts]), return_inverse=True)
            n = np.bincount(at, weights=np.concatenate([p[1] for p in self.parts]), minlength=len(k)).astype(np.int64)
            self.parts = [(k, n)]
        self.size = len(self.parts[0][0]) if self.parts else 0
        return self.parts[0] if self.parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def count(texts: DataFrame) -> DataFrame:
    """kind, key, n: how often every word (END included) and every gram occurs in ``texts`` (a column text); of rows
    with a true held_out, if there is such a column, the grams alone, as HELD."""
    if "held_out" not in texts.columns:
        texts = texts.withColumn("held_out", F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, ends = {WORD: _Counts(), GRAM: _Counts(), HELD: _Counts()}, 0

        def out(kind: int) -> pa.RecordBatch:
            k, n = own[kind].merge()
            own[kind] = _Counts()
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int8)), pa.array(k.view(np.int64)), pa.array(n)],
                                              names=["kind", "key", "n"])

        for step in steps(batches, "text"):
            held = step.column("held_out")
            train = step.filter(pc.invert(held)).column("text")
            own[WORD].add(words(train, SPACED).hash)
            own[GRAM].add(spelled(train)[0])
            own[HELD].add(spelled(step.filter(held).column("text"))[0])
            ends += len(train)
            for kind in own:
                if own[kind].size > 1 << 20:
                    yield out(kind)
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([WORD], pa.int8()), pa.array([END], pa.int64()), pa.array([ends], pa.int64())],
                                             names=["kind", "key", "n"])
        for kind in own:
            yield out(kind)

    return arrow_map(texts.select("text", "held_out"), run, "kind byte, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def probability(levels: list[tuple[np.ndarray, ...]], smoothing: float, keys: np.ndarray) -> np.ndarray:
    """Of each key's last byte after those before it."""
    p = np.full(len(keys), 1.0 / SYMBOLS)
    for depth, (contexts, totals, entries, counts) in enumerate(levels):
        if not len(contexts):
            break
        own = keys & np.uint64((1 << 8 * (depth + 1)) - 1)
        context = own >> np.uint64(8)
        i = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
        j = np.minimum(np.searchsorted(entries, own), len(entries) - 1)
        n = np.where(entries[j] == own, counts[j], 0)
        p = np.where(contexts[i] == context, (n + smoothing * p) / (totals[i] + smoothing), p)
    return p


class _Logs:
    """Scores by gram; what was met lately is looked up."""

    def __init__(self):
        self._keys = np.full(1 << _CACHE_BITS, (1 << 64) - 1, np.uint64)  # scores met lately, by hash of the gram
        self._logs = np.zeros(1 << _CACHE_BITS, np.float32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def logs(self, keys: np.ndarray) -> np.ndarray:
        """``find`` of each key."""
        slot = (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _CACHE_BITS)
        out = self._logs[slot].astype(np.float64)
        missed = np.flatnonzero(self._keys[slot] != keys)
        if len(missed):
            new, at = np.unique(keys[missed], return_inverse=True)
            logs = self.find(new).astype(np.float32)
            out[missed] = logs[at]
            where = (new * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _CACHE_BITS)
            where, first = np.unique(where, return_index=True)  # one of those that share a slot
            self._keys[where], self._logs[where] = new[first], logs[first]
        return out


class Tree(_Logs):
    """Retained contexts by depth: sorted context keys, their totals; sorted (context, symbol) keys, their counts."""

    def __init__(self, levels: list[tuple[np.ndarray, ...]], smoothing: float):
        super().__init__()
        self.levels, self.smoothing = levels, smoothing

    def probability(self, keys: np.ndarray) -> np.ndarray:
        return probability(self.levels, self.smoothing, keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """log10 of ``probability``."""
        return np.log10(self.probability(keys))


class Head(_Logs):
    """Scores of grams by the shorter contexts or from the sorted head; NaN for those that only the joined table has."""

    def __init__(self, top: list[tuple[np.ndarray, ...]], smoothing: float, deep: np.ndarray, keys: np.ndarray, logs: np.ndarray):
        super().__init__()
        self.top, self.deep, self.keys, self.found = Tree(top, smoothing), np.unpackbits(deep).view(bool), keys, logs

    def find(self, keys: np.ndarray) -> np.ndarray:
        deep = self.deep[_ending(keys)]
        out = np.full(len(keys), np.nan)
        out[~deep] = self.top.find(keys[~deep])
        if len(self.keys):
            i = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            out = np.where(deep & (self.keys[i] == keys), self.found[i], out)
        return out


def _ending(keys: np.ndarray) -> np.ndarray:
    """The last TOP + 1 bytes of each key's context."""
    return (keys >> np.uint64(8)) & np.uint64((1 << 8 * (TOP + 1)) - 1)


def _candidates(keys: np.ndarray, counts: np.ndarray, above: list[tuple[np.ndarray, ...]], last: int, least: float,
                divergence: float, smoothing: float) -> tuple[list[tuple[np.ndarray, ...]], list[np.ndarray]]:
    """``above`` and the candidates' levels after it, to depth ``last``, and which of the latters' contexts diverge."""
    levels, keep = list(above), []
    for depth in range(len(above), last + 1):
        entries, at = np.unique(keys & np.uint64((1 << 8 * (depth + 1)) - 1), return_inverse=True)
        n = np.bincount(at, weights=counts, minlength=len(entries))
        contexts, at = np.unique(entries >> np.uint64(8), return_inverse=True)
        totals = np.bincount(at, weights=n, minlength=len(contexts))
        enough = totals >= least
        entries, n, total = entries[enough[at]], n[enough[at]], totals[at][enough[at]]
        contexts, totals = contexts[enough], totals[enough]
        if depth:
            parent = probability(levels, smoothing, entries & np.uint64((1 << 8 * depth) - 1))
            start = np.searchsorted(entries >> np.uint64(8), contexts)
            gain = np.add.reduceat(n * np.log(n / total / parent), start) if len(start) else np.zeros(0)
        else:
            gain = np.full(len(contexts), np.inf)
        levels.append((contexts, totals, entries, n))
        keep.append(gain >= divergence)
    return levels, keep


def _close(levels: list[tuple[np.ndarray, ...]], keep: list[np.ndarray], longer: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """What is retained of the last ``len(keep)`` levels: what diverges, and the suffixes of that and of ``longer``."""
    out = []
    for depth in range(len(levels) - 1, len(levels) - len(keep) - 1, -1):
        contexts, totals, entries, counts = levels[depth]
        kept = keep[depth - len(levels)] | np.isin(contexts, longer & np.uint64((1 << 8 * depth) - 1))
        of = kept[np.searchsorted(contexts, entries >> np.uint64(8))] if len(contexts) else np.zeros(0, bool)
        longer = contexts[kept]
        out.append((longer, totals[kept], entries[of], counts[of]))
    return out[::-1]


def deep_scores(grams: DataFrame, top: list[tuple[np.ndarray, ...]], min_count: int, divergence: float, smoothing: float) -> DataFrame:
    """key, met and log of every gram (kind, key, n) that ends in a retained context of more than TOP bytes; ``top``
    has all shorter candidates."""
    shared = grams.sparkSession.sparkContext.broadcast(top)

    def scores(keys: np.ndarray, n: np.ndarray, kinds: np.ndarray) -> pa.RecordBatch:
        train = kinds == GRAM
        levels, keep = _candidates(keys[train], n[train], shared.value, DEPTH, min_count, divergence, smoothing)
        levels = _close(levels, keep, np.zeros(0, np.uint64))
        keys, at = np.unique(keys, return_inverse=True)
        met = np.bincount(at, weights=n, minlength=len(keys)).astype(np.int64)
        deep = np.isin(_ending(keys), levels[0][0])
        logs = np.log10(probability([*shared.value, *levels], smoothing, keys[deep]))
        return pa.RecordBatch.from_arrays([pa.array(keys[deep].view(np.int64)), pa.array(met[deep]), pa.array(logs.astype(np.float32))],
                                          names=["key", "met", "log"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            parts.append([batch.column(c).to_numpy() for c in ("key", "n", "kind")])
            size += batch.num_rows
            if size < _GROWN_ROWS:
                continue
            keys, n, kinds = (np.concatenate(p) for p in zip(*parts))
            keys = keys.view(np.uint64)
            stop = int(np.searchsorted(_ending(keys), _ending(keys[-1:])[0]))  # the last ending may go on
            if stop:
                yield scores(keys[:stop], n[:stop], kinds[:stop])
            parts = [[keys[stop:].view(np.int64), n[stop:], kinds[stop:]]]
            size = len(keys) - stop
        if size:
            keys, n, kinds = (np.concatenate(p) for p in zip(*parts))
            yield scores(keys.view(np.uint64), n, kinds)

    ending = F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * (TOP + 1)) - 1))
    dealt = grams.withColumn("ending", ending).repartition("ending").sortWithinPartitions("ending")
    return arrow_map(dealt.select("kind", "key", "n"), run, "key long, met long, log float")


def _sizes(counted: DataFrame, n: str) -> dict[int, tuple[int, int]]:
    """Entries and sum of ``n`` by the floor of its log2."""
    return {r[0]: (r[1], r[2]) for r in counted.groupBy(F.floor(F.log2(F.col(n).cast("double") + 0.25)).alias("p"))
            .agg(F.count("*"), F.sum(n)).collect()}


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held: int = 1, min_count: int = 8,
          divergence: float = 2.0, smoothing: float = 8.0, head_words: int = 1 << 19, head_grams: int = 1 << 20) -> DataFrame:
    """``id_col``, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       in_fold(F.col(id_col), folds, held).alias("held_out"))
    counts = checkpointed(count(rows))
    vocabulary = counts.where(F.col("kind") == WORD).select("key", "n")
    sizes = _sizes(vocabulary, "n")
    n_all, n_types = sum(s for _, s in sizes.values()), sum(c for c, _ in sizes.values())
    word_cut = cut(sizes, head_words)
    short = F.col("key").bitwiseAND(F.lit((1 << 8 * (TOP + 1)) - 1))
    t = counts.where(F.col("kind") == GRAM).groupBy(short.alias("key")).agg(F.sum("n").alias("n")).toArrow()
    top, keep = _candidates(t.column("key").to_numpy().view(np.uint64), t.column("n").to_numpy().astype(np.float64), [], TOP,
                            min_count, divergence, smoothing)
    grams = checkpointed(deep_scores(counts.where(F.col("kind") != WORD), top, min_count, divergence, smoothing))
    t = grams.select(F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * (TOP + 1)) - 1)).alias("ending")).distinct().toArrow()
    endings = t.column("ending").to_numpy().view(np.uint64)
    deep = np.zeros(1 << 8 * (TOP + 1), np.uint8)
    deep[endings] = 1
    gram_cut = cut(_sizes(grams, "met"), head_grams)
    t = grams.where(F.col("met") >= 1 << gram_cut).select("key", "log").toArrow()
    keys, logs = t.column("key").to_numpy().view(np.uint64), t.column("log").to_numpy()
    order = np.argsort(keys)
    scores = (_close(top, keep, endings), smoothing, np.packbits(deep), keys[order], logs[order])
    # by counts of at least 2 ** cut; the end is looked up like a word
    t = vocabulary.where((F.col("n") >= 1 << word_cut) | (F.col("key") == END)).toArrow()
    keys, n = t.column("key").to_numpy().view(np.uint64), t.column("n").to_numpy()
    order = np.argsort(keys)
    head = (keys[order], n[order].astype(np.int64))
    below = n_all + 0.5 * (n_types + 1)
    model = spark.sparkContext.broadcast((scores, head, below))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, (known, n), below = model.value
        tree = Head(*scores)
        logs = np.log10((np.concatenate((n, [0])) + 0.5) / below)
        for step in steps(batches, "text"):
            w = words(step.column("text"), SPACED)
            symbols, lengths = spelled(step.column("text"))
            found = tree.logs(symbols)
            joined = np.isnan(found)
            total = np.add.reduceat(np.where(joined, 0.0, found), np.cumsum(lengths) - lengths)
            joined_at = np.concatenate(([0], np.cumsum(joined)))[np.concatenate(([0], np.cumsum(lengths)))]
            i = np.searchsorted(known, w.hash)
            i[i == len(known)] = 0
            hit = known[i] == w.hash if len(known) else np.zeros(len(i), bool)
            ends = int(n[0]) if len(known) and known[0] == END else 0
            sums = np.concatenate(([0.0], np.cumsum(np.where(hit, logs[i], 0.0))))
            base = sums[w.first[1:]] - sums[w.first[:-1]] + np.log10((ends + 0.5) / below)
            hits = np.concatenate(([0], np.cumsum(hit)))
            n_known = hits[w.first[1:]] - hits[w.first[:-1]] + (ends > 0)
            rare = w.hash[~hit]
            at = np.concatenate(([0], np.cumsum(~hit)))[w.first]
            yield pa.RecordBatch.from_arrays(
                [step.column("id"), step.column("row"), step.column("held_out"), pa.array(w.count + 1, pa.int64()),
                 pa.array(n_known, pa.int64()), pa.array(base), pa.array(total),
                 pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(rare.view(np.int64))),
                 pa.ListArray.from_arrays(pa.array(joined_at, pa.int32()), pa.array(symbols[joined].view(np.int64)))],
                names=["id", "row", "held_out", "n_tokens", "n_known", "base", "score", "rare", "grams"])

    scored = checkpointed(arrow_map(
        rows.withColumn("row", F.monotonically_increasing_id()), run,
        f"id {id_type}, row long, held_out boolean, n_tokens long, n_known long, base double, score double, rare array<long>, "
        "grams array<long>"))
    rest = vocabulary.where(F.col("n") < 1 << word_cut)
    tail = scored.select("row", F.explode("rare").alias("key")).join(rest, "key", "left").groupBy("row").agg(
        F.sum(F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(float(below)))).alias("more"), F.count("n").alias("known"))
    deeper = scored.select("row", F.explode("grams").alias("key")).join(grams.where(F.col("met") < 1 << gram_cut), "key") \
        .groupBy("row").agg(F.sum(F.col("log").cast("double")).alias("deeper"))
    return scored.join(tail, "row", "left").join(deeper, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(int(n_all)).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("deeper", F.lit(0.0))).alias("score"))


def op10_lm_scores(spark, sf_dir: str) -> DataFrame:
    """Scores of all whole documents, learned from four of five."""
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
