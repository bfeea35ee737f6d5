"""N-gram Jaccard join by PartEnum signatures.

A document's set holds the hashes of its distinct word n-grams. Sets with Jaccard similarity of T % or more differ in
at most k = (100 - T) / (100 + T) * (sum of sizes) elements. Sizes fall into bands of ratio 100 / T; a pair lies in
one band or in neighbouring ones, so every set takes part in its own band and, if a partner can be larger than that,
in the next. A band has one k. The feature domain is cut into n1 partitions, so in one of them a pair differs in at
most K2 elements, and each partition into N2 parts, so the pair agrees on some N2 - K2 of these: for every such subset
of parts, the set's elements in it form a signature, and similar sets share one.

Empty projections would make all small sets alike, so they are left out; n1 has spare partitions for that. A set
with too many empty projections for the guarantee also enumerates further, differently hashed partitionings, up to
the first that is full enough; two sets always share the fuller one's partitioning.

Signatures travel as packed arrays by ranges of their hash (as many as 16 a shuffle partition). Equal sets of a task
send them once. A range's task finds the signatures that several documents share and returns groups of document ids,
not pairs. Links are then found in two rounds: every document against one hub of its groups, and then, among the
documents of groups that still hold several components, the pairs across components that neither sizes nor feature
counts (a lower bound of the difference) rule out, compared group by group in blocks of bounded size. So a group of near copies costs
about one comparison a member, and no link between components is missed. Every link is verified on the whole sets,
which travel once to every task they are needed in, not once a pair: the second round's pairs are made and judged inside
its tasks, of which only documents with partners and the links that join components come out.

Sets are compared as 64-bit hashes (48 bits of them in verification): n documents meet about n^2 / 2^65 false equalities.

Defined cases: null texts and texts without words have an empty set and link with nothing; texts of fewer words than
an n-gram are one n-gram; rows that share an id are one node, linked by any of them; rows with a null id keep their
size and have no component; repeated rows give repeated results; an empty table gives an empty result; a text is taken
whole (its words' hashes are held at once, about 40 bytes a byte of a single text); of equally good hubs the smaller id is
taken, which links do not depend on; ids are whole numbers (others do not cast); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .shared import arrow_map, checkpointed, grouped, steps
from .words import SPACED, grams, mixed, words

K2, N2 = 1, 2
SUBSETS = tuple(combinations(range(N2), N2 - K2))
#: The least threshold for which sets fill enough parts.
LEAST_PERCENT = 75


def spare(percent: int) -> float:
    """Spare first-level partitions, as a share: sets of lower thresholds leave more parts empty."""
    return 0.2 if percent >= 80 else 0.5

#: Signatures that a task packs at a time.
PACKED = 1 << 19
#: Ids that a broadcast may hold (16 bytes each); beyond it texts are shuffled to their ids.
BROADCAST_IDS = 1 << 21
_CELLS = 128  # of the feature counts
#: Documents of a block; two blocks are compared at a time.
BLOCK = 1024
#: Rows of groups that one task of the second round compares.
TASK_ROWS = 1 << 13
#: What the second round keeps of them.
MARKED = ["g", "low", "high", "i", "id", "n", "c", "hub", "task"]


def sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted set of every text."""
    w = words(column, SPACED)
    all_grams = grams(w.hash, n)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(all_grams[a:b - n + 1]))
        else:
            out.append(grams(w.hash[a:b], b - a) if b > a else w.hash[:0])
    return out


def fingerprint(elements: np.ndarray) -> int:
    """Of a whole set, as a signed 64-bit value."""
    with np.errstate(over="ignore"):
        total = mixed(elements).sum(dtype=np.uint64) + np.uint64(len(elements)) * np.uint64(0x9E3779B97F4A7C15)
    return int(mixed(np.array([total], np.uint64)).view(np.int64)[0])


@lru_cache(None)
def band_tops(percent: int, size: int) -> tuple[int, ...]:
    """The largest sizes of the bands, up to the one after that of ``size``."""
    tops = [1]
    while len(tops) < 2 or tops[-2] < size:
        tops.append(max(tops[-1] + 1, 100 * tops[-1] // percent))
    return tuple(tops)


def bands(size: int, percent: int) -> list[tuple[int, int]]:
    """(band, k) in which a set of ``size`` takes part; those with k = 0 hold only equal sets and are left out."""
    tops = band_tops(percent, 1 << max(4, size.bit_length()))
    own = int(np.searchsorted(tops, size))
    reach = 100 * size // percent
    out = []
    for band in (own, own + 1) if reach > tops[own] else (own,):
        k = 2 * tops[band] * (100 - percent) // (100 + percent)
        if k:
            out.append((band, k))
    return out


@lru_cache(4096)
def _names(band: int, attempt: int, n1: int) -> np.ndarray:
    """What tells apart the signatures of a band's partitions and subsets: one row per subset."""
    salt = np.uint64(((band << 8) + attempt) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    place = np.arange(n1, dtype=np.uint64) * np.uint64(len(SUBSETS))
    return np.stack([mixed(place + np.uint64(s) + salt) for s in range(len(SUBSETS))])


def signatures(elements: np.ndarray, percent: int) -> np.ndarray:
    """All PartEnum signatures of a sorted set."""
    out = []
    spread = {0: (elements, mixed(elements))}
    for band, k in bands(len(elements), percent):
        least = -(-(k + 1) // (K2 + 1))
        n1 = least + max(1, int(np.ceil(least * spare(percent))))
        parts = n1 * N2
        attempt = 0
        while True:
            if attempt not in spread:
                own = np.sort(mixed(elements ^ np.uint64(attempt * 0x632BE59BD9B4E019 & (1 << 64) - 1)))
                spread[attempt] = own, mixed(own)
            own, values = spread[attempt]
            part = (((own >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
            edge = np.flatnonzero(part[1:] != part[:-1]) + 1
            edge = np.concatenate(([0], edge))
            sums = np.zeros(parts, np.uint64)
            sums[part[edge]] = np.add.reduceat(values, edge)
            full = np.zeros(parts, bool)
            full[part[edge]] = True
            sums, full = mixed(sums).reshape(n1, N2), full.reshape(n1, N2)
            for name, subset in zip(_names(band, attempt, n1), SUBSETS):
                if len(subset) == 1:
                    some, value = full[:, subset[0]], sums[:, subset[0]]
                else:
                    some, value = full[:, list(subset)].any(axis=1), sums[:, list(subset)].sum(axis=1, dtype=np.uint64)
                out.append(mixed(value[some] + name[some]))
            # so many differences it takes to break every signature of the set that isn't empty
            if np.minimum(full.sum(axis=1), K2 + 1).sum() > k:
                break
            attempt += 1
    return np.concatenate(out) if out else elements[:0]


def pack(ids: np.ndarray, values: np.ndarray) -> bytes:
    """Ascending ids as differences of the least sufficient width, and the low 40 bits of values."""
    steps_ = np.diff(ids)
    width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(steps_) or int(steps_.max()) < 1 << 8 * w)
    head = np.array([len(ids), width, ids[0]], np.int64).tobytes()
    return b"".join((head, steps_.astype(f"u{width}").tobytes(), values.astype(np.uint32).tobytes(),
                     (values >> np.uint64(32)).astype(np.uint8).tobytes()))


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, width, first = np.frombuffer(blob, np.int64, 3).tolist()
    at = 24
    ids = np.empty(n, np.int64)
    ids[0] = first
    ids[1:] = np.frombuffer(blob, f"u{width}", n - 1, at)
    np.cumsum(ids, out=ids)
    at += width * (n - 1)
    low = np.frombuffer(blob, np.uint32, n, at).astype(np.uint64)
    high = np.frombuffer(blob, np.uint8, n, at + 4 * n).astype(np.uint64)
    return ids, low | high << np.uint64(32)


def packed_signatures(docs: DataFrame, n: int, percent: int, ranges: int) -> DataFrame:
    """cell, blob: signatures with their documents' ids, dealt by ``ranges`` ranges of the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, values, size, seen = [], [], 0, set()

        def out() -> pa.RecordBatch:
            counts = np.array([len(v) for v in values])
            who, what = np.repeat(np.array(ids, np.int64), counts), np.concatenate(values)
            cell = (((what >> np.uint64(40)) * np.uint64(ranges)) >> np.uint64(24)).astype(np.int64)
            order = np.lexsort((who, cell))
            who, what, cell = who[order], what[order] & np.uint64((1 << 40) - 1), cell[order]
            edge = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1], [True])))
            blobs = [pack(who[a:b], what[a:b]) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
            return pa.RecordBatch.from_arrays([pa.array(cell[edge[:-1]]), pa.array(blobs, pa.binary())], names=["cell", "blob"])

        for step in steps(batches, "text"):
            for doc, own in zip(step.column("id").to_pylist(), sets(step.column("text"), n)):
                if len(own) < 2:
                    continue
                key = fingerprint(own)
                if key in seen:
                    continue
                seen.add(key)
                found = signatures(own, percent)
                if len(found):
                    ids.append(doc)
                    values.append(found)
                    size += len(found)
                if size >= PACKED:
                    yield out()
                    ids, values, size, seen = [], [], 0, set()
        if size:
            yield out()

    return arrow_map(docs, run, "cell long, blob binary")


def shared_groups(table: pa.Table) -> pa.Table:
    """Groups (their hash) and ids of the documents that share a signature of one range."""
    both = [unpack(b) for b in table.column("blob").to_pylist()]
    ids, values = np.concatenate([b[0] for b in both]), np.concatenate([b[1] for b in both])
    order = np.lexsort((ids, values))
    ids, values = ids[order], values[order]
    new = np.concatenate(([True], (values[1:] != values[:-1]) | (ids[1:] != ids[:-1])))
    ids, values = ids[new], values[new]
    start = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    size = np.diff(np.concatenate((start, [len(ids)])))
    group = mixed(np.add.reduceat(mixed(ids.view(np.uint64)), start) + size.astype(np.uint64))
    many = np.flatnonzero(size > 1)
    many = many[np.unique(group[many], return_index=True)[1]]  # equal groups once
    total = size[many].sum()
    at = np.repeat(start[many] - np.concatenate(([0], np.cumsum(size[many])[:-1])), size[many]) + np.arange(total) if len(many) else many
    return pa.table({"g": np.repeat(group[many], size[many]).view(np.int64), "id": ids[at]})


def described(docs: DataFrame, n: int) -> DataFrame:
    """id, n, f (fingerprint) and counts (elements in each of 128 cells, 255 at most) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            own = sets(step.column("text"), n)
            counts = [np.minimum(np.bincount((s >> np.uint64(57)).astype(np.int64), minlength=_CELLS), 255).astype(np.uint8).tobytes() for s in own]
            yield pa.RecordBatch.from_arrays(
                [step.column("id"), pa.array([len(s) for s in own], pa.int64()),
                 pa.array([fingerprint(s) if len(s) else None for s in own], pa.int64()), pa.array(counts, pa.binary())],
                names=["id", "n", "f", "counts"])

    return arrow_map(docs, run, "id long, n long, f long, counts binary")


def possible(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Those of (a, b) that sizes and feature counts do not rule out, with their sizes."""
    for side in "ab":
        pairs = pairs.join(reps.select(F.col("id").alias(side), F.col("n").alias(f"n{side}"), F.col("counts").alias(f"c{side}")), side)
    pairs = pairs.where((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ca, cb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, _CELLS).astype(np.int32) for c in ("ca", "cb"))
            total = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            near = np.abs(ca - cb).sum(1) * (100 + percent) <= (100 - percent) * total
            yield batch.filter(pa.array(near)).select(["a", "b", "na", "nb"])

    return arrow_map(pairs.select("a", "b", "na", "nb", "ca", "cb"), run, "a long, b long, na long, nb long")


def sorted_units(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """Rows of groups (g, or two blocks of a large one: low, high) by size, and where each unit begins, then their number."""
    table = table.sort_by([(x, "ascending") for x in ("g", "low", "high", "n", "id")])
    g, low, high = (table.column(x).to_numpy() for x in ("g", "low", "high"))
    return table, np.flatnonzero(np.concatenate(([True], (g[1:] != g[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1]), [True])))


def partners(table: pa.Table, new: np.ndarray, counts: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, rows of its unit) of different components that sizes and feature counts do not rule out and that are not a
    document and its hub, which the first round has judged."""
    low, high, i, n, c, ids, hub = (table.column(x).to_numpy() for x in ("low", "high", "i", "n", "c", "id", "hub"))
    reach = 100 * n // percent
    for a, b in zip(new[:-1].tolist(), new[1:].tolist()):
        for x in range(a, b - 1):  # partners that are as large or larger, within reach
            some = np.arange(x + 1, a + np.searchsorted(n[a:b], reach[x], side="right"))
            some = some[(c[some] != c[x]) & ((low[x] == high[x]) | (i[some] != i[x])) & (ids[some] != hub[x]) & (hub[some] != ids[x])]
            if len(some):
                near = np.abs(counts[some] - counts[x]).sum(axis=1, dtype=np.int32) * (100 + percent) <= (100 - percent) * (n[some] + n[x])
                if near.any():
                    yield x, some[near]


def with_partners(percent: int):
    """Groups -> of each, the documents that have partners in it; of a task's groups with the same ones left, the first."""

    def run(table: pa.Table) -> pa.Table:
        table, new = sorted_units(table)
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint8).reshape(-1, _CELLS).astype(np.int16)
        used = np.zeros(len(counts), bool)
        for x, some in partners(table, new, counts, percent):
            used[x] = used[some] = True
        low, high, i, n, ids = (table.column(x).to_numpy() for x in ("low", "high", "i", "n", "id"))
        seen, kept = set(), [new[:0]]
        for a, b in zip(new[:-1].tolist(), new[1:].tolist()):
            own = a + np.flatnonzero(used[a:b])
            key = ids[own].tobytes(), n[own].tobytes(), i[own].tobytes() if low[a] != high[a] else None
            if len(own) and key not in seen:
                seen.add(key)
                kept.append(own)
        return table.take(pa.array(np.concatenate(kept))).select(MARKED)

    return run


def tested(percent: int):
    """Groups of documents with partners, and the documents' sets -> links (a, b) of different components, verified.

    Every pair is compared once a task at most, and not at all once links of the task have joined its components: at most
    one link fewer comes out than there are components.
    """

    def run(table: pa.Table, held: pa.Table) -> pa.Table:
        own: list[np.ndarray] = []
        of: dict[tuple[int, int], list[int]] = {}  # rows that share an id: each of them
        for k, blob in dict.fromkeys(zip(held.column("id").to_pylist(), held.column("s").to_pylist())):
            of.setdefault((k, len(blob) // 6), []).append(len(own))
            own.append(restore(blob))
        sides = [(row, e) for row, key in enumerate(zip(table.column("id").to_pylist(), table.column("n").to_pylist())) for e in of[key]]
        table = table.take(pa.array([row for row, _ in sides], pa.int64())).append_column("e", pa.array([e for _, e in sides], pa.int64()))
        found: list[tuple[int, int]] = []
        if len(sides):
            table, new = sorted_units(table)
            c, ids, e = (table.column(x).to_pylist() for x in ("c", "id", "e"))
            counts = np.stack([np.bincount((s >> np.uint64(41)).astype(np.int64), minlength=_CELLS) for s in own]).astype(np.int32)
            done = np.zeros((len(own), len(own) // 8 + 1), np.uint8)  # a bit for every pair
            root: dict[int, int] = {}

            def top(x: int) -> int:
                while (up := root.get(x, x)) != x:
                    root[x] = x = root.get(up, up)
                return x

            for x, some in partners(table, new, counts[e], percent):
                for y in some.tolist():
                    p, q, (one, two) = top(c[x]), top(c[y]), sorted((e[x], e[y]))
                    if p == q or done[one, two >> 3] >> (two & 7) & 1:
                        continue
                    done[one, two >> 3] |= 1 << (two & 7)
                    common = len(np.intersect1d(own[one], own[two], assume_unique=True))
                    if (100 + percent) * common >= percent * (len(own[one]) + len(own[two])):
                        root[q] = p
                        found.append((max(ids[x], ids[y]), min(ids[x], ids[y])))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return run


def by_hub(pairs: DataFrame, block: int) -> DataFrame:
    """Pairs (hub a, b, na, nb) with the group (k, i, j) in which their sets meet: many hubs to a group, or a part of a large hub's."""
    n = pairs.count()
    sizes = checkpointed(pairs.groupBy("a").agg(F.count("*").alias("m")), n)
    groups = max(1, n // block)
    large = sizes.where(F.col("m") > block).select("a", F.ceil(F.col("m") / block).alias("parts"))
    alone, own = F.col("parts").isNull(), F.xxhash64("a")
    return pairs.join(large, "a", "left").select(
        "a", "b", "na", "nb", F.when(alone, F.pmod(own, F.lit(groups))).otherwise(-1 - F.pmod(own, F.lit(1 << 60))).alias("k"),
        F.lit(0).alias("i"), F.when(alone, 0).otherwise(F.pmod(F.xxhash64("b"), F.col("parts"))).cast("int").alias("j"))


def restore(blob: bytes) -> np.ndarray:
    k = len(blob) // 6
    return np.frombuffer(blob, np.uint32, k).astype(np.uint64) | np.frombuffer(blob, np.uint16, k, 4 * k).astype(np.uint64) << np.uint64(32)


def placed(sides: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """The sets (id, s: 48 bits an element) of the ids of ``sides``, once for each of its rows; ``sides`` is computed already."""
    wanted = sides.select(F.col("id").alias("wanted")).distinct()
    few = sides.count() <= BROADCAST_IDS
    own = docs.join(F.broadcast(wanted) if few else wanted, F.col("id") == F.col("wanted"), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            blobs = []
            for s in sets(step.column("text"), n):
                v = s >> np.uint64(16)
                blobs.append(v.astype(np.uint32).tobytes() + (v >> np.uint64(32)).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([step.column("id"), pa.array(blobs, pa.binary())], names=["id", "s"])

    held = arrow_map(own.select("id", "text"), run, "id long, s binary")
    return held.join(F.broadcast(sides) if few else sides, "id")


def verified(pairs: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """(a, b, na, nb) with ``common``, the number of elements that both sets hold; ``pairs`` (a, b, na, nb, k, i, j) is computed already.

    Sets travel once for every group (k, i, j) of pairs they are in, not once a pair.
    """
    sides = checkpointed(pairs.select(F.explode(F.array("a", "b")).alias("id"), "k", "i", "j").distinct(), 2 * pairs.count())
    held = placed(sides, docs, n).select("k", "i", "j", "id", "s")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        own: dict[int, list[bytes]] = {}  # rows that share an id: each of them
        for k, s in zip(right.column("id").to_pylist(), right.column("s").to_pylist()):
            if s not in own.setdefault(k, []):
                own[k].append(s)
        left = left.sort_by("a")
        last, mine, common = None, [], []
        for a, b in zip(left.column("a").to_pylist(), left.column("b").to_pylist()):
            if a != last:
                last, mine = a, [restore(x) for x in own[a]]
            other = [restore(x) for x in own[b]]
            common.append(max(len(np.intersect1d(x, y, assume_unique=True)) for x in mine for y in other))
        return left.select(["a", "b", "na", "nb"]).append_column("common", pa.array(common, pa.int64()))

    keys = ("k", "i", "j")
    return pairs.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(grouped(compare), "a long, b long, na long, nb long, common long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """``id_col``, n_shingles and component_id (the smallest id reachable by links) of every row."""
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"the threshold must be {LEAST_PERCENT} to 100 percent")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    named = rows.where(F.col("id").isNotNull())
    facts = checkpointed(described(rows, n))
    reps = facts.where("f is not null and id is not null").groupBy("f").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("counts").alias("counts"))
    whose = facts.where("f is not null and id is not null").select("id", "f").join(reps.select("f", F.col("id").alias("rep")), "f").select("id", "rep")
    copies = whose.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    n_rows = facts.count()
    reps = checkpointed(reps.select("id", "n", "counts"), n_rows)

    ranges = 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = packed_signatures(named, n, percent, ranges).groupBy("cell").applyInArrow(grouped(shared_groups), "g long, id long").distinct()
    groups = checkpointed(groups.join(whose, "id").select("g", F.col("rep").alias("id")).distinct())

    degree = groups.groupBy("id").agg(F.count("*").alias("degree"))
    hubs = groups.join(degree, "id").groupBy("g").agg(F.max_by("id", F.struct("degree", -F.col("id"))).alias("hub"), F.count("*").alias("size"))
    hubs = hubs.where("size > 1").select("g", "hub")
    first = groups.join(hubs, "g").where("id <> hub").groupBy("id", "hub").agg(F.count("*").alias("times"))
    first = first.groupBy("id").agg(F.max_by("hub", F.struct("times", -F.col("hub"))).alias("hub"))
    first = first.select(F.col("hub").alias("a"), F.col("id").alias("b"))
    linked = (100 + percent) * F.col("common") >= percent * (F.col("na") + F.col("nb"))
    first = checkpointed(by_hub(checkpointed(possible(first, reps, percent), n_rows), BLOCK), n_rows)
    judged = first.select(F.col("b").alias("id"), F.col("a").alias("hub"))  # the others were ruled out, and are again
    judgements = checkpointed(verified(first, rows, n), n_rows)
    links = judgements.where(linked).select("a", "b").unionByName(copies)
    whole = checkpointed(components(links), n_rows)

    # in groups that still hold several components, their documents in blocks; a task has groups of the same least component
    of = groups.join(whole, F.col("id") == F.col("node"), "left").select("g", "id", F.coalesce("component", "id").alias("c"))
    still = of.groupBy("g").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.count("*").alias("m")).where("c0 <> c1")
    still = checkpointed(still.select("g", "c0", "m", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")))
    tasks = max(1, (still.agg(F.sum(F.col("m") * F.col("blocks"))).first()[0] or 0) // TASK_ROWS)
    parts = still.groupBy("c0", "blocks").agg(F.ceil(2 * F.sum("m") / ((F.col("blocks") + 1) * TASK_ROWS)).alias("parts"))
    nodes = of.join(still.join(parts, ["c0", "blocks"]).select("g", "c0", "blocks", "parts"), "g").join(reps, "id") \
        .join(judged, "id", "left").withColumn("hub", F.coalesce("hub", "id")) \
        .withColumn("i", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumns({"low": F.least("i", "other"), "high": F.greatest("i", "other")})
    place = F.xxhash64("c0", "blocks", "low", "high", F.pmod(F.xxhash64("g"), F.col("parts")))
    nodes = nodes.withColumn("task", F.pmod(place, F.lit(tasks))).select(*MARKED, "counts")
    marked = checkpointed(nodes.groupBy("task").applyInArrow(
        grouped(with_partners(percent)), "g long, low int, high int, i int, id long, n long, c long, hub long, task long"))
    if marked.head(1):  # rows, if any, of the second round
        sides = checkpointed(marked.select("id", "task").distinct())
        held = placed(sides, rows, n).select("task", "id", "s")
        more = marked.groupBy("task").cogroup(held.groupBy("task")).applyInArrow(grouped(tested(percent)), "a long, b long")
        whole = components(links.unionByName(more))
    return facts.join(whole, F.col("id") == F.col("node"), "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def op1_partenum_join(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: five words, similarity 0.8."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP1_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[s:s + least(len(w), 5) - 1], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS s FROM doc WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM doc
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM doc d JOIN comp c USING (doc_id) LEFT JOIN n USING (doc_id)
"""
