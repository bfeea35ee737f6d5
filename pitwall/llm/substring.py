"""Exact substring dedup: words covered by a window that an earlier document holds are removed.

A window is ``window`` consecutive words of one document; it is removed where a document with a smaller id holds the
same words. Windows are judged on the input.

1. Anchors. Of the ``gram``-word hashes of a window the smallest (leftmost) is its anchor, so equal windows have equal
   anchors. A first pass counts in how many documents every anchor occurs. Bitmaps of fixed size, one bit a hash
   range, say which anchors several documents share and which are in ``crowd`` or more (a false bit only costs work).
2. Reference shards. A second pass cuts out the words around shared anchors (consecutive windows with the same anchor)
   and deals them by anchor, equal ones of a chunk of documents once. All windows that could be equal are in one shard,
   so instead of sending every shard's automaton to every task, each is built in the task that its shard's texts
   reach: the texts of an anchor enter a generalised suffix automaton in the order of their documents, every state
   keeps its first document, and each text is streamed through the automaton of those before it for its matching
   statistics. Where at least ``window`` words match, the state tells the first document of that window.
   Windows of crowded anchors are dealt by their own hash, as texts of one window, so no shard holds all neighbourhoods
   of a passage that very many documents share.
3. Removal. For every chunk of documents a list of its windows to remove meets the chunk's texts in one shuffle, and
   the union of the windows (maximal spans) is taken out.

A chunk is a stretch of one input partition of at most ``chunk_rows`` rows and ``CHUNK_BYTES``; its number follows
from the input's partitions, so the input must be read the same way by every pass (tables are). The last
pass looks up every window that a chunk was told of, and fails rather than return wrong rows if it isn't there.

Word identity is a 32-bit hash, window identity a 64-bit one: two windows that differ in one word are confused with a
chance of 2^-32.

Defined cases: null and empty texts have no words; texts shorter than a window lose nothing; rows with a null id lose
nothing and are no reference; rows that share an id are no earlier document to each other, in whatever chunks they are;
an empty table gives an empty result; a text is taken whole (its words' hashes are held at once, about 40 bytes a byte
of a single text); ids are whole numbers (others do not cast); other columns travel along.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .shared import arrow_map, grouped, steps
from .words import SPACED, grams, mixed, words

SHARED_BITS, CROWD_BITS = 27, 23
CHUNK_BYTES = 8 << 20
#: Packed entries (anchors, then words) of one output batch.
PACKED = 1 << 21


def chunked(batches: Iterator[pa.RecordBatch], chunk_rows: int, text=lambda batch: batch.column("text")) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of a partition with the number of their chunk; a chunk's slices follow each other. Cuts depend on the rows' order and lengths only."""
    task = TaskContext.get()
    base = (task.partitionId() if task else 0) << 32
    chunk = rows = size = 0
    for batch in batches:
        lengths = np.asarray(pc.fill_null(pc.binary_length(text(batch)), 0), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            if rows >= chunk_rows or size >= CHUNK_BYTES:
                chunk, rows, size = chunk + 1, 0, 0
            sums = np.cumsum(lengths[at:at + chunk_rows - rows])
            n = min(len(sums), int(np.searchsorted(sums, CHUNK_BYTES - size, side="left")) + 1)
            yield base | chunk, batch.slice(at, n)
            at, rows, size = at + n, rows + n, size + int(sums[n - 1])


def by_chunk(batches: Iterator[pa.RecordBatch], chunk_rows: int) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Each chunk's number and its rows in slices of bounded text."""
    last, held = None, []
    for chunk, own in chunked(batches, chunk_rows):
        if chunk != last and held:
            yield last, held
            held = []
        last = chunk
        held += steps([own], "text")
    if held:
        yield last, held


def anchors(own: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of a document's words: the place of its anchor, and all gram hashes."""
    all_grams = grams(own, gram)
    n, span = len(own) - window + 1, window - gram + 1
    if n <= 0:
        return np.zeros(0, np.int64), all_grams
    low, at = all_grams[:n].copy(), np.arange(n)
    for k in range(1, span):
        other = all_grams[k:k + n]
        less = other < low
        low[less] = other[less]
        at[less] = np.flatnonzero(less) + k
    return at, all_grams


def ids32(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words as 32-bit values in 64, and the first word of each text."""
    w = words(column, SPACED, lower=False)
    return w.hash >> np.uint64(32), w.first


def cells(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return (((hashes >> np.uint64(40)) * np.uint64(ranges)) >> np.uint64(24)).astype(np.int64)


def bit(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def has(bitmap: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    at = bit(hashes, bits)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def count_anchors(docs: DataFrame, window: int, gram: int, chunk_rows: int, ranges: int) -> DataFrame:
    """cell, blob: anchors (their first 40 bits) and in how many documents of a chunk they are (16 bits, saturating)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            h, n = (np.concatenate([x[k] for x in held]) for k in (0, 1))
            cell = cells(h, ranges)
            order = np.argsort(cell, kind="stable")
            h, n, cell = h[order], n[order], cell[order]
            edge = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1], [True])))
            low, top = (h >> np.uint64(24)).astype(np.uint32), (h >> np.uint64(56)).astype(np.uint8)
            blobs = [np.int64(b - a).tobytes() + low[a:b].tobytes() + n[a:b].tobytes() + top[a:b].tobytes()
                     for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
            return pa.RecordBatch.from_arrays([pa.array(cell[edge[:-1]]), pa.array(blobs, pa.binary())], names=["cell", "blob"])

        for _, parts in by_chunk(batches, chunk_rows):
            found = []
            for step in parts:
                w, first = ids32(step.column("text"))
                for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                    if b - a >= window:
                        at, g = anchors(w[a:b], window, gram)
                        found.append(np.unique(g[at[np.concatenate(([True], at[1:] != at[:-1]))]]))
            if found:
                h, n = np.unique(np.concatenate(found), return_counts=True)
                held.append((h, np.minimum(n, 65535).astype(np.uint16)))
                size += len(h)
            if size >= PACKED:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    return arrow_map(docs, run, "cell long, blob binary")


def marks(crowd: int):
    """A range's anchors -> its stretch of the two bitmaps."""

    def run(table: pa.Table) -> pa.Table:
        h, n = [], []
        for blob in table.column("blob").to_pylist():
            k = int(np.frombuffer(blob, np.int64, 1)[0])
            low, top = np.frombuffer(blob, np.uint32, k, 8).astype(np.uint64), np.frombuffer(blob, np.uint8, k, 8 + 6 * k).astype(np.uint64)
            h.append(low << np.uint64(24) | top << np.uint64(56))
            n.append(np.frombuffer(blob, np.uint16, k, 8 + 4 * k).astype(np.int64))
        h, at = np.unique(np.concatenate(h), return_inverse=True)
        n = np.bincount(at, weights=np.concatenate(n))
        kinds, offsets, blobs = [], [], []
        for kind, (bits, least) in enumerate(((SHARED_BITS, 2), (CROWD_BITS, crowd))):
            own = np.unique(bit(h[n >= least], bits))
            if len(own):
                low = int(own[0]) >> 3
                piece = np.zeros((int(own[-1]) >> 3) - low + 1, np.uint8)
                np.bitwise_or.at(piece, (own >> 3) - low, np.uint8(1) << (own & 7).astype(np.uint8))
                kinds.append(kind)
                offsets.append(low)
                blobs.append(piece.tobytes())
        return pa.table({"kind": pa.array(kinds, pa.int32()), "at": pa.array(offsets, pa.int64()), "bits": pa.array(blobs, pa.binary())})

    return run


def shard_texts(docs: DataFrame, bitmaps, window: int, gram: int, chunk_rows: int, ranges: int) -> DataFrame:
    """cell, blob: the texts around shared anchors, with chunk, anchor (or window) key, first document and whether there are more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, crowded = (np.frombuffer(b, np.uint8) for b in bitmaps.value)
        held, size = [], 0

        def out() -> pa.RecordBatch:
            chunk, key, doc, many, n = (np.concatenate([x[k] for x in held]) for k in range(5))
            flat = np.concatenate([x[5] for x in held])
            begin = np.cumsum(n) - n
            cell = cells(key, ranges)
            order = np.argsort(cell, kind="stable")
            cell = cell[order]
            chunk, key, doc, many, n, begin = (x[order] for x in (chunk, key, doc, many, n, begin))
            flat = flat[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            upto = np.concatenate(([0], np.cumsum(n)))
            edge = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1], [True])))
            chunks, chunk = np.unique(chunk, return_inverse=True)
            known = chunks.tobytes()
            blobs = [b"".join((np.array([b - a, len(chunks)], np.int64).tobytes(), known, chunk[a:b].astype(np.uint16).tobytes(),
                               key[a:b].tobytes(), doc[a:b].tobytes(), many[a:b].tobytes(), n[a:b].astype(np.uint16).tobytes(),
                               flat[upto[a]:upto[b]].tobytes())) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
            return pa.RecordBatch.from_arrays([pa.array(cell[edge[:-1]]), pa.array(blobs, pa.binary())], names=["cell", "blob"])

        for number, parts in by_chunk(batches, chunk_rows):
            keys, texts, ends, owner, flats, base = [], [], [], [], [], 0
            for step in parts:
                w, first = ids32(step.column("text"))
                flats.append(w)
                for doc, a, b in zip(step.column("id").to_pylist(), first[:-1].tolist(), first[1:].tolist()):
                    if doc is None or b - a < window:
                        continue
                    at, g = anchors(w[a:b], window, gram)
                    start = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
                    stop = np.concatenate((start[1:], [len(at)]))
                    h = g[at[start]]
                    yes = has(shared, h, SHARED_BITS)
                    if not yes.any():
                        continue
                    start, stop, h = start[yes], stop[yes], h[yes]
                    crowd = has(crowded, h, CROWD_BITS)
                    if crowd.any():  # window by window, each under its own hash
                        own = grams(w[a:b], window)
                        k = stop[crowd] - start[crowd]
                        each = np.repeat(start[crowd] - (np.cumsum(k) - k), k) + np.arange(k.sum())
                        start = np.concatenate((start[~crowd], each))
                        stop = np.concatenate((stop[~crowd], each + 1))
                        h = np.concatenate((h[~crowd], own[each]))
                    keys.append(h)
                    texts.append(start + a + base)
                    ends.append(stop + window - 1 + a + base)
                    owner.append(np.full(len(h), doc, np.int64))
                base += len(w)
            if not keys:
                continue
            flat = np.concatenate(flats)
            keys, texts, ends, owner = (np.concatenate(x) for x in (keys, texts, ends, owner))
            # equal texts of the chunk once: first and last window and the length tell a text
            full = grams(flat, window)
            same = mixed(mixed(full[texts]) + full[ends - window] + keys + (ends - texts).astype(np.uint64))
            order = np.lexsort((owner, same))
            same, keys, texts, ends, owner = (x[order] for x in (same, keys, texts, ends, owner))
            edge = np.flatnonzero(np.concatenate(([True], same[1:] != same[:-1])))
            last = owner[np.concatenate((edge[1:], [len(owner)])) - 1]
            keys, texts, ends, owner = keys[edge], texts[edge], ends[edge], owner[edge]
            n = ends - texts
            words_ = flat[np.repeat(texts - (np.cumsum(n) - n), n) + np.arange(n.sum())].astype(np.uint32)
            held.append((np.full(len(keys), number, np.int64), keys, owner, (last != owner).astype(np.uint8), n, words_))
            size += len(words_)
            if size >= PACKED:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    return arrow_map(docs, run, "cell long, blob binary")


class Automaton:
    """A generalised suffix automaton over words; every state knows the first document of its strings."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.first = [-1], [0], [-1]

    def add(self, text: list[int], doc: int) -> None:
        """Documents must come in ascending order."""
        nexts, link, length, first = self.next, self.link, self.length, self.first
        last = 0
        for c in text:
            q = nexts[last].get(c)
            if q is not None:
                if length[q] != length[last] + 1:
                    q = self._split(last, c, q)
                last = q
                continue
            new = len(nexts)
            nexts.append({})
            length.append(length[last] + 1)
            first.append(doc)
            link.append(0)
            p = last
            while p >= 0 and c not in nexts[p]:
                nexts[p][c] = new
                p = link[p]
            if p >= 0:
                q = nexts[p][c]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
            last = new

    def _split(self, p: int, c: int, q: int) -> int:
        nexts, link = self.next, self.link
        clone = len(nexts)
        nexts.append(nexts[q].copy())
        self.length.append(self.length[p] + 1)
        self.first.append(self.first[q])
        link.append(link[q])
        link[q] = clone
        while p >= 0 and nexts[p].get(c) == q:
            nexts[p][c] = clone
            p = link[p]
        return clone

    def firsts(self, text: list[int], window: int) -> list[int | None]:
        """The first document of every window of ``text``; None where no document has it."""
        nexts, link, length = self.next, self.link, self.length
        out, state, matched = [], 0, 0
        for k, c in enumerate(text, 1):
            while state and c not in nexts[state]:
                state = link[state]
                matched = length[state]
            q = nexts[state].get(c)
            if q is not None:
                state, matched = q, matched + 1
            if matched > window:  # only the last ``window`` words count
                matched = window
                while length[link[state]] >= window:
                    state = link[state]
            if k >= window:
                out.append(self.first[state] if matched >= window else None)
        return out


def first_documents(texts: list[list[int]], docs: list[int], window: int) -> list[int]:
    """Of every window of every text, the first document; texts in ascending order of their documents."""
    automaton, out = Automaton(), []
    for k, (text, doc) in enumerate(zip(texts, docs)):
        if k:
            out += [doc if f is None else f for f in automaton.firsts(text, window)]
        else:
            out += [doc] * (len(text) - window + 1)
        if k + 1 < len(texts):
            automaton.add(text, doc)
    return out


def judged(window: int):
    """A shard's texts -> (chunk, kind, blob): windows to remove from a chunk's documents; kind 0: from
    all, kind 1: from those with a larger id than the one given, where that document has rows in the chunk itself."""

    def run(table: pa.Table) -> pa.Table:
        columns: list[list[np.ndarray]] = [[] for _ in range(6)]
        for blob in table.column("blob").to_pylist():
            k, c = np.frombuffer(blob, np.int64, 2).tolist()
            at = 16
            known = np.frombuffer(blob, np.int64, c, at)
            at += 8 * c
            columns[0].append(known[np.frombuffer(blob, np.uint16, k, at)])
            at += 2 * k
            for j, (kind, width) in enumerate(((np.uint64, 8), (np.int64, 8), (np.uint8, 1), (np.uint16, 2)), 1):
                columns[j].append(np.frombuffer(blob, kind, k, at))
                at += width * k
            columns[5].append(np.frombuffer(blob, np.uint32, -1, at))
        chunk, key, doc, many, n, flat = (np.concatenate(c) for c in columns)
        n, flat = n.astype(np.int64), flat.astype(np.uint64)
        begin = np.cumsum(n) - n
        place = (np.arange(len(flat)) - np.repeat(begin, n)).astype(np.uint64)
        text = mixed(np.add.reduceat(mixed(flat + (place << np.uint64(32))), begin) + n.astype(np.uint64))
        order = np.lexsort((chunk, doc, text, key))
        chunk, key, doc, many, n, begin, text = (x[order] for x in (chunk, key, doc, many, n, begin, text))
        new_key = np.concatenate(([True], key[1:] != key[:-1]))
        new_text = new_key | np.concatenate(([True], text[1:] != text[:-1]))
        of = np.cumsum(new_text) - 1                       # row -> its text
        rows = np.flatnonzero(new_text)                    # text -> its first row: its first document
        group = (np.cumsum(new_key) - 1)[rows]             # text -> its anchor
        windows = n[rows] - window + 1
        offset = np.cumsum(windows) - windows
        full = grams(flat, window)
        starts = np.repeat(begin[rows] - offset, windows) + np.arange(windows.sum())
        hashes = full[starts]
        first = np.repeat(doc[rows], windows)
        home = np.repeat(chunk[rows], windows)             # the chunk of that document
        sizes = np.bincount(group)
        # a text that is alone with its anchor is its windows' first document; the others go through their automaton
        for g in np.flatnonzero(sizes > 1):
            own = np.arange(*np.searchsorted(group, (g, g + 1)))
            own = own[np.argsort(doc[rows[own]], kind="stable")]
            texts = [flat[b:b + k].tolist() for b, k in zip(begin[rows[own]].tolist(), n[rows[own]].tolist())]
            found = first_documents(texts, doc[rows[own]].tolist(), window)
            where = {d: c for d, c in zip(doc[rows[own]][::-1].tolist(), chunk[rows[own]][::-1].tolist())}
            at = 0
            for t in own.tolist():
                a, k = int(offset[t]), int(windows[t])
                part = found[at:at + k]
                first[a:a + k] = part
                home[a:a + k] = [where[d] for d in part]
                at += k
        # every row's windows
        k = windows[of]
        each = np.repeat(offset[of] - (np.cumsum(k) - k), k) + np.arange(k.sum())
        whose, lowest, more = np.repeat(chunk, k), np.repeat(doc, k), np.repeat(many, k) > 0
        first, home, hashes = first[each], home[each], hashes[each]
        # the first document may have another row with this window in the chunk: then the shard has that row too
        of_first = np.isin(mixed(first.view(np.uint64)) ^ whose.view(np.uint64), mixed(doc.view(np.uint64)) ^ chunk.view(np.uint64))
        late = (home == whose) | (first == lowest) | of_first
        keep = ~late | (first < lowest) | more
        out: list[tuple[int, int, bytes]] = []
        for kind in (0, 1):
            some = keep & (late == bool(kind))
            c, h, f = whose[some], hashes[some], first[some]
            order = np.lexsort((h, c))
            c, h, f = c[order], h[order], f[order]
            if not len(c):
                continue
            new = np.concatenate(([True], (c[1:] != c[:-1]) | (h[1:] != h[:-1])))
            c, h, f = c[new], h[new], f[new]
            edge = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1], [True])))
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                out.append((int(c[a]), kind, h[a:b].tobytes() + (f[a:b].tobytes() if kind else b"")))
        c, kind, blob = zip(*out) if out else ((), (), ())
        return pa.table({"chunk": pa.array(c, pa.int64()), "kind": pa.array(kind, pa.int32()), "blob": pa.array(blob, pa.binary())})

    return run


def finished(text_col: str, id_col: str, window: int):
    """A chunk's rows and the windows to remove from them -> the rows with what is kept."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        lists: list[list[bytes]] = [[], []]
        for kind, blob in zip(right.column("kind").to_pylist(), right.column("blob").to_pylist()):
            lists[kind].append(blob)
        everywhere = np.unique(np.concatenate([np.frombuffer(b, np.uint64) for b in lists[0]])) if lists[0] else np.zeros(0, np.uint64)
        later = np.concatenate([np.frombuffer(b, np.uint64, len(b) // 16) for b in lists[1]]) if lists[1] else np.zeros(0, np.uint64)
        after = np.concatenate([np.frombuffer(b, np.int64, -1, len(b) // 2) for b in lists[1]]) if lists[1] else np.zeros(0, np.int64)
        later, at = np.unique(later, return_index=True)
        after = after[at]
        seen = [np.zeros(len(everywhere), bool), np.zeros(len(later), bool)]

        def place(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if not len(table):
                return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
            k = np.minimum(np.searchsorted(table, values), len(table) - 1)
            return k, table[k] == values

        n_words, n_removed, kept = [], [], []
        rows = left.column("row").combine_chunks()
        rows = pa.RecordBatch.from_arrays([rows.field(id_col).cast(pa.int64()), rows.field(text_col).cast(pa.string())], names=["id", "text"])
        for step in steps([rows], "text"):
            w, first = ids32(step.column("text"))
            for doc, text, a, b in zip(step.column("id").to_pylist(), step.column("text"), first[:-1].tolist(), first[1:].tolist()):
                own = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
                n_words.append(b - a)
                if doc is not None and b - a >= window and (len(everywhere) or len(later)):
                    full = grams(w[a:b], window)
                    i, found = place(everywhere, full)
                    seen[0][i[found]] = True
                    j, special = place(later, full)
                    seen[1][j[special]] = True
                    gone = np.where(special, doc > after[j], found) if len(later) else found
                    if gone.any():
                        edge = np.zeros(b - a + 1, np.int32)
                        edge[:len(gone)] += gone
                        edge[window:window + len(gone)] -= gone
                        stays = np.cumsum(edge[:-1]) == 0
                        own = list(compress(own, stays.tolist()))
                kept.append(b" ".join(own))
                n_removed.append(b - a - len(own))
        if not (seen[0].all() and seen[1].all()):
            raise RuntimeError("a chunk's texts are not those of the first passes: the input's partitions changed between passes")
        return pa.table({"row": left.column("row"), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                         "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, gram: int = 5,
                   crowd: int = 4096, chunk_rows: int = 4096) -> DataFrame:
    """The rows of ``docs`` as a struct ``row``, with n_words, n_removed and kept (the kept words, joined by one space)."""
    if 2 * window - gram >= 1 << 16:
        raise ValueError("a text around an anchor has 65,535 words at most")
    spark = docs.sparkSession
    ranges = 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    pieces = count_anchors(rows, window, gram, chunk_rows, ranges) \
        .groupBy("cell").applyInArrow(grouped(marks(crowd)), "kind int, at long, bits binary").toLocalIterator()
    bitmaps = [np.zeros(1 << SHARED_BITS - 3, np.uint8), np.zeros(1 << CROWD_BITS - 3, np.uint8)]
    for kind, at, piece in pieces:  # together at most the bitmaps' fixed size, and a byte for each range
        bitmaps[kind][at:at + len(piece)] |= np.frombuffer(piece, np.uint8)
    shared = spark.sparkContext.broadcast(tuple(b.tobytes() for b in bitmaps))
    found = shard_texts(rows, shared, window, gram, chunk_rows, ranges).groupBy("cell") \
        .applyInArrow(grouped(judged(window)), "chunk long, kind int, blob binary")

    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, own in chunked(batches, chunk_rows, lambda batch: batch.column("row").field(text_col).cast(pa.string())):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(own.num_rows, chunk, np.int64)), own.column("row")], names=["chunk", "row"])

    row = StructField("row", whole.schema["row"].dataType)
    numbered = arrow_map(whole, number, StructType([StructField("chunk", LongType()), row]))
    schema = StructType([row, StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType())])
    return numbered.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(grouped(finished(text_col, id_col, window)), schema)


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without the 13-word windows that an earlier document holds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("row.doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
wins AS (
  SELECT doc_id, s, hash(array_to_string(w[s:s + 12], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS s FROM doc WHERE len(w) >= 13)),
firsts AS (SELECT g, min(doc_id) AS first FROM wins GROUP BY g),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(s, s + 12)) AS p FROM wins JOIN firsts USING (g) WHERE first < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM doc),
kept AS (
  SELECT k.doc_id, string_agg(word, ' ' ORDER BY k.p) AS text, count(*) AS n
  FROM words k LEFT JOIN gone g ON k.doc_id = g.doc_id AND k.p = g.p WHERE g.p IS NULL GROUP BY k.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM doc d LEFT JOIN kept k USING (doc_id)
"""
