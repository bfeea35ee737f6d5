"""Token counts of every prefix of a text under byte-level BPE, by prefix dynamic programming.

A text is cut into its special strings and pattern pieces, as the vocabulary's library does. Within a piece the
program walks over the bytes: of the tokens that end at byte i exactly one may be the last token of the encoding
of the first i bytes, namely the one that, after the last token of what precedes it, is left apart by the merges.
So ``last[i]`` follows from ``last[i - len(token)]`` and ``count[i] = count[i - len(token)] + 1`` is the exact token
count of every prefix of the piece. Whole texts are sums over pieces, and as pieces repeat, results are kept by piece.

``Prefixes`` answers how many tokens any prefix has and which prefix fits a budget, without encoding again.

Defined cases: a null or empty text has 0 bytes and 0 tokens; special strings inside texts count as their one
token; texts may be of any length (pieces stream, only token ends are kept); repeated rows count each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import arrow_map

#: The pattern of the vocabulary's pre-tokeniser.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces whose counts a worker keeps.
KEPT_PIECES = 1 << 18
LONG_PIECE = 64


def byte_symbols() -> dict[str, int]:
    """The vocabulary file's printable stand-in of each byte: printable Latin-1 bytes stand for themselves, others follow from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """Tokens and merges of a byte-level BPE file in the tokenizers library's JSON format."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbol = byte_symbols()
        as_bytes = lambda token: bytes(symbol[c] for c in token)
        model = spec["model"]
        self.tokens = {as_bytes(t) for t in model["vocab"] if all(c in symbol for c in t)}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {(as_bytes(a), as_bytes(b)): k for k, (a, b) in enumerate(pairs)}
        #: Every tail of a token, and every head; True where it is a token itself.
        self.heads = {t[:k]: False for t in self.tokens for k in range(1, len(t))} | dict.fromkeys(self.tokens, True)
        self.tails = {t[k:]: False for t in self.tokens for k in range(1, len(t))} | dict.fromkeys(self.tokens, True)
        special = [t["content"] for t in spec.get("added_tokens", []) if t.get("special")]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pieces = regex.compile(PIECES)
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.recent: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def merged(self, data: bytes) -> list[bytes]:
        """The merges applied one by one; only used on two tokens at a time."""
        parts = [data[k:k + 1] for k in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.rank.get((parts[k], parts[k + 1]), 1 << 60), k) for k in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def apart(self, left: bytes, right: bytes) -> bool:
        """Do the merges leave the two tokens as they are? With an empty left one: is the right one its own encoding?"""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= KEPT_PIECES:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merged(left + right) == ([left, right] if left else [right])
        return known

    def lasts(self, piece: bytes) -> tuple[list[int], list[bytes]]:
        """For every prefix of ``piece``: its token count, and its last token."""
        n, heads, apart, pairs = len(piece), self.heads, self.apart, self.pairs
        count, last = [0] * (n + 1), [b""] * (n + 1)
        ending: list[list[int] | None] = [None] * (n + 1)
        for at in range(n):
            for to in range(at + 1, n + 1):  # tokens that start here; stops where no token goes on
                token = heads.get(piece[at:to])
                if token is None:
                    break
                if token:
                    if ending[to] is None:
                        ending[to] = [at]
                    else:
                        ending[to].append(at)
            end = at + 1
            for start in ending[end] or ():
                token = piece[start:end]
                known = pairs.get((last[start], token))
                if known or known is None and apart(last[start], token):
                    count[end], last[end] = count[start] + 1, token
                    break
            else:
                raise ValueError("the vocabulary has no token for a byte")
            ending[end] = None
        return count, last

    def last(self, piece: bytes, end: int, count: list[int], last: list[bytes | None]) -> bytes:
        """The same recurrence, from the end: fills in only the prefixes that the longest fitting tokens lead to."""
        tails, pairs = self.tails, self.pairs
        starts = []
        for start in range(end - 1, -1, -1):
            token = tails.get(piece[start:end])
            if token is None:
                break
            if token:
                starts.append(start)
        for start in reversed(starts):
            before = last[start]
            if before is None:
                before = self.last(piece, start, count, last)
            token = piece[start:end]
            known = pairs.get((before, token))
            if known or known is None and self.apart(before, token):
                count[end], last[end] = count[start] + 1, token
                return token
        raise ValueError("the vocabulary has no token for a byte")

    def piece_count(self, piece: str) -> int:
        """Tokens of one piece; short pieces are kept in two generations of bounded size."""
        n = self.recent.get(piece)
        if n is None:
            n = self.older.get(piece)
            if n is None:
                data = piece.encode()
                size = len(data)
                if data in self.tokens and self.apart(b"", data):
                    n = 1
                elif size <= 4 * LONG_PIECE:
                    count = [0] * (size + 1)
                    self.last(data, size, count, [b""] + [None] * size)
                    n = count[size]
                else:
                    n = self.lasts(data)[0][size]
            if len(piece) <= LONG_PIECE:
                if len(self.recent) >= KEPT_PIECES:
                    self.older, self.recent = self.recent, {}
                self.recent[piece] = n
        return n

    def stretches(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text cut at its special strings; True marks those."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            if m.start() > at:
                yield text[at:m.start()], False
            yield m.group(), True
            at = m.end()
        if at < len(text):
            yield text[at:] if at else text, False

    def count(self, text: str | None) -> int:
        """The tokens of the whole text."""
        return self.measure(text, None)[0]

    def measure(self, text: str | None, limit: int | None) -> tuple[int, int]:
        """The tokens of the whole text, and the end (in characters) of the last piece up to which it has at most ``limit``."""
        text = text or ""
        total, fits, at = 0, None, 0
        for part, special in self.stretches(text):
            before = total
            if special:
                total += 1
            else:
                long = len(part) > 1 << 20  # a long part's pieces are not held
                keep = self.recent.get
                for piece in (m.group() for m in self.pieces.finditer(part)) if long else self.pieces.findall(part):
                    n = keep(piece)
                    if n is None:
                        n = self.piece_count(piece)
                        keep = self.recent.get
                    total += n
            if fits is None and limit is not None and total > limit:
                # only the pieces that fit are walked again, by their known counts
                fits, left = at, limit - before
                for m in () if special else self.pieces.finditer(part):
                    left -= self.piece_count(m.group())
                    if left < 0:
                        break
                    fits = at + m.end()
            at += len(part)
        return total, at if fits is None else fits


class Prefixes:
    """Exact token counts of the prefixes of one text, as the whole text is cut into pieces."""

    def __init__(self, vocabulary: Vocabulary, text: str | None):
        self.text, counts = text or "", [np.zeros(1, np.int64)]
        total = 0
        for part, special in vocabulary.stretches(self.text):
            if special:  # counts once it is complete
                n = len(part.encode())
                counts.append(np.full(n, total, np.int64))
                counts[-1][-1] = total = total + 1
                continue
            for m in vocabulary.pieces.finditer(part):
                own = np.array(vocabulary.lasts(m.group().encode())[0][1:], np.int64) + total
                counts.append(own)
                total = int(own[-1])
        self.counts = np.concatenate(counts)

    def tokens(self, n_bytes: int) -> int:
        """Tokens of the first ``n_bytes`` bytes."""
        return int(self.counts[min(n_bytes, len(self.counts) - 1)])

    def fit(self, budget: int) -> str:
        """The longest prefix (whole characters) of at most ``budget`` tokens."""
        data = self.text.encode()
        ends = np.array([k for k in range(len(data) + 1) if k == len(data) or data[k] & 0xC0 != 0x80])
        return data[:ends[self.counts[ends] <= budget].max()].decode()


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def count_tokens(docs: DataFrame, vocabulary_file: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_bytes, n_tokens, over_limit and fit_bytes of every row.

    ``fit_bytes`` is the end, in bytes, of the last piece up to which the text has at most ``limit`` tokens: a cut
    there needs no second encoding. The vocabulary file is read by every worker from its installed place.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(vocabulary_file)
        for batch in batches:
            tokens, fits = [], []
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            for text, size in zip(batch.column(1), lengths.to_pylist()):
                text = text.as_py()
                n, end = v.measure(text, limit)
                tokens.append(n)
                fits.append(size if n <= limit else len(text[:end].encode()))
            n = pa.array(tokens, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lengths, n, pc.greater(n, limit), pa.array(fits, pa.int64())],
                names=["id", "n_bytes", "n_tokens", "over_limit", "fit_bytes"])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return arrow_map(out, run, f"id {id_type}, n_bytes long, n_tokens long, over_limit boolean, fit_bytes long") \
        .withColumnRenamed("id", id_col)


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of every whole text under byte_bpe_50k.json; over_limit beyond 1024."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, vocabulary_path("byte_bpe_50k.json"), 1024)
