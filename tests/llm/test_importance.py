"""Importance resampling against brute force."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
from helpers import alnum
from hypothesis import given, settings
from hypothesis import strategies as st

from pitwall.llm.importance import LONG_FEATURE, crcs, resample


def features(text):
    w = alnum(text)
    return [" ".join(w[k:k + n]) for n in (1, 2, 3) for k in range(len(w) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def brute(docs, target):
    s, t = (Counter(bucket(f) for text in texts for f in features(text)) for texts in ([x for _, x in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in s}
    out = []
    for i, text in docs:
        own = features(text)
        weight = sum(gain[bucket(f)] for f in own)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(alnum(text)) >= 20])
    long = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for rank, r in enumerate(long[:5 * len(long) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


def result(spark, frame, docs, target):
    items = spark.createDataFrame([(t,) for t in target], "text string")
    return sorted((tuple(r) for r in resample(frame(docs), items).collect()), key=str)


def test_matches_brute_force(spark, frame, small, odd):
    items = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("text").collect()]
    docs = small + [(100_000 + i, t) for i, t in odd] + [(None, "a b c " * 10), (None, None)]
    docs += [(200_000, "w" * 100_000 + " x y")] + 60 * [(5_000, "same text " * 12)] + 30 * [(None, "without an id " * 9)]
    assert result(spark, frame, docs, items + [None, "", "X-y"]) == brute(docs, items + [None, "", "X-y"])


def test_empty_tables(spark, frame, small):
    assert result(spark, frame, [], ["a b"]) == []
    assert result(spark, frame, small[:30], []) == brute(small[:30], [])


@settings(deadline=None, max_examples=60)
@given(st.binary(max_size=900), st.lists(st.tuples(st.integers(0, 900), st.integers(0, 700)), max_size=12))
def test_crcs_equal_zlib(data, spans):
    spans = [(min(a, len(data)), min(n, len(data) - min(a, len(data)))) for a, n in spans] + [(0, min(len(data), LONG_FEATURE))]
    start, length = (np.array(x, np.int64) for x in zip(*spans))
    got = crcs(np.frombuffer(data, np.uint8), start, length)
    assert got.tolist() == [zlib.crc32(data[a:a + n]) for a, n in spans]
