"""Brute-force forms that the operators are held against."""

import math
import re
import zlib
from collections import Counter


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def smallest_reachable(nodes, links):
    label = {n: n for n in nodes}
    while True:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
        if not changed:
            return label


def shingles(text, n=5):
    w = spaced(lower(text))
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def jaccard_components(docs, percent=80):
    sets = {i: shingles(t) for i, t in docs}
    ids = sorted(i for i in sets if sets[i])
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c) for i, c in smallest_reachable(sets, links).items()}


def without_repeats(docs, window=13):
    first = {}
    for i, t in docs:
        w = spaced(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = {}
    for i, t in docs:
        w = spaced(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone |= set(range(k, k + window))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def benchmark_hits(text, items, window=10):
    w, hit, found = alnum(text), set(), set()
    for i, t in items:
        own = alnum(t)
        n = min(window, len(own))
        wins = {tuple(own[k:k + n]) for k in range(len(own) - n + 1)} if n else set()
        for k in range(len(w) - n + 1):
            if n and tuple(w[k:k + n]) in wins:
                hit |= set(range(k, k + n))
                found.add(str(i))
    return len(w), len(hit), sorted(found)


def unigram(docs, folds=5, held=1):
    """N, V and counts over training tokens; the end is None."""
    counts, total = Counter(), 0
    for i, t in docs:
        if i is None or fold(i, folds) != held:
            w = spaced(lower(t))
            counts.update(w)
            counts[None] += 1
            total += len(w) + 1
    return total, len(counts), counts


def spelled(text, depth=5):
    t = " ".join(spaced(lower(text))).encode()
    return b" " * depth + t + (b" \n" if t else b"\n")


def suffix_tree_scores(train, texts, min_count=8, divergence=2.0, smoothing=8.0, depth=5):
    """log10 probability of every text under contexts retained by count and divergence, from the definition, by dictionaries."""
    counts = [{} for _ in range(depth + 1)]
    for t in train:
        s = spelled(t, depth)
        for j in range(depth, len(s)):
            for d in range(depth + 1):
                counts[d].setdefault(s[j - d:j], Counter())[s[j]] += 1
    totals = {c: sum(n.values()) for level in counts for c, n in level.items()}
    count = {c: n for level in counts for c, n in level.items()}
    candidates = {c for c, n in totals.items() if n >= min_count}

    def probability(states, context, symbol, upto=None):
        p = 1 / 256
        for d in range((len(context) if upto is None else upto) + 1):
            c = context[len(context) - d:]
            if c in states:
                p = (count[c][symbol] + smoothing * p) / (totals[c] + smoothing)
        return p

    kept = set()
    for c in candidates:
        gain = sum(n * math.log(n / totals[c] / probability(candidates, c, s, len(c) - 1)) for s, n in count[c].items()) if c else math.inf
        if gain >= divergence:
            kept |= {c[k:] for k in range(len(c) + 1)} & candidates
    known = {}

    def log(context, symbol):
        key = context, symbol
        if key not in known:
            known[key] = math.log10(probability(kept, context, symbol))
        return known[key]

    out = []
    for t in texts:
        s = spelled(t, depth)
        out.append(sum(log(s[j - depth:j], s[j]) for j in range(depth, len(s))))
    return out
