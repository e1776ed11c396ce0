"""Brute-force versions of the operators, written from their contracts, and small planted tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

from xxhash import xxh64_intdigest

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def simhash(rows):
    """{position in rows: (hex fingerprint, smallest id)} of (doc_id, text) rows."""
    fps = []
    for _, text in rows:
        w = WORDS.findall(lower(text or ""))
        sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
        h = [xxh64_intdigest(s.encode(), 42) for s in sh]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)].append(doc)
    return [(f"{fps[i]:016x}", min(least[find(i)], default=None)) for i in range(len(rows))]


def repeats(rows, length=200):
    """(n_bytes, n_removed, n_spans, kept_sha256) of each (doc_id, text) row."""
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def contamination(rows, items):
    """(n_words, n_hit, n_items, items_sha256) of each (doc_id, text) row against (item_id, text) rows."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in items:
        w = word.findall(lower(text or ""))
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i:i + n])].add(str(item))
    out = []
    for _, text in rows:
        w = word.findall(lower(text or ""))
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = WORDS.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if WORDS.search(x):
            dup += x in seen
            seen.add(x)
    win = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    rep = {j for i in range(len(w) - 7) if win[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(rep),
            len(w) < 20 or 100 * len(rep) > 30 * len(w))


def pii_base(text):
    """Base spans by plain scans of the contract's patterns."""
    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    checks = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.group().split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(d := re.sub("[^0-9]", "", m.group())) <= 19 and luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15))
    found = [(m.start(), k, m.end()) for k, (_, p, ok) in enumerate(checks) for m in re.finditer(p, text or "") if ok(m)]
    return sorted(found)


def crc(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))


LATIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def cluster(rows, k=40, rounds=5, dims=64, scale=256, seed="2"):
    """(vec_id, cluster, distance, cluster inertia, inertia, digest) of the usable (vec_id, vector) rows, by all distances."""
    kept = [(i, [scale * n // d for n, d in map(float.as_integer_ratio, v)], v) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and x == x and abs(x) != float("inf") for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[2]))[:k]
    centroids = [x for _, x, _ in first]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        of = defaultdict(list)
        for _, x, _ in kept:
            of[near(x)[1]].append(x)
        for n, some in of.items():
            centroids[n] = [sum(c) // len(some) for c in zip(*some)]
    found = [(i, *near(x)) for i, x, _ in kept]
    inertia = Counter()
    for _, d, n in found:
        inertia[n] += d
    long = lambda v: v if v < 1 << 63 else None
    whole = {n: None if any(long(d) is None for _, d, m in found if m == n) else v for n, v in inertia.items()}
    every = None if None in whole.values() else long(sum(whole.values()))
    return [(i, n, long(d), None if whole[n] is None else long(whole[n]), every,
             hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for i, d, n in found]


def resample(rows, items, ngrams=1, buckets=10_000, seed="2024", least=20, percent=10):
    """(doc_id, n_features, weight, score, rank) of each (doc_id, text)."""
    import math

    def hashed(text):
        w = LATIN.findall(lower(text or ""))
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, ngrams + 1) for i in range(len(w) - n + 1)]

    raw, goal = Counter(), Counter()
    docs = [(i, *hashed(t)) for i, t in rows]
    for _, _, f in docs:
        raw.update(f)
    for _, t in items:
        goal.update(hashed(t)[1])
    s, t = sum(raw.values()), sum(goal.values())
    gain = lambda b: math.floor(1000 * math.log((goal[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets))))
    out = []
    for i, n, f in docs:
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    some = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for place, r in enumerate(some[:len(some) * percent // 100], 1):
        r[4] = place
    return [tuple(r[:5]) for r in out]


def mix(rows, weights=(5, 2, 1), epochs=3, percent=100, seed="13"):
    """(doc_id, size, source, source size, target, taken) of each (doc_id, text, source): one queue, served document by document."""
    seen, docs = Counter(), []
    for i, t, source in rows:
        size = len(WORDS.findall(t or ""))
        seen[i, source, size] += 1
        number = seen[i, source, size]
        parts = [seed, *([str(i)] if i is not None else []), str(size), str(number)]
        h = int(hashlib.sha256(":".join(parts).encode()).hexdigest()[:15], 16)
        docs.append((source, h, i, size, number))
    sources = sorted({d[0] for d in docs}, key=lambda x: (x is None, (x or "").encode()))
    total = {x: sum(d[3] for d in docs if d[0] == x) for x in sources}
    weight = {x: weights[n % len(weights)] for n, x in enumerate(sources)}
    budget = sum(total.values()) * percent // 100
    target, open_ = {}, set(sources)
    while open_:  # the excess goes to the others until none is above
        rest, w = budget - sum(target.values()), sum(weight[x] for x in open_)
        above = {x for x in open_ if weight[x] * rest / w >= epochs * total[x]}
        if not above:
            target |= {x: weight[x] * rest / w for x in open_}
            break
        target |= {x: epochs * total[x] for x in above}
        open_ -= above
    line = []
    key = lambda d: (d[1], d[2] is None, d[2] or 0, d[3], d[4])
    for x in sources:
        words = 0
        for _ in range(epochs):
            for n, d in sorted(((n, d) for n, d in enumerate(docs) if d[0] == x), key=lambda p: key(p[1])):
                words += d[3]
                if d[3]:
                    line.append((words / target[x], x is None, x or "", *key(d), n))
    taken, left = Counter(), budget
    for *_, n in sorted(line):
        if docs[n][3] > left:
            break
        left -= docs[n][3]
        taken[n] += docs[n][3]
    return [(d[2], d[3], d[0], total[d[0]], round(float(target[d[0]]), 6), taken[n]) for n, d in enumerate(docs)]
