"""The operators' results worked out in plain Python, without their methods."""

import collections
import math
import re
import zlib

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def lowered(text):
    return (text or "").translate(LOWER)


def words(text):
    return WORD.findall(text or "")


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def grams(seq, n):
    return [tuple(seq[i : i + n]) for i in range(len(seq) - n + 1)]


def fingerprint(text):
    w = words(lowered(text))
    parts = [" ".join(g) for g in grams(w, 3)] or ([" ".join(w)] if w else [])
    ones = [0] * 64
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), seed=42)
        for i in range(64):
            ones[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * ones[i] > len(parts))


def groups(prints):
    """Smallest id reachable over links of at most two bits; prints: id -> fingerprint."""
    ids, values = list(prints), np.array(list(prints.values()), np.uint64)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, i in enumerate(ids):
        for j in np.nonzero(np.bitwise_count(values ^ values[k]) <= 2)[0]:
            a, b = sorted((find(i), find(ids[int(j)])))
            parent[b] = a
    return {i: find(i) for i in ids}


def removed_lines(docs):
    """docs: ordered (id, text); line numbers that go, by position of the document."""
    seen, out = [], []
    for _, text in docs:
        gone = []
        for k, line in enumerate(text.split("\n") if text is not None else []):
            s = frozenset(words(line.lower()))
            if not s:
                continue
            if any(9 * len(s & o) >= 4 * (len(s) + len(o)) for o in seen):
                gone.append(k)
            seen.append(s)
        out.append(gone)
    return out


SECRETS = [
    ("assign", re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), lambda m: len(m[2]) >= 8),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32),
]


def base_secrets(text):
    found = [(m.start(), i, m.end()) for i, (_, p, keep) in enumerate(SECRETS) for m in p.finditer(text or "") if keep(m)]
    return [(SECRETS[i][0], s, e) for s, i, e in sorted(found)]


def repeated(ws, n=5):
    g = grams(ws, n)
    times, covered = collections.Counter(g), set()
    for i, x in enumerate(g):
        if times[x] > 1:
            covered.update(range(i, i + n))
    return len(covered)


def base_quality(text):
    ws, seen, dup = words(text), set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), dup, repeated(ws)


def base_scores(docs):
    """docs: id -> text; id -> (held out, tokens, known, training tokens, base score)."""
    count = collections.Counter()
    for i, t in docs.items():
        if fold(i) != 1:
            count.update([*words(lowered(t)), None])
    total, kinds = sum(count.values()), len(count)
    one = lambda w: math.log10((count[w] + 0.5) / (total + 0.5 * (kinds + 1)))
    out = {}
    for i, t in docs.items():
        tokens = [*words(lowered(t)), None]
        out[i] = (fold(i) == 1, len(tokens), sum(count[w] > 0 for w in tokens), total, sum(map(one, tokens)))
    return out


def bench_words(text):
    return lowered(text).translate({ord(c): None for c in ".,;:!?\"'()"}).split()


def leaks(text, items):
    there, out = set(grams(bench_words(text), 5)), []
    for i, t in items.items():
        g = grams(bench_words(t), 5)
        if not g:
            continue
        f = [x in there for x in g]
        m = (len(f) + 1) // 2
        halves = [h for h in (f[:m], f[m:]) if h]
        if sum(f) >= 0.8 * len(f) and all(sum(h) >= 0.5 * len(h) for h in halves):
            out.append(i)
    return sorted(out)
