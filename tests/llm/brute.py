"""Plain re-statements of the operators' contracts, one text or one small table at a time."""

import hashlib
import re
import zlib
from collections import Counter

import xxhash

ASSIGN = re.compile(r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def crc(n):
    return zlib.crc32(str(n).encode())


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def licenses(t):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    places, labels = [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def secrets(t):
    t = t or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m[1]) >= 8]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
    line = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))
    n = Counter(k for *_, k in spans)
    return n["assign"], n["access"], n["hex"], hashlib.sha256(line.encode()).hexdigest(), line


def counts(t):
    t = t or ""
    words = WORD.findall(t)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def simhash(t, k=3):
    words = WORD.findall(lower(t))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, fps, bits=2):
    """Smallest id reachable over links of at most ``bits`` differing bits."""
    up = list(range(len(ids)))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                up[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            r = root(i)
            least[r] = min(least.get(r, d), d)
    return [least.get(root(i)) for i in range(len(ids))]


def leaks(docs, items, w=8, least=6):
    """(doc, item) pairs that share ``least`` runs of ``w`` plain words (all, if the item has fewer)."""
    words = lambda t: re.findall(r"[^\W\d_]+", (t or "").lower())
    grams = lambda x: {tuple(x[i:i + w]) for i in range(len(x) - w + 1)}
    out = set()
    held = {i: grams(words(t)) for i, t in items}
    for d, t in docs:
        g = grams(words(t))
        for i, h in held.items():
            if h and len(g & h) >= min(least, len(h)):
                out.add((d, i))
    return out
