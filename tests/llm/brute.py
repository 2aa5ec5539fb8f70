"""Plain versions of what the operators must return, written for clarity alone."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

SEPARATED = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def words(text):
    return SEPARATED.findall(text or "")


def base_quality(text):
    ws = words(text)
    windows = [tuple(ws[i : i + 8]) for i in range(len(ws) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (
        len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
        len(ws) < 20 or 100 * len(covered) > 30 * len(ws),
    )


def fingerprint(text):
    ws = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] or [" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(rows):
    """(doc_id, text) -> (doc_id, fingerprint, component_id)."""
    prints = [fingerprint(t) for _, t in rows]
    kinds = list(set(prints))
    parent = {p: p for p in kinds}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            if (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    least = {}
    for (d, _), p in zip(rows, prints):
        if d is not None:
            least[root(p)] = min(least.get(root(p), d), d)
    return [(d, f"{p:016x}", least.get(root(p))) for (d, _), p in zip(rows, prints)]


def substrings(rows, size=20):
    """(doc_id, text) -> (doc_id, n_words, n_removed, kept)."""
    last = 1 << 63
    split = [(d, words(t)) for d, t in rows]
    first = {}
    for d, ws in split:
        for i in range(len(ws) - size + 1):
            key, at = tuple(ws[i : i + size]), (last if d is None else d, i)
            first[key] = min(first.get(key, at), at)
    out = []
    for d, ws in split:
        gone = {i + k for i in range(len(ws) - size + 1) if first[tuple(ws[i : i + size])] < (last if d is None else d, i) for k in range(size)}
        out.append((d, len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return out


def benchmark_hits(docs, items, size=10):
    """Rows (doc_id, n_words, n_hit, n_items, items)."""
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: pattern.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    owners = defaultdict(set)
    for name, text in items:
        ws = split(text)
        for i in range(max(1, len(ws) - size + 1) if ws else 0):
            owners[tuple(ws[i : i + size])].add("" if name is None else str(name))
    sizes = {len(k) for k in owners}
    out = []
    for d, text in docs:
        ws, hit, named = split(text), set(), set()
        for n in sizes:
            for i in range(len(ws) - n + 1):
                if (key := tuple(ws[i : i + n])) in owners:
                    hit.update(range(i, i + n))
                    named |= owners[key]
        out.append((d, len(ws), len(hit), len(named), ",".join(sorted(named))))
    return out


def secrets(text):
    keys = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token", "api_?key"))
    found = []
    for m in re.finditer(rf"({keys})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text or ""):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return sorted(found)
