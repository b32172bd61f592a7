"""Plain-Python versions of the operators, for small tables."""

import hashlib
import zlib

import numpy as np
import xxhash


def words(text):
    return (text or "").encode().split()


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text, size=3):
    found = (text or "").encode().lower().split()
    grams = [b" ".join(found[i:i + size]) for i in range(max(1, len(found) - size + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(rows, radius=2):
    """``[(doc_id, fingerprint, component)]`` by comparing all pairs of distinct fingerprints."""
    prints = [fingerprint(t) for _, t in rows]
    distinct = np.array(sorted(set(prints)), np.uint64)
    label = {int(f): min((d for (d, _), p in zip(rows, prints) if p == f and d is not None), default=None) for f in distinct}
    parent = {int(f): int(f) for f in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for f in distinct:
        for g in distinct[np.bitwise_count(distinct ^ f) <= radius]:
            parent[find(int(f))] = find(int(g))
    best: dict = {}
    for f, low in label.items():
        if low is not None:
            best[find(f)] = min(best.get(find(f), low), low)
    return [(d, f"{p:016x}", best.get(find(p))) for (d, _), p in zip(rows, prints)]


def substrings(rows, size=20):
    first: dict = {}
    for doc, text in rows:
        found = words(text)
        for i in range(len(found) - size + 1):
            key = tuple(found[i:i + size])
            first[key] = min(first.get(key, (doc, i)), (doc, i))
    out = []
    for doc, text in rows:
        found = words(text)
        gone = [False] * len(found)
        for i in range(len(found) - size + 1):
            if first[tuple(found[i:i + size])] != (doc, i):
                gone[i:i + size] = [True] * size
        kept = b" ".join(w for w, g in zip(found, gone) if not g).decode()
        out.append((doc, len(found), sum(gone), sha(kept)))
    return out


def pieces(rows, tokenizer, capacity=4096):
    out = []
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for p, a in enumerate(range(0, len(ids), capacity)):
            cut = np.array(ids[a:a + capacity], "<u4")
            out.append((doc, p, a, len(cut), zlib.crc32(cut.tobytes())))
    return out
