"""Plain sequential versions of the contracts, for comparison on small tables."""

import hashlib
import re
import zlib
from collections import defaultdict

import duckdb

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(sf_dir, name, columns="*"):
    return duckdb.connect().execute(
        f"SELECT {columns} FROM read_parquet('{sf_dir}/{name}.parquet') ORDER BY 1").fetchall()


def runs_of(mask):
    out, start = [], None
    for i, m in enumerate([*mask, False]):
        if m and start is None:
            start = i
        elif not m and start is not None:
            out.append((start, i))
            start = None
    return out


def byte_repeats(docs, width=100):
    """op1: {doc_id: (n_bytes, n_removed, n_spans, sha256)} for docs in order of id."""
    seen, out = set(), {}
    for i, text in docs:
        raw = (text or "").encode()
        mask = bytearray(len(raw))
        for k in range(len(raw) - width + 1):
            w = raw[k:k + width]
            if w in seen:
                mask[k:k + width] = b"\1" * width
            else:
                seen.add(w)
        kept = bytes(b for b, m in zip(raw, mask) if not m)
        out[i] = (len(raw), sum(mask), len(runs_of(mask)), hashlib.sha256(kept).hexdigest())
    return out


def word_repeats(docs, width=50):
    """op9: {doc_id: (n_words, n_removed, sha256)}."""
    words = {i: WORD.findall(t or "") for i, t in docs}
    lowest = {}
    for i in sorted(words):
        w = words[i]
        for k in range(len(w) - width + 1):
            lowest.setdefault(tuple(w[k:k + width]), i)
    out = {}
    for i, w in words.items():
        mask = bytearray(len(w))
        for k in range(len(w) - width + 1):
            if lowest[tuple(w[k:k + width])] < i:
                mask[k:k + width] = b"\1" * width
        kept = " ".join(x for x, m in zip(w, mask) if not m)
        out[i] = (len(w), sum(mask), hashlib.sha256(kept.encode()).hexdigest())
    return out


def ascii_lower(s):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), s or "")


def shingles(text, n=5):
    w = WORD.findall(ascii_lower(text))
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}


def jaccard_components(docs, percent=80, n=5):
    """op7: {doc_id: (n_shingles, component_id)}, all pairs that share a shingle compared."""
    sets = {i: shingles(t, n) for i, t in docs}
    at = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            at[x].append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        shared = defaultdict(int)
        for x in s:
            for j in at[x]:
                if j < i:
                    shared[j] += 1
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def crc(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))
