"""Operator 9: substring dedup on words by super-k-mer partitioning.

Consecutive windows of ``width`` words that share a minimiser travel as one packed string, the
words joined by single spaces, to the bucket of the minimiser (see ``repeats``); there the windows
are sorted as strings, which brings equal ones together exactly, and every window that also starts
in a document of smaller id is marked.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from vigil.llm.common import by_bytes, covered, documents, flat, mix, runs
from vigil.llm.repeats import (ONE, SPREAD, TWO, Wanted, arrow_schema, drawn, ids_of, in_order,
                               repeated_spans, spans_by_row, window_runs, with_blocks)

WIDTH = 50
GRAM = 8
FACTOR = 0x9E3779B97F4A7C15
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def words_of(raw: np.ndarray, offsets: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, bounds) of the words of a chunk of documents: byte places of each word and
    the number of words before each document. Words end at the end of their document."""
    word = ~IS_SPACE[raw]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(raw))]
    begins[edges] = word[edges]
    stops = word.copy()
    stops[:-1] &= ~word[1:]
    stops[edges - 1] = word[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: differences of a running polynomial over the bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = len(raw)
    power = np.full(n + 1, FACTOR, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    total = np.concatenate((np.zeros(1, np.uint64),
                            np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:n])))
    back = np.full(n + 1, pow(FACTOR, -1, 1 << 64), np.uint64)
    back[0] = 1
    back = np.cumprod(back)
    return mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def _functions(width: int, gram: int, spread: int = SPREAD):
    def scan(t: pa.Table):
        """Per chunk: (first row, bytes, word hashes, starts, ends, bounds, runs)."""
        raw, offsets = flat(t.column("text"))
        for i, j in by_bytes(offsets):
            part = raw[offsets[i]:offsets[j]]
            off = offsets[i:j + 1] - offsets[i]
            starts, ends, bounds = words_of(part, off)
            h = word_hashes(part, starts, ends)
            for first, last, key, _ in window_runs(h, bounds, gram, width):
                yield i, part, h, starts, ends, bounds, first, last, key

    def once(h: np.ndarray, d: np.ndarray) -> np.ndarray:
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        s, e = runs(h)
        return h[s] | np.where(d[s] != d[e - 1], ONE, np.uint64(0))  # in several documents

    def minimisers(t: pa.Table) -> np.ndarray:
        ids = ids_of(t)
        none = np.zeros(0, np.uint64)
        keys, docs, many = [none], [np.zeros(0, np.int64)], [none]
        for i, _, h, _, _, bounds, first, last, key in scan(t):
            keys.append(key)
            docs.append(ids[i + np.searchsorted(bounds, first, "right") - 1])
            many.append(key[drawn(h, first, last, width, spread)])
        h = once(np.concatenate(keys), np.concatenate(docs))
        h[np.searchsorted(h | ONE, np.concatenate(many))] |= TWO
        return h

    def windows(t: pa.Table, wanted: Wanted) -> np.ndarray:
        ids = ids_of(t)
        keys, docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for i, _, h, _, _, bounds, first, last, key in scan(t):
            at, key = wanted.hot_windows(h, first, last, key, width)
            keys.append(key)
            docs.append(ids[i + np.searchsorted(bounds, at, "right") - 1])
        return once(np.concatenate(keys), np.concatenate(docs))

    def pack(t: pa.Table, wanted: Wanted):
        ids = ids_of(t)
        keys, rows, starts, ends, packed, again = [], [], [], [], [], []
        seen: dict[bytes, int] = {}
        chunk, text = None, b""
        for i, part, symbols, w_start, w_end, bounds, first, last, h in scan(t):
            if chunk is not part:
                chunk, text = part, np.where(IS_SPACE[part], np.uint8(32), part).tobytes()
            first, end, h = wanted.strings(symbols, first, last, h, width)
            local = np.searchsorted(bounds, first, "right") - 1
            keys.append(h)
            rows.append(local + i)
            starts.append(first - bounds[local])
            ends.append(end - bounds[local])
            for a, b, d in zip(w_start[first].tolist(), w_end[end - 1].tolist(),
                               ids[local + i].tolist()):
                s = text[a:b]
                if b"  " in s:
                    s = b" ".join(s.split())
                # a repeat in another document is known here; in the same one the bucket decides
                again.append(seen.setdefault(s, d) != d)
                packed.append(s)
        none = [np.zeros(0, np.int64)]
        return (np.concatenate(keys or [np.zeros(0, np.uint64)]), np.concatenate(rows or none),
                np.concatenate(starts or none), packed, np.array(again, bool),
                np.concatenate(ends or none))

    def match(ids, rows, starts, packed):
        first: dict[bytes, int] = {}
        source = np.array([first.setdefault(s, i) for i, s in enumerate(packed)], np.int64)
        windows, owner, place, n_windows = [], [], [], {}
        for s, i in first.items():
            gaps = [-1, *np.flatnonzero(np.frombuffer(s, np.uint8) == 32).tolist(), len(s)]
            n = len(gaps) - width
            n_windows[i] = n
            windows += [s[gaps[k] + 1:gaps[k + width]] for k in range(n)]
            owner += [i] * n
            place += range(n)
        owner, place = np.array(owner, np.int64), np.array(place, np.int64)
        order = np.array(sorted(range(len(windows)), key=windows.__getitem__), np.int64)
        # equal windows are neighbours now, in order of (id, row, start) of their strings
        same = np.array([windows[a] == windows[b] for a, b in
                         zip(order[:-1].tolist(), order[1:].tolist())], bool)
        group = np.concatenate(([0], np.cumsum(~same))) if len(order) else order
        lowest = ids[owner[order[np.searchsorted(group, group)]]] if len(order) else order
        hit = order[lowest < ids[owner[order]]]
        marked: dict[int, list] = {}
        for o, p in zip(owner[hit].tolist(), place[hit].tolist()):
            marked.setdefault(o, []).append(p)
        spans = {}
        for o, p in marked.items():
            p = np.sort(np.array(p))
            cut = np.flatnonzero(np.diff(p) != 1) + 1
            spans[o] = (p[np.concatenate(([0], cut))],
                        p[np.concatenate((cut, [len(p)])) - 1] + width)
        entry, a, b = [], [], []
        for i, o in enumerate(source.tolist()):
            if ids[i] != ids[o]:
                entry.append([i])
                a.append([0])
                b.append([n_windows[o] - 1 + width])
            elif o in spans:
                entry.append([i] * len(spans[o][0]))
                a.append(spans[o][0])
                b.append(spans[o][1])
        none = [np.zeros(0, np.int64)]
        return tuple(np.concatenate(x or none).astype(np.int64) for x in (entry, a, b))

    return minimisers, windows, pack, match


def _kept(t: pa.Table, found: pa.Table):
    """(row number, id, words, kept words) of each row of a block."""
    if not t.num_rows:
        return
    raw, offsets = flat(t.column("text"))
    at, starts, ends = spans_by_row(found, t.num_rows)
    for k, i in enumerate(t.column("id").to_pylist()):
        words = raw[offsets[k]:offsets[k + 1]].tobytes().split()
        s, e = starts[at[k]:at[k + 1]], ends[at[k]:at[k + 1]]
        yield k, i, words, list(compress(words, ~covered(s, e, len(words)))) if len(s) else words


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = WIDTH, gram: int = GRAM,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``id``, ``n_words``, ``n_removed``, ``kept`` and the columns
    ``keep``. ``kept`` is the text as it was where nothing is removed (null stays null), else the
    kept words joined by single spaces.

    Words are maximal runs of bytes other than space and 0x09-0x0D, unchanged. A word goes when a
    window of ``width`` words covers it whose words also start in a document of smaller id;
    windows are judged on the input. Rows of one id count as one document: they lose nothing to
    each other. Null ids come last. Null, empty and short texts lose nothing. Other columns are
    not looked at; an empty table gives no rows.
    """
    rows, n_blocks = with_blocks(docs, id_col, text_col, keep)
    spans = repeated_spans(rows, n_blocks, *_functions(width, gram))
    out = rows.select("id", *(f"keep.{c}" for c in keep)).schema
    for name, kind in (("n_words", "long"), ("n_removed", "long"), ("kept", "string")):
        out = out.add(name, kind)

    def finish(t: pa.Table, found: pa.Table) -> pa.Table:
        t = in_order(t)
        texts = t.column("text")
        done = [(len(words), len(words) - len(kept),
                 texts[k].as_py() if len(kept) == len(words) else b" ".join(kept).decode())
                for k, _, words, kept in _kept(t, found)]
        n_words, n_removed, kept = zip(*done) if done else ((), (), ())
        return pa.Table.from_arrays(
            [t.column("id"), *_columns(t, keep), pa.array(n_words, pa.int64()),
             pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            names=["id", *keep, "n_words", "n_removed", "kept"])

    return (rows.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(finish, out)
            .withColumnRenamed("id", id_col))


def _columns(t: pa.Table, keep: tuple[str, ...]) -> list:
    """The carried columns; they travel as one struct, so their names cannot clash."""
    if not keep:
        return []
    return [pc.struct_field(t.column("keep").combine_chunks(), [k]) for k in range(len(keep))]


def op9_superkmer_dedup(spark, sf_dir: str) -> DataFrame:
    rows, n_blocks = with_blocks(documents(spark, sf_dir), "doc_id", "text")
    spans = repeated_spans(rows, n_blocks, *_functions(WIDTH, GRAM))
    ddl = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    schema = arrow_schema(ddl)

    def finish(t: pa.Table, found: pa.Table) -> pa.Table:
        out = [(i, len(words), len(words) - len(kept),
                hashlib.sha256(b" ".join(kept)).hexdigest())
               for _, i, words, kept in _kept(in_order(t), found)]
        return pa.Table.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 4, schema)],
            schema=schema)

    return rows.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(finish, ddl)
