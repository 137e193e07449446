"""Operator 1: substring dedup on bytes with a logarithmic family of suffix arrays.

Every byte that a string of ``width`` bytes covers which also starts earlier is removed. The runs
of windows that may repeat (see ``repeats``) meet in buckets by minimiser. In a bucket, batches in
order of (id, start) get suffix arrays, ordered by their first ``width`` bytes; each is
merge-scanned against the sorted levels that exist and what is new becomes a level. Levels of
equal size class merge, so there are logarithmically many and every suffix is merged
logarithmically often.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vigil.llm.common import covered, documents, flat, runs
from vigil.llm.repeats import (ONE, SPREAD, TWO, Wanted, arrow_schema, drawn, in_order,
                               repeated_spans, spans_by_row, window_runs, with_blocks)

WIDTH = 100
GRAM = 32
# Bytes of packed strings of which one suffix array is built.
BATCH = 1 << 18


class SuffixFamily:
    """Suffix arrays over ever more batches of byte strings, for matches of ``width`` bytes."""

    def __init__(self, width: int = WIDTH, batch: int = BATCH):
        self.width, self.batch = width, batch
        self.levels: list[np.ndarray] = []  # sorted, distinct, disjoint; sizes grow geometrically

    def add(self, strings: list[bytes]) -> list[np.ndarray]:
        """For each string, the mask of its windows that an earlier window equals: one of an
        earlier batch, of an earlier string, or of an earlier place of the string itself."""
        out, i = [], 0
        while i < len(strings):
            j, size = i, 0
            while j < len(strings) and (j == i or size + len(strings[j]) <= self.batch):
                size += len(strings[j])
                j += 1
            out += self._add_batch(strings[i:j])
            i = j
        return out

    def _add_batch(self, strings: list[bytes]) -> list[np.ndarray]:
        width = self.width
        text = np.frombuffer(b"".join(strings), np.uint8)
        sizes = np.array([len(s) for s in strings], np.int64)
        windows = np.maximum(sizes - width + 1, 0)
        bounds = np.concatenate(([0], np.cumsum(windows)))
        first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        at = np.arange(bounds[-1]) + np.repeat(first - bounds[:-1], windows)
        if not len(at):
            return [np.zeros(0, bool)] * len(strings)
        # equal-width byte strings: comparison and equality are those of all `width` bytes
        keys = np.ascontiguousarray(
            np.lib.stride_tricks.sliding_window_view(text, width)[at]).view(f"S{width}").ravel()
        suffixes = np.argsort(keys, kind="stable")
        keys = keys[suffixes]
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        heads = np.flatnonzero(new)
        distinct = keys[heads]
        known = np.zeros(len(distinct), bool)
        for level in self.levels:  # merge scan: both sides are sorted
            i = np.searchsorted(level, distinct)
            i[i == len(level)] = 0
            known |= level[i] == distinct
        seen = ~new
        seen[heads[known]] = True
        self._put(distinct[~known])
        mask = np.empty(len(at), bool)
        mask[suffixes] = seen
        return [mask[a:b] for a, b in zip(bounds[:-1], bounds[1:])]

    def _put(self, level: np.ndarray) -> None:
        if not len(level):
            return
        self.levels.append(level)
        while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
            b, a = self.levels.pop(), self.levels.pop()
            merged = np.concatenate((a, b))
            merged.sort(kind="stable")  # two sorted runs: one merge
            self.levels.append(merged)


def _functions(width: int, gram: int, spread: int = SPREAD):
    def once(h: np.ndarray) -> np.ndarray:
        h = np.sort(h)
        s, e = runs(h)
        return h[s] | np.where(e - s > 1, ONE, np.uint64(0))

    def minimisers(t: pa.Table) -> np.ndarray:
        raw, offsets = flat(t.column("text"))
        none = [np.zeros(0, np.uint64)]
        found, many = none, none
        for first, last, h, places in window_runs(raw, offsets, gram, width):
            found = [*found, places]
            many = [*many, h[drawn(raw, first, last, width, spread)]]
        h = once(np.concatenate(found))
        h[np.searchsorted(h | ONE, np.concatenate(many))] |= TWO
        return h

    def windows(t: pa.Table, wanted: Wanted) -> np.ndarray:
        raw, offsets = flat(t.column("text"))
        return once(np.concatenate([np.zeros(0, np.uint64), *(
            wanted.hot_windows(raw, first, last, h, width)[1]
            for first, last, h, _ in window_runs(raw, offsets, gram, width))]))

    def pack(t: pa.Table, wanted: Wanted):
        raw, offsets = flat(t.column("text"))
        text = raw.tobytes()
        keys, rows, starts, ends, packed, again = [], [], [], [], [], []
        seen: set[bytes] = set()
        for first, last, h, _ in window_runs(raw, offsets, gram, width):
            first, end, h = wanted.strings(raw, first, last, h, width)
            row = np.searchsorted(offsets, first, "right") - 1
            keys.append(h)
            rows.append(row)
            starts.append(first - offsets[row])
            ends.append(end - offsets[row])
            for a, b in zip(first.tolist(), end.tolist()):
                s = text[a:b]
                again.append(s in seen)
                packed.append(s)
                seen.add(s)
        none = [np.zeros(0, np.int64)]
        return (np.concatenate(keys or [np.zeros(0, np.uint64)]), np.concatenate(rows or none),
                np.concatenate(starts or none), packed, np.array(again, bool),
                np.concatenate(ends or none))

    def match(ids, rows, starts, packed):
        first: dict[bytes, int] = {}
        distinct, whole = [], []
        for i, s in enumerate(packed):
            if first.setdefault(s, i) == i:
                distinct.append(i)
            else:
                whole.append(i)
        masks = SuffixFamily(width).add([packed[i] for i in distinct])
        entry = [np.array(whole, np.int64)]
        a = [np.zeros(len(whole), np.int64)]
        b = [np.array([len(packed[i]) for i in whole], np.int64)]
        for i, mask in zip(distinct, masks):
            if mask.any():
                s, e = runs(mask)
                s, e = s[mask[s]], e[mask[s]]
                entry.append(np.full(len(s), i))
                a.append(s)
                b.append(e - 1 + width)
        return np.concatenate(entry), np.concatenate(a), np.concatenate(b)

    return minimisers, windows, pack, match


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """One row per input row: ``id``, ``n_bytes``, ``spans`` (array of (start, end) byte offsets of
    the maximal removed runs) and ``kept`` (binary: the remaining bytes).

    A string starts earlier in the row of a smaller id, or further left in the same row; strings
    are judged on the input. Null and empty texts have no bytes; texts shorter than ``width``
    keep all. Rows of one id are ordered by their text, so of identical repeated rows all but one
    lose what they share; null ids come last. Other columns are not looked at; an empty table
    gives no rows.
    """
    rows, n_blocks = with_blocks(docs, id_col, text_col)
    spans = repeated_spans(rows, n_blocks, *_functions(width, gram))
    ddl = "id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    schema = arrow_schema(ddl)

    def finish(t: pa.Table, found: pa.Table) -> pa.Table:
        ids, n_bytes, cut, kept = [], [], [], []
        for i, n, spans_, text in _kept(t, found):
            ids.append(i)
            n_bytes.append(n)
            cut.append([{"start": a, "end": b} for a, b in spans_])
            kept.append(text)
        return pa.Table.from_arrays(
            [pa.array(c, f.type) for c, f in zip((ids, n_bytes, cut, kept), schema)],
            schema=schema)

    return (rows.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(finish, ddl)
            .withColumnRenamed("id", id_col))


def _kept(t: pa.Table, found: pa.Table):
    """(id, bytes, removed runs, remaining bytes) of each row of a block."""
    if not t.num_rows:
        return
    t = in_order(t)
    raw, offsets = flat(t.column("text"))
    at, starts, ends = spans_by_row(found, t.num_rows)
    for k, i in enumerate(t.column("id").to_pylist()):
        text = raw[offsets[k]:offsets[k + 1]]
        s, e = starts[at[k]:at[k + 1]], ends[at[k]:at[k + 1]]
        if not len(s):
            yield i, len(text), [], text.tobytes()
            continue
        mask = covered(s, e, len(text))
        a, b = runs(mask)
        cut = mask[a]
        yield i, len(text), list(zip(a[cut].tolist(), b[cut].tolist())), text[~mask].tobytes()


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    rows, n_blocks = with_blocks(documents(spark, sf_dir), "doc_id", "text")
    spans = repeated_spans(rows, n_blocks, *_functions(WIDTH, GRAM))
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema = arrow_schema(ddl)

    def finish(t: pa.Table, found: pa.Table) -> pa.Table:
        out = [(i, n, n - len(kept), len(cut), hashlib.sha256(kept).hexdigest())
               for i, n, cut, kept in _kept(t, found)]
        return pa.Table.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 5, schema)],
            schema=schema)

    return rows.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(finish, ddl)
