"""Finding passages that repeat across a corpus: what operators 1 and 9 share.

A window of ``width`` symbols has a minimiser, the smallest hash of its grams of ``gram`` symbols.
Equal windows have equal minimisers, so all copies of a window can meet at the bucket of its
minimiser; consecutive windows of one minimiser form a run and travel as one packed string.

1. Each block of documents sends its distinct minimisers to buckets, which send back those that
   occur more than once. A window whose minimiser occurs once cannot repeat, so its run need not
   travel. (One entry per minimiser and block, however hot it is.)
2. Each block packs the runs of the others and sends each distinct packed string once, for its
   first occurrence in the block; later ones are known to be repeats there and then.
3. Buckets decide by content which windows of the packed strings started earlier, and the spans go
   back to the block of their document.

A passage that many documents hold in different surroundings gives its minimiser a different packed
string in each. The first pass flags such hot minimisers: those that have a string whose hash is
drawn, one in ``SPREAD`` distinct ones (copies of a string are drawn together, so they make nothing
hot). Their windows go one by one to buckets of the window's own hash, where equal windows still
meet; another pass like the first, over the hashes of these windows, keeps back all windows that
occur only once.

Documents are dealt to blocks by their id once; that exchange serves all three passes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import (block_count, block_of, covered, deal, merge_intervals, mix, runs,
                              sliding, text_bytes)

SLICE = 1 << 19
# Buckets of packed strings per block of documents.
PACKED_BUCKETS = 4
# A minimiser with some thousands of distinct packed strings has one of those drawn.
SPREAD = 1 << 11
# Hashes leave two bits free. To a bucket: repeats within the block; has a drawn string.
# Back to a block: a window that repeats; a hot minimiser.
KEY = np.uint64(0xFFFFFFFFFFFFFFFC)
ONE, TWO = np.uint64(1), np.uint64(2)
FACTOR = np.uint64(0x9E3779B97F4A7C15)
SPANS = "block int, rows array<int>, starts array<int>, ends array<int>"
PACKED = ("bucket int, block int, ids array<long>, rows array<int>, starts array<int>, "
          "packed array<binary>, again_rows array<int>, again_starts array<int>, "
          "again_ends array<int>")


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    return to_arrow_schema(_parse_datatype_string(ddl))


def in_order(t: pa.Table) -> pa.Table:
    """Rows of a block by (id, text); null ids last. The same order in every pass, so a row's
    number names it within its block."""
    order = pc.sort_indices(t, sort_keys=[("id", "ascending"), ("text", "ascending")],
                            null_placement="at_end")
    return t.take(order)


def ids_of(t: pa.Table) -> np.ndarray:
    return pc.fill_null(t.column("id").combine_chunks().cast(pa.int64()),
                        np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


def gram_hashes(symbols: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` symbols at every place."""
    h = symbols.astype(np.uint64) + np.uint64(1)
    have = 1
    while have < gram:  # polynomial hash of `gram` symbols by doubling
        step = min(have, gram - have)
        power = np.uint64(pow(int(FACTOR), step, 1 << 64))
        # the last `step` symbols overlap where `gram` is no power of two; still a hash of
        # exactly the symbols of the gram
        h = h[:-step] * power + h[step:] * np.uint64(0x2545F4914F6CDD1D)
        have += step
    return mix(h) & KEY


def window_hashes(symbols: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the windows at the ascending places ``at``."""
    if not len(at):
        return np.zeros(0, np.uint64)
    return gram_hashes(symbols[at[0]:at[-1] + width], width)[at - at[0]]


def drawn(symbols: np.ndarray, first: np.ndarray, last: np.ndarray, width: int,
          spread: int) -> np.ndarray:
    """Which runs have a packed string that is drawn, by the hash of its content: that of its
    outer windows, which cover it."""
    h = gram_hashes(symbols[first[0]:last[-1] + width], width)
    a, b = h[first - first[0]], h[last - first[0]]
    return mix(a * FACTOR + b + (last - first).astype(np.uint64)) % np.uint64(spread) == 0


class Wanted:
    """What a block has to send: runs by minimiser, windows of hot minimisers one by one."""

    def __init__(self, flags: np.ndarray):
        mark, key = flags & ~KEY, flags & KEY
        self.runs, self.windows, self.hot = (np.sort(key[mark == m]) for m in range(3))

    def hot_windows(self, symbols, first, last, keys, width):
        """(places, hashes) of the windows of the runs with a hot minimiser."""
        hot = _among(keys, self.hot)
        first, n = first[hot], last[hot] - first[hot] + 1
        at = np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)
        return at, window_hashes(symbols, at, width)

    def strings(self, symbols, first, last, keys, width):
        """(first symbol, end, key) of the strings to send of these runs."""
        at, h = self.hot_windows(symbols, first, last, keys, width)
        back = _among(h, self.windows)
        at, h = at[back], h[back]
        keep = _among(keys, self.runs)
        return (np.concatenate((first[keep], at)),
                np.concatenate((last[keep] + width, at + width)), np.concatenate((keys[keep], h)))


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Mask of the values in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    i = np.searchsorted(known, values)
    i[i == len(known)] = 0
    return known[i] == values


def window_runs(symbols: np.ndarray, offsets: np.ndarray, gram: int, width: int
                ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of windows with one minimiser, in slices of bounded size: (first window, last window,
    minimiser) of each run, and the minimisers at all their places. Windows never cross the
    ``offsets`` of documents; a run may be cut where slices meet. Minimisers leave the bits
    outside ``KEY`` free."""
    n = len(symbols) - width + 1
    span = width - gram + 1
    for a in range(0, max(n, 0), SLICE):
        b = min(a + SLICE, n)
        g = gram_hashes(symbols[a:b + width - 1], gram)
        m = sliding(g, span, np.minimum) if span > 1 else g.copy()
        i, j = np.searchsorted(offsets, (a, b - 1 + width), "right")
        near = np.clip(offsets[max(i - 1, 0):j + 1] - a, 0, None)
        ends = near[1:]
        bad = covered(np.clip(np.maximum(ends - width + 1, near[:-1]), 0, b - a),
                      np.clip(ends, 0, b - a), b - a)
        at = np.flatnonzero(~bad)
        if not len(at):
            continue
        v = m[at]
        cut = np.flatnonzero((v[1:] != v[:-1]) | (np.diff(at) != 1)) + 1
        first = np.concatenate(([0], cut))
        last = np.concatenate((cut, [len(at)])) - 1
        m[bad] = 0
        pad = np.zeros(span - 1, np.uint64)
        places = sliding(np.concatenate((pad, m, pad)), span, np.maximum)
        yield at[first] + a, at[last] + a, v[first], g[(places == g) & (places > 0)]


def bucket_of(minimisers: np.ndarray, n: int) -> np.ndarray:
    """Minimisers are small numbers among hashes, so they are mixed again."""
    return (mix(minimisers) % np.uint64(n)).astype(np.int32)


def flags_of(t: pa.Table) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, np.uint64) for x in t.column("hashes").to_pylist()]
                          or [np.zeros(0, np.uint64)])


def packed_strings(docs: DataFrame, n_blocks: int, minimisers: Callable, windows: Callable,
                   pack: Callable) -> DataFrame:
    """The strings of each block that may hold repeated windows, by bucket, and the spans that the
    block itself knows to repeat. ``docs``: block, id, text.

    ``minimisers(table)`` gives sorted distinct minimisers of a block, with ONE where the block
    alone shows that it repeats and TWO where it has a drawn string. ``windows(table, wanted)``
    gives those of the windows with a hot minimiser alike. ``pack(table, wanted)`` gives (key,
    row, start, packed string, is again, end) arrays of the strings that are wanted.
    """
    n_packed = n_blocks * PACKED_BUCKETS
    hashes = "bucket int, block int, hashes binary"
    hash_schema = arrow_schema(hashes)
    flag_schema = arrow_schema("block int, hashes binary")
    packed_schema = arrow_schema(PACKED)

    def send(t: pa.Table) -> pa.Table:
        return dealt(t, minimisers(in_order(t)))

    def send_windows(t: pa.Table, flags: pa.Table) -> pa.Table:
        wanted = Wanted(flags_of(flags))
        if not t.num_rows or not len(wanted.hot):
            return hash_schema.empty_table()
        return dealt(t, windows(in_order(t), wanted))

    def dealt(t: pa.Table, h: np.ndarray) -> pa.Table:
        block = t.column("block")[0].as_py()
        order, at = deal(bucket_of(h & KEY, n_blocks), n_blocks)
        h = h[order]
        full = np.flatnonzero(np.diff(at))
        return pa.Table.from_arrays(
            [pa.array(full, pa.int32()), pa.array([block] * len(full), pa.int32()),
             pa.array([h[at[i]:at[i + 1]].tobytes() for i in full], pa.binary())],
            schema=hash_schema)

    def count(t: pa.Table) -> pa.Table:
        return often(t, lambda low: low & TWO)

    def count_windows(t: pa.Table) -> pa.Table:
        return often(t, lambda low: np.full(len(low), ONE))

    def often(t: pa.Table, mark: Callable) -> pa.Table:
        parts = [np.frombuffer(x, np.uint64) for x in t.column("hashes").to_pylist()]
        blocks = np.repeat(t.column("block").to_numpy(), [len(p) for p in parts])
        h = np.concatenate(parts)
        key = h & KEY
        order = np.argsort(key, kind="stable")
        s, e = runs(key[order])
        low = np.bitwise_or.reduceat(h[order] & ~KEY, s)
        repeats = ((low & ONE) > 0) | (e - s > 1)
        key[order] |= np.repeat(mark(low), e - s)
        keep = order[np.repeat(repeats, e - s)]
        keep = keep[np.argsort(blocks[keep], kind="stable")]
        s, e = runs(blocks[keep])
        return pa.Table.from_arrays(
            [pa.array(blocks[keep][s], pa.int32()),
             pa.array([key[keep[i:j]].tobytes() for i, j in zip(s, e)], pa.binary())],
            schema=flag_schema)

    def send_packed(t: pa.Table, flags: pa.Table) -> pa.Table:
        if not t.num_rows or not flags.num_rows:
            return packed_schema.empty_table()
        block = t.column("block")[0].as_py()
        t = in_order(t)
        keys, row, start, packed, again, end = pack(t, Wanted(flags_of(flags)))
        ids = ids_of(t)
        new, old = np.flatnonzero(~again), np.flatnonzero(again)
        order, at = deal(bucket_of(keys[new], n_packed), n_packed)
        none = np.zeros(0, np.int64)
        cols: list[list] = [[] for _ in range(9)]
        for b in np.flatnonzero(np.diff(at)):
            i = new[order[at[b]:at[b + 1]]]
            for c, x in zip(cols, (b, block, ids[row[i]], row[i], start[i],
                                   [packed[k] for k in i.tolist()], none, none, none)):
                c.append(x)
        if len(old):  # known already: any bucket passes them on
            size = int(end.max()) + 2
            a, z = merge_intervals(row[old] * size + start[old], row[old] * size + end[old])
            for c, x in zip(cols, (block * PACKED_BUCKETS, block, none, none, none, [],
                                   a // size, a % size, z % size)):
                c.append(x)
        return pa.Table.from_arrays(
            [pa.array(c, f.type) for c, f in zip(cols, packed_schema)], schema=packed_schema)

    flags = (docs.groupBy("block").applyInArrow(send, hashes)
             .groupBy("bucket").applyInArrow(count, "block int, hashes binary"))
    back = (docs.groupBy("block").cogroup(flags.groupBy("block"))
            .applyInArrow(send_windows, hashes)
            .groupBy("bucket").applyInArrow(count_windows, "block int, hashes binary"))
    return (docs.groupBy("block").cogroup(flags.union(back).groupBy("block"))
            .applyInArrow(send_packed, PACKED))


def repeated_spans(docs: DataFrame, n_blocks: int, minimisers: Callable, windows: Callable,
                   pack: Callable, match: Callable) -> DataFrame:
    """Spans of repeated windows, packed by block; see ``packed_strings``.
    ``match(ids, rows, starts, packed)`` decides, with entries of many blocks in order of
    (id, row, start), and gives (entry, start, end) arrays of repeated stretches.
    """
    span_schema = arrow_schema(SPANS)

    def decide(t: pa.Table) -> pa.Table:
        col = {n: t.column(n).combine_chunks() for n in t.schema.names}
        size = pc.list_value_length(col["rows"]).to_numpy()
        block = np.repeat(col["block"].to_numpy(), size)
        ids, rows, starts = (col[n].flatten().to_numpy() for n in ("ids", "rows", "starts"))
        packed = col["packed"].flatten().to_pylist()
        order = np.lexsort((starts, rows, ids))
        entry, a, b = match(ids[order], rows[order], starts[order],
                            [packed[i] for i in order.tolist()])
        entry = order[entry]
        again = np.repeat(col["block"].to_numpy(),
                          pc.list_value_length(col["again_rows"]).to_numpy())
        blocks = np.concatenate((block[entry], again))
        out = [np.concatenate((x, col[n].flatten().to_numpy())).astype(np.int32) for x, n in (
            (rows[entry], "again_rows"), (starts[entry] + a, "again_starts"),
            (starts[entry] + b, "again_ends"))]
        order = np.argsort(blocks, kind="stable")
        s, e = runs(blocks[order])
        lists = [[x[order[i:j]] for i, j in zip(s, e)] for x in out]
        return pa.Table.from_arrays(
            [pa.array(blocks[order][s], pa.int32()),
             *(pa.array(x, pa.list_(pa.int32())) for x in lists)], schema=span_schema)

    packed = packed_strings(docs, n_blocks, minimisers, windows, pack)
    return packed.groupBy("bucket").applyInArrow(decide, SPANS)


def with_blocks(docs: DataFrame, id_col: str, text_col: str,
                keep: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """The input dealt to blocks of about 8 MB of text by a hash of the id, as (block, id, text);
    null texts stay null. The columns ``keep`` go along as the struct ``keep``; every
    pass reads all columns, so that the passes share one exchange. The number of blocks follows from the bytes of all texts."""
    n_blocks = block_count(text_bytes(docs, text_col))
    others = [F.struct(*keep).alias("keep")] if keep else []
    rows = docs.select(block_of(F.col(id_col), n_blocks).alias("block"),
                       F.col(id_col).cast("long").alias("id"),
                       F.col(text_col).alias("text"), *others)
    return rows, n_blocks


def spans_by_row(spans: pa.Table, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bounds of n rows, starts, ends) of a block's spans, grouped by row."""
    if not spans.num_rows:
        return np.zeros(n + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, starts, ends = (spans.column(c).combine_chunks().flatten().to_numpy().astype(np.int64)
                          for c in ("rows", "starts", "ends"))
    order, at = deal(rows, n)
    return at, starts[order], ends[order]
