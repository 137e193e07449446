"""Operator 3: packing by best-fit decreasing.

Documents longer than a sequence are first cut into full windows. Best-fit decreasing looks only
at lengths, of which there are at most ``capacity``: the driver gets the number of pieces of each
length (never the pieces) and works out the exact best-fit plan with a segment tree indexed by
remaining capacity that finds the tightest open bins. Bins that are alike are one entry with a
count, so the plan's size depends on the capacity alone, not on the data. Tasks then look up the
place of each piece by its length and its gapless number among the pieces of that length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.bpe import codec, encode, share, texts_of, _arrow_id
from vigil.llm.common import batch, documents, materialize

CAPACITY = 2048
SEPARATOR = 1
# Pieces of one length that one numbering task holds together.
NUMBER_ROWS = 512


class Tightest:
    """Segment tree over remaining capacities 0..n: how many open bins have each, and the
    smallest capacity of at least x that some bin has."""

    def __init__(self, n: int):
        self.size = 1 << n.bit_length()
        self.bins = [0] * (2 * self.size)

    def add(self, capacity: int, n: int) -> None:
        i = capacity + self.size
        while i:
            self.bins[i] += n
            i >>= 1

    def find(self, least: int) -> int | None:
        i = least + self.size
        if self.bins[i]:
            return least
        while i > 1:
            if not i & 1 and self.bins[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.bins[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """The best-fit-decreasing plan for ``counts`` pieces of each length.

    Rows (length, first, per_bin, bin, offset, n), in order of length and first: of the pieces of
    this length numbered first, first + 1, ..., n go per_bin to each of the bins bin, bin + 1, ...,
    the first at this offset of its bin. Equal pieces go to the tightest bin until it is too
    tight for one more, as best fit does piece by piece.
    """
    tree = Tightest(capacity)
    open_bins: dict[int, list[tuple[int, int]]] = {}
    plan, next_bin = [], 0

    def put(left: int, first_bin: int, n: int) -> None:
        if left and n:
            open_bins.setdefault(left, []).append((first_bin, n))
            tree.add(left, n)

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} does not fit into {capacity}")
        todo, first = counts[length], 0
        while todo:
            left = tree.find(length)
            if left is None:
                left, first_bin = capacity, next_bin
                n_bins = -(-todo // (capacity // length))
                next_bin += n_bins
            else:
                first_bin, n_bins = open_bins[left].pop()
                tree.add(left, -n_bins)
            each = left // length
            full = min(n_bins, todo // each)
            if full:
                plan.append((length, first, each, first_bin, capacity - left, full * each))
                put(left - each * length, first_bin, full)
                first, todo = first + full * each, todo - full * each
            if full < n_bins:  # fewer pieces are left than the next bin takes
                if todo:
                    plan.append((length, first, todo, first_bin + full, capacity - left, todo))
                    put(left - todo * length, first_bin + full, 1)
                    first, todo, full = first + todo, 0, full + 1
                put(left, first_bin + full, n_bins - full)
    return np.array(sorted(plan), np.int64).reshape(-1, 6)


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents: ``id``, ``start``, ``length``, ``ids_crc32`` and ``doc_tokens``.
    A document is the ids of its whole text and a closing id 1 (null text: that id alone); it is
    cut into full windows and a rest."""
    tables = share(docs.sparkSession, path)
    schema = pa.schema([("id", _arrow_id(docs, id_col)), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids_crc32", pa.int64()),
                        ("doc_tokens", pa.int64())])
    close = np.array([SEPARATOR], "<u4").tobytes()

    def run(batches):
        for rb in batches:
            for i, j, texts in texts_of(rb):
                row, start, size, crc, total = [], [], [], [], []
                for k, ids in enumerate(codec(tables.value).encode(texts)):
                    ids += close
                    n = len(ids) // 4
                    for s in range(0, n, capacity):
                        part = ids[4 * s:4 * (s + capacity)]
                        row.append(i + k)
                        start.append(s)
                        size.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        total.append(n)
                yield batch(schema, rb.column(0).take(pa.array(row, pa.int64())), start, size,
                            crc, total)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset`` (gapless from 0 in its
    sequence). Empty and null texts are pieces of length 1. Repeated rows (also of one id) are
    packed each for itself. An empty table gives no rows. Other columns are not looked at."""
    cut = materialize(pieces(docs, path, capacity, id_col, text_col), "pieces")
    sizes = cut.groupBy("length").count()
    counts = {r["length"]: r["count"] for r in sizes.collect()}  # at most `capacity` rows
    plan = docs.sparkSession.sparkContext.broadcast(best_fit(counts, capacity))
    # Gapless numbers among the pieces of a length, by two levels of counting.
    buckets = F.broadcast(sizes.select(  # at most `capacity` rows
        "length", F.ceil(F.col("count") / NUMBER_ROWS).cast("long").alias("n_buckets")))
    rows = cut.join(buckets, "length").withColumn(
        "bucket", F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.col("n_buckets")))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    base = rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "bucket").orderBy("id", "start", "ids_crc32")
    numbered = (rows.withColumn("rank", F.row_number().over(inside) - 1)
                .join(base, ["length", "bucket"])
                .select("id", "start", "length", "ids_crc32", "doc_tokens",
                        (F.col("base") + F.col("rank")).cast("long").alias("number")))

    def place(batches):
        table = plan.value
        key = table[:, 0] << 44 | table[:, 1]
        for rb in batches:
            size, number = (rb.column(k).to_numpy(zero_copy_only=False) for k in (2, 5))
            at = np.searchsorted(key, size << 44 | number, "right") - 1
            first, each, bin_, offset = (table[at, k] for k in (1, 2, 3, 4))
            turn, step = np.divmod(number - first, each)
            yield pa.RecordBatch.from_arrays(
                [*rb.columns[:5], pa.array(bin_ + turn), pa.array(offset + step * size)],
                names=[*rb.schema.names[:5], "sequence_id", "offset"])

    kind = docs.schema[id_col].dataType.simpleString()
    return numbered.mapInArrow(place, f"id {kind}, start long, length long, ids_crc32 long, "
                                      "doc_tokens long, sequence_id long, offset long")


def sequences(docs: DataFrame, placed: DataFrame, path: str | None = None,
              capacity: int = CAPACITY, pad: int = 0, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The sequences themselves: ``sequence_id``, ``ids`` (array<int>, padded to ``capacity``)
    and ``n_ids`` before padding. Ids of documents must be unique here."""
    ids = encode(docs, path, id_col, text_col).select(
        F.col(id_col).alias("id"), F.concat("ids", F.array(F.lit(SEPARATOR))).alias("ids"))
    part = placed.join(ids, "id").select("sequence_id", F.struct(
        "offset", F.expr("slice(ids, int(start) + 1, int(length))").alias("ids")).alias("p"))
    whole = part.groupBy("sequence_id").agg(F.sort_array(F.collect_list("p")).alias("p"))
    flat = F.flatten(F.transform("p", lambda x: x["ids"]))
    return whole.select("sequence_id", F.concat(
        flat, F.array_repeat(F.lit(pad), F.lit(capacity) - F.size(flat))).alias("ids"),
        F.size(flat).alias("n_ids"))


def op3_packing(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    return pack(documents(spark, sf_dir), path).withColumnRenamed("id", "doc_id")
