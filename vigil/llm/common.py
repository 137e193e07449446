"""Helpers shared by the operators: record batches as flat byte arrays, packed rows, sizing."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.session import ensure_checkpoint_dir

# Bytes of text that one block (the unit of work of a task) is sized for.
BLOCK_BYTES = 8 << 20
# Bytes of text that are put through numpy at once; bounds the temporary arrays.
CHUNK_BYTES = 1 << 20
MIN_BLOCKS = 64


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder of ``spark.checkpoint.dir`` and read it
    back: lineage is cut, and later stages read it instead of computing it again."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/vigil-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. Texts without other than ASCII characters take Spark's quick
    ``lower``, which does the same there."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(
        F.translate(c, upper, upper.lower()))


def text_bytes(df: DataFrame, text_col: str) -> int:
    """Total UTF-8 bytes of the texts, counted over all rows."""
    row = df.agg(F.sum(F.octet_length(F.col(text_col)).cast("long"))).first()
    return int(row[0] or 0)


def block_count(total_bytes: int, block_bytes: int = BLOCK_BYTES) -> int:
    """Number of blocks (or buckets) that keeps each at about ``block_bytes``."""
    return max(MIN_BLOCKS, -(-total_bytes // block_bytes))


def block_of(id_col: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(n_blocks)).cast("int")


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty. No Python objects."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type)
                                  or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1]
    offsets = offsets.astype(np.int64)
    first, last = offsets[0], offsets[-1]
    raw = np.frombuffer(data, np.uint8)[first:last] if last > first else np.zeros(0, np.uint8)
    return raw, offsets - first


def by_bytes(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows of about ``limit`` bytes, one row at least."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (unsigned, wrapping)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal neighbours."""
    if len(values) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.flatnonzero(values[1:] != values[:-1]) + 1
    return np.concatenate(([0], cut)), np.concatenate((cut, [len(values)]))


def sliding(values: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` (np.minimum or np.maximum) over every ``width`` neighbours, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = op(out[:-step], out[step:])
        have += step
    return out


def deal(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that groups ``keys`` (bucket numbers) and the n + 1 bounds of the groups."""
    order = np.argsort(keys, kind="stable")
    return order, np.searchsorted(keys[order], np.arange(n + 1))


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Mask of n positions that any half-open interval covers."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, starts, 1)
    np.add.at(d, ends, -1)
    return np.cumsum(d[:-1]) > 0


def merge_intervals(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals as maximal ones (touching ones join)."""
    if len(starts) == 0:
        return starts, ends
    o = np.argsort(starts, kind="stable")
    s, e = starts[o], np.maximum.accumulate(ends[o])
    new = np.concatenate(([True], s[1:] > e[:-1]))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:] - 1, [len(s) - 1]))
    return s[first], e[last]


def batch(schema: pa.Schema, *columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, schema)],
        schema=schema)
