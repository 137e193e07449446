"""Operator 4: quality classifier by nearest-neighbour voting on latent-semantic vectors.

A text becomes counts of hashed byte trigrams and of 4-grams of byte classes, and how often a word
follows itself. From a bounded sample of labelled rows come the feature weights and the latent
axes (the leading singular vectors of the centred, weighted counts). The sample's vectors, at most
``SAMPLE`` of ``AXES`` numbers, are broadcast; every document is compared with all of them by
exact blocked products, and its nearest neighbours vote, weighted by cosine.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import batch, by_bytes, documents, flat
from vigil.llm.repeats import arrow_schema
from vigil.llm.superkmers import word_hashes, words_of

# Labelled rows at most that the classifier is fitted on (those of the smallest hashes).
SAMPLE = 4096
AXES = 64
NEIGHBOURS = 15
THRESHOLD = 0.3
FOLDS = 5
TRIGRAMS, SHAPES, REPEATS = 1024, 1024, 8
N_FEATURES = TRIGRAMS + SHAPES + REPEATS

# Classes of bytes: lower, upper, digit, line end, other space, each ASCII mark, high bytes.
CLASSES = np.zeros(256, np.int64)
CLASSES[np.arange(ord("a"), ord("z") + 1)] = 1
CLASSES[np.arange(ord("A"), ord("Z") + 1)] = 2
CLASSES[np.arange(ord("0"), ord("9") + 1)] = 3
CLASSES[[10, 13]] = 4
CLASSES[[9, 11, 12, 32]] = 5
CLASSES[128:] = 1
for _i, _b in enumerate(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"):
    CLASSES[_b] = 6 + _i


def features(column) -> tuple[np.ndarray, np.ndarray]:
    """(weights, empty) of texts: square roots of the shares of each family of features."""
    raw, offsets = flat(column)
    n = len(offsets) - 1
    out = np.zeros((n, N_FEATURES), np.float32)
    for i, j in by_bytes(offsets):
        part = raw[offsets[i]:offsets[j]]
        off = offsets[i:j + 1] - offsets[i]
        for base, width, size, symbols in ((0, 3, TRIGRAMS, part.astype(np.int64)),
                                           (TRIGRAMS, 4, SHAPES, CLASSES[part])):
            code = np.zeros(max(len(part) - width + 1, 0), np.int64)
            for k in range(width):
                code = code * 257 + symbols[k:k + len(code)]
            code = (code * 0x9E3779B1 & 0xFFFFFFFF) >> 22  # 10 bits
            first, last = off[:-1], np.minimum(np.maximum(off[1:] - width + 1, off[:-1]),
                                               len(code))
            owner = np.repeat(np.arange(j - i), np.maximum(last - first, 0))
            at = np.concatenate([np.arange(a, b) for a, b in zip(first, last)]) \
                if len(owner) else owner
            count = np.bincount(owner * size + code[at], minlength=(j - i) * size)
            out[i:j, base:base + size] = count.reshape(j - i, size)
        starts, ends, bounds = words_of(part, off)
        h = word_hashes(part, starts, ends)
        same = np.concatenate(([0], np.cumsum(h[1:] == h[:-1]))) if len(h) else np.zeros(1)
        words = np.diff(bounds)
        pairs = np.maximum(words - 1, 0)
        lo, hi = np.minimum(bounds[:-1], len(same) - 1), np.maximum(bounds[1:] - 1, 0)
        share = np.where(pairs > 0, same[np.minimum(hi, len(same) - 1)] - same[lo], 0) \
            / np.maximum(pairs, 1)
        level = np.minimum((share * 2 * REPEATS).astype(int), REPEATS - 1)
        out[np.arange(i, j), TRIGRAMS + SHAPES + level] = (words > 0)
    for base, size in ((0, TRIGRAMS), (TRIGRAMS, SHAPES)):
        family = out[:, base:base + size]
        family /= np.maximum(family.sum(axis=1, keepdims=True), 1)
    return np.sqrt(out), ~out.any(axis=1)


class Latent:
    """Latent axes and labelled vectors."""

    @staticmethod
    def fit(x: np.ndarray, labels: np.ndarray, axes: int = AXES) -> dict:
        """Tables to be broadcast; ``x``: features of the sample, ``labels``: 0 or 1."""
        present = (x > 0).mean(axis=0)
        weight = np.sqrt(np.log((1 + len(x)) / (1 + present * len(x))) + 1).astype(np.float32)
        mean = (x * weight).mean(axis=0)
        centred = x * weight - mean
        values, vectors = np.linalg.eigh(centred.T @ centred)
        axis = vectors[:, ::-1][:, :min(axes, len(values))].astype(np.float32)
        return {"weight": weight, "mean": mean, "axis": axis, "labels": labels.astype(np.float32),
                "sample": Latent.project(x, weight, mean, axis),
                "base": float(labels.mean())}

    @staticmethod
    def project(x, weight, mean, axis) -> np.ndarray:
        v = (x * weight - mean) @ axis
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def score(t: dict, column, neighbours: int = NEIGHBOURS, rows: int = 512) -> np.ndarray:
    """Scores of texts under the tables of ``Latent.fit``."""
    out = np.empty(len(column))
    if not len(t.get("labels", ())):
        out[:] = 0.5
        return out
    k = min(neighbours, len(t["labels"]))
    for i in range(0, len(column), rows):
        x, empty = features(column.slice(i, rows))
        cosine = Latent.project(x, t["weight"], t["mean"], t["axis"]) @ t["sample"].T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        w = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** 2
        # one vote of the base rate keeps scores of far-off texts near it
        vote = ((w * t["labels"][near]).sum(axis=1) + 0.1 * t["base"]) / (w.sum(axis=1) + 0.1)
        out[i:i + rows] = np.clip(np.where(empty, t["base"], vote), 0, 1)
    return out


def fold(id_col: Column, folds: int = FOLDS) -> Column:
    return F.crc32(F.encode(id_col.cast("string"), "utf-8")) % folds


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> dict:
    """Fit on at most ``sample`` labelled ids outside fold 0: those of the smallest hashes,
    whatever their label. An id that several rows have counts once, with the first of their vectors.
    Labels other than 0 and 1, ids that are labelled both ways and null ids are left out. Without
    labelled rows the classifier says 0.5."""
    marks = (labels.filter(F.col(label_col).isin(0, 1) & (fold(F.col(id_col)) != 0))
             .groupBy(F.col(id_col).alias("_id"))
             .agg(F.min(label_col).alias("_a"), F.max(label_col).alias("_b"))
             .filter("_a = _b").select("_id", F.col("_a").alias("_label")))
    # at most `sample` rows, so the side can be broadcast; some labelled ids may not be in docs
    found = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        F.broadcast(marks.join(docs.select(F.col(id_col).alias("_id")), "_id", "left_semi")
                    .orderBy(F.xxhash64("_id"), "_id").limit(sample)), "_id")
    schema = arrow_schema("id string, label int, x binary")

    def run(batches):
        for rb in batches:
            for i, j in by_bytes(flat(rb.column(0))[1]):
                x, _ = features(rb.column(0).slice(i, j - i))
                yield batch(schema, rb.column(2).slice(i, j - i), rb.column(1).slice(i, j - i),
                            [r.astype(np.float16).tobytes() for r in x])

    rows = (found.select("_text", F.col("_label").cast("int"), F.col("_id").cast("string"))
            .mapInArrow(run, "id string, label int, x binary")
            .groupBy("id", "label").agg(F.min("x").alias("x")).orderBy("label", "x").toArrow())
    if not rows.num_rows:
        return {}
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.float16)
    return Latent.fit(x.reshape(rows.num_rows, N_FEATURES).astype(np.float32),
                      rows.column("label").to_numpy())


def classify(docs: DataFrame, tables: dict, id_col: str = "doc_id", text_col: str = "text",
             keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``id``, the columns ``keep``, and ``score`` (0 to 1, higher: label 1
    is likelier). Null and empty texts get the share of label 1 in the sample. Repeated rows get
    equal scores; whole texts are read; other columns are not looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(tables)
    source = docs.select(F.col(text_col).alias("_text"), F.col(id_col), *keep)
    out = source.drop("_text").schema.add("score", "double", False)

    def run(batches):
        for rb in batches:
            found = np.concatenate(
                [score(shared.value, rb.column(0).slice(i, j - i))
                 for i, j in by_bytes(flat(rb.column(0))[1])] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays(
                [*rb.columns[1:], pa.array(found, pa.float64())],
                names=[*rb.schema.names[1:], "score"])

    return source.mapInArrow(run, out)


def op4_quality_knn(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    tables = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return classify(docs, tables).select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % FOLDS == 0
