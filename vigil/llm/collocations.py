"""Operator 11: phrases whose words occur together, counted over a prefix-free parse.

Every text becomes a stream of words, each followed by a blank or, at the end of a piece, by a
line end. Where a hash of two neighbouring words is divisible by ``PERIOD`` the stream is cut:
a chunk reaches from one such pair to the end of the next, so neighbours overlap by that pair, and
equal passages give equal chunks wherever they stand. The distinct chunks with their frequencies
are the dictionary; copies of a passage cost nothing beyond it.

N-grams of up to three words are counted inside the distinct chunks, weighted by the chunk's
frequency. An n-gram belongs to the chunk that it starts in before the last two words (those start
the next chunk), so none is counted twice, and each lies whole within its chunk.

Counts travel packed: a task adds up what it sees of about ``TEXT_BYTES`` of dictionary and sends,
for every language and bucket, one compressed string of n-grams with their counts. Buckets are
hashes of the n-gram, so a frequent one is one entry per task, and no bucket is large for it.
Only what reaches the minimum leaves the buckets, because a part is never rarer than its phrase.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import (block_count, by_bytes, deal, documents, flat, materialize, mix,
                              text_bytes)
from vigil.llm.pieces import take_slices

MIN_COUNT, ABSORBED_PERCENT, TOP, SCALE = 10, 50, 2000, 1_000_000
# Mean words of a chunk beyond the two that overlap; text handled at once; dictionary per bucket.
PERIOD, TEXT_BYTES, BUCKET_BYTES = 32, 6 << 20, 6 << 20
# Groups of phrases of a language that are ranked apart before their best are ranked together.
RANK_GROUPS = 32
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
BLANK, STOP = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = BLANK
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = STOP


def total_of(part: np.ndarray) -> np.ndarray:
    """Running total with a leading 0."""
    return np.concatenate(([0], np.cumsum(part, dtype=np.int64)))


def crc(words: pa.Array) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words.to_pylist()), np.uint64, len(words))


def binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)),
         pa.py_buffer(np.ascontiguousarray(data))])


# -- parse -------------------------------------------------------------------------------
def streams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stream, bounds of its words, number of words before each text): all texts one after the
    other, every word followed by its blank or line end."""
    texts = pc.binary_join_element_wise(texts.cast(pa.large_string()),
                                        pa.scalar("", pa.large_string()),
                                        pa.scalar("\n", pa.large_string()))
    raw, offsets = flat(texts)
    kind = _KIND[raw]
    inside = kind == 0
    after = inside[:-1] & ~inside[1:]  # the byte behind a word (every text ends with a stop)
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    starts = np.flatnonzero(start)
    ends = np.flatnonzero(after) + 1
    keep = inside.copy()
    keep[ends] = True
    stream = _LOWER[raw[keep]]
    place = total_of(keep)
    stops = total_of(kind == STOP)
    upto = np.append(starts[1:], len(raw))
    last = place[ends]  # where the byte behind each word went
    stream[last] = np.where(stops[upto] > stops[ends], 0x0A, 0x20)
    return stream, np.append(place[starts], len(stream)), np.searchsorted(starts, offsets)


def parse(texts: pa.Array, period: int = PERIOD):
    """Chunks of the texts, in order: (chunk array, whether it ends its text, words that n-grams
    may start with, text number)."""
    stream, bounds, before = streams(texts)
    n = len(bounds) - 1
    if n == 0:
        none = np.zeros(0, np.int64)
        return binary(stream, np.zeros(1, np.int64)), none.astype(bool), none, none
    sizes = np.diff(bounds)
    blank = np.zeros(len(stream), bool)
    blank[bounds[1:] - 1] = True
    words = binary(stream[~blank], total_of(sizes - 1)).dictionary_encode()
    h = crc(words.dictionary)[words.indices.to_numpy()]
    pair = mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])
    cut = np.flatnonzero(pair % np.uint64(period) == 0)
    text_of = np.repeat(np.arange(len(before) - 1), np.diff(before))
    cut = cut[text_of[cut] == text_of[cut + 1]]
    firsts = before[:-1][np.diff(before) > 0]
    first = np.union1d(firsts, cut)  # first words of chunks
    ends_text = np.append(text_of[first[1:]] != text_of[first[:-1]], True)
    starting = np.diff(np.append(first, n))
    stop = np.append(first[1:], n) + np.where(ends_text, 0, 2)
    at, size = bounds[first], bounds[stop] - bounds[first]
    return binary(take_slices(stream, at, size), total_of(size)), ends_text, starting, text_of[first]


def dictionary(docs: DataFrame, group_col: str = "lang", text_col: str = "text",
               period: int = PERIOD) -> DataFrame:
    """Distinct chunks: ``part`` (the group; null: ``und``), ``chunk`` (bytes), ``ends`` (it ends
    its text), ``starts`` (words that n-grams may start with) and ``n`` (its frequency). Null texts
    are empty; texts without words have no chunk."""
    def run(batches):
        for rb in batches:
            for i, j in by_bytes(flat(rb.column(1))[1], TEXT_BYTES):
                chunks, ends, starting, text_of = parse(rb.column(1).slice(i, j - i), period)
                yield pa.RecordBatch.from_arrays(
                    [rb.column(0).slice(i, j - i).take(pa.array(text_of)),
                     chunks.cast(pa.binary()), pa.array(ends), pa.array(starting)],
                    names=["part", "chunk", "ends", "starts"])

    rows = docs.select(F.coalesce(F.col(group_col).cast("string"), F.lit("und")).alias("part"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chunks = rows.mapInArrow(run, "part string, chunk binary, ends boolean, starts long")
    return chunks.groupBy("part", "chunk", "ends", "starts").agg(F.count(F.lit(1)).alias("n"))


# -- n-grams ------------------------------------------------------------------------------
def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, sums of their weights, number of its key at each place)."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.diff(ordered, prepend=-1) != 0
    first = np.flatnonzero(new)
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    sums = np.add.reduceat(weights[order], first) if len(first) else weights[:0]
    return ordered[first], sums, number


def ngrams(parts: pa.Array, chunks: pa.Array, starting: np.ndarray, weight: np.ndarray):
    """For n = 1, 2, 3: (word numbers, one row per distinct n-gram and part; part numbers; counts)
    of chunks, with the distinct words and parts."""
    raw, offsets = flat(chunks)
    gap = (raw == 0x20) | (raw == 0x0A)
    bounds = np.concatenate(([0], np.flatnonzero(gap) + 1))
    words = binary(raw[~gap], total_of(np.diff(bounds) - 1)).dictionary_encode()
    part = parts.dictionary_encode()
    code, n_words = words.indices.to_numpy().astype(np.int64), len(words.dictionary)
    before = np.searchsorted(bounds[:-1], offsets)
    size = np.diff(before)
    chunk_of = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(code)) - before[chunk_of]
    counted = place < starting[chunk_of]
    joined = raw[bounds[1:] - 1] == 0x20 if len(code) else np.zeros(0, bool)
    w, group = weight[chunk_of], part.indices.to_numpy().astype(np.int64)[chunk_of]
    here = np.flatnonzero(counted)
    found, rows = [], []
    number = group[here]
    for n in (1, 2, 3):
        keys, sums, at = summed(number * n_words + code[here + n - 1], w[here])
        one = np.empty(len(keys), np.int64)
        one[at] = np.arange(len(here))  # a place where each stands
        found.append((code[here[one][:, None] + np.arange(n)], group[here[one]], sums))
        go = joined[here + n - 1]
        here, number = here[go], at[go]
    return found, words.dictionary, part.dictionary


def packed_counts(found, words: pa.Array, n_buckets: int):
    """(part number, bucket, packed n-grams, packed counts), one per part and bucket."""
    raw, offsets = flat(words)
    # every word with a blank behind it
    sizes = np.diff(offsets)
    spaced = np.full(len(raw) + len(sizes), 0x20, np.uint8)
    spaced[np.arange(len(raw)) + np.repeat(np.arange(len(sizes)), sizes)] = raw
    at, size, h = offsets[:-1] + np.arange(len(sizes)), sizes + 1, crc(words)
    for rows, group, sums in found:
        if not len(rows):
            continue
        mixed = np.zeros(len(rows), np.uint64)
        for column in rows.T:
            mixed = mix(mixed * np.uint64(0x9E3779B97F4A7C15) + h[column])
        bucket = (mixed % np.uint64(n_buckets)).astype(np.int64)
        order, cells = np.argsort(group * n_buckets + bucket, kind="stable"), None
        rows, group, bucket, sums = rows[order], group[order], bucket[order], sums[order]
        cells = np.flatnonzero(np.diff(group * n_buckets + bucket, prepend=-1))
        data = take_slices(spaced, at[rows.ravel()], size[rows.ravel()])
        ends = total_of(size[rows].sum(axis=1))
        data[ends[1:] - 1] = 0x0A
        for a, b in zip(cells.tolist(), [*cells[1:].tolist(), len(rows)]):
            yield (int(group[a]), int(bucket[a]),
                   pa.compress(data[ends[a]:ends[b]].tobytes(), "zstd", asbytes=True),
                   pa.compress(sums[a:b].tobytes(), "zstd", asbytes=True),
                   int(ends[b] - ends[a]), b - a)


PACKED = pa.schema([("part", pa.string()), ("bucket", pa.int32()), ("grams", pa.binary()),
                    ("counts", pa.binary()), ("size", pa.int64()), ("n", pa.int64())])


def counts(chunks: DataFrame, n_buckets: int, min_count: int = MIN_COUNT) -> DataFrame:
    """``part``, ``gram`` (words joined by a blank), ``words`` (1 to 3) and ``f``: every n-gram of
    the dictionary that occurs ``min_count`` times or more."""
    def pack(batches):
        for rb in batches:
            for i, j in by_bytes(flat(rb.column(1))[1], TEXT_BYTES):
                one = rb.slice(i, j - i)
                found, words, parts = ngrams(one.column(0), one.column(1),
                                             one.column(2).to_numpy(), one.column(3).to_numpy())
                names = parts.to_pylist()
                rows = [(names[g], *rest) for g, *rest in packed_counts(found, words, n_buckets)]
                for k in range(0, len(rows), 1000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t.type) for c, t in zip(zip(*rows[k:k + 1000]), PACKED)],
                        schema=PACKED)

    def unpack(key, table):
        columns = [table.column(c).to_pylist() for c in ("grams", "counts", "size", "n")]
        raw = np.frombuffer(b"".join(pa.decompress(g, s, "zstd", asbytes=True)
                                     for g, s in zip(columns[0], columns[2])), np.uint8)
        sums = np.frombuffer(b"".join(pa.decompress(c, 8 * n, "zstd", asbytes=True)
                                      for c, n in zip(columns[1], columns[3])), np.int64)
        end = raw == 0x0A
        bounds = np.concatenate(([0], np.flatnonzero(end) + 1))
        grams = binary(raw[~end], total_of(np.diff(bounds) - 1)).dictionary_encode()
        which, f, _ = summed(grams.indices.to_numpy().astype(np.int64), sums)
        often = f >= min_count
        text = grams.dictionary.take(pa.array(which[often])).cast(pa.large_string())
        n_words = pc.add(pc.count_substring(text, " "), 1)
        return pa.table([pa.array([key[0].as_py()] * len(text), pa.string()),
                         text.cast(pa.string()), n_words.cast(pa.int32()),
                         pa.array(f[often], pa.int64())], names=["part", "gram", "words", "f"])

    rows = chunks.select("part", "chunk", "starts", "n").mapInArrow(
        pack, "part string, bucket int, grams binary, counts binary, size long, n long")
    return rows.groupBy("part", "bucket").applyInArrow(
        unpack, "part string, gram string, words int, f long")


# -- phrases -------------------------------------------------------------------------------
def scored(grams: DataFrame) -> DataFrame:
    """Phrases of two or three words: part, phrase, a, l, r, score of the weakest cut."""
    words = F.split("gram", " ", -1)
    phrases = grams.where("words > 1").select("part", F.col("gram").alias("phrase"),
                                              F.col("f").alias("a"), words.alias("w"))
    join = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    cuts = phrases.select("part", "phrase", "a", "w", F.explode(
        F.sequence(F.lit(1), F.size("w") - 1)).alias("k")).select(
        "part", "phrase", "a", "k", join(F.lit(1), F.col("k")).alias("first"),
        join(F.col("k") + 1, F.size("w") - F.col("k")).alias("rest"))
    f = grams.select("part", "gram", "f")
    both = (cuts.join(f.withColumnsRenamed({"gram": "first", "f": "l"}), ["part", "first"])
            .join(f.withColumnsRenamed({"gram": "rest", "f": "r"}), ["part", "rest"]))
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    square = (exact("a") * exact("a")).cast("decimal(38,0)") * F.lit(SCALE).cast("decimal(7,0)")
    both = both.withColumn("_s", square).withColumn(
        "_p", (exact("l") * exact("r")).cast("decimal(38,0)"))
    both = both.withColumn("score", F.expr("_s div _p"))
    weakest = F.min(F.struct("score", "k", "l", "r")).alias("m")
    return both.groupBy("part", "phrase", "a").agg(weakest).select(
        "part", "phrase", "a", "m.l", "m.r", "m.score")


def collocations(docs: DataFrame, group_col: str = "lang", text_col: str = "text",
                 min_count: int = MIN_COUNT, top: int = TOP, period: int = PERIOD) -> DataFrame:
    """Per group (null: ``und``) its best ``top`` phrases of two or three words by pointwise
    association: part, rank, phrase, a, l, r, n, score. ASCII letters are lower-cased; phrases
    never cross punctuation, lines or texts. Phrases that mostly occur inside a longer one are
    dropped. Empty and null texts hold none; repeated rows count as often as they stand there;
    other columns are not looked at. Counts may reach 10**15 with exact scores."""
    chunks = materialize(dictionary(docs, group_col, text_col, period), "chunks")
    n_buckets = block_count(text_bytes(chunks, "chunk"), BUCKET_BYTES)
    grams = materialize(counts(chunks, n_buckets, min_count), "ngrams")
    found = scored(grams)
    # the longer phrase that holds it most often
    words = F.split("gram", " ", -1)
    inner = grams.where("words = 3").select("part", "f", F.explode(F.array(
        F.array_join(F.slice(words, 1, 2), " "), F.array_join(F.slice(words, 2, 2), " "))).alias("phrase"))
    inner = inner.groupBy("part", "phrase").agg(F.max("f").alias("longer"))
    kept = found.join(inner, ["part", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * ABSORBED_PERCENT)).drop("longer")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept = kept.withColumn("_g", F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS)))
    kept = kept.withColumn("_r", F.row_number().over(Window.partitionBy("part", "_g").orderBy(*best)))
    ranked = kept.where(F.col("_r") <= top).withColumn(
        "rank", F.row_number().over(Window.partitionBy("part").orderBy(*best))).where(F.col("rank") <= top)
    n = chunks.groupBy("part").agg(F.sum(F.col("n") * F.col("starts")).alias("n"))
    return ranked.join(n, "part").select("part", F.col("rank").cast("long").alias("rank"), "phrase",
                                         "a", "l", "r", "n", "score")


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir)).withColumnRenamed("part", "lang")


SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
p AS (
  SELECT lang, w FROM (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'),
    lambda x: x <> '') AS w FROM d) WHERE len(w) > 0),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2),
    lambda i: array_to_string(w[i:i + k - 1], ' '))) AS gram
  FROM p, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, gram, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, gram, f AS a, string_split(gram, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
x AS (SELECT *, unnest(range(1, len(w))) AS cut FROM c),
y AS (
  SELECT x.lang, x.gram, x.a, cut, l.f AS l, r.f AS r,
    (CAST(1000000 AS HUGEINT) * x.a * x.a) // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM x JOIN f l ON l.lang = x.lang AND l.gram = array_to_string(w[1:cut], ' ')
         JOIN f r ON r.lang = x.lang AND r.gram = array_to_string(w[cut + 1:], ' ')),
z AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, cut) = 1),
h AS (
  SELECT lang, gram, max(a) AS longer FROM (
    SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS gram FROM c WHERE len(w) = 3)
  GROUP BY ALL),
t AS (
  SELECT z.*, row_number() OVER (PARTITION BY z.lang ORDER BY score DESC, a DESC, z.gram) AS rank
  FROM z LEFT JOIN h USING (lang, gram) WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, rank, gram AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM t JOIN n USING (lang) WHERE rank <= 2000"""
