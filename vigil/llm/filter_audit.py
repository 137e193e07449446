"""Operator 12: what each filter of a chain removes, in every order of the filters.

The states are the subsets of filters already applied. A row is kept in a state when it fails none
of the state's filters, so everything follows from a small table: rows per (part, set of failed
filters). An edge of the subset lattice adds one filter to a state; what it removes is the
difference of its two ends. Counting the orders that reach a state (forward) and those that leave
it for the full set (backward) gives the number of orders through each edge: Shapley sums are the
edges' removals weighted by it, and the steps of any one order are read from the same edges.

The rows are looked at once. Their facts (some 60 bytes a row) are joined with the labels and
counted per content, which tells the rows that repeat another's text; after that only counts are
left, at most 2 ** filters a part. No group is ever collected: a text that a third of all rows hold
is one row per task after the partial counts.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import by_bytes, documents, flat, materialize

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 200, 50, 3
# More filters than this would make the list of all orders unreasonable (8! = 40320 a part).
MAX_FILTERS = 8
COUNTS = ("n", "good", "toxic")
# Bytes of text that are put through numpy at once.
TEXT_BYTES = 4 << 20
_SPACE, _SYMBOL = np.zeros(256, bool), np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL[list(b"#$%&*|")] = True


# -- the lattice (a constant of the number of filters) ------------------------------------
def path_counts(n: int) -> tuple[list[int], list[int]]:
    """For each of the 2**n states: orders that reach it from the empty state, and orders that
    lead on from it to the full one, each summed over the edges of the state."""
    forward, backward = [0] * (1 << n), [0] * (1 << n)
    forward[0] = backward[-1] = 1
    for s in range(1, 1 << n):
        forward[s] = sum(forward[s ^ 1 << f] for f in range(n) if s >> f & 1)
    for s in range((1 << n) - 2, -1, -1):
        backward[s] = sum(backward[s | 1 << f] for f in range(n) if not s >> f & 1)
    return forward, backward


def edges(n: int) -> list[tuple[int, int, int]]:
    """(state, filter added, orders through the edge)."""
    forward, backward = path_counts(n)
    return [(s, f, forward[s] * backward[s | 1 << f])
            for s in range(1 << n) for f in range(n) if not s >> f & 1]


def orders(letters: str) -> list[tuple[str, int, int, int]]:
    """(order, step from 1, state before it, filter) of every order of the filters."""
    out = []
    for order in permutations(range(len(letters))):
        state, name = 0, "".join(letters[f] for f in order)
        for step, f in enumerate(order, 1):
            out.append((name, step, state, f))
            state |= 1 << f
    return out


# -- counts ------------------------------------------------------------------------------
def lattice(counts: DataFrame, n: int) -> DataFrame:
    """``counts`` (part, mask of failed filters, n, good, toxic) -> part, ``kept``: for every state,
    in order, the struct of counts of the rows that are left; ``alone`` and ``failing``: for every
    filter the rows that fail it only, and all that fail it."""
    one = counts.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS])
    by_mask = one.groupBy("part").agg(F.map_from_entries(F.collect_list(
        F.struct("mask", F.struct(*COUNTS)))).alias("of"))  # at most 2**n entries
    zero = F.struct(*[F.lit(0).cast("long").alias(c) for c in COUNTS])

    def total(condition) -> Column:
        """The sum of counts over the masks that ``condition`` holds for."""
        masks = F.filter(F.sequence(F.lit(0), F.lit((1 << n) - 1)), condition)
        return F.aggregate(masks, zero, lambda a, m: F.struct(*[
            (a[c] + F.coalesce(F.try_element_at("of", m)[c], F.lit(0))).alias(c) for c in COUNTS]))

    every = F.sequence(F.lit(0), F.lit((1 << n) - 1))
    by_mask = by_mask.withColumn(
        "kept", F.transform(every, lambda s: total(lambda m: m.bitwiseAND(s) == 0)))
    left = lambda s: F.get("kept", s)["n"]
    filters = [F.lit(1 << f) for f in range(n)]
    alone = F.array(*[F.coalesce(F.try_element_at("of", b)["n"], F.lit(0)) for b in filters])
    failing = F.array(*[left(F.lit(0)) - left(b) for b in filters])
    return by_mask.select("part", "kept", alone.alias("alone"), failing.alias("failing"))


def audit(counts: DataFrame, letters: str = FILTERS) -> DataFrame:
    """``counts`` (part, mask, n, good, toxic) -> one row per part, order of ``letters`` and step:
    part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley. Bit f of ``mask`` stands for a failure of the f-th letter. No rows: no rows."""
    n = len(letters)
    if not 0 < n <= MAX_FILTERS:
        raise ValueError(f"1 to {MAX_FILTERS} filters")
    table = lattice(counts, n)
    at = lambda s: F.get("kept", s)
    # the edges' removals, weighted by the orders through them, per filter
    ways = F.array(*[F.array(*[F.struct(F.lit(s).alias("s"), F.lit(w).cast("long").alias("w"))
                               for s, g, w in edges(n) if g == f]) for f in range(n)])
    shapley = F.transform(ways, lambda own, f: F.aggregate(
        own, F.lit(0).cast("long"),
        lambda a, e: a + e["w"] * (at(e["s"])["n"] - at(
            e["s"] + F.pow(F.lit(2), f).cast("int"))["n"])))
    table = table.withColumn("shapley", shapley)
    spark = counts.sparkSession
    steps = spark.createDataFrame(orders(letters), "filter_order string, step int, s int, f int")
    # an order's step is an edge: it meets every part at the edge's state
    rows = table.select("*", F.posexplode("kept").alias("s", "_")).join(F.broadcast(steps), "s")
    before, after = at(F.col("s")), at((F.col("s") + F.pow(F.lit(2), F.col("f"))).cast("int"))
    removed = before["n"] - after["n"]
    return rows.select(
        "part", "filter_order", "step",
        after["n"].alias("kept"), removed.alias("removed"),
        (F.get("failing", F.col("f")) - removed).alias("redundant"),
        F.get("alone", F.col("f")).alias("unique_fails"),
        (before["good"] - after["good"]).alias("good_lost"),
        (before["toxic"] - after["toxic"]).alias("toxic_lost"),
        F.get("shapley", F.col("f")).alias("shapley"))


# -- the five filters of documents -----------------------------------------------------------
def text_failures(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits 0 to 3 of every text (bytes and their bounds): failures of A to D by words, distinct
    words, capitals and symbols."""
    def per_text(marks: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(marks)))[offsets])

    inside = ~_SPACE[raw]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    firsts = offsets[:-1][np.diff(offsets) > 0]
    start[firsts] = inside[firsts]
    n_words = per_text(start)
    # the words one after the other, without what is between them
    letters = np.ascontiguousarray(raw[inside])
    bounds = np.concatenate(([0], np.cumsum(inside)))[np.append(np.flatnonzero(start), len(raw))]
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(letters)])
    codes = words.dictionary_encode()
    text_of = np.repeat(np.arange(len(n_words)), n_words)
    pairs = np.sort(text_of * max(1, len(codes.dictionary)) + codes.indices.to_numpy())
    pairs = pairs[np.diff(pairs, prepend=-1) > 0]
    distinct = np.bincount(pairs // max(1, len(codes.dictionary)), minlength=len(n_words))
    points = per_text((raw & 0xC0) != 0x80)
    return ((n_words < MIN_WORDS) + 2 * (100 * distinct < MIN_DISTINCT_PERCENT * n_words)
            + 4 * (100 * per_text((raw >= 65) & (raw <= 90)) > MAX_UPPER_PERCENT * points)
            + 8 * (per_text(_SYMBOL[raw]) > 0)).astype(np.int32)


def text_facts(batches):
    """(id, part, text) -> (id, part, mask, digest and size of the text's bytes)."""
    for rb in batches:
        for i, j in by_bytes(flat(rb.column(2))[1], TEXT_BYTES):
            part = rb.slice(i, j - i)
            raw, offsets = flat(part.column(2))
            whole, sizes = raw.tobytes(), np.diff(offsets)
            digests = [hashlib.sha256(whole[a:b]).digest()
                       for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(text_failures(raw, offsets)),
                 pa.array(digests, pa.binary()), pa.array(sizes)],
                names=["_id", "part", "mask", "_digest", "_size"])


def failures(docs: DataFrame, labels: DataFrame, part_col: str = "lang", id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Counts (part, mask, n, good, toxic) of the failures of A to E, for ``audit``.

    Null texts are empty, null parts the empty string. E, a text that a smaller id has too, looks
    at the whole table: rows of the smallest id pass, repeated rows of it as well; a null id is
    larger than any other. A row is good (toxic) if any label of its id says so; labels of ids that
    are not there, null ones and those of null ids count nothing."""
    kind = docs.schema[id_col].dataType.simpleString()
    facts = docs.select(
        F.col(id_col).alias("_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col), F.lit(""))).mapInArrow(
        text_facts, f"_id {kind}, part string, mask int, _digest binary, _size long")
    # null ids match no label and are dealt out by content
    salt = F.when(F.col("_id").isNull(), F.crc32("_digest")).otherwise(0).cast("long")
    facts = facts.withColumn("_salt", salt)
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic")
    ).withColumn("_salt", F.lit(0).cast("long"))
    marked = facts.join(marks, ["_id", "_salt"], "left").select(
        "_id", "part", "mask", "_digest", "_size", F.coalesce("good", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"))
    # rows of one id and content (its copies) first, then the smallest id of each content and
    # kind of row; a hot content is then a few rows: kinds are parts x labels
    kind = ["_digest", "_size", "part", "mask", "good", "toxic"]
    copies = marked.groupBy("_id", *kind).agg(F.count(F.lit(1)).alias("n"))
    last = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"))
    kinds = copies.groupBy(*kind).agg(F.sum("n").alias("n"), F.min(
        F.struct(last.alias("id"), "n")).alias("first"))
    least = F.min("first.id").over(Window.partitionBy("_digest", "_size"))
    kinds = kinds.withColumn("pass", F.when(F.col("first.id") == least, F.col("first.n")).otherwise(0))
    repeated = 1 << 4
    both = F.explode(F.array(F.struct("mask", F.col("pass").alias("n")),
                             F.struct((F.col("mask") + repeated).alias("mask"),
                                      (F.col("n") - F.col("pass")).alias("n"))))
    return (kinds.select("part", "good", "toxic", both.alias("e")).where("e.n > 0")
            .groupBy("part", F.col("e.mask").alias("mask"))
            .agg(F.sum("e.n").alias("n"), F.sum(F.col("e.n") * F.col("good")).alias("good"),
                 F.sum(F.col("e.n") * F.col("toxic")).alias("toxic")))


def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    counts = materialize(failures(documents(spark, sf_dir), labels), "failures")
    return audit(counts)


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
f AS (
  SELECT doc_id, part, [
    len(words) < 200,
    100 * len(list_distinct(words)) < 50 * len(words),
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
    regexp_matches(t, '[#$%&*|]'),
    doc_id > min(doc_id) OVER (PARTITION BY t)] AS fails
  FROM w),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
c AS (
  SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
k AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
o AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM k a, k b, k c, k d, k e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT o, i AS step, o[i] AS x FROM o, k),
r AS (
  SELECT part, array_to_string(list_transform(o, lambda j: 'ABCDE'[j]), '') AS filter_order, step, x,
    sum(CASE WHEN len(list_filter(o[1:step], lambda j: fails[j])) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN fails[x] AND len(list_filter(o[1:step - 1], lambda j: fails[j])) = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fails[x] AND len(list_filter(o[1:step - 1], lambda j: fails[j])) > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails[x] AND len(list_filter(fails, lambda y: y)) = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN fails[x] AND len(list_filter(o[1:step - 1], lambda j: fails[j])) = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN fails[x] AND len(list_filter(o[1:step - 1], lambda j: fails[j])) = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM r"""
