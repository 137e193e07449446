"""Operator 8: sharding by weighted rendezvous hashing of stable record keys.

Every shard draws a number from the key's digest and the shard's name; the highest weighted draw
takes the record. A new shard can only win records, never move them between old shards. The text
is read for its size and checksum only and never shuffled; slots are numbered by two levels of
counting, so no task holds a whole shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import documents

# Rows of one numbering bucket (of one shard: fewer).
BUCKET_ROWS = 16_384


def draw(key: Column, name: str) -> Column:
    """A number in (0, 1): the first 52 bits of md5(key:name)."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{name}"))), 1, 13), 16, 10)
    return (bits.cast("long").cast("double") + 0.5) / F.lit(float(1 << 52))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard with the highest score -weight / ln(draw); ties to the smaller
    number. Shards of weight 0 take nothing; a null key is the empty key."""
    k = F.coalesce(key.cast("string"), F.lit(""))
    scores = [F.struct((F.lit(-float(w)) / F.log(draw(k, str(i)))).alias("score"),
                       F.lit(-i).alias("i")) for i, w in enumerate(weights) if w > 0]
    if not scores:
        raise ValueError("a shard of positive weight is needed")
    best = scores[0] if len(scores) == 1 else F.greatest(*scores)
    return (-best["i"]).cast("int")


def shard(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id``, ``size`` (UTF-8 bytes plus 1), ``text_crc32`` (null text:
    empty), ``shard``, ``slot`` (gapless from 0 in a shard) and ``grown_shard`` (under the weights
    ``grown``: by default one more shard of the last one's weight).

    Null ids share the empty key; repeated rows go to one shard and get slots of their own. An
    empty table gives no rows; no other column is looked at.
    """
    grown = list(grown) if grown is not None else [*weights, weights[-1]]
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8")
    rows = docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"), rendezvous(F.col(id_col), weights).alias("shard"),
        rendezvous(F.col(id_col), grown).alias("grown_shard"))
    n_buckets = max(1, -(-docs.count() // BUCKET_ROWS))
    key = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = rows.withColumn("bucket", F.pmod(
        F.conv(F.substring(key, 1, 13), 16, 10).cast("long"), F.lit(n_buckets)))
    # Rows of a bucket before this one, plus the rank inside the bucket. The counts are one row
    # per (shard, bucket), so their running sum is small.
    inside = Window.partitionBy("shard", "bucket").orderBy("id", "text_crc32", "size")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    base = counts.select("shard", "bucket",
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = rows.withColumn("rank", F.row_number().over(inside) - 1)
    return ranked.join(base, ["shard", "bucket"]).select(
        "id", "size", "text_crc32", "shard",
        (F.col("base") + F.col("rank")).cast("long").alias("slot"), "grown_shard")


def op8_rendezvous_sharding(spark, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir), [1.0] * 8).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"),
        "shard", "slot", "grown_shard")


def _sql() -> str:
    """The same law in DuckDB. CRC-32 runs over the bytes with a table made from its rule."""
    def winner(n: int) -> str:
        scores = ", ".join(
            f"{{'s': -1.0 / ln((('0x' || substr(md5(doc_id || ':{i}'), 1, 13))::BIGINT::DOUBLE"
            f" + 0.5) / 4503599627370496.0), 'i': {-i}}}" for i in range(n))
        return f"(-(list_max([{scores}])).i)::INTEGER"
    step = ("list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 "
            "THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)")
    return f"""
WITH crc AS (SELECT list({step} ORDER BY b) AS t FROM (SELECT unnest(range(256)) AS b)),
d AS (SELECT doc_id::VARCHAR AS k, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT greatest(1, (count(*) + {BUCKET_ROWS - 1}) // {BUCKET_ROWS}) AS n FROM documents),
s AS (
  SELECT doc_id, length(h) // 2 + 1 AS size,
         xor(list_reduce(
           list_concat([4294967295::BIGINT], list_transform(
             regexp_extract_all(h, '..'), lambda x: ('0x' || x)::BIGINT)),
           lambda c, x: xor(c >> 8, crc.t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32,
         {winner(8).replace("doc_id", "k")} AS shard,
         {winner(9).replace("doc_id", "k")} AS grown_shard,
         ('0x' || substr(md5(k), 1, 13))::BIGINT % n.n AS bucket
  FROM d, crc, n)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id) - 1 AS slot, grown_shard
FROM s
"""


SQL = _sql()
