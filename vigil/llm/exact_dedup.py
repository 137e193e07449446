"""Operator 6: exact dedup by skew-safe combining.

The text is itself a grouping key at every stage, so full contents are compared, never digests
alone. Each map task first combines its own rows (partial aggregation: one row per distinct text
and task), the salted digest groups merge next, and the salt winners combine last; a text that
holds a third of all rows reaches any one task as at most one row per map task of its salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import ascii_lower, documents, materialize

SALTS = 32
# Texts of at least so many rows, and of one in HOT_SHARE rows or more, are combined by salts in
# ``kept_documents``; others reach a task as at most one row per map task anyway.
HOT_LEAST, HOT_SHARE = 256, 4096


def sha256(c: Column) -> Column:
    return F.unhex(F.sha2(F.encode(c, "utf-8"), 256))


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              salts: int = SALTS, digest=sha256) -> DataFrame:
    """One row per input row: ``id``, ``keep_id``, ``group_size``, ``kept`` and ``digest``
    (binary; of the normalised text).

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty, and an
    empty text is a text like any other. The row with the largest id stays; null ids lose to any
    other. Of repeated rows with the same id and text exactly one stays. An empty table gives no
    rows. Other columns of the input, whatever their names, are not looked at.
    """
    rows = _normalised(docs, id_col, text_col, digest)
    classes = materialize(_classes(rows, salts).select("digest", "keep_id", "group_size"),
                          "exact-classes")
    # repeated rows travel as one row with their number
    members = (rows.withColumn("norm_key", F.xxhash64("norm"))
               .groupBy("id", "digest", "norm_key").agg(F.count(F.lit(1)).alias("n")))
    # A digest that stands for several texts (a collision) cannot name a class: its rows are
    # joined on the text instead.
    clash = classes.groupBy("digest").count().filter("count > 1").select("digest")
    if clash.isEmpty():
        out = members.join(classes, "digest")
    else:
        clash = materialize(clash, "exact-clashes")
        apart = rows.join(clash, "digest", "left_semi")
        exact = (apart.groupBy("id", "digest", "norm").agg(F.count(F.lit(1)).alias("n"))
                 .join(_classes(apart, salts), ["digest", "norm"]))
        cols = ["id", "digest", "n", "keep_id", "group_size"]
        out = (members.join(clash, "digest", "left_anti").join(classes, "digest").select(*cols)
               .unionByName(exact.select(*cols)))
    copy = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    return copy.select(
        "id", "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "digest")


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   salts: int = SALTS, digest=sha256) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    The winner's row travels with its text, so no row is joined back. Only texts that very many
    rows hold take the salted way; all others are whole after their one shuffle. Of repeated rows
    with the same id and text exactly one stays; null ids lose to any other.
    """
    rows = docs.select(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"),
                       F.struct(*docs.columns).alias("row"),
                       F.struct(id_col, F.xxhash64(text_col)).alias("turn"))
    rows = rows.withColumn("digest", digest(F.col("norm")))
    counts = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts.filter(F.col("n") >= HOT_LEAST), "exact-counts")
    total = docs.count()
    # at most HOT_SHARE digests, however many rows there are
    hot = F.broadcast(counts.filter(F.col("n") * HOT_SHARE >= total).select("digest"))
    salt = F.pmod(F.spark_partition_id(), F.lit(salts))
    local = _winners(rows.join(hot, "digest", "left_semi").withColumn("salt", salt),
                     "digest", "salt", "norm")
    cold = _winners(rows.join(hot, "digest", "left_anti"), "digest", "norm")
    kept = cold.select("row").union(_winners(local, "digest", "norm").select("row"))
    return kept.select("row.*")


def _winners(rows: DataFrame, *keys: str) -> DataFrame:
    """One row of each group: the one of the largest ``turn``."""
    return rows.groupBy(*keys).agg(F.max_by("row", "turn").alias("row"), F.max("turn").alias("turn"))


def _normalised(docs: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"),
                       ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"))
    return rows.withColumn("digest", digest(F.col("norm")))


def _classes(rows: DataFrame, salts: int) -> DataFrame:
    """Distinct texts with the winner's id and the number of rows. ``rows``: id, norm, digest.
    The salt is the map task's, so that a task's copies combine before they are sent; which salt
    a row gets never changes the result."""
    salted = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    local = salted.groupBy("digest", "salt", "norm").agg(
        F.max("id").alias("id"), F.count(F.lit(1)).alias("n"))
    return local.groupBy("digest", "norm").agg(
        F.max("id").alias("keep_id"), F.sum("n").alias("group_size"))


def op6_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return decisions(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))


SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) = 1 AS kept,
       sha256(t) AS text_sha256
FROM d
"""
