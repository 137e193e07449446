"""A corpus pipeline of five stages over ``documents``.

Quality classifier, exact dedup, n-gram Jaccard join, substring dedup, packing. Each stage works
on all rows that its predecessor kept; all but the last return the columns of ``documents``. A
stage's result is written as Parquet and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm import exact_dedup, jaccard_join, packing, quality_knn, superkmers
from vigil.llm.common import documents, materialize


def quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold. The classifier is fitted on labelled rows."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    tables = quality_knn.fit(docs, labels)
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))
    scored = quality_knn.classify(rows, tables, keep=("_row",))
    return scored.filter(F.col("score") >= quality_knn.THRESHOLD).select("_row.*")


def exact(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest id."""
    return exact_dedup.kept_documents(docs)


def near(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar documents: the one with the smallest id.
    Documents without words are similar to none and stay; so do those of a null id, which the join
    links with nothing."""
    found = jaccard_join.jaccard_join(docs)
    gone = found.filter("component_id <> id").select(F.col("id").alias("doc_id")).distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def substrings(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that start in a document of smaller id too.
    ``n_chars`` follows the text; all other columns go along in one struct."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select("doc_id", "text", F.struct(*others).alias("_row")) if others else docs
    cleaned = superkmers.substring_dedup(rows, keep=("_row",) if others else ())
    new = {c: F.col("_row").getField(c) for c in others}
    if "n_chars" in new:
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(
            new["n_chars"])
    new |= {"doc_id": F.col("doc_id"), "text": F.col("kept")}
    return cleaned.select(*(new[c].alias(c) for c in docs.columns))


def packed(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("n-gram Jaccard join", near),
          ("substring dedup", substrings), ("packing", packed)]

# Classifier, tokens and similarity joins have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, "stage")
    return docs
