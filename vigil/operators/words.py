"""Word jobs (P4, P5, P7, A3, A4). Map-side combine makes a hot word cost one partial row per task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.text import split_on_space, split_on_whitespace, strip_whitespace


def word_counts(texts: DataFrame, col: str = "text") -> DataFrame:
    """``line.split(" ")`` then count per word — case-sensitive, empty words counted (A3)."""
    # explode_outer + filter: plain explode would let the optimizer push size(split(..)) > 0,
    # i.e. the split itself, below the scan's exchange and evaluate it twice
    return (texts.select(F.explode_outer(split_on_space(col)).alias("word"))
                 .where(F.col("word").isNotNull())
                 .groupBy("word").agg(F.count("*").alias("n")))


def word_total(texts: DataFrame, col: str = "text") -> DataFrame:
    """``x.split()`` word total (P7 + A4): per-text sizes summed, no word rows materialized."""
    return texts.agg(F.coalesce(F.sum(F.size(split_on_whitespace(col))), F.lit(0)).cast("long").alias("total"))


def stripped_length(texts: DataFrame, ids: list[str], col: str = "text") -> DataFrame:
    """Length of each text with every Unicode whitespace run removed."""
    return texts.select(*ids, F.length(strip_whitespace(col)).alias("n"))
