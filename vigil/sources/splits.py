"""JSON files in byte ranges (S2): a file of any size, on one line or many, is read by many tasks.

The text source cuts files into ranges and, with a closing brace as the line separator, hands each
range over in chunks that end with one. A brace inside a literal ends none: whether a chunk starts
inside a literal follows from the number of quotes before it, a running sum over the file that
starts anew at each line end (a literal holds none, so a broken one costs its line only). Chunks
that start inside a literal are put back to the one before; the rest is framing as for lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.scan import RunSpec, running
from vigil.functions.sizing import materialize
from vigil.sources.framing import parts_needed, reassemble

BY = ["topic", "partition"]


def _quotes(text: Column) -> Column:
    """Quotes that start or end a literal."""
    return F.length(F.regexp_replace(F.regexp_replace(text, r"(?s)\\.", ""), r'[^"]++', "")).cast("long")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """(topic = file, partition 0, offset, value): the files cut behind closing braces, in order."""
    raw = spark.read.option("lineSep", "}").option("recursiveFileLookup", "true").text(path)
    raw = raw.select(F.col("_metadata.file_path").alias("topic"), F.col("_metadata.file_size").alias("_size"),
                     F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"), "value")
    # the last chunk of a file ends with its separator if the lengths add up to the file's
    ends = raw.groupBy("topic").agg(F.max("offset").alias("offset"), F.max("_size").alias("_size"),
                                    F.sum(F.octet_length("value") + 1).alias("_read"))
    open_ = ends.where("_read > _size").select("topic", "offset", F.lit(True).alias("_open"))
    return raw.join(open_, ["topic", "offset"], "left").select(
        *BY, "offset", F.concat("value", F.when(F.col("_open"), "").otherwise("}")).alias("value"))


def read_objects(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(documents, lost) of all files under ``path``: one row per top-level object with its file
    (``topic``) and text (``value``), and every piece of text that belongs to none, with the reason.
    Objects may stand in arrays, one after the other, on one line or many."""
    chunks = materialize(read_chunks(spark, path), "chunks")
    parts = parts_needed(chunks, "value")
    dealt = chunks.repartition(parts, *BY, "offset") if parts else chunks
    line_end = F.instr("value", "\n") > 0
    after = F.when(line_end, F.substring_index("value", "\n", -1)).otherwise(F.col("value"))
    # narrow tables, written because a running value reads its input twice
    facts = materialize(chunks.select(*BY, "offset", _quotes(after).alias("_q"), line_end.alias("_new")), "quotes")
    seen = materialize(running(facts, BY, "offset", [RunSpec("_v", "_q", inclusive=False)], parts=parts), "quotes")
    seen = seen.withColumn("_v", F.coalesce("_v", F.lit(0))).withColumn(
        "_at", F.when(F.col("_new"), F.col("_v")))
    seen = materialize(running(seen, BY, "offset", [RunSpec("_base", "_at", "max", inclusive=False)], parts=parts), "quotes")
    starts = ((F.col("_v") - F.coalesce("_base", F.lit(0))) % 2 == 0).cast("long")
    groups = running(seen.select(*BY, "offset", starts.alias("_starts")), BY, "offset", [RunSpec("_g", "_starts")],
                     parts=parts)
    text = F.struct("offset", "value")
    lines = (dealt.join(groups.select(*BY, "offset", "_g"), [*BY, "offset"]).groupBy(*BY, "_g")
             .agg(F.min("offset").alias("offset"), F.array_sort(F.collect_list(text)).alias("_l"))
             .select(*BY, "offset", F.array_join(F.transform("_l", lambda c: c["value"]), "").alias("value")))
    docs, unfinished, lost = reassemble(materialize(lines, "lines"), between="")
    return docs, lost.unionByName(unfinished.withColumn("reason", F.lit("unfinished")))
