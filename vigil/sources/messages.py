"""Message readers. Every reader yields the same record columns:

    topic string, partition int, offset long, value string   (+ timestamp for Kafka)

so framing / decoding / the streaming runner do not care where records come from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KAFKA_PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13"


def read_kafka(spark: SparkSession, brokers: str, topic: str, streaming: bool = True,
               starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka topic as records (S1). Needs the Kafka connector package on the classpath."""
    reader = spark.readStream if streaming else spark.read
    r = (reader.format("kafka").option("kafka.bootstrap.servers", brokers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if streaming and max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    try:
        df = r.load()
    except Exception as e:  # noqa: BLE001 - surface the missing connector plainly
        if "kafka" in str(e).lower() and ("not find" in str(e).lower() or "failed to find" in str(e).lower()):
            raise RuntimeError(f"Kafka source needs the {KAFKA_PACKAGE} package on the classpath") from e
        raise
    return df.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"),
                     "timestamp")


def read_lines(spark: SparkSession, path: str, streaming: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Text lines (S3): topic = file, partition 0, offset increasing along the file (the id is
    partition-major and a file's splits are numbered in file order), so line-framed documents
    in files can be reassembled like a Kafka partition."""
    if streaming:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        df = r.load(path)
    else:
        df = spark.read.text(path)
    return df.select(F.input_file_name().alias("topic"), F.lit(0).alias("partition"),
                     F.monotonically_increasing_id().alias("offset"), "value")


def read_documents(spark: SparkSession, path: str, streaming: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Whole files as one record each (S2): a file holds one JSON document (object or array)."""
    if streaming:
        r = spark.readStream.format("text").option("wholetext", "true")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        df = r.load(path)
    else:
        df = spark.read.text(path, wholetext=True)
    return df.select(F.input_file_name().alias("topic"), F.lit(0).alias("partition"),
                     F.lit(0).cast("long").alias("offset"), "value")


def read_records_table(spark: SparkSession, path: str, streaming: bool = False,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table that already has (topic, partition, offset, value) — e.g. a landed Kafka
    topic — as a batch or a file stream."""
    if streaming:
        schema = spark.read.parquet(path).schema
        r = spark.readStream.schema(schema).format("parquet")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return r.load(path)
    return spark.read.parquet(path)


def read_answers(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Answers to commands (scope, batch_id, ack) as a stream, from the parquet files that whatever
    talks to the devices puts into a folder."""
    r = spark.readStream.schema("scope string, batch_id long, ack boolean").format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def write_kafka(df: DataFrame, brokers: str, topic: str, key_col: str | None = None) -> None:
    """Batch Kafka sink (K6): every column packed as JSON into the value."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    (df.select(key.alias("key"), value.alias("value")).write.format("kafka")
       .option("kafka.bootstrap.servers", brokers).option("topic", topic).save())
