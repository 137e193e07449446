"""Table-form inputs derived from the driver's ``events`` table.

Long readings:  ord=event_id, guid=user_id, sensor=event_type, x=value, batch=ts truncated to unit
Wide messages:  the weather-station envelope built from the same rows (k = integer in ``props``):
    temperature=value, pressure=25+k/20, humidity=k, ambient_light=255-value, timestamp=ts (ISO)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.schema import MESSAGE_FORMAT, SENSOR_FIELDS

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def _scope(scope: str) -> Column:
    """'ALL' pools every device (reference behaviour); 'guid' keeps one statistic per device."""
    return F.lit("ALL") if scope == "ALL" else F.col("guid")


def truncate(ev: DataFrame, col: str, unit: str) -> Column:
    """Batch key: ``col`` truncated to ``unit`` (year, month, day, hour, minute). A wall-clock
    (timestamp_ntz) column is truncated field by field, so batches never depend on the session
    time zone; a zoned timestamp uses ``date_trunc`` in the session zone."""
    c = F.col(col)
    if ev.schema[col].dataType.typeName() != "timestamp_ntz":
        return F.date_trunc(unit, c)
    keep = ["year", "month", "day", "hour", "minute"]
    if unit not in keep:
        raise ValueError(f"unsupported batch unit {unit!r}")
    n = keep.index(unit) + 1
    parts = [F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c)]
    ones = [None, F.lit(1), F.lit(1), F.lit(0), F.lit(0)]
    args = [parts[i] if i < n else ones[i] for i in range(5)]
    return F.make_timestamp_ntz(*args, F.lit(0))


def valid(x: Column) -> Column:
    """Readings that count: NULL and NaN are ignored."""
    return x.isNotNull() & ~F.isnan(x)


def long_readings(ev: DataFrame, unit: str = "day", scope: str = "ALL") -> DataFrame:
    r = ev.select(
        F.col("event_id").alias("ord"),
        F.col("user_id").cast("string").alias("guid"),
        F.col("event_type").alias("sensor"),
        F.col("value").alias("x"),
        truncate(ev, "ts", unit).alias("batch"))
    return r.where(valid(F.col("x"))).withColumn("scope", _scope(scope))


def props_k(ev: DataFrame) -> Column:
    return F.get_json_object(F.col("props"), "$.k").cast("int")


def wide_messages(ev: DataFrame, unit: str = "hour", keep: tuple[str, ...] = ()) -> DataFrame:
    """(ord, batch, [keep...], msg) with ``msg`` the nested message struct (shape C without
    position); ``keep`` carries extra event columns along (e.g. ``ts``) without a self-join."""
    k = props_k(ev).cast("double")
    data = F.struct(
        F.col("value").alias("temperature"),
        (F.lit(25.0) + k / F.lit(20.0)).alias("pressure"),
        k.alias("humidity"),
        (F.lit(255.0) - F.col("value")).alias("ambient_light"),
        F.date_format("ts", ISO_FORMAT).alias("timestamp"))
    msg = F.struct(
        F.col("user_id").cast("string").alias("guid"),
        F.lit(None).cast("string").alias("destination"),
        F.date_format("ts", ISO_FORMAT).alias("eventTime"),
        F.struct(F.lit(None).cast("string").alias("reply_to"),
                 F.lit(MESSAGE_FORMAT).alias("format"),
                 data.alias("data")).alias("payload"))
    return ev.select(F.col("event_id").alias("ord"), truncate(ev, "ts", unit).alias("batch"),
                     *keep, msg.alias("msg"))


def message_readings(msgs: DataFrame, scope: str = "ALL", keep: tuple[str, ...] = ()) -> DataFrame:
    """Wide messages → long readings: one row per present, valid sensor value (P9 unpivot)."""
    flat = msgs.select("ord", "batch", *keep, F.col("msg.guid").alias("guid"),
                       *[F.col(f"msg.payload.data.{f}").alias(s) for f, s in SENSOR_FIELDS.items()])
    longf = flat.unpivot(["ord", "batch", *keep, "guid"], list(SENSOR_FIELDS.values()), "sensor", "x")
    return longf.where(valid(F.col("x"))).withColumn("scope", _scope(scope))
