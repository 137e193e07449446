"""Record feeds derived from the driver's ``events`` table by Spark itself (so their size grows
with the table): the same weather messages as JSON documents, as pretty-printed lines split
over records, in the sensor-array shape, and with broken records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.schema import MESSAGE_FORMAT, SENSOR_FIELDS
from vigil.sources.tables import wide_messages

LINE_SLOTS = 8            # offsets that a message's lines may take
LINE_PARTITIONS = 4       # records spread over four topic partitions
ARRAY_MESSAGES = 500      # messages of one array
CUT_OFF = '{"guid": "cut off"'


def json_records(ev: DataFrame, unit: str = "hour", keep: tuple[str, ...] = ()) -> DataFrame:
    """One record per message: the JSON array ``[{...}]`` (the generator's layout)."""
    m = wide_messages(ev, unit, keep)
    return m.select(F.lit("events").alias("topic"), F.lit(0).alias("partition"),
                    F.col("ord").alias("offset"), "batch", *keep,
                    F.to_json(F.array(F.col("msg"))).alias("value"))


def split_line_records(ev: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages as line records of long arrays on partition ``ord % 4``, at offsets from
    ``ord * 8``: most over several lines, every seventh compact on one, and after every 97th place
    a line that opens an object and never closes it."""
    m = wide_messages(ev, keep=keep)
    obj = F.to_json(F.col("msg"))
    place = F.expr(f"ord div {LINE_PARTITIONS} % {ARRAY_MESSAGES}")
    none = F.array().cast("array<string>")

    def line(condition, text):
        return F.when(condition, F.array(F.lit(text))).otherwise(none)

    body = F.expr("substring(_obj, 2, length(_obj) - 2)")
    spread_out = F.array(F.lit("  {"), body, F.lit("  },"))
    lines = F.concat(line(F.col("_p") == 0, "["), line(F.col("ord") % 97 == 5, CUT_OFF),
                     F.when(F.col("ord") % 7 == 0, F.array(F.concat("_obj", F.lit(","))))
                     .otherwise(spread_out), line(F.col("_p") == ARRAY_MESSAGES - 1, "]"))
    return (m.select("ord", *keep, obj.alias("_obj"), place.alias("_p"))
             .select("ord", *keep, F.posexplode(lines).alias("i", "value"))
             .select(*keep, F.lit("events").alias("topic"),
                     (F.col("ord") % LINE_PARTITIONS).cast("int").alias("partition"),
                     (F.col("ord") * LINE_SLOTS + F.col("i")).alias("offset"), "value"))


def mixed_records(ev: DataFrame) -> DataFrame:
    """Records of many forms, by ``ord % 11``: an array, an object, two documents, a document and
    more, no message, wrong types, unknown fields, white space, a cut-off document, and two in
    which 13 to 100 levels of objects stand before a message: in a message and in none."""
    m = wide_messages(ev).select("ord", F.to_json(F.col("msg")).alias("o"))
    deep = F.expr("""concat(repeat('{"x":', cast(13 + ord % 88 as int)), '1',
                            repeat('}', cast(13 + ord % 88 as int)))""")
    wrapped = F.concat(F.expr("substring(o, 1, length(o) - 1)"), F.lit(',"deep":'), deep, F.lit("}"))
    forms = [F.concat(F.lit("["), "o", F.lit("]")), F.col("o"),
             F.concat(F.lit("["), "o", F.lit("],["), "o", F.lit("]")),
             F.concat(F.lit("["), "o", F.lit("] trailing")), F.lit("[null]"),
             F.lit('{"payload":5}'), F.lit('{"foo":1}'), F.lit("\t\r\n "),
             F.concat("o", F.lit(' {"guid":')), F.concat(F.lit("["), wrapped, F.lit(","), "o", F.lit("]")),
             F.concat(F.lit('{"foo":'), deep, F.lit("} "), "o")]
    value = forms[-1]
    for i in range(len(forms) - 2, -1, -1):
        value = F.when(F.col("ord") % len(forms) == i, forms[i]).otherwise(value)
    return m.select(F.lit("events").alias("topic"), F.lit(0).alias("partition"),
                    F.col("ord").alias("offset"), value.alias("value"))


def sensor_array_records(ev: DataFrame) -> DataFrame:
    """Shape A: readings as ``sensors: [{current, senstype}, ...]`` instead of flat fields."""
    m = wide_messages(ev)
    data = F.col("msg.payload.data")
    sensors = F.array(*[F.struct(data.getField(f).alias("current"), F.lit(f).alias("senstype"))
                        for f in SENSOR_FIELDS])
    msg = F.struct(F.col("msg.guid").alias("guid"),
                   F.struct(F.lit(MESSAGE_FORMAT).alias("format"),
                            F.struct(sensors.alias("sensors"),
                                     data.getField("timestamp").alias("timestamp")).alias("data"))
                    .alias("payload"))
    return m.select(F.lit("events").alias("topic"), F.lit(0).alias("partition"),
                    F.col("ord").alias("offset"), F.to_json(F.array(msg)).alias("value"))


def broken_records(ev: DataFrame) -> DataFrame:
    """Messages of error events arrive cut in half (truncated JSON); the rest are intact.
    One pass: the event type rides along with the message (no self-join)."""
    m = wide_messages(ev, keep=("event_type",))
    r = m.select("ord", "event_type", F.to_json(F.array(F.col("msg"))).alias("value"))
    cut = F.expr("substring(value, 1, length(value) div 2)")
    return r.select(F.lit("events").alias("topic"), F.lit(0).alias("partition"), F.col("ord").alias("offset"),
                    F.when(F.col("event_type") == "error", cut).otherwise(F.col("value")).alias("value"))


def _fmt(c: Column) -> Column:
    return F.format_string("%f", c)


def pretty_lines(ev: DataFrame, unit: str = "hour", keep: tuple[str, ...] = ()) -> DataFrame:
    """Every message printed one field a line: (batch, ord, [keep...], line_no, value)."""
    m = wide_messages(ev, unit, keep)
    d = "msg.payload.data"

    def number(name, field, end=","):
        return F.concat(F.lit(f'"{name}" : '), _fmt(F.col(f"{d}.{field}")), F.lit(end))

    lines = F.array(
        F.concat(F.lit('{ "guid" : "'), F.col("msg.guid"), F.lit('",')),
        F.lit('"payload" : { "data" : {'),
        number("temperature", "temperature"), number("pressure", "pressure"),
        number("humidity", "humidity"), number("ambient_light", "ambient_light"),
        F.concat(F.lit('"timestamp" : "'), F.col(f"{d}.timestamp"), F.lit('"')),
        F.concat(F.lit('}, "format" : "'), F.col("msg.payload.format"), F.lit('" } }')))
    return m.select("batch", "ord", *keep, F.posexplode(lines).alias("line_no", "value"))


def compact_lines(ev: DataFrame, unit: str = "hour") -> DataFrame:
    """Every message on one line, both sensor keys of the line jobs in it."""
    m = wide_messages(ev, unit)
    d = "msg.payload.data"
    line = F.concat(F.lit('{"humidity":'), _fmt(F.col(f"{d}.humidity")),
                    F.lit(',"ambient_light":'), _fmt(F.col(f"{d}.ambient_light")), F.lit(","))
    return m.select("batch", "ord", F.lit(0).alias("line_no"), line.alias("value"))


__all__ = ["json_records", "split_line_records", "mixed_records", "sensor_array_records",
           "broken_records", "pretty_lines", "compact_lines"]
