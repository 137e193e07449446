"""Line-stream jobs (F3, P3-P6, P8, A1, A2, O2, O3): per batch filter, extract, count, sum, sort.

Input: records (batch, ord, ..., value) where each record is one line of a pretty-printed
message. Everything is a built-in expression; batches are a grouping key, so an empty batch
has no row at all (the reference prints no count/sum for it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.text import strip_whitespace, try_double
from vigil.schema import COUNT_LABEL, SUM_LABELS

# Line patterns (searched anywhere in the whitespace-free line) and the key
# text removed before the number is read, per sensor.
LINE_PATTERNS = {"HUMIDITY": "humidity.*", "LIGHT": "ambient_light.*,"}
LINE_KEYS = {"HUMIDITY": '"humidity":', "LIGHT": '"ambient_light":',
             "TEMPERATURE": '"temperature":'}
# Patterns of the other revisions.
TEMPERATURE_PATTERN = {"TEMPERATURE": "temperature.*"}
LIGHT_WITHOUT_COMMA = {"HUMIDITY": "humidity.*", "LIGHT": "ambient_light.*"}


def matched_lines(lines: DataFrame, ids: list[str],
                  patterns: dict[str, str] | None = None) -> DataFrame:
    """(ids..., sensor, line): whitespace-stripped lines, once for each sensor whose pattern they
    match; the filters are independent, so a line may reach several."""
    s = lines.select(*ids, strip_whitespace("value").alias("line"))
    hits = F.array(*[F.when(F.col("line").rlike(p), F.lit(sensor))
                     for sensor, p in (patterns or LINE_PATTERNS).items()])
    # through a generator: a plain filter on ``sensor`` would be pushed below the projection and
    # strip / match every line again inside the filter
    return (s.select(*ids, F.explode_outer(F.array_compact(hits)).alias("sensor"), "line")
            .where(F.col("sensor").isNotNull()))


def line_values(matched: DataFrame, ids: list[str]) -> DataFrame:
    """(ids..., sensor, x_text, x): key and commas removed; bad text gives NULL x, not a failure.
    On a line with other fields the number is what follows the sensor's own key."""
    key = F.lit(None).cast("string")
    for sensor, k in LINE_KEYS.items():
        key = F.when(F.col("sensor") == sensor, F.lit(k)).otherwise(key)
    alone = F.regexp_replace(F.replace(F.col("line"), key, F.lit("")), ",", "")
    own = F.regexp_extract(F.call_function("substring_index", F.col("line"), key, F.lit(-1)), r"^[^,{}\[\]]*", 0)
    text = F.when(F.col("line").contains('":') & (F.size(F.split("line", '":')) > 2), own).otherwise(alone)
    return matched.select(*ids, "sensor", text.alias("x_text"), try_double(text).alias("x"))


def parsed(values: DataFrame) -> DataFrame:
    """Rows whose text parsed to a number — kept through a generator so the extraction regex
    is not re-evaluated inside a pushed-down filter."""
    hit = F.explode_outer(F.when(F.col("x").isNotNull(), F.array(F.lit(True)))).alias("_ok")
    return values.select("*", hit).where(F.col("_ok").isNotNull()).drop("_ok")


def batch_count(values: DataFrame, sensor: str = "HUMIDITY") -> DataFrame:
    """A1 + P8: parsed values per batch with the label line."""
    g = parsed(values).where(F.col("sensor") == sensor).groupBy("batch").agg(
        F.count("*").alias("n"))
    return g.select("batch", "n", F.concat(F.lit(COUNT_LABEL), F.col("n").cast("string")).alias("label"))


def batch_sum(values: DataFrame) -> DataFrame:
    """A2 + P8: per batch and sensor, the sum of parsed values and its label line."""
    g = parsed(values).groupBy("batch", "sensor").agg(F.sum("x").alias("total"))
    label = F.lit(None).cast("string")
    for sensor, text in SUM_LABELS.items():
        label = F.when(F.col("sensor") == sensor, F.lit(text)).otherwise(label)
    return g.select("batch", "sensor", "total",
                    F.concat(label, F.format_string("%.6f", F.col("total"))).alias("label"))


def batch_sort(values: DataFrame, by_text: bool = False) -> DataFrame:
    """O2 (numeric) / O3 (as text: "100.1" sorts before "38.2"): ascending within each batch and
    sensor. A global range-partitioned sort, so no batch has to fit one task."""
    key = "x_text" if by_text else "x"
    v = parsed(values) if not by_text else values
    return v.select("batch", "sensor", key).orderBy("batch", "sensor", key)
