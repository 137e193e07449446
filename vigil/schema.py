"""Message schema and the fixed sensor vocabulary."""

from pyspark.sql.types import (ArrayType, DoubleType, StringType, StructField, StructType)

# ---------------------------------------------------------------------------
# These must equal the reference for identical results.
#   sensor type strings, in alarm priority order (first in breach wins)
ALARM_PRIORITY = ["TEMPERATURE", "PRESSURE", "HUMIDITY", "LIGHT"]
#   message field feeding each sensor type
SENSOR_FIELDS = {"temperature": "TEMPERATURE", "pressure": "PRESSURE",
                 "humidity": "HUMIDITY", "ambient_light": "LIGHT"}
#   breach band half-width in standard deviations
SIGMAS = 2.0
#   batch summary alert limit and its messages
ALERT_LIMIT = 95.0
MAX_ALERT_TEXT = "*ALERT!* - Temperature rose above 95.0!"
AVG_ALERT_TEXT = "Avg. temperature was above 95.0!"
AVG_OK_TEXT = "Avg. temperature was OK, not above 95.0"
#   per-batch line-job labels
COUNT_LABEL = "Total Count of Msgs: "
SUM_LABELS = {"HUMIDITY": "Total Sum of Humidity: ", "LIGHT": "Total Sum of Light: "}
RUNNING_NAMES = {"HUMIDITY": "Humidity", "LIGHT": "Ambient Light"}
#   alarm codes sent to the device: off / on
ALARM_CODE_OFF = "0"
ALARM_CODE_ON = "1"
# ---------------------------------------------------------------------------

# Format tag written into the messages our fixture feeds build (not read by any query).
MESSAGE_FORMAT = "urn:sensors:weather-station"

# One schema for all three payload shapes: absent fields become NULL.
SENSOR_ENTRY = StructType([StructField("current", DoubleType()), StructField("senstype", StringType())])

DATA = StructType([
    StructField("temperature", DoubleType()),
    StructField("pressure", DoubleType()),
    StructField("humidity", DoubleType()),
    StructField("ambient_light", DoubleType()),
    StructField("timestamp", StringType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("altitude", DoubleType()),
    StructField("sensors", ArrayType(SENSOR_ENTRY)),
])

PAYLOAD = StructType([
    StructField("reply_to", StringType()),
    StructField("format", StringType()),
    StructField("data", DATA),
])

MESSAGE = StructType([
    StructField("guid", StringType()),
    StructField("destination", StringType()),
    StructField("eventTime", StringType()),
    StructField("payload", PAYLOAD),
])

MESSAGES = ArrayType(MESSAGE)

# Long readings: one row per (message, sensor).
READING_COLUMNS = ["scope", "sensor", "batch", "ord", "guid", "x"]
