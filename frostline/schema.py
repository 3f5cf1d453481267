"""Schemas and fixed values shared by every operator."""

from pyspark.sql import types as T

# Wire format and settings that results depend on.
TOPIC = "device_activity_stream"
BOOTSTRAP_SERVERS = "localhost:9092"
CONSUMER_GROUP = "group1"
JSON_DEVICE_ID = "device-id"
JSON_TIME = "time"
JSON_SENSOR_NAME_1 = "sensor-name-1"
JSON_SENSOR_VALUE_1 = "sensor-value-1"
JSON_SENSOR_NAME_2 = "sensor-name-2"
JSON_SENSOR_VALUE_2 = "sensor-value-2"
DEFROST_THRESHOLD = 0.0
PATTERN_WITHIN_MS = 10_000
WINDOW_MS = 30_000
SLIDE_MS = 1_000
EFFICIENCY_SCALE = 100
TIMELINE_TTL_SECONDS = 7_200
TRIGGER_INTERVAL = "6 seconds"
SPARKLINE_LENGTH = 100
DOOR_LABELS = ("Open", "Closed")
DEFROST_LABELS = ("Thawed", "Normal")
GAUGE_UNIT = "Δ°F/kw"
GAUGE_RANGE = (0.0, 5.0)
HTTP_DATE_FORMAT = "EEE, dd MMM yyyy HH:mm:ss 'GMT'"

CORRUPT_COLUMN = "_corrupt"

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField(JSON_TIME, T.DoubleType()),
        T.StructField(JSON_DEVICE_ID, T.StringType()),
        T.StructField(JSON_SENSOR_NAME_1, T.StringType()),
        T.StructField(JSON_SENSOR_VALUE_1, T.DoubleType()),
        T.StructField(JSON_SENSOR_NAME_2, T.StringType()),
        T.StructField(JSON_SENSOR_VALUE_2, T.DoubleType()),
        T.StructField(CORRUPT_COLUMN, T.StringType()),
    ]
)

READING_COLUMNS = [
    "device_id",
    "time_ms",
    "ts",
    "seq",
    "sensor_name_1",
    "temp",
    "sensor_name_2",
    "kw",
]

READING_SCHEMA = T.StructType(
    [
        T.StructField("device_id", T.StringType()),
        T.StructField("time_ms", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("seq", T.LongType()),
        T.StructField("sensor_name_1", T.StringType()),
        T.StructField("temp", T.DoubleType()),
        T.StructField("sensor_name_2", T.StringType()),
        T.StructField("kw", T.DoubleType()),
    ]
)

STATUS_SCHEMA = T.StructType(
    [
        T.StructField("device_id", T.StringType()),
        T.StructField("door_open", T.BooleanType()),
        T.StructField("defrosted", T.BooleanType()),
        T.StructField("efficiency", T.DoubleType()),
    ]
)

# One row per update of one status column; the other two columns are NULL.
STATUS_CHANGE_SCHEMA = T.StructType(
    STATUS_SCHEMA.fields
    + [T.StructField("time_ms", T.LongType()), T.StructField("seq", T.LongType())]
)
