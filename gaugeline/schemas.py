"""Fixed schemas. Nothing is inferred anywhere in the package."""

from pyspark.sql import types as T

LONG, INT, STRING = T.LongType(), T.IntegerType(), T.StringType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# One record of a keyed text topic.
MESSAGE = _struct(
    key=STRING,
    value=STRING,
    topic=STRING,
    partition=INT,
    offset=LONG,
    timestamp=T.TimestampType(),
)

WEATHER = _struct(humidity=INT, temperature=INT, wind_speed=INT)

READING_NESTED = _struct(
    station_id=LONG,
    s_no=LONG,
    battery_status=STRING,
    status_timestamp=LONG,
    weather=WEATHER,
)

READING_FLAT = _struct(
    station_id=LONG,
    s_no=LONG,
    battery_status=STRING,
    status_timestamp=LONG,
    humidity=INT,
    temperature=INT,
    wind_speed=INT,
)

ALERT = _struct(event=STRING, station_id=LONG, s_no=LONG, humidity=INT, status=STRING)

# An archived table carries its partition date beside the record's own columns.
READING_ARCHIVE = T.StructType(READING_FLAT.fields + [T.StructField("date", T.DateType())])
ALERT_ARCHIVE = T.StructType(ALERT.fields + [T.StructField("date", T.DateType())])

# An indexed document is the record plus its id.
READING_DOCUMENT = T.StructType([T.StructField("doc_id", STRING)] + READING_FLAT.fields)
ALERT_DOCUMENT = T.StructType([T.StructField("doc_id", STRING)] + ALERT.fields)

DEAD_LETTER = _struct(key=STRING, value=STRING)

KEY_VALUE = _struct(key=STRING, value=STRING)

# One put: (file_id, offset) is its position, ts_ms the wall clock when it was put.
PUT_LOG = _struct(key=STRING, value=STRING, ts_ms=LONG, file_id=LONG, offset=LONG)

# External payload. Numbers are read as text so that each can be judged on its own.
OBSERVATION = _struct(
    current=_struct(
        temperature_2m=STRING,
        relative_humidity_2m=STRING,
        wind_speed_10m=STRING,
    ),
    ingest_seq=LONG,
    ingest_ts=T.TimestampType(),
)

READING_COLUMNS = READING_FLAT.fieldNames()
ALERT_COLUMNS = ALERT.fieldNames()
# The id of a reading. The number comes first because a sort settles most comparisons on its
# first key, and there are far more numbers than stations.
READING_KEY = ["s_no", "station_id"]
ARRIVAL_ORDER = ["partition", "offset"]
