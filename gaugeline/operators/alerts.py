"""Rain alerts: raised from raw messages, read back from alert texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.functions.json_fields import (
    CORRUPT,
    all_of,
    computed_once,
    fits_int,
    plain_text,
    present,
    read_loose,
    read_typed,
    texts,
    whole_numbers,
)
from gaugeline.operators.ranking import dedup_first
from gaugeline.schemas import ALERT, ALERT_COLUMNS, INT, LONG, READING_KEY

# What an alert says and when it is raised.
HUMIDITY_THRESHOLD = 70
ALERT_EVENT = "CRITICAL_RAIN_ALERT"
ALERT_STATUS = "RAIN_DETECTED"
UNREADABLE_ALERT = '{"event":"UNKNOWN_ALERT_ERROR"}'

_SOURCE = T.StructType(
    [
        T.StructField("station_id", LONG),
        T.StructField("s_no", LONG),
        T.StructField("weather", T.StructType([T.StructField("humidity", INT)])),
    ]
)
_SOURCE_NODES = T.StructType(
    [T.StructField(name, T.VariantType()) for name in ("station_id", "s_no", "weather")]
)
_ALERT_NUMBERS = ["station_id", "s_no", "humidity"]
_ALERT_TEXTS = ["event", "status"]


def _int_or_zero(number: str) -> str:
    return f"CASE WHEN {fits_int(number)} THEN CAST({number} AS INT) ELSE 0 END"


def _long_or_zero(number: str) -> str:
    return f"coalesce({number}, 0L)"


def read_humidity(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add station_id, s_no, humidity and ``readable`` (the text is a JSON object).

    Missing or unusable fields read as 0. This is the lenient reading of a raw message: it
    needs none of the fields a valid reading must have, so a message may raise an alert and
    still be a dead letter.
    """
    is_whole = all_of(
        f"_typed.{CORRUPT} IS NULL",
        present("_typed.station_id"),
        present("_typed.s_no"),
        present("_typed.weather.humidity"),
    )
    # Weather stays one node here, since a weather that is no object is no error.
    numbers = whole_numbers(
        "_loose.station_id",
        "_loose.s_no",
        "try_variant_get(_loose.weather, '$.humidity', 'variant')",
    )
    staged = (
        messages.withColumn("_typed", read_typed(value, _SOURCE))
        .withColumn("_whole", is_whole)
        .withColumn("_loose", F.when(~F.col("_whole"), read_loose(value, _SOURCE_NODES)))
        .withColumn("_numbers", F.when(F.col("_loose").isNotNull(), numbers))
    )
    reading = computed_once(
        station_id=f"IF(_whole, _typed.station_id, {_long_or_zero('_numbers[0]')})",
        s_no=f"IF(_whole, _typed.s_no, {_long_or_zero('_numbers[1]')})",
        humidity=f"IF(_whole, _typed.weather.humidity, {_int_or_zero('_numbers[2]')})",
        readable=f"_whole OR (_loose IS NOT NULL AND _loose.{CORRUPT} IS NULL)",
    )
    return staged.withColumn("_reading", reading).select(*messages.columns, "_reading.*")


def rain_alerts(
    messages: DataFrame, threshold: int = HUMIDITY_THRESHOLD, value: str = "value"
) -> DataFrame:
    """Messages with humidity strictly above the threshold, with their alert fields."""
    return read_humidity(messages, value).where(F.col("readable") & (F.col("humidity") > threshold))


def alert_json() -> Column:
    """The alert text of a message read by :func:`read_humidity`."""
    text = F.to_json(
        F.struct(
            F.lit(ALERT_EVENT).alias("event"),
            "station_id",
            "s_no",
            "humidity",
            F.lit(ALERT_STATUS).alias("status"),
        )
    )
    return F.when(F.col("readable"), text).otherwise(F.lit(UNREADABLE_ALERT))


def to_alert_messages(raised: DataFrame) -> DataFrame:
    """Messages read for alerts, with the alert text in place of the raw one."""
    texts_in_place = raised.withColumn("value", alert_json())
    return texts_in_place.drop("station_id", "s_no", "humidity", "readable")


def alert_messages(messages: DataFrame, threshold: int = HUMIDITY_THRESHOLD) -> DataFrame:
    """Raw messages in, alert messages out: same key and position, the alert as value."""
    return to_alert_messages(rain_alerts(messages, threshold))


def alert_messages_once(
    messages: DataFrame, threshold: int = HUMIDITY_THRESHOLD, keys: Sequence[str] = READING_KEY
) -> DataFrame:
    """As :func:`alert_messages`, but an id raises only its first alert."""
    return to_alert_messages(dedup_first(rain_alerts(messages, threshold), keys))


def parse_alerts(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add the alert columns and ``valid`` to alert messages.

    Missing fields read as 0 or ``""``. Only a text that is not JSON, or a NULL, is invalid;
    blank text and non-objects give a row of defaults.
    """
    is_whole = all_of(
        f"_typed.{CORRUPT} IS NULL",
        *[present(f"_typed.{name}") for name in ALERT_COLUMNS],
        *[plain_text(f"_typed.{name}") for name in _ALERT_TEXTS],
    )
    blank = F.regexp_replace(value, r"[ \t\r\n]", "") == ""
    valid = (
        F.expr(f"_whole OR (_loose IS NOT NULL AND _loose.{CORRUPT} IS NULL)")
        | F.coalesce(blank, F.lit(False))
        | F.try_parse_json(value).isNotNull()
    )
    has_loose = F.col("_loose").isNotNull()
    staged = (
        messages.withColumn("_typed", read_typed(value, ALERT))
        .withColumn("_whole", is_whole)
        .withColumn("_loose", F.when(~F.col("_whole"), read_loose(value, ALERT)))
        .withColumns(
            {
                "_numbers": F.when(
                    has_loose, whole_numbers(*[f"_loose.{name}" for name in _ALERT_NUMBERS])
                ),
                "_texts": F.when(has_loose, texts(*[f"_loose.{name}" for name in _ALERT_TEXTS])),
            }
        )
        .withColumn("_valid", valid)
    )
    lenient = {
        "event": "coalesce(_texts[0], '')",
        "station_id": _long_or_zero("_numbers[0]"),
        "s_no": _long_or_zero("_numbers[1]"),
        "humidity": _int_or_zero("_numbers[2]"),
        "status": "coalesce(_texts[1], '')",
    }
    fields = {
        name: f"CASE WHEN _whole THEN _typed.{name} WHEN _valid THEN {text} END"
        for name, text in lenient.items()
    }
    parsed = staged.withColumn("_alert", computed_once(**fields, valid="_valid"))
    return parsed.select(*messages.columns, "_alert.*")


def alert_records(parsed: DataFrame) -> DataFrame:
    """Readable alerts. Unreadable ones are in :func:`unreadable_alerts`, for strict callers."""
    return parsed.where("valid").drop("valid", "value")


def unreadable_alerts(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("valid")).drop("valid", *ALERT_COLUMNS)
