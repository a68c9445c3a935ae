"""Column expressions shared by the operators. All run inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def message_id(station_id: str = "station_id", s_no: str = "s_no") -> Column:
    return F.concat_ws("-", F.col(station_id).cast("string"), F.col(s_no).cast("string"))


def event_time(seconds: str = "status_timestamp") -> Column:
    return F.timestamp_seconds(F.col(seconds))


def event_date(seconds: str = "status_timestamp") -> Column:
    return F.to_date(event_time(seconds))


def partition_path(base: str, station_id: str = "station_id", date: Column | None = None) -> Column:
    """The directory a record is archived under, as text."""
    day = F.date_format(event_date() if date is None else date, "yyyy-MM-dd")
    return F.format_string(f"{base}/station_id=%d/date=%s", F.col(station_id), day)


def round_half_up(x: Column) -> Column:
    """Halves go toward positive infinity (-0.5 becomes 0), unlike ``F.round``."""
    return F.floor(x + F.lit(0.5)).cast("int")


def celsius_to_fahrenheit(celsius: Column) -> Column:
    return round_half_up(celsius * 9.0 / 5.0 + 32)


def epoch_seconds_now() -> Column:
    return F.unix_timestamp()


def epoch_millis_now() -> Column:
    return F.unix_millis(F.current_timestamp())


def decode_key(raw: Column) -> Column:
    """A key as it stands in a request path.

    Percent escapes are decoded, outer slashes trimmed, and the rest decoded once more as a
    form field, which also turns ``+`` into a space. A broken escape gives NULL.
    """
    plus_kept = F.replace(raw, F.lit("+"), F.lit("%2B"))
    trimmed = F.regexp_replace(F.try_url_decode(plus_kept), "^/+|/+$", "")
    return F.try_url_decode(trimmed)


def json_string(text: Column) -> Column:
    """The text as a quoted, escaped JSON string."""
    one = F.to_json(F.array(text))
    return F.substring(one, F.lit(2), F.length(one) - 2)
