"""Small builders shared by the tests."""

import datetime as dt
import json

from gaugeline.schemas import MESSAGE, PUT_LOG

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def reading(station=1, s_no=1, battery="low", time=1704067200, humidity=50, temp=70, wind=5):
    return {
        "station_id": station,
        "s_no": s_no,
        "battery_status": battery,
        "status_timestamp": time,
        "weather": {"humidity": humidity, "temperature": temp, "wind_speed": wind},
    }


def message(value, offset=0, partition=0, key="1", arrived=0):
    text = json.dumps(value) if isinstance(value, (dict, list)) else value
    when = START + dt.timedelta(seconds=arrived)
    return (key, text, "weather_status", partition, offset, when)


def messages(spark, rows):
    return spark.createDataFrame(rows, MESSAGE)


def puts(spark, rows):
    """Puts as (file_id, key, value), in order of writing."""
    sized = [(k, v, 0, f, i) for i, (f, k, v) in enumerate(rows)]
    return spark.createDataFrame(sized, PUT_LOG)


def as_dict(df, key="key", value="value"):
    rows = df.collect()
    found = {r[key]: r[value] for r in rows}
    assert len(found) == len(rows), "a key came more than once"
    return found


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
