"""The event messages in SQL: shared opening of every oracle query.

``m`` is the undamaged reading of each event, ``msg`` its raw text, ``valid`` the readings a
parser accepts, ``first`` one per id, ``raised`` the messages that raise an alert, ``puts``
the log of all valid readings.
"""

FLAT_JSON = """
'{"station_id":' || station_id || ',"s_no":' || s_no
|| ',"battery_status":"' || battery_status || '","status_timestamp":' || status_timestamp
|| ',"humidity":' || humidity || ',"temperature":' || temperature
|| ',"wind_speed":' || wind_speed || '}'
"""

NESTED_JSON = """
'{"station_id":' || station_id || ',"s_no":' || s_no
|| ',"battery_status":"' || battery_status || '","status_timestamp":' || status_timestamp
|| ',"weather":{"humidity":' || humidity || ',"temperature":' || temperature
|| ',"wind_speed":' || wind_speed || '}}'
"""

ALERT_JSON = """
'{"event":"CRITICAL_RAIN_ALERT","station_id":' || station_id || ',"s_no":' || s_no
|| ',"humidity":' || humidity || ',"status":"RAIN_DETECTED"}'
"""

READING = "station_id, s_no, battery_status, status_timestamp, humidity, temperature, wind_speed"

MESSAGES = f"""
WITH m AS (
  SELECT event_id AS arrival,
         user_id % 11 AS station_id,
         event_id % 1000 AS s_no,
         CASE WHEN event_type = 'signup' THEN 'low'
              WHEN event_type IN ('click', 'view') THEN 'medium' ELSE 'high' END AS battery_status,
         CAST(floor(epoch(ts)) AS BIGINT) AS status_timestamp,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS humidity,
         CAST(60 + CAST(floor(value) AS BIGINT) % 60 AS INTEGER) AS temperature,
         CAST(1 + event_id % 50 AS INTEGER) AS wind_speed,
         event_id % 20 AS damage
  FROM events
), texts AS (
  SELECT *, '{{"station_id":' || station_id || ',"s_no":' || s_no
    || CASE WHEN damage = 1 THEN '' ELSE ',"battery_status":"' || battery_status || '"' END
    || ',"status_timestamp":' || status_timestamp || ',"weather":'
    || CASE WHEN damage = 4 THEN 'null' ELSE '{{"humidity":'
         || CASE WHEN damage = 2 THEN '"' || humidity || '"'
                 WHEN damage = 3 THEN humidity || '.9'
                 ELSE CAST(humidity AS VARCHAR) END
         || ',"temperature":' || temperature || ',"wind_speed":' || wind_speed || '}}' END
    || '}}' AS whole
  FROM m
), msg AS (
  SELECT *, CAST(station_id AS VARCHAR) AS key,
         CASE WHEN damage = 0 THEN left(whole, length(whole) - 20) ELSE whole END AS value
  FROM texts
), valid AS (
  SELECT * FROM m WHERE damage NOT IN (0, 1, 4)
), first AS (
  SELECT * FROM valid
  QUALIFY row_number() OVER (PARTITION BY station_id, s_no ORDER BY arrival) = 1
), raised AS (
  SELECT *, CAST(station_id AS VARCHAR) AS key FROM m WHERE damage NOT IN (0, 4) AND humidity > 70
), puts AS (
  SELECT station_id || '-' || s_no AS key, {FLAT_JSON} AS value,
         status_timestamp * 1000 AS ts_ms, arrival // 1000 AS file_id, arrival AS offset_
  FROM valid
), newest AS (
  SELECT * FROM puts
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY file_id DESC, offset_ DESC) = 1
), stations AS (
  SELECT CAST(station_id AS VARCHAR) AS key, {FLAT_JSON} AS value FROM first
  QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY arrival DESC) = 1
)
"""
