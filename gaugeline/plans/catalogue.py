"""Every operator as a query over the given tables, beside the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeline.functions import scalars
from gaugeline.operators import alerts, documents, latest, observations, readings
from gaugeline.operators.gaps import sequence_gaps
from gaugeline.operators.memory import dedup_last_n
from gaugeline.operators.ranking import dedup_first, dedup_within, first_per_key, last_per_key
from gaugeline.operators.sequence import sequence_numbers
from gaugeline.plans import event_messages as source
from gaugeline.plans.oracles import ALERT_JSON, FLAT_JSON, MESSAGES, NESTED_JSON, READING
from gaugeline.schemas import ALERT_COLUMNS, ARRIVAL_ORDER, KEY_VALUE, READING_COLUMNS, READING_KEY
from gaugeline.session import configure, scratch_dir
from gaugeline.sinks import archive, export, search
from gaugeline.sinks.keyed import KeyedTable
from gaugeline.sinks.progress import counted
from gaugeline.sinks.progress_log import ProgressLog, progress
from gaugeline.sources import messages as topics
from gaugeline.sources import tables
from gaugeline.streaming import chain, fan_out, jobs
from gaugeline.streaming import observations as observed

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PUTS_PER_FILE = 1000
VALUE_BUCKETS = 8
PROCESSING_DAY = "2024-02-01"
HORIZON = 10 * 24 * 3600


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function, under its own name unless given, with its oracle."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        QUERIES[name or build.__name__] = run
        ORACLES[name or build.__name__] = sql
        return build

    return register


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.event_messages(source.read_events(spark, sf_dir))


def _land(events: DataFrame, landing: str) -> None:
    """Add events to a landing folder in even files, a core's share each.

    A stream reads a file in as few tasks as it has row groups, so a table of one large file would leave
    all parsing to one task.
    """
    even = events.repartition(events.sparkSession.sparkContext.defaultParallelism)
    even.write.mode("append").parquet(landing)


def _in_batches(spark: SparkSession, sf_dir: str, run: Callable[[DataFrame], StreamingQuery]) -> None:
    """Land the events in three parts, by time; after each, resume the stream until it is drained."""
    events, landing = source.read_events(spark, sf_dir), scratch_dir(spark, "landing")
    first, last = events.agg(F.min("event_id"), F.max("event_id")).first()
    third = ((last or 0) - (first or 0)) // 3 + 1
    for k in range(3):
        at = (first or 0) + k * third
        part = events.where((F.col("event_id") >= at) & (F.col("event_id") < at + third))
        _land(part, landing)
        run(source.event_messages(source.stream_events(spark, landing))).awaitTermination()


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings.parse_readings(_messages(spark, sf_dir))


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings.valid_readings(_parsed(spark, sf_dir))


def _first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_first(_valid(spark, sf_dir))


def _parsed_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.parse_alerts(alerts.alert_messages(_messages(spark, sf_dir)))


def _puts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All valid readings as a put log, keyed by message id so that most files hold live rows."""
    return _valid(spark, sf_dir).select(
        scalars.message_id().alias("key"),
        readings.flat_json().alias("value"),
        (F.col("status_timestamp") * 1000).alias("ts_ms"),
        F.expr(f"offset div {PUTS_PER_FILE}").alias("file_id"),
        "offset",
    )


def _stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last accepted reading of every station."""
    newest = last_per_key(latest.puts_from_readings(_first(spark, sf_dir)), ["key"])
    return newest.select("key", "value")


# -- messages ---------------------------------------------------------------------------


@query(MESSAGES + "SELECT key, value, arrival FROM msg")
def src_messages(spark, sf_dir):
    return _messages(spark, sf_dir).select("key", "value", F.col("offset").alias("arrival"))


@query(MESSAGES + f"SELECT CAST(station_id AS VARCHAR) AS key, {NESTED_JSON} AS value FROM m")
def msg_serialize(spark, sf_dir):
    return readings.to_messages(source.event_readings(source.read_events(spark, sf_dir)))


@query(MESSAGES + f"SELECT {READING} FROM valid")
def parse_flatten(spark, sf_dir):
    return _valid(spark, sf_dir).select(*READING_COLUMNS)


@query(
    MESSAGES
    + "SELECT damage NOT IN (0, 1, 4) AS valid, count(*) AS messages FROM m GROUP BY 1"
)
def valid_split(spark, sf_dir):
    return _parsed(spark, sf_dir).groupBy("valid").agg(F.count(F.lit(1)).alias("messages"))


@query(MESSAGES + "SELECT key, value, arrival FROM msg WHERE damage IN (0, 1, 4)")
def dlq_raw(spark, sf_dir):
    bad = readings.invalid_messages(_parsed(spark, sf_dir))
    return bad.select("key", "value", F.col("offset").alias("arrival"))


def _index_checks():
    """A store that takes wind up to 45 and no flat batteries in the cold."""
    return [
        (F.col("wind_speed") <= 45, "wind_speed above 45"),
        ((F.col("battery_status") != "low") | (F.col("temperature") >= 70), "cold and low"),
    ]


def _documents_with_outcome(spark, sf_dir):
    return documents.with_outcome(_first(spark, sf_dir), _index_checks())


_REJECTED = f"""
SELECT station_id || '-' || s_no AS key,
       '{{"error":"' || CASE WHEN wind_speed > 45 THEN 'wind_speed above 45' ELSE 'cold and low' END
       || '","record":' || {FLAT_JSON} || '}}' AS value
FROM first WHERE wind_speed > 45 OR (battery_status = 'low' AND temperature < 70)
"""


@query(MESSAGES + _REJECTED)
def dlq_envelope(spark, sf_dir):
    judged = _documents_with_outcome(spark, sf_dir)
    return documents.rejection_envelopes(judged, READING_COLUMNS, scalars.message_id())


@query(
    MESSAGES
    + f"SELECT key, value FROM msg WHERE damage IN (0, 1, 4) UNION ALL SELECT * FROM ({_REJECTED})"
)
def dlq_all(spark, sf_dir):
    """One parse: first copies are judged, and a message that cannot be read is an id of its own."""
    parsed = _parsed(spark, sf_dir)
    own = {f"_own_{c}": F.when(~F.col("valid"), F.col(c)) for c in ARRIVAL_ORDER}
    settled = first_per_key(parsed.withColumns(own), [*READING_KEY, *own])
    judged = documents.with_outcome(settled, _index_checks())
    envelope = F.to_json(F.struct("error", F.struct(*READING_COLUMNS).alias("record")))
    wanted = judged.where(~F.col("valid") | F.col("error").isNotNull())
    return wanted.select(
        F.when(F.col("valid"), scalars.message_id()).otherwise(F.col("key")).alias("key"),
        F.when(F.col("valid"), envelope).otherwise(F.col("value")).alias("value"),
    )


@query(
    MESSAGES
    + f"""SELECT CAST(station_id AS VARCHAR) AS key,
    '{{"error":"humidity above 95","record":' || {ALERT_JSON} || '}}' AS value
    FROM raised WHERE humidity > 95"""
)
def dlq_alert_envelope(spark, sf_dir):
    records = alerts.alert_records(_parsed_alerts(spark, sf_dir))
    judged = documents.with_outcome(records, [(F.col("humidity") <= 95, "humidity above 95")])
    return documents.rejection_envelopes(judged, ALERT_COLUMNS, F.col("station_id").cast("string"))


# -- alerts -----------------------------------------------------------------------------


@query(MESSAGES + "SELECT arrival, humidity FROM raised")
def alert_filter(spark, sf_dir):
    raised = alerts.rain_alerts(_messages(spark, sf_dir))
    return raised.select(F.col("offset").alias("arrival"), "humidity")


@query(MESSAGES + f"SELECT key, {ALERT_JSON} AS value, arrival FROM raised")
def alert_project(spark, sf_dir):
    raised = alerts.alert_messages(_messages(spark, sf_dir))
    return raised.select("key", "value", F.col("offset").alias("arrival"))


@query(
    MESSAGES
    + f"""SELECT key, {ALERT_JSON} AS value, arrival FROM raised
    QUALIFY row_number() OVER (PARTITION BY station_id, s_no ORDER BY arrival) = 1"""
)
def alert_once(spark, sf_dir):
    raised = alerts.alert_messages_once(_messages(spark, sf_dir))
    return raised.select("key", "value", F.col("offset").alias("arrival"))


_ALERT = "'CRITICAL_RAIN_ALERT' AS event, station_id, s_no, humidity, 'RAIN_DETECTED' AS status"


@query(MESSAGES + f"SELECT {_ALERT} FROM raised")
def alert_parse(spark, sf_dir):
    return alerts.alert_records(_parsed_alerts(spark, sf_dir)).select(*ALERT_COLUMNS)


@query(MESSAGES + f"SELECT {_ALERT}, DATE '{PROCESSING_DAY}' AS date FROM raised")
def alert_archive(spark, sf_dir):
    path = scratch_dir(spark, "alerts")
    records = alerts.alert_records(_parsed_alerts(spark, sf_dir))
    day = F.lit(PROCESSING_DAY).cast("date")
    archive.write_archive(archive.dated_alerts(records, day), path)
    return tables.read_alert_archive(spark, path)


@query(
    MESSAGES
    + f"""SELECT station_id, DATE '{PROCESSING_DAY}' AS date, count(*) AS alerts
    FROM raised GROUP BY station_id"""
)
def alert_groups(spark, sf_dir):
    records = alerts.alert_records(_parsed_alerts(spark, sf_dir))
    dated = archive.dated_alerts(records, F.lit(PROCESSING_DAY).cast("date"))
    return dated.groupBy(*archive.LAYOUT).agg(F.count(F.lit(1)).alias("alerts"))


@query(
    MESSAGES
    + f""", seen AS (
      SELECT arrival, damage, station_id, s_no,
             CASE WHEN damage = 4 THEN 0 ELSE humidity END AS humidity FROM m)
    SELECT arrival, CASE WHEN damage = 0 THEN '{{"event":"UNKNOWN_ALERT_ERROR"}}'
                         ELSE {ALERT_JSON} END AS value FROM seen"""
)
def alert_payload(spark, sf_dir):
    """The alert text of every message, whether or not it is above the threshold."""
    read = alerts.read_humidity(_messages(spark, sf_dir))
    return read.select(F.col("offset").alias("arrival"), alerts.alert_json().alias("value"))


_INDEXED_ALERTS = f"""SELECT station_id || '-' || s_no AS doc_id, {_ALERT} FROM raised
QUALIFY row_number() OVER (PARTITION BY station_id, s_no ORDER BY arrival DESC) = 1"""


@query(MESSAGES + _INDEXED_ALERTS)
def alert_index(spark, sf_dir):
    records = alerts.alert_records(_parsed_alerts(spark, sf_dir))
    return documents.latest_documents(records).select("doc_id", *ALERT_COLUMNS)


# -- scalar projections -----------------------------------------------------------------


@query(MESSAGES + "SELECT arrival, station_id || '-' || s_no AS message_id FROM valid")
def msg_id(spark, sf_dir):
    return _valid(spark, sf_dir).select(
        F.col("offset").alias("arrival"), scalars.message_id().alias("message_id")
    )


@query(
    MESSAGES
    + """SELECT arrival,
    CAST(to_timestamp(status_timestamp) AT TIME ZONE 'UTC' AS DATE) AS date FROM valid"""
)
def event_date(spark, sf_dir):
    return _valid(spark, sf_dir).select(
        F.col("offset").alias("arrival"), scalars.event_date().alias("date")
    )


@query(
    MESSAGES
    + """SELECT arrival, 'archivedData/station_id=' || station_id || '/date='
    || strftime(to_timestamp(status_timestamp) AT TIME ZONE 'UTC', '%Y-%m-%d') AS path FROM valid"""
)
def partition_path(spark, sf_dir):
    path = scalars.partition_path("archivedData")
    return _valid(spark, sf_dir).select(F.col("offset").alias("arrival"), path.alias("path"))


@query(
    """SELECT event_id,
    CAST(floor((value - 250) * 9.0 / 5.0 + 32 + 0.5) AS INTEGER) AS fahrenheit FROM events"""
)
def c_to_f(spark, sf_dir):
    return source.read_events(spark, sf_dir).select(
        "event_id", scalars.celsius_to_fahrenheit(F.col("value") - 250).alias("fahrenheit")
    )


@query("SELECT page_id, replace(trim(url, '/'), '&', ' ') AS key FROM pages")
def key_decode(spark, sf_dir):
    # Page addresses as request paths: slashes escaped once, equals signs twice, & as +.
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    escaped = F.replace(F.col("url"), F.lit("/"), F.lit("%2F"))
    escaped = F.replace(escaped, F.lit("="), F.lit("%253D"))
    escaped = F.replace(escaped, F.lit("&"), F.lit("+"))
    raw = F.concat(F.lit("/"), escaped, F.lit("//"))
    return pages.select("page_id", scalars.decode_key(raw).alias("key"))


@query("SELECT doc_id, CAST(to_json(text) AS VARCHAR) AS json FROM documents")
def json_escape(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return texts.select("doc_id", scalars.json_string(F.col("text")).alias("json"))


# -- archive ----------------------------------------------------------------------------

_DATED = f"""SELECT {READING},
  CAST(to_timestamp(status_timestamp) AT TIME ZONE 'UTC' AS DATE) AS date FROM first"""


def _archived(spark, sf_dir):
    path = scratch_dir(spark, "archive")
    archive.write_archive(archive.dated_readings(_first(spark, sf_dir)), path)
    return tables.read_archive(spark, path)


@query(MESSAGES + _DATED)
def archive_weather(spark, sf_dir):
    return _archived(spark, sf_dir)


@query(
    MESSAGES
    + f"""SELECT station_id, date, count(*) AS readings, max(humidity) AS max_humidity
    FROM ({_DATED}) WHERE date >= DATE '2024-01-03' AND battery_status <> 'low' GROUP BY 1, 2"""
)
def archive_scan(spark, sf_dir):
    late = _archived(spark, sf_dir).where(
        (F.col("date") >= F.lit("2024-01-03").cast("date")) & (F.col("battery_status") != "low")
    )
    return late.groupBy("station_id", "date").agg(
        F.count(F.lit(1)).alias("readings"), F.max("humidity").alias("max_humidity")
    )


@query(MESSAGES + f"SELECT station_id, date, count(*) AS readings FROM ({_DATED}) GROUP BY 1, 2")
def archive_groups(spark, sf_dir):
    dated = archive.dated_readings(_first(spark, sf_dir))
    return dated.groupBy(*archive.LAYOUT).agg(F.count(F.lit(1)).alias("readings"))


# -- repeats and numbering --------------------------------------------------------------


@query(MESSAGES + f"SELECT arrival, {READING} FROM first", name="dedup_first")
def first_arrivals(spark, sf_dir):
    return _first(spark, sf_dir).select(F.col("offset").alias("arrival"), *READING_COLUMNS)


def _kept(horizon: int) -> str:
    """MESSAGES with ``kept``: arrivals with no kept one of their id within the horizon before."""
    return (
        MESSAGES.replace("WITH", "WITH RECURSIVE", 1)
        + f""", times AS (
      SELECT station_id, s_no, min(status_timestamp) AS t FROM valid GROUP BY 1, 2
      UNION ALL
      SELECT k.station_id, k.s_no, min(v.status_timestamp) FROM times k JOIN valid v
        ON v.station_id = k.station_id AND v.s_no = k.s_no AND v.status_timestamp >= k.t + {horizon}
      GROUP BY k.station_id, k.s_no, k.t
    ), kept AS (
      SELECT v.* FROM valid v JOIN times k
        ON v.station_id = k.station_id AND v.s_no = k.s_no AND v.status_timestamp = k.t
      QUALIFY row_number() OVER (PARTITION BY v.station_id, v.s_no, k.t ORDER BY arrival) = 1)
    """
    )


@query(_kept(HORIZON) + f"SELECT arrival, {READING} FROM kept", name="dedup_within")
def spaced_arrivals(spark, sf_dir):
    kept = dedup_within(_valid(spark, sf_dir), HORIZON)
    return kept.select(F.col("offset").alias("arrival"), *READING_COLUMNS)


# Ids a lane remembers, and lanes.
MEMORY, MEMORY_LANES = 40, 16

_REMEMBERED = (
    MESSAGES.replace("WITH", "WITH RECURSIVE", 1)
    + f""", dealt AS (
      SELECT arrival, station_id || '-' || s_no AS id,
             CAST('0x' || left(md5(s_no || '-' || station_id), 8) AS BIGINT) % {MEMORY_LANES} AS lane,
             station_id % 4 AS topic_partition
      FROM valid
    ), lined AS (
      SELECT *, row_number() OVER (PARTITION BY lane ORDER BY topic_partition, arrival) AS turn FROM dealt
    ), steps AS (
      SELECT lane, turn, arrival, true AS accepted, [id] AS memory FROM lined WHERE turn = 1
      UNION ALL
      SELECT l.lane, l.turn, l.arrival, NOT list_contains(s.memory, l.id),
             CASE WHEN list_contains(s.memory, l.id) THEN s.memory
                  ELSE list_slice(list_append(s.memory, l.id), -{MEMORY}, -1) END
      FROM steps s JOIN lined l ON l.lane = s.lane AND l.turn = s.turn + 1
    )
    SELECT arrival, {READING} FROM steps JOIN valid USING (arrival) WHERE accepted"""
)


@query(_REMEMBERED, name="dedup_last_n")
def unremembered(spark, sf_dir):
    kept = dedup_last_n(_valid(spark, sf_dir), MEMORY, MEMORY_LANES)
    return kept.select(F.col("offset").alias("arrival"), *READING_COLUMNS)


@query(
    """SELECT event_id AS arrival, user_id % 11 AS station_id,
    row_number() OVER (PARTITION BY user_id % 11 ORDER BY event_id) AS seq FROM events"""
)
def seq_number(spark, sf_dir):
    sent = source.event_readings(source.read_events(spark, sf_dir)).drop("s_no")
    numbered = sequence_numbers(sent, name="seq")
    return numbered.select(F.col("offset").alias("arrival"), "station_id", "seq")


@query(
    MESSAGES
    + """, steps AS (
      SELECT station_id, s_no, arrival, lag(s_no) OVER (PARTITION BY station_id ORDER BY arrival) AS before FROM valid
    ), runs AS (
      SELECT *, 1 + count(*) FILTER (s_no < before) OVER (PARTITION BY station_id ORDER BY arrival) AS run FROM steps)
    SELECT station_id, run, before + 1 AS first, s_no - 1 AS last, s_no - before - 1 AS missing
    FROM runs WHERE s_no > before + 1"""
)
def seq_gaps(spark, sf_dir):
    """Numbers of each station that never came, by run between restarts."""
    return sequence_gaps(_valid(spark, sf_dir))


_OBSERVED = f"""
WITH o AS (
  SELECT *, row_number() OVER (ORDER BY event_id) AS s_no,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
r AS (
  SELECT CAST(0 AS BIGINT) AS station_id, s_no, 'high' AS battery_status,
         CAST(floor(epoch(ts)) AS BIGINT) AS status_timestamp, k AS humidity,
         CAST(floor((value - 250) * 9.0 / 5.0 + 32 + 0.5) AS INTEGER) AS temperature,
         CAST(floor(value / 8 + 0.5) AS INTEGER) AS wind_speed
  FROM o WHERE event_type <> 'error')
"""


def _landed_observations(spark, sf_dir):
    # Error events stand for fetches that brought no observation.
    payload = F.struct(
        (F.col("value") - 250).alias("temperature_2m"),
        F.get_json_object("props", "$.k").cast("int").alias("relative_humidity_2m"),
        (F.col("value") / 8).alias("wind_speed_10m"),
    )
    landing = scratch_dir(spark, "observations")
    source.read_events(spark, sf_dir).select(
        F.when(F.col("event_type") != "error", payload).alias("current"),
        F.col("event_id").alias("ingest_seq"),
        F.col("ts").cast("timestamp").alias("ingest_ts"),
    ).write.json(landing)
    return landing


@query(_OBSERVED + f"SELECT {READING} FROM r")
def obs_normalize(spark, sf_dir):
    landed = tables.read_observations(spark, _landed_observations(spark, sf_dir))
    return observations.normalize_observations(landed)


# -- latest value per key ---------------------------------------------------------------


@query(MESSAGES + "SELECT key, value FROM stations")
def kv_latest(spark, sf_dir):
    return _stations(spark, sf_dir)


@query(MESSAGES + "SELECT key, value FROM newest")
def kv_snapshot(spark, sf_dir):
    return latest.snapshot(_puts(spark, sf_dir))


@query(MESSAGES + "SELECT count(*) AS keys FROM newest")
def kv_count(spark, sf_dir):
    return latest.snapshot(_puts(spark, sf_dir)).agg(F.count(F.lit(1)).alias("keys"))


def _stored_puts(spark, sf_dir):
    """The put log as a stored table by key, which the readers of single keys open."""
    stored = KeyedTable(spark, scratch_dir(spark, "values"), KEY_VALUE, "key", VALUE_BUCKETS)
    stored.upsert(_puts(spark, sf_dir), latest.POSITION, "log", 0)
    return stored


@query(MESSAGES + "SELECT key, value FROM newest WHERE key = '7-77'")
def kv_get(spark, sf_dir):
    return _stored_puts(spark, sf_dir).get("7-77")


@query(MESSAGES + "SELECT key, value FROM newest WHERE key = '7-77'")
def kv_get_from_log(spark, sf_dir):
    return latest.get(_puts(spark, sf_dir), "7-77")


@query(
    MESSAGES
    + """SELECT r.key, newest.value FROM
    (SELECT (c_custkey % 11) || '-' || c_custkey AS key FROM customer) r
    LEFT JOIN newest ON r.key = newest.key"""
)
def kv_get_many(spark, sf_dir):
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    number = F.col("c_custkey")
    key = F.concat_ws("-", (number % 11).cast("string"), number.cast("string"))
    return _stored_puts(spark, sf_dir).get_many(customers.select(key.alias("key")))


_POSITIONED = "key, value, ts_ms, file_id, offset_ AS arrival"


def _positioned(log: DataFrame) -> DataFrame:
    return log.withColumnRenamed("offset", "arrival")


@query(MESSAGES + f"SELECT {_POSITIONED} FROM newest")
def kv_replay(spark, sf_dir):
    return _positioned(latest.replay(_puts(spark, sf_dir)))


@query("SELECT CAST(doc_id AS VARCHAR) AS key, text AS value FROM documents")
def kv_csv(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet")
    key, value = F.col("doc_id").cast("string"), F.col("text")
    export.export_csv(texts.select(key.alias("key"), value.alias("value")), path)
    return tables.read_snapshot_csv(spark, path)


@query(
    MESSAGES
    + """SELECT 0 AS object_id, '{' || string_agg('"' || key || '":"' || replace(value, '"', '\\"')
    || '"', ',' ORDER BY key) || '}' AS json FROM stations"""
)
def kv_json(spark, sf_dir):
    return export.snapshot_json(_stations(spark, sf_dir))


@query("SELECT 0 AS object_id, '{}' AS json")
def kv_json_empty(spark, sf_dir):
    return export.snapshot_json(_stations(spark, sf_dir).where(F.col("key") == "no station"))


@query(
    """SELECT event_id, 'k' AS key, '[' || event_id || ']' AS value FROM events UNION ALL
    SELECT event_id, 'n', CASE WHEN event_id % 2 = 0 THEN NULL ELSE event_type END FROM events
    UNION ALL SELECT event_id, 'o', replace(props, ' ', '') FROM events"""
)
def kv_json_repeated(spark, sf_dir):
    """Objects with a repeated key, whose last value counts, a nested one and a null."""
    text = F.expr(
        """concat('{"k":"first","n":', IF(event_id % 2 = 0, 'null', concat('"', event_type, '"')),
                  ',"o":', props, ',"k":[', event_id, ']}')"""
    )
    objects = source.read_events(spark, sf_dir).select("event_id", text.alias("json"))
    return export.json_entries(objects, "json")


@query("SELECT event_id, 'k' AS key, json_extract_string(props, '$.k') AS value FROM events")
def kv_json_explode(spark, sf_dir):
    objects = source.read_events(spark, sf_dir).select("event_id", "props")
    return export.json_entries(objects, "props")


# -- documents by id --------------------------------------------------------------------


@query(
    MESSAGES
    + f"""SELECT station_id || '-' || s_no AS doc_id, {READING} FROM valid
    QUALIFY row_number() OVER (PARTITION BY station_id, s_no ORDER BY arrival DESC) = 1"""
)
def index_upsert(spark, sf_dir):
    """Older half indexed first, newer half upserted over it: the same as the last per id."""
    newer = F.col("timestamp") >= F.lit("2024-01-16").cast("timestamp")
    found = documents.replaced_by(_valid(spark, sf_dir), newer)
    return found.select("doc_id", *READING_COLUMNS)


@query(MESSAGES + f"SELECT station_id || '-' || s_no AS doc_id, {READING} FROM first")
def index_typed(spark, sf_dir):
    """A typed index declared twice, filled, and read by its name."""
    path = scratch_dir(spark, "index")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    for _ in range(2):
        search.create_index(spark, table, path)
    indexed = documents.latest_documents(_first(spark, sf_dir))
    indexed.select("doc_id", *READING_COLUMNS).write.insertInto(table)
    return spark.table(table)


# -- streams ----------------------------------------------------------------------------


@query(MESSAGES + f"SELECT key, {ALERT_JSON} AS value, arrival FROM raised")
def stream_alerts(spark, sf_dir):
    path, checkpoint = scratch_dir(spark, "alerts"), scratch_dir(spark, "checkpoint")
    _in_batches(spark, sf_dir, lambda topic: jobs.alert_stream(topic, path, checkpoint))
    landed = topics.landed_table(spark, path)
    return landed.select("key", "value", F.col("offset").alias("arrival"))


def _alert_fan_out(spark, sf_dir, sink):
    root, checkpoint = scratch_dir(spark, "alert-fan-out"), scratch_dir(spark, "checkpoint")

    def run(topic):
        raised = alerts.alert_messages(topic)
        return fan_out.start_alert_fan_out(raised, root, checkpoint, [sink])

    _in_batches(spark, sf_dir, run)
    return root


@query(MESSAGES + f"SELECT {_ALERT} FROM raised")
def stream_alert_archive(spark, sf_dir):
    return fan_out.archived_alerts(spark, _alert_fan_out(spark, sf_dir, fan_out.ARCHIVE)).drop("date")


@query(MESSAGES + _INDEXED_ALERTS)
def stream_alert_index(spark, sf_dir):
    return fan_out.indexed_alerts(spark, _alert_fan_out(spark, sf_dir, fan_out.DOCUMENTS))


@query(_OBSERVED + f"SELECT CAST(station_id AS VARCHAR) AS key, {NESTED_JSON} AS value FROM r")
def stream_observations(spark, sf_dir):
    root, checkpoint = scratch_dir(spark, "observed"), scratch_dir(spark, "checkpoint")
    payloads = tables.observation_stream(spark, _landed_observations(spark, sf_dir))
    observed.start_observations(payloads, root, checkpoint).awaitTermination()
    return observed.observation_messages(spark, root)


def _fan_out(spark, sf_dir, *sinks, checks=(), horizon=fan_out.HORIZON_SECONDS):
    root, checkpoint = scratch_dir(spark, "fan-out"), scratch_dir(spark, "checkpoint")

    def run(topic):
        return fan_out.start_fan_out(topic, root, checkpoint, sinks, horizon, checks)

    _in_batches(spark, sf_dir, run)
    return root


_STREAMED = _kept(fan_out.HORIZON_SECONDS)
_DATED_KEPT = _DATED.replace("FROM first", "FROM kept")


@query(_kept(HORIZON) + _DATED_KEPT)
def stream_dedup(spark, sf_dir):
    """A horizon that ends within the table: ids are suppressed, and pass again."""
    return fan_out.archived(spark, _fan_out(spark, sf_dir, fan_out.ARCHIVE, horizon=HORIZON))


@query(_STREAMED + _DATED_KEPT)
def stream_archive(spark, sf_dir):
    return fan_out.archived(spark, _fan_out(spark, sf_dir, fan_out.ARCHIVE))


_NEWEST = f"""SELECT CAST(station_id AS VARCHAR) AS key, {FLAT_JSON} AS value FROM kept
QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY arrival DESC) = 1"""


@query(_STREAMED + _NEWEST)
def stream_latest_state(spark, sf_dir):
    """By an intake and a query of its own, whose state says which keys a batch changed."""
    root, checkpoint, own = (scratch_dir(spark, p) for p in ("chain", "checkpoint", "checkpoint"))
    _in_batches(spark, sf_dir, lambda topic: chain.start_intake(topic, root, checkpoint))
    chain.start_latest_state(spark, root, own).awaitTermination()
    return chain.latest_state_table(spark, root).rows()


@query(
    MESSAGES
    + """, third AS (SELECT min(event_id) AS low, (max(event_id) - min(event_id)) // 3 + 1 AS size FROM events)
    SELECT 'valid' AS sink, (arrival - low) // size AS batch_id, count(*) AS rows FROM valid, third GROUP BY ALL"""
)
def stream_progress(spark, sf_dir):
    """What a listener noted of every micro-batch."""
    path, checkpoint = scratch_dir(spark, "progress"), scratch_dir(spark, "checkpoint")
    log = ProgressLog(spark, path)

    def run(topic):
        seen = counted(readings.valid_readings(readings.parse_readings(topic)), "valid")
        running = jobs.start(seen.writeStream.format("noop"), checkpoint)
        running.awaitTermination()
        log.wait_for(running)
        return running

    try:
        _in_batches(spark, sf_dir, run)
    finally:
        log.close()
    return progress(spark, path).select("sink", "batch_id", "rows")


@query(_STREAMED + _NEWEST)
def stream_latest(spark, sf_dir):
    return fan_out.latest_values(spark, _fan_out(spark, sf_dir, fan_out.LATEST))


_INDEXED = f"""SELECT station_id || '-' || s_no AS doc_id, {READING} FROM kept
QUALIFY row_number() OVER (PARTITION BY station_id, s_no ORDER BY arrival DESC) = 1"""


@query(_STREAMED + _INDEXED)
def stream_index(spark, sf_dir):
    return fan_out.indexed_documents(spark, _fan_out(spark, sf_dir, fan_out.DOCUMENTS))


@query(_STREAMED + _INDEXED)
def stream_index_buckets(spark, sf_dir):
    """Every document by its own id, out of the bucket it lies in."""
    root = _fan_out(spark, sf_dir, fan_out.DOCUMENTS)
    found = fan_out.indexed_documents(spark, root).select("doc_id")
    return fan_out.document_table(spark, root).get_many(found)


@query(
    MESSAGES
    + f"""SELECT {READING}, 1 AS run FROM first WHERE arrival % 2 = 0
    UNION ALL SELECT {READING}, 2 FROM (SELECT * FROM valid WHERE arrival % 2 = 1
      QUALIFY row_number() OVER (PARTITION BY station_id, s_no ORDER BY arrival) = 1)""".replace(
        "FROM first WHERE arrival % 2 = 0",
        """FROM (SELECT * FROM valid WHERE arrival % 2 = 0
      QUALIFY row_number() OVER (PARTITION BY station_id, s_no ORDER BY arrival) = 1)""",
    )
)
def stream_archive_rerun(spark, sf_dir):
    """Two checkpoints on one root: even messages under the first, odd ones under the second."""
    root, events = scratch_dir(spark, "rerun"), source.read_events(spark, sf_dir)
    seen = None
    for run in (1, 2):
        landing = scratch_dir(spark, "landing")
        _land(events.where(F.col("event_id") % 2 == run - 1), landing)
        topic = source.event_messages(source.stream_events(spark, landing))
        sinks, forever = [fan_out.ARCHIVE], 10 * 365 * 24 * 3600
        fan_out.start_fan_out(topic, root, scratch_dir(spark, "checkpoint"), sinks, forever).awaitTermination()
        stored = fan_out.archived(spark, root).drop("date")
        added = stored if seen is None else stored.exceptAll(seen.drop("run"))
        numbered = added.withColumn("run", F.lit(run))
        seen = numbered if seen is None else seen.unionByName(numbered)
    return seen


# A batch indexes the last reading of an id, of which all that were kept have been judged.
@query(
    _STREAMED
    + "SELECT key, value FROM msg WHERE damage IN (0, 1, 4) UNION ALL SELECT * FROM ("
    + _REJECTED.replace("FROM first", "FROM kept")
    + ")"
)
def stream_dead_letters(spark, sf_dir):
    root = _fan_out(spark, sf_dir, fan_out.DEAD_LETTERS, fan_out.DOCUMENTS, checks=_index_checks())
    return fan_out.dead_letters(spark, root).select("key", "value")


# -- values that depend on the clock, as checks of it -------------------------------------


@query("SELECT true AS today, true AS seconds, true AS millis, count(*) AS events FROM events")
def clock(spark, sf_dir):
    """The processing date and the time in seconds and milliseconds agree with one another."""
    events = source.read_events(spark, sf_dir).select(
        F.current_date().alias("day"),
        scalars.epoch_seconds_now().alias("seconds"),
        scalars.epoch_millis_now().alias("millis"),
    )
    day = F.to_date(F.timestamp_seconds("seconds"))
    return events.agg(
        F.every(F.col("day") == day).alias("today"),
        F.every(F.col("seconds") > 1_700_000_000).alias("seconds"),
        F.every(F.floor(F.col("millis") / 1000) == F.col("seconds")).alias("millis"),
        F.count("*").alias("events"),
    )


@query(MESSAGES + f"SELECT {_ALERT}, true AS dated FROM raised")
def alert_processing_date(spark, sf_dir):
    """Alerts archived under the day they are processed on."""
    path = scratch_dir(spark, "alerts-today")
    archive.write_archive(archive.dated_alerts(alerts.alert_records(_parsed_alerts(spark, sf_dir))), path)
    near = F.abs(F.datediff(F.current_date(), "date")) <= 1
    return tables.read_alert_archive(spark, path).withColumn("dated", near).drop("date")


@query(MESSAGES + "SELECT count(*) AS indexed FROM valid")
def progress_count(spark, sf_dir):
    """The rows counted on their way to a sink."""
    seen = Observation("indexed")
    counted(_valid(spark, sf_dir), seen).write.format("noop").mode("overwrite").save()
    return spark.range(1).select(F.lit(seen.get["rows"]).cast("bigint").alias("indexed"))
