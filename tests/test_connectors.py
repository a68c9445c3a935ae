"""Connectors are not in this environment: calls must get as far as asking for them."""

import pytest
from pyspark.sql import DataFrame

from gaugeline.schemas import KEY_VALUE
from gaugeline.sinks.export import publish_table
from gaugeline.sinks.search import READINGS_INDEX, publish_documents
from gaugeline.sources.messages import READINGS_TOPIC, kafka_stream, kafka_table
from gaugeline.streaming.jobs import publish_stream

ASKED = "(?i)failed to find( the)? data source|kafka"


def test_topic_readers(spark):
    with pytest.raises(Exception, match=ASKED):
        kafka_table(spark, "broker:9092", READINGS_TOPIC)
    with pytest.raises(Exception, match=ASKED):
        kafka_stream(spark, "broker:9092", READINGS_TOPIC, max_records=2000)


def test_topic_writers(spark, at):
    rows: DataFrame = spark.createDataFrame([("1", "{}")], KEY_VALUE)
    with pytest.raises(Exception, match=ASKED):
        publish_table(rows, "broker:9092", READINGS_TOPIC)
    rows.write.parquet(at("rows"))
    stream = spark.readStream.schema(KEY_VALUE).parquet(at("rows"))
    with pytest.raises(Exception, match=ASKED):
        publish_stream(stream, "broker:9092", READINGS_TOPIC, at("checkpoint"))


def test_search_writer(spark):
    documents = spark.createDataFrame([("1-1", "x")], "doc_id string, battery_status string")
    with pytest.raises(Exception, match=ASKED):
        publish_documents(documents, READINGS_INDEX, "search:9200")
