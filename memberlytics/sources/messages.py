"""Analysis request messages: key and JSON value, for Kafka or a file sink."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The default topic and the delivery settings of the producer.
REQUEST_TOPIC = "analysis.request.v1"
KAFKA_DELIVERY = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.retries": "10",
    "kafka.delivery.timeout.ms": "120000",
}


def to_request_messages(targets: DataFrame) -> DataFrame:
    """(request_id, case_id, analyzer_version) -> (key, value); the key keeps one request on one partition."""
    body = F.struct(
        F.col("request_id").alias("dispatchRequestId"),
        F.col("case_id").alias("caseId"),
        F.col("analyzer_version").alias("analyzerVersion"),
    )
    return targets.select(F.col("request_id").alias("key"), F.to_json(body).alias("value"))


def write_messages(messages: DataFrame, sink: str, **options: str) -> None:
    """Append messages to a JSON folder, or to Kafka when `sink` is "kafka" (needs its connector jar)."""
    if sink == "kafka":
        settings = {"topic": REQUEST_TOPIC, **KAFKA_DELIVERY, **options}
        messages.write.format("kafka").options(**settings).save()
    else:
        messages.write.mode("append").options(**options).json(sink)


def read_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of a JSON folder, or of all runs below one that `deliver_to_folder` has written."""
    return spark.read.schema("key string, value string").json(folder).select("key", "value")


def deliver_to_folder(folder: str) -> Callable[[DataFrame], DataFrame]:
    """A delivery to JSON files: every call writes a folder `run=<id>` of its own below `folder` and
    reports as sent what it finds there afterwards, so the copies of a repeated run can be told apart."""

    def deliver(sent: DataFrame) -> DataFrame:
        run = f"{folder}/run={uuid.uuid4().hex}"
        write_messages(sent, run)
        stored = read_messages(sent.sparkSession, run)
        return stored.select(F.col("key").alias("request_id"), F.lit(True).alias("ok"), F.lit(None).cast("string").alias("error"))

    return deliver
