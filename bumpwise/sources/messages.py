"""Trip messages: files of envelopes, or any streaming source of payloads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bumpwise.operators.ingest import decode_payload
from bumpwise.schema import ENVELOPE


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines `{"seq": .., "data": "<base64>"}` to `seq` and the JSON text `value`."""
    return decode_payload(spark.read.schema(ENVELOPE).json(path))


def message_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """`read_messages` as a stream of the files that arrive in a folder."""
    reader = spark.readStream.schema(ENVELOPE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return decode_payload(reader.json(path))


def payload_stream(
    spark: SparkSession,
    source: str,
    options: Mapping[str, str],
    payload: str = "value",
    order: str = "offset",
) -> DataFrame:
    """A stream of UTF-8 payloads from a connector (`kafka` by default columns).

    `order` ranks the deliveries of one trip; with Kafka, key messages by trip so that a trip
    stays in one partition and its offsets rise.
    """
    stream = spark.readStream.format(source).options(**options).load()
    return stream.select(
        F.col(order).cast("bigint").alias("seq"),
        F.try_validate_utf8(F.col(payload).cast("string")).alias("value"),
    )
