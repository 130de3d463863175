"""Records as keyed JSON messages, and the message stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake.operators.numbering import number_records
from wardlake.schema import MESSAGE_SCHEMA, RAW_SCHEMA

# Delivery settings of the message writer.
KAFKA_WRITE_OPTIONS = {"kafka.acks": "all", "kafka.retries": "3"}
CORRUPT = "_corrupt_record"


def to_messages(df: DataFrame, order: str = "record_id") -> DataFrame:
    """Key record_{n}, counted from zero in the order of `order`; value a JSON object with nulls."""
    # numbered before encoding: the text is larger than the columns that would be shuffled
    return number_records(df, order, "_number").select(
        F.concat(F.lit("record_"), F.col("_number").cast("string")).alias("key"),
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"),
    )


def write_messages(messages: DataFrame, topic: str, fmt: str = "kafka", **options: str) -> None:
    """Send messages to a Kafka topic, or append them to a message table (`fmt="parquet"`)."""
    if fmt == "kafka":
        writer = messages.write.format("kafka").options(**KAFKA_WRITE_OPTIONS)
        writer.options(**options).option("topic", topic).save()
    else:
        messages.write.mode("append").format(fmt).options(**options).save()


def read_stream(spark: SparkSession, fmt: str = "kafka", **options: str) -> DataFrame:
    """Message stream with the columns of MESSAGE_SCHEMA.

    Kafka needs `subscribe` and `kafka.bootstrap.servers`, and the connector on the class path.
    Any file format streams a message table of the same columns from `path`.
    """
    if fmt == "kafka":
        source = spark.readStream.format("kafka").option("startingOffsets", "earliest")
        return source.options(**options).load().select(
            F.col("key").cast("string"),
            F.col("value").cast("string"),
            "topic",
            "partition",
            "offset",
            "timestamp",
        )
    return spark.readStream.schema(MESSAGE_SCHEMA).format(fmt).options(**options).load()


def parse_messages(messages: DataFrame, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Decode JSON values next to the broker columns; undecodable text is kept in _corrupt_record."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return messages.select(
        F.from_json("value", with_corrupt, options).alias("record"),
        F.unix_millis(F.col("timestamp").cast("timestamp")).alias("kafka_timestamp"),
        F.col("offset").alias("kafka_offset"),
        F.col("partition").alias("kafka_partition"),
        F.current_timestamp().alias("consumer_timestamp"),
    ).select("record.*", "kafka_timestamp", "kafka_offset", "kafka_partition", "consumer_timestamp")


def split_corrupt(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good records and quarantined ones."""
    bad = F.col(CORRUPT).isNotNull()
    return parsed.filter(~bad).drop(CORRUPT), parsed.filter(bad)
