"""Message topics: JSON keys and values, on Kafka or in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from paystrata.model import TRANSACTION
from paystrata.sources.files import Folder

ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
_MESSAGE = StructType().add("key", "string").add("value", "string")


def kafka_topic(spark: SparkSession, servers: str, topic: str, group: str, **options: str) -> DataFrame:
    """A live topic from its latest offset, as ``key`` and ``value`` text (needs the Kafka connector package).

    ``maxOffsetsPerTrigger`` among the options bounds a micro-batch after a backlog.
    """
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
            .option("kafka.group.id", group).option("startingOffsets", "latest").options(**options).load()
            .select(F.col("key").cast("string"), F.col("value").cast("string")))


def folder_topic(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A live topic kept as message files below one folder."""
    return (spark.readStream.schema(_MESSAGE).options(recursiveFileLookup="true", **options).parquet(path))


def to_messages(df: DataFrame, key_columns: list[str], decimals_as_text: bool = False) -> DataFrame:
    """JSON messages: the key holds ``key_columns``, the value all columns, times are ISO-8601 in UTC."""
    options = {"timestampFormat": ISO_UTC, "ignoreNullFields": "false"}
    values = [F.col(field.name).cast("string").alias(field.name)
              if decimals_as_text and isinstance(field.dataType, DecimalType) else F.col(field.name)
              for field in df.schema]
    return df.select(F.to_json(F.struct(*key_columns), options).alias("key"),
                     F.to_json(F.struct(*values), options).alias("value"))


def parse_messages(messages: DataFrame, schema: StructType = TRANSACTION) -> DataFrame:
    """Values as typed columns. Text that is not JSON becomes a row of NULLs, which the cleaning step drops.

    The parsed struct is unfolded by ``inline``, not by field access: filters on its fields then stay above the
    parse, where each would otherwise be pushed below it with a parse of its own.
    """
    return messages.select(F.inline(F.array(F.from_json("value", schema, {"mode": "PERMISSIVE"}))))


def write_folder(messages: DataFrame, path: str, batch_id: int) -> None:
    """Add a batch to a folder topic. A batch that is there in full is left alone: a replay sends nothing twice."""
    if not Folder(messages.sparkSession, path).exists(f"batch_id={batch_id}/_SUCCESS"):
        messages.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
