"""The row-local operators on streams of JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import classify as C
from ..operators.messages import first_of
from ..operators.preference import preference_pairs
from ..sources.jsonl import kept


def chat_stream(spark: SparkSession, path: str, files_at_once: int = 16) -> DataFrame:
    """Chats of JSON lines files as they come; ``conv_id`` is the digest of the line."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_at_once).text(path)
    return kept(lines, "chat").select(F.md5("value").alias("conv_id"), "messages")


def labelled(chats: DataFrame) -> DataFrame:
    """conv_id, prompt, response, persona, layer: the same columns for a stream and for a table."""
    pairs = chats.select("conv_id", first_of(F.col("messages"), "user").alias("prompt"), first_of(F.col("messages"), "assistant").alias("response")).where("prompt <> '' AND response <> ''")
    return pairs.withColumns({"persona": C.persona(F.col("prompt")), "layer": C.layer(F.col("response"), F.col("conv_id"))})


def preference_stream(chats: DataFrame) -> DataFrame:
    return preference_pairs(labelled(chats).select("conv_id", "prompt", "response"))


def unique_within(events: DataFrame, keys: list[str], time: str, delay: str = "1 hour") -> DataFrame:
    """The first row seen of each key within the delay; state older than that is let go."""
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)
