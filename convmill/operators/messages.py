"""Taking messages out of chats and putting them back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_of(messages: Column, role: str) -> Column:
    """Content of the first message of a role; empty if there is none."""
    return F.coalesce(F.get(F.filter(messages, lambda m: m["role"] == role), F.lit(0))["content"], F.lit(""))


def last_index(messages: Column, role: str) -> Column:
    """Position from 0 of the last message of a role; null if there is none."""
    return F.array_max(F.filter(F.transform(messages, lambda m, i: F.when(m["role"] == role, i)), lambda i: i.isNotNull()))


def replace_last(messages: Column, role: str, content: Column) -> Column:
    """Messages with the last one of a role given other content; unchanged where there is none."""
    last = last_index(messages, role)
    put = lambda m, i: F.struct(m["role"].alias("role"), F.when(i == last, content).otherwise(m["content"]).alias("content"))
    return F.transform(messages, put)


def all_content(messages: Column) -> Column:
    return F.array_join(F.transform(messages, lambda m: m["content"]), " ")


def nested(turns: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """Turns in long form (key, order, role, text) to one row a chat with ``messages`` in order."""
    grouped = turns.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, "role", F.col("text").alias("content")))).alias("_m"))
    return grouped.select(key, F.transform("_m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))


def unnested(chats: DataFrame, key: str = "conv_id") -> DataFrame:
    return chats.select(key, F.posexplode("messages").alias("turn", "m")).select(key, F.col("turn").cast("bigint").alias("turn"), "m.role", F.col("m.content").alias("text"))


def chat_pairs(turns: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """key, prompt (first user text), response (first assistant text), for chats that have both; one shuffle with partial aggregation."""
    first = lambda role: F.min_by(F.when(F.col("role") == role, F.col("text")), F.when(F.col("role") == role, F.col(order)))
    pairs = turns.groupBy(key).agg(first("user").alias("prompt"), first("assistant").alias("response"))
    return pairs.where("prompt <> '' AND response <> ''")


def reject_reason(messages: Column) -> Column:
    """Why a chat gives no pair; null where it does."""
    from ..schema import EMPTY_MESSAGES, NO_ASSISTANT, NO_MESSAGES, NO_USER

    return F.when(messages.isNull(), F.lit(NO_MESSAGES)).when(F.size(messages) == 0, F.lit(EMPTY_MESSAGES)).when(first_of(messages, "user") == "", F.lit(NO_USER)).when(first_of(messages, "assistant") == "", F.lit(NO_ASSISTANT))
