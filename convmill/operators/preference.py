"""Pairs of a chosen and a rejected answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import draw as D
from ..functions import vocab as V
from .chat import instruction
from .variants import call_json


def has_call(response: Column) -> Column:
    return response.contains(V.TOOL_MARK) | response.contains(V.NEED.strip())


def without_call(response: Column) -> Column:
    """The text before the first mark of a call; a stock answer if that is blank."""
    from ..functions.text import stripped

    need = V.NEED.strip()
    text = F.when(response.contains(need), F.substring_index(response, need, 1)).when(response.contains(V.TOOL_MARK), F.substring_index(response, V.TOOL_MARK, 1)).otherwise(response)
    return F.coalesce(F.nullif(stripped(text), F.lit("")), F.lit(V.UNSURE))


def wrong_call(user: Column, response: Column, key: Column, tools: list[str] | None = None, seed: str = "wrong") -> Column:
    """A call of a drawn tool that the response doesn't name."""
    everything = D.strings(tools or V.TOOLS)
    unused = F.filter(everything, lambda t: ~F.contains(response, t))
    tool = D.choice(F.when(F.size(unused) > 0, unused).otherwise(everything), seed, key)
    safe = F.replace(F.replace(F.replace(user, F.lit("'"), F.lit("\\'")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit(" "))
    safe = F.substring(safe, 1, 64)
    args = (
        F.when(tool == "calc_tool", F.create_map(F.lit("query"), F.lit("2+2")))
        .when(tool == "python_repl", F.create_map(F.lit("code"), F.lit("print('test')")))
        .when(tool == "read_file", F.create_map(F.lit("filepath"), F.lit("example.txt")))
        .when(tool == "write_file", F.create_map(F.lit("filepath"), F.lit("example.txt"), F.lit("content"), F.lit("test")))
        .when(tool == "get_current_weather", F.create_map(F.lit("location"), safe))
        .otherwise(F.create_map(F.lit("query"), safe))
    )
    return F.concat(F.lit(V.NEED), call_json(tool, args))


def preference_pairs(pairs: DataFrame, key: str = "conv_id", seed: str = "wrong") -> DataFrame:
    """key, prompt, chosen, rejected from prompt and response: the text without the call, or a wrong call where there is none."""
    made = pairs.where("prompt <> '' AND response <> ''").select(key, instruction(F.col("prompt")).alias("prompt"), F.col("response").alias("chosen"), F.when(has_call(F.col("response")), without_call(F.col("response"))).otherwise(wrong_call(F.col("prompt"), F.col("response"), F.col(key), seed=seed)).alias("rejected"))
    return made.where("chosen <> '' AND rejected <> ''")


def checked(pairs: DataFrame) -> DataFrame:
    """``pairs`` if it has the columns and at least one row, none of them null; says what is missing."""
    from ..schema import PREFERENCE

    missing = [n for n in PREFERENCE.fieldNames() if n not in pairs.columns]
    if missing:
        raise ValueError(f"preference pairs lack {', '.join(missing)}")
    counts = pairs.agg(F.count(F.lit(1)).alias("n"), *(F.count(F.when(F.col(n).isNull(), 1)).alias(n) for n in PREFERENCE.fieldNames())).first()
    if not counts["n"]:
        raise ValueError("there are no preference pairs")
    bad = [n for n in PREFERENCE.fieldNames() if counts[n]]
    if bad:
        raise ValueError(f"preference pairs have nulls in {', '.join(bad)}")
    return pairs
