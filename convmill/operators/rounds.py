"""The agent loop over a table of conversations: in each round all open ones ask, their calls are found, each distinct call is executed
once, and its results are appended in order; those without a call leave. State is a written table, so a round starts from what the last one left."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.durable import written
from ..functions.names import fresh
from .toolcalls import Registry, execute_calls, extract_calls

#: Takes the open conversations (their columns, ``prompt``) and the round from 1 on; adds ``output`` and, where asking failed, ``error``.
Ask = Callable[[DataFrame, int], DataFrame]


def continued(prompt, output, results):
    """What is asked next: all before, what was answered, and what the calls in it gave."""
    return F.concat(prompt, F.lit("\nPrevious output: "), output, F.lit("\nTool results:\n"), results, F.lit("\nNow integrate and continue:"))


def converse(questions: DataFrame, ask: Ask, registry: Registry | None = None, most: int = 5, strict: bool = False, question: str = "question") -> DataFrame:
    """``questions`` plus prompt (as it was asked last), answer, rounds and status.

    ``answered``: an answer without a call. ``failed``: asking gave an error, which is the answer's text. ``unfinished``: still calling after ``most`` rounds; the
    answer is the last output. With ``strict`` a blank question, a failure and a blank answer end the job. Tools' errors are part of the results.
    Repeated and null keys do no harm: each row is a conversation of its own. Null questions count as blank, an empty table gives an empty one.
    """
    if most < 1:
        raise ValueError("at least one round is needed")
    row, = fresh(questions, "row", also=["prompt", "output", "error", "answer", "rounds", "status", "results", "call", "name", "arguments", "result"])
    first = F.trim(F.coalesce(F.col(question), F.lit("")))
    if strict:
        first = F.when(first == "", F.raise_error(F.lit("the question is blank")).cast("string")).otherwise(first)
    open_ = written(questions.withColumns({row: F.monotonically_increasing_id(), "prompt": first}))
    done, own = [], [*questions.columns]
    for k in range(1, most + 1):
        asked = ask(open_, k)
        if "error" not in asked.columns:
            asked = asked.withColumn("error", F.lit(None).cast("string"))
        output, error = F.coalesce("output", F.lit("")), F.col("error")
        if strict:
            output = F.when(error.isNotNull(), F.raise_error(F.concat(F.lit("asking failed: "), error)).cast("string")).when(F.trim(output) == "", F.raise_error(F.lit("the answer is blank")).cast("string")).otherwise(output)
        asked = written(asked.select(*(F.col(f"`{c}`") for c in own), row, "prompt", output.alias("output"), "error"))
        ran = execute_calls(extract_calls(asked.where("error IS NULL"), "output", [row]), registry)
        # One answer's calls, which is what its text holds.
        told = ran.groupBy(row).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("call", "result"))), lambda r: r["result"]), "\n").alias("results"))
        told = written(asked.join(told, row, "left"))
        status = F.when(F.col("error").isNotNull(), "failed").when(F.col("results").isNull(), "answered").otherwise("unfinished")
        ends = told if k == most else told.where("results IS NULL")
        answer = F.coalesce(F.concat(F.lit("Error in model inference: "), "error"), "output")
        done.append(ends.select(*(F.col(f"`{c}`") for c in own), "prompt", answer.alias("answer"), F.lit(k).cast("bigint").alias("rounds"), status.alias("status")))
        if k < most:
            open_ = written(told.where("results IS NOT NULL").select(*(F.col(f"`{c}`") for c in own), row, continued(F.col("prompt"), F.col("output"), F.col("results")).alias("prompt")))
            if open_.isEmpty():
                break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out
