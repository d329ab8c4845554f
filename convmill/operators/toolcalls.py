"""Tool calls in texts: found, parsed, executed."""

from __future__ import annotations

import ast
import operator
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocab as V
from ..functions.names import fresh
from . import calls
from .calls import find_calls

#: Results and exponents beyond these are refused: a cell of data must not stall a task.
DIGITS_MOST, EXPONENT_MOST = 4000, 10_000

_OPERATORS: dict[type, Callable] = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv, ast.FloorDiv: operator.floordiv, ast.Mod: operator.mod, ast.Pow: operator.pow, ast.UAdd: operator.pos, ast.USub: operator.neg}


def _value(node: ast.AST):
    match node:
        case ast.Constant(value=bool() | int() | float()):
            return node.value
        case ast.UnaryOp(op=op, operand=inner) if type(op) in _OPERATORS:
            return _OPERATORS[type(op)](_value(inner))
        case ast.BinOp(left=a, op=op, right=b) if type(op) in _OPERATORS:
            x, y = _value(a), _value(b)
            if isinstance(op, ast.Pow) and (abs(y) > EXPONENT_MOST or isinstance(x, int) and abs(x).bit_length() * abs(y) > 3.4 * DIGITS_MOST):
                raise ValueError("exponent too large")
            return _OPERATORS[type(op)](x, y)
    raise ValueError(f"unsupported: {type(node).__name__}")


def calculate(expression: str | None) -> str:
    """The value of an arithmetic expression as text, or what is wrong with it; nothing else is evaluated."""
    if not expression:
        return "Error: Invalid expression input"
    try:
        return str(_value(ast.parse(expression.strip(), mode="eval").body))
    except (ValueError, SyntaxError, TypeError) as error:
        return f"Error: Invalid expression - {error}"
    except (ArithmeticError, RecursionError, MemoryError) as error:
        return f"Error: Calculation failed - {error}"


def calculate_column(expression: Column) -> Column:
    """``calculate`` in Arrow batches; each distinct expression of a batch is worked out once."""

    @F.pandas_udf("string")
    def run(batch: pd.Series) -> pd.Series:
        known = {e: calculate(e) for e in batch.dropna().unique()}
        return batch.map(lambda e: known.get(e) or calculate(None))

    return run(expression)


class Registry:
    """Named functions of one text argument, usable on columns and from SQL."""

    def __init__(self) -> None:
        self.tools: dict[str, Callable[[Column], Column]] = {}

    def register(self, name: str):
        def keep(f: Callable[[Column], Column]) -> Callable[[Column], Column]:
            self.tools[name] = f
            return f

        return keep

    def register_function(self, spark: SparkSession, name: str, f: Callable[[str], str]) -> None:
        """A Python function as a tool and, in Arrow batches, as the SQL function of that name; null in, null out, since a CASE evaluates it for other tools' rows too."""

        @F.pandas_udf("string")
        def run(batch: pd.Series) -> pd.Series:
            return batch.map(lambda x: None if x is None else f(x))

        self.tools[name] = spark.udf.register(name, run)

    def execute(self, name: Column, args: Column) -> Column:
        """What the tool answers to its first argument; unknown tools and missing arguments are said to be so."""
        first = F.get(F.map_values(args), F.lit(0))
        out = F
        for tool, f in self.tools.items():
            missing = F.concat(F.lit(f"Tool {tool} invalid args: Missing required argument for "), F.lit(tool))
            out = out.when(name == tool, F.when(first.isNull(), missing).otherwise(F.concat(F.lit(f"Tool {tool} result: "), f(first))))
        return (out.otherwise(F.concat(F.lit("Unknown tool: "), name)) if out is not F else F.concat(F.lit("Unknown tool: "), name))


def default_registry() -> Registry:
    registry = Registry()
    for name, text in V.LOOKUPS.items():
        before, after = text.split("{}")
        registry.tools[name] = lambda x, a=before, b=after: F.concat(F.lit(a), x, F.lit(b))
    registry.tools["calc_tool"] = calculate_column
    return registry


def extract_calls(df: DataFrame, text: str, key: list[str]) -> DataFrame:
    """key, call (from 0), name, arguments (a map; values that are no texts as JSON) for every well-formed call that has both, in order, at any depth. Arguments that are no object give an empty map."""
    arguments = F.coalesce(F.from_json("arguments", "map<string,string>"), F.create_map().cast("map<string,string>"))
    return calls.extract(df, text, key).select(*key, "call", "name", arguments.alias("arguments"))


def converse(step: Callable[[list[dict]], str], question: str, run: Callable[[str, dict], str], most: int = 5, strict: bool = False) -> str:
    """Asks ``step`` for an answer, runs the tool calls in it in order and tells it their results, up to ``most`` times.

    The first answer without a call is returned, or the last one. Errors of tools become text; ``strict`` raises them, and on a blank question or answer.
    """
    if strict and not question.strip():
        raise ValueError("the question is blank")
    messages, answer = [{"role": "user", "content": question}], ""
    for _ in range(most):
        answer = step(messages)
        if strict and not (answer or "").strip():
            raise ValueError("the answer is blank")
        found = find_calls(answer)
        if not found:
            break
        results = []
        for call in found:
            try:
                results.append(run(call["name"], call["arguments"]))
            except Exception as error:
                if strict:
                    raise
                results.append(f"Tool {call['name']} error: {error}")
        messages += [{"role": "assistant", "content": answer}, {"role": "user", "content": "Tool results: " + "\n".join(results)}]
    return answer


def execute_calls(called: DataFrame, registry: Registry | None = None) -> DataFrame:
    """``called`` plus ``result``; equal calls are worked out once and met again."""
    registry = registry or default_registry()
    args, tool, told = fresh(called, "args", "tool", "told", also=["result"])
    keyed = called.withColumn(args, F.to_json("arguments"))
    distinct = keyed.select("name", args, "arguments").dropDuplicates(["name", args])
    worked = distinct.select(F.col("name").alias(tool), F.col(args).alias(told), registry.execute(F.col("name"), F.col("arguments")).alias("result"))
    return keyed.join(worked, keyed["name"].eqNullSafe(worked[tool]) & keyed[args].eqNullSafe(worked[told]), "left").drop(args, tool, told)


def anchors(html: Column, pattern: str = r'(?s)<a [^>]*?href="(.*?)"[^>]*>(.*?)</a>', most: int = 5) -> Column:
    """The first links of a page as (url, title)."""
    urls, titles = (F.slice(F.regexp_extract_all(html, F.lit(pattern), F.lit(i)), 1, most) for i in (1, 2))
    return F.zip_with(urls, titles, lambda u, t: F.struct(F.trim(u).alias("url"), F.trim(t).alias("title")))
