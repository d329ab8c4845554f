"""Tool calls at any depth of nesting: a scanner that counts braces and minds strings, as a table function and as a check.

Only texts that hold the mark of a call cross to Python, in Arrow batches; each text is a row of its own, so a long one stalls no other.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import fresh

MARK = '"tool_call"'
_BEGIN = re.compile(r'\{\s*"tool_call"')
_SIGN = re.compile(r'["{}]')
_REST_OF_STRING = re.compile(r'(?:[^"\\]|\\.)*+"', re.DOTALL)


def spans(text: str) -> list[tuple[int, int | None]]:
    """Where calls begin and end, in order; the end is null for one that isn't closed.

    Later ones are looked at first, so one that holds others passes over them at once.
    """
    ends: dict[int, int | None] = {}
    begins = [m.start() for m in _BEGIN.finditer(text)]
    for begin in reversed(begins):
        at, depth, end = begin + 1, 1, None
        while m := _SIGN.search(text, at):
            if m[0] == '"':
                closed = _REST_OF_STRING.match(text, m.end())
                if closed is None:
                    break
                at = closed.end()
            elif m[0] == "{" and m.start() in ends:
                if ends[m.start()] is None:
                    break
                at = ends[m.start()]
            else:
                at, depth = m.end(), depth + (1 if m[0] == "{" else -1)
                if depth == 0:
                    end = at
                    break
        ends[begin] = end
    return [(b, ends[b]) for b in begins]


def parsed(text: str) -> Iterator[dict | None]:
    """For each place where a call begins what it parses to; null where it isn't closed, doesn't parse or is nested deeper than the parser goes."""
    for begin, end in spans(text):
        try:
            yield None if end is None else json.loads(text[begin:end])
        except (ValueError, RecursionError):
            yield None


def find_calls(text: str | None) -> list[dict]:
    """Every tool call of a text that parses and has a name and arguments."""
    calls = (p["tool_call"] for p in parsed(text or "") if p is not None)
    return [c for c in calls if isinstance(c, dict) and "name" in c and "arguments" in c]


class _Calls:
    """The calls of one text, numbered from 0; names that are no text, and all arguments, as JSON."""

    def eval(self, text: str):
        for i, c in enumerate(find_calls(text)):
            name = c["name"] if isinstance(c["name"], str) else json.dumps(c["name"], ensure_ascii=False)
            yield i, name, json.dumps(c["arguments"], ensure_ascii=False)


def table_function():
    return F.udtf(_Calls, returnType="call bigint, name string, arguments string", useArrow=True)


def register(spark: SparkSession, name: str = "tool_calls") -> None:
    """The table function under a name for SQL: ``SELECT ... FROM t, LATERAL tool_calls(t.content) AS c``."""
    spark.udtf.register(name, table_function())


def extract(df: DataFrame, text: str, key: list[str]) -> DataFrame:
    """``key``, call (from 0), name and arguments (JSON) for every call, in order."""
    content, = fresh(df, "content", also=["call", "name", "arguments"])
    marked = df.where(F.contains(F.col(text), F.lit(MARK))).select(*key, F.col(text).alias(content))
    return marked.lateralJoin(table_function()(F.col(content).outer())).drop(content)


def _parse(texts: pd.Series) -> pd.Series:
    return texts.map(lambda some: all(p is not None for t in some for p in parsed(t)) if some is not None else True)


def all_parse(contents: Column) -> Column:
    """True where every place in these texts that begins a tool call begins a whole object that parses."""
    marked = F.filter(contents, lambda c: F.coalesce(F.contains(c, F.lit(MARK)), F.lit(False)))
    return F.pandas_udf(_parse, "boolean")(F.when(F.size(marked) > 0, marked))
