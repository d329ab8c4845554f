"""Chats with tool calls worked into the assistant's answer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import draw as D
from ..functions import vocab as V
from ..functions.text import json_string, let, words
from .calls import all_parse
from .messages import all_content, first_of, replace_last

KINDS = ("single", "multi", "none")


def kinds(count: int) -> list[str]:
    """``count`` variants dealt over the kinds by thirds; what remains goes to the first kinds."""
    share, rest = divmod(count, len(KINDS))
    return [k for i, k in enumerate(KINDS) for _ in range(share + (i < rest))]


def calculation(query: Column) -> Column:
    """A sum of the first two numbers, twice the only one, or one and one."""
    numbers = F.regexp_extract_all(query, F.lit(r"\d+\.?\d*"), F.lit(0))
    return F.when(F.size(numbers) >= 2, F.concat(F.get(numbers, F.lit(0)), F.lit(" + "), F.get(numbers, F.lit(1)))).when(F.size(numbers) == 1, F.concat(F.get(numbers, F.lit(0)), F.lit(" * 2"))).otherwise("1 + 1")


def _texts(query: Column) -> Column:
    """What tools are told of a query, escaped as JSON: its first words, code, content, details, task and place. One array, so that the escaping is planned once."""

    def made(first: Column) -> Column:
        head = F.substring(query, 1, 50)
        return F.array(
            F.array_join(first, " "),
            F.concat(F.lit("print("), F.array_join(first, " "), F.lit(")")),
            F.concat(F.lit("Generated from: "), head),
            F.concat(F.lit("Meeting about "), F.coalesce(F.get(first, F.lit(0)), F.lit("task"))),
            F.concat(F.lit("Task: "), head),
            F.coalesce(F.try_element_at(first, F.lit(-1)), F.lit("New York")),
        )

    return F.transform(let(F.slice(words(F.lower(query)), 1, 5), made), lambda t: json_string(t, ascii_only=True))


def _fields(query: Column, texts: Column) -> dict[str, dict[str, Column]]:
    """Each known tool's arguments in call order, from a query and its ``_texts``."""
    text, code, content, details, task, place = (F.get(texts, F.lit(i)) for i in range(6))
    of = {
        "calc_tool": {"query": calculation(query)},
        "python_repl": {"code": code},
        "read_file": {"filepath": F.lit("/data/allowed/read/notes.txt")},
        "write_file": {"filepath": F.lit("/data/allowed/write/output.txt"), "content": content},
        "calendar_tool": {"action": F.lit("create_event"), "details": details},
        "task_tracker_tool": {"task_details": task},
        "get_current_weather": {"location": place},
    }
    return {name: of.get(name, {"query": text}) for name in V.TOOLS}


def arguments(tool: Column, query: Column) -> Column:
    """A tool's arguments from a query: a map in call order; empty for unknown tools.

    Texts are escaped as JSON already, so writing them into a call escapes them once more, as those who read the calls expect.
    """

    def made(texts: Column) -> Column:
        out = F
        for name, fields in _fields(query, texts).items():
            out = out.when(tool == name, F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v)]))
        return out.otherwise(F.create_map().cast("map<string,string>"))

    return let(_texts(query), made)


def call_lines(query: Column) -> Column:
    """For each known tool the call with its arguments from a query, and on the next line what it is made to answer."""

    def made(texts: Column, again: Column) -> Column:
        entries, told = [], _fields(query, texts)
        # Numbers, signs and the fixed paths have nothing to escape; the texts are escaped once more.
        for name, fields in _fields(query, again).items():
            begin, rest = V.TOOL_ANSWERS[name].split("{") if name in V.TOOL_ANSWERS else (f"Tool result: {name} executed", "}")
            arg, end = rest.split("}")
            shown = [x for k, v in fields.items() for x in (F.lit(f'"{k}": "'), v, F.lit('", '))]
            shown[-1] = F.lit('"}}}')
            entries += [F.lit(name), F.concat(F.lit(f'{V.NEED}{{"tool_call": {{"name": "{name}", "arguments": {{'), *shown, F.lit(f"\n{begin}"), told[name].get(arg, F.lit("")), F.lit(end))]
        return F.create_map(*entries)

    return let(_texts(query), lambda t: let(F.transform(t, lambda x: json_string(x)), lambda again: made(t, again)))


def answer(tool: Column, args: Column) -> Column:
    """What the tool is made to answer."""
    out = F
    for name, text in V.TOOL_ANSWERS.items():
        before, rest = text.split("{")
        arg, after = rest.split("}")
        out = out.when(tool == name, F.concat(F.lit(before), F.coalesce(F.try_element_at(args, F.lit(arg)), F.lit("")), F.lit(after)))
    return out.otherwise(F.concat(F.lit("Tool result: "), tool, F.lit(" executed")))


def call_json(tool: Column, args: Column) -> Column:
    """{"tool_call": {"name": ..., "arguments": {...}}}, with a space after colons and commas."""
    fields = F.transform(F.map_entries(args), lambda e: F.concat(F.lit('"'), e["key"], F.lit('": "'), json_string(e["value"]), F.lit('"')))
    return F.concat(F.lit('{"tool_call": {"name": "'), json_string(tool), F.lit('", "arguments": {'), F.array_join(fields, ", "), F.lit("}}}"))


def with_calls(kind: Column, tools: Column, lines: Column, response: Column, key: Column, seed: str = "variant") -> Column:
    """The answer of a variant, by the ``call_lines`` of its chat: one call, two different ones, or none; unknown kinds count as none."""
    order = D.shuffled(tools, seed, key)
    count = F.when(kind == "single", 1).when(kind == "multi", 2).otherwise(0)
    unknown = lambda t: F.concat(F.lit(V.NEED), call_json(t, F.create_map().cast("map<string,string>")), F.lit("\nTool result: "), t, F.lit(" executed"))
    calls = F.transform(F.slice(order, F.lit(1), F.least(count, F.size(tools))), lambda t: F.coalesce(F.try_element_at(lines, t), unknown(t)))
    return F.when(count == 0, response).otherwise(F.array_join(F.concat(calls, F.array(F.concat(F.lit(V.ADVICE), response))), "\n"))


def variants(chats: DataFrame, count: int, tools: list[str], key: str = "conv_id", relevant=None, seed: str = "variant") -> DataFrame:
    """Originals (variant 0) and ``count`` variants of each chat that has a user and an assistant text; in the originals nothing changes.

    ``relevant``: a function of the user's text to the tools that go with it; all ``tools`` else.
    """
    if count < 0 or not tools:
        raise ValueError("count is 0 or more, and at least one tool is needed")
    base = chats.select(key, "messages")
    originals = base.select(key, F.lit(0).cast("bigint").alias("variant"), F.lit("original").alias("kind"), "messages")
    user, response = first_of(F.col("messages"), "user"), first_of(F.col("messages"), "assistant")
    order = D.shuffled(D.strings(kinds(count)), f"{seed}-kinds", F.col(key))
    # Calls are worked out once for a chat, before it is dealt over its variants.
    ready = base.select(key, "messages", user.alias("user"), response.alias("response")).where("user <> '' AND response <> ''")
    ready = ready.select(key, "messages", "response", call_lines(F.col("user")).alias("lines"), (relevant(F.col("user")) if relevant else D.strings(tools)).alias("allowed"))
    dealt = ready.select("*", F.posexplode(order).alias("at", "kind"))
    text = with_calls(F.col("kind"), F.col("allowed"), F.col("lines"), F.col("response"), F.concat_ws("-", F.col(key).cast("string"), F.col("at").cast("string")), seed)
    made = dealt.select(key, (F.col("at") + 1).cast("bigint").alias("variant"), "kind", replace_last(F.col("messages"), "assistant", text).alias("messages"))
    return originals.unionByName(made)


def valid(messages: Column, most_tokens: int = 32_000, count: Callable[[Column], Column] | None = None) -> Column:
    """Not empty, not too long, and all tool calls well formed, however deep. ``count`` gives a text's tokens; words are counted without it."""
    tokens = (count or (lambda text: F.size(words(text))))(all_content(messages))
    whole = all_parse(F.transform(messages, lambda m: m["content"]))
    return F.coalesce((F.size(messages) > 0) & (tokens <= most_tokens) & whole, F.lit(False))
