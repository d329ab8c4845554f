"""Labels of prompts and responses by ordered rules, and seeded choices among what a label allows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import draw as D
from ..functions import vocab as V
from ..functions.rules import Rule, classify


def by_label(pools: dict[str, list[str]], label: Column, default: str) -> Column:
    """The pool of a label, else that of ``default``."""
    out = None
    for name, pool in pools.items():
        out = F.when(label == name, D.strings(pool)) if out is None else out.when(label == name, D.strings(pool))
    return out.otherwise(D.strings(pools[default]))


def persona(text: Column, rules: list[Rule] | None = None) -> Column:
    return classify(text, V.PERSONA_RULES if rules is None else rules, V.DEFAULT_PERSONA)


def intent(text: Column, rules: list[Rule] | None = None) -> Column:
    return classify(text, V.INTENT_RULES if rules is None else rules, V.DEFAULT_INTENT)


def context(text: Column, key: Column | None = None, rules: list[Rule] | None = None, suffixes: list[str] | None = None, seed: str = "context") -> Column:
    """Base context by rule; with a row key, and one of the suffixes drawn for it."""
    base = classify(text, V.CONTEXT_RULES if rules is None else rules, V.CONTEXT_DEFAULT)
    suffixes = V.CONTEXT_SUFFIXES if suffixes is None else suffixes
    return base if key is None or not suffixes else F.concat(base, D.choice(D.strings(suffixes), seed, key))


def layer(response: Column, key: Column, seed: str = "layer", rules: list[Rule] | None = None) -> Column:
    return classify(response, V.LAYER_RULES if rules is None else rules, D.choice(D.strings(V.LAYERS), seed, key))


def layer_by_cues(response: Column) -> Column:
    return classify(response, V.LAYER_CUES, V.DEFAULT_LAYER)


def principle(text: Column, key: Column, weights: dict[str, int] | None = None, seed: str = "principle", rules: list[Rule] | None = None) -> Column:
    """A chapter by rule, else drawn by integer weight (1 where none is given); and one of its principles."""
    weighted = D.weighted({c: (weights or {}).get(c, 1) for c in V.CHAPTERS}, seed, key)
    chapter = classify(text, V.CHAPTER_RULES if rules is None else rules, weighted)
    return F.concat(chapter, F.lit(" > "), D.choice(by_label(V.CHAPTERS, chapter, "Chapter 1"), f"{seed}-part", key))


def principle_by_cues(response: Column) -> Column:
    return classify(response, V.PRINCIPLE_CUES, V.DEFAULT_PRINCIPLE)


def attributes(layer_: Column, key: Column, count: int = 3, seed: str = "attributes", pools: dict | None = None) -> Column:
    return F.slice(D.shuffled(by_label(pools or V.ATTRIBUTES, layer_, V.DEFAULT_LAYER), seed, key), 1, count)


def steps(layer_: Column, key: Column, least: int = 3, seed: str = "steps", pools: dict | None = None, most: int | None = None) -> Column:
    """From ``least`` to ``most`` or all of the layer's steps, in drawn order."""
    pool = by_label(pools or V.STEPS, layer_, V.DEFAULT_LAYER)
    top = F.size(pool) if most is None else F.least(F.size(pool), F.lit(most))
    count = (F.lit(least) + D.index(top - least + 1, f"{seed}-count", key)).cast("int")
    return F.slice(D.shuffled(pool, seed, key), F.lit(1), count)


def _cues(text: Column, cues: list[tuple[list[str], str]]) -> list[Column]:
    low = F.lower(text)
    return [F.when(F.lit(False) if not keys else _any(low, keys), F.lit(label)) for keys, label in cues]


def _any(low: Column, keys: list[str]) -> Column:
    out = low.contains(keys[0])
    for k in keys[1:]:
        out = out | low.contains(k)
    return out


def attributes_by_cues(response: Column, cues: list | None = None) -> Column:
    return F.filter(F.array(*map(F.lit, V.ATTRIBUTES_ALWAYS), *_cues(response, cues or V.ATTRIBUTE_CUES)), lambda x: x.isNotNull())


def steps_by_cues(response: Column, cues: list | None = None) -> Column:
    found = F.filter(F.array(*_cues(response, cues or V.STEP_CUES)), lambda x: x.isNotNull())
    return F.when(F.size(found) == 0, F.array(F.lit(V.DEFAULT_STEP))).otherwise(found)


def follow_up(persona_: Column, key: Column, banks: list[tuple[str, list[str]]] | None = None, seed: str = "follow", general: list[str] | None = None) -> Column:
    """A question of the first bank whose key is in the persona, else a general one."""
    out = F
    for name, pool in banks or []:
        out = out.when(persona_.contains(name), D.strings(pool))
    general = V.FOLLOW_UPS if general is None else general
    pool = D.strings(general) if out is F else out.otherwise(D.strings(general))
    return D.choice(pool, seed, key)


def relevant_tools(message: Column, tools: list[str], topics: list | None = None) -> Column:
    """The allowed tools of the first topic in the message, in the topic's order; all where there is no topic or none of its tools is allowed."""
    low, everything, out = F.lower(message), D.strings(tools), F
    for name, wanted in topics or V.TOOL_TOPICS:
        out = out.when(low.contains(name), F.filter(D.strings(wanted), lambda t: F.array_contains(everything, t)))
    found = out.otherwise(everything)
    return F.when(F.size(found) > 0, found).otherwise(everything)
