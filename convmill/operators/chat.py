"""Intent records rendered as training text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import draw as D
from ..functions import vocab as V
from .augment import adjust_prompt, shift_context
from .curate import has_fields


def system_prompt(layer: Column, prompts: dict[str, str] | None = None) -> Column:
    out = F
    for name, text in (prompts or V.SYSTEM_PROMPTS).items():
        out = out.when(layer == name, F.lit(text))
    return out.otherwise(F.lit(V.DEFAULT_SYSTEM_PROMPT))


def _shown(name: str) -> Column:
    """A field as text; a field that is there but null shows as None."""
    return F.coalesce(F.col(name), F.lit("None"))


def system_text(layer: Column, context: Column, intent: Column, persona: Column) -> Column:
    return F.concat_ws("\n", system_prompt(layer), F.concat(F.lit("Context: "), context), F.concat(F.lit("User Intent: "), intent), F.concat(F.lit("Persona: "), persona))


def plain(system: Column, user: Column, assistant: Column) -> Column:
    return F.concat(F.lit("System: "), system, F.lit("\nUser: "), user, F.lit("\nAssistant: "), assistant, F.lit("\n"))


def tagged(system: Column, user: Column, assistant: Column) -> Column:
    """A chat template with a line for each role."""
    part = lambda role, text: F.concat(F.lit(f"<|{role}|>\n"), text, F.lit("<|end|>\n"))
    return F.concat(part("system", system), part("user", user), part("assistant", assistant))


def instruction(prompt: Column) -> Column:
    return F.concat(F.lit(V.PROMPT_OPEN), prompt, F.lit(V.PROMPT_CLOSE))


def render(records: DataFrame, key: str | None = None, percent: int = 50, template=plain, seed: str = "render") -> DataFrame:
    """``records`` (intent records) plus ``text`` and ``shifted``.

    A record that lacks a required column's value has an empty text and a reject reason. With ``key``, that
    percentage of rows has its context shifted and its prompt adjusted.
    """
    from ..schema import MISSING_FIELD

    whole = has_fields(V.REQUIRED_FIELDS)
    shifted = D.gate(percent, seed, F.col(key)) if key else F.lit(False)
    context = F.when(shifted, shift_context(_shown("context_summary"), _shown("persona_archetype"))).otherwise(_shown("context_summary"))
    prompt = F.when(shifted, adjust_prompt(_shown("application_prompt"), context)).otherwise(_shown("application_prompt"))
    text = template(system_text(_shown("capability_layer"), context, _shown("user_intent"), _shown("persona_archetype")), prompt, _shown("ideal_response_final"))
    return records.withColumns({"text": F.when(whole, text).otherwise(""), "shifted": shifted, "reject_reason": F.when(~whole, F.lit(MISSING_FIELD))})
