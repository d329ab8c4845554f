"""More records from each: contexts shifted, prompts adjusted, responses paraphrased."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import draw as D
from ..functions import vocab as V
from ..functions.text import words


def paraphrase(text: Column, key: Column, synonyms: dict[str, list[str]] | None = None, strip: str = ".,?!", seed: str = "paraphrase") -> Column:
    """Words with synonyms replaced by a drawn one; words joined by one space. ``strip``: characters ignored at a word's ends."""
    synonyms = V.SYNONYMS if synonyms is None else synonyms
    table = F.create_map(*[x for k, v in synonyms.items() for x in (F.lit(k), D.strings(v))])

    def one(w: Column, i: Column) -> Column:
        plain = F.lower(F.btrim(w, F.lit(strip)) if strip else w)
        return F.when(plain.isin(*synonyms), D.choice(F.try_element_at(table, plain), seed, key, i)).otherwise(w)

    return F.array_join(F.transform(words(text), one), " ")


def pairs(persona: Column, context: Column, prompt: Column, key: Column, pool: list | None = None, seed: str = "pairs") -> Column:
    """(context, prompt) pairs that suit the persona, in drawn order."""
    made = []
    for need, more_context, more_prompt in V.AUGMENTATIONS if pool is None else pool:
        pair = F.struct(F.concat(context, F.lit(more_context)).alias("context"), F.concat(prompt, F.lit(more_prompt)).alias("prompt"))
        made.append(F.when(persona.contains(need), pair) if need else pair)
    return D.shuffled(F.filter(F.array(*made), lambda p: p.isNotNull()), seed, key)


def drawn(pool: Column, count: Column | int, key: Column, seed: str = "drawn") -> Column:
    """``count`` items of the pool, with replacement."""
    count = F.lit(count) if isinstance(count, int) else count
    some = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: D.choice(pool, seed, key, i))
    return F.when((count < 1) | (F.size(pool) == 0), F.slice(pool, 1, 0)).otherwise(some)


def dynamic_perturbation(context: Column, depth: int, key: Column, seed: str = "perturb") -> Column:
    """``depth`` of the templates, drawn without replacement, joined by spaces."""
    inverted = context
    for a, b in V.INVERSIONS:
        inverted = F.replace(inverted, F.lit(a), F.lit(b))
    made = [F.concat(F.lit(before), inverted if i == 0 else context, F.lit(after)) for i, (before, after) in enumerate(V.PERTURBATION_TEMPLATES)]
    return F.array_join(F.slice(D.shuffled(F.array(*made), seed, key), 1, min(depth, len(made))), " ")


def pairs_in_depth(persona: Column, context: Column, prompt: Column, depth: int, key: Column, extra: dict[str, list[tuple[str, str]]] | None = None, seed: str = "depth", pool: list | None = None) -> Column:
    """As ``pairs``, with a dynamic perturbation and further pairs by what the persona has, the first of ``extra`` that it has."""
    base = F.array(F.struct(dynamic_perturbation(context, depth, key, seed).alias("context"), prompt.alias("prompt")))
    more = F
    for need, suffixes in (extra or {}).items():
        more = more.when(persona.contains(need), F.array(*(F.struct(F.concat(context, F.lit(c)).alias("context"), F.concat(prompt, F.lit(p)).alias("prompt")) for c, p in suffixes)))
    none = F.slice(base, 1, 0)
    return D.shuffled(F.concat(base, pairs(persona, context, prompt, key, pool), none if more is F else more.otherwise(none)), seed, key)


def shift_context(context: Column, persona: Column) -> Column:
    """The first shift whose name is in the persona: a phrase replaced, a sentence appended."""
    low, out = F.lower(persona), F
    for name, old, new, sentence, _ in V.CONTEXT_SHIFTS:
        out = out.when(low.contains(name), F.concat(F.replace(context, F.lit(old), F.lit(new)), F.lit(f" {sentence}")))
    return out.otherwise(context)


def adjust_prompt(prompt: Column, context: Column) -> Column:
    out = F
    for mark, shift in zip(V.SHIFT_MARKS, V.CONTEXT_SHIFTS):
        out = out.when(context.contains(mark), F.concat(prompt, F.lit(shift[4])))
    return out.otherwise(prompt)


def shift_by_persona(context: Column, persona: Column, key: Column, shifts: list | None = None, seed: str = "shift") -> Column:
    """One of the shifts, drawn; it does nothing unless its name is in the persona."""
    shifts = shifts or V.PERSONA_SHIFTS
    at, out = D.index(len(shifts), seed, key), F
    for i, (name, old, new, _) in enumerate(shifts):
        out = out.when((at == i) & persona.contains(name), F.replace(context, F.lit(old), F.lit(new)))
    return out.otherwise(context)


def adjust_by_persona(prompt: Column, context: Column, shifts: list | None = None) -> Column:
    out = F
    for _, _, new, suffix in shifts or V.PERSONA_SHIFTS:
        out = out.when(context.contains(new), F.concat(prompt, F.lit(suffix)))
    return out.otherwise(prompt)


def with_question(response: Column, question: Column) -> Column:
    """A follow-up question appended, unless the response ends with one."""
    trimmed = F.trim(response)
    return F.when(trimmed.endswith("?"), response).otherwise(F.concat(trimmed, F.lit(" "), question))


def exploded(df: DataFrame, pool: str, key: str) -> DataFrame:
    """One row for the original (variant 0, its own context and prompt) and one for each pair of ``pool``."""
    base = F.array(F.struct(F.col("context").alias("context"), F.col("prompt").alias("prompt")))
    rows = df.withColumn("_all", F.concat(base, F.col(pool)))
    own = [c for c in df.columns if c not in ("context", "prompt", pool)]
    return rows.select(*own, F.posexplode("_all").alias("variant", "_p")).select(*own, F.col("variant").cast("bigint").alias("variant"), "_p.context", "_p.prompt")
