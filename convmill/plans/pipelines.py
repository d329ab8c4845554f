"""The three data paths, as compositions of operators.

The generators' dialects are parameters: how many pairs and whether with depth, which text is classified, whether a question is
appended, how sampling and splitting go.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dialects as L
from ..functions import draw as D
from ..functions.durable import written
from ..functions.rules import Rule
from ..operators import augment as A
from ..operators import classify as C
from ..operators import curate as U
from ..operators import preference as P
from ..operators import tokens as T
from ..operators.chat import plain, render
from ..operators.messages import first_of


@dataclass
class Dialect:
    """What the generators differ in."""

    factor: int = 10
    depth: int = 0
    classify_original: bool = False
    question: bool = True
    pool_bound: bool = False
    strip: str = ".,?!"
    synonyms: dict | None = None
    persona_rules: list[Rule] | None = None
    intent_rules: list[Rule] | None = None
    context_rules: list[Rule] | None = None
    weights: dict[str, int] | None = None
    suffixes: list[str] | None = None
    attribute_pools: dict | None = None
    step_pools: dict | None = None
    steps_most: int | None = None
    banks: list | None = None
    questions: list[str] | None = None
    pair_pool: list | None = None
    extra_pairs: dict = field(default_factory=dict)
    seed: str = "convmill"


MASTER = Dialect()
PROACTIVE = Dialect(pool_bound=True, synonyms=L.PROACTIVE_SYNONYMS, suffixes=L.PROACTIVE_SUFFIXES, banks=L.PROACTIVE_BANKS, questions=L.PROACTIVE_QUESTIONS, pair_pool=L.PROACTIVE_PAIRS)
PUBLICATION = Dialect(
    factor=20,
    depth=2,
    classify_original=True,
    question=False,
    pool_bound=True,
    strip="",
    synonyms=L.PUBLICATION_SYNONYMS,
    suffixes=L.PUBLICATION_SUFFIXES,
    attribute_pools=L.PUBLICATION_ATTRIBUTES,
    step_pools=L.PUBLICATION_STEPS,
    steps_most=4,
    pair_pool=L.PUBLICATION_PAIRS,
    extra_pairs=L.PUBLICATION_PERSONA_PAIRS,
)
DIALECTS = {"master": MASTER, "proactive": PROACTIVE, "publication": PUBLICATION}


def intent_records(pairs: DataFrame, key: str = "conv_id", dialect: Dialect = MASTER) -> DataFrame:
    """Intent records of (key, prompt, response): the original (variant 0) and factor - 1 drawn augmentations of each."""
    d, row = dialect, F.col(key)
    base = pairs.where("prompt <> '' AND response <> ''").withColumns({"original": F.col("prompt"), "context": C.context(F.col("prompt"), row, d.context_rules, d.suffixes, seed=f"{d.seed}-context"), "_persona": C.persona(F.col("prompt"), d.persona_rules)})
    pool = A.pairs_in_depth(F.col("_persona"), F.col("context"), F.col("prompt"), d.depth, row, d.extra_pairs, pool=d.pair_pool) if d.depth else A.pairs(F.col("_persona"), F.col("context"), F.col("prompt"), row, d.pair_pool)
    base = base.withColumn("_pool", pool)
    count = F.least(F.lit(d.factor - 1), F.size("_pool")) if d.pool_bound else F.lit(d.factor - 1)
    rows = A.exploded(base.withColumn("_pool", A.drawn(F.col("_pool"), count, row)), "_pool", key)
    judged = F.col("original") if d.classify_original else F.col("prompt")
    one = F.concat_ws("-", row.cast("string"), F.col("variant").cast("string"))
    rows = rows.withColumns({"persona_archetype": C.persona(judged, d.persona_rules), "capability_layer": C.layer(F.col("response"), row, f"{d.seed}-layer")})
    response = A.paraphrase(F.col("response"), one, d.synonyms, d.strip)
    if d.question:
        response = F.concat(response, F.lit(" "), C.follow_up(F.col("persona_archetype"), one, d.banks, general=d.questions))
    return rows.select(
        key,
        "variant",
        D.digest(d.seed, row, F.col("variant")).alias("intent_id"),
        "persona_archetype",
        C.principle(judged, one, d.weights).alias("governing_principle"),
        "capability_layer",
        C.intent(judged, d.intent_rules).alias("user_intent"),
        F.col("context").alias("context_summary"),
        F.col("prompt").alias("application_prompt"),
        response.alias("ideal_response_final"),
        C.attributes(F.col("capability_layer"), one, pools=d.attribute_pools).alias("ideal_response_attributes"),
        C.steps(F.col("capability_layer"), one, pools=d.step_pools, most=d.steps_most).alias("ideal_response_cot"),
    )


def updated(records: DataFrame, key: str = "intent_id", dialect: Dialect = MASTER) -> DataFrame:
    """Intent records whose response doesn't end with a question get one, and steps drawn anew; those without prompt or response go."""
    kept = records.where("application_prompt <> '' AND ideal_response_final <> ''")
    asks = F.trim("ideal_response_final").endswith("?")
    persona = F.coalesce("persona_archetype", C.persona(F.col("application_prompt"), dialect.persona_rules))
    layer = F.coalesce("capability_layer", C.layer(F.col("ideal_response_final"), F.col(key)))
    return kept.withColumns({"ideal_response_cot": F.when(asks, F.col("ideal_response_cot")).otherwise(C.steps(layer, F.col(key), pools=dialect.step_pools, most=dialect.steps_most)), "ideal_response_final": A.with_question(F.col("ideal_response_final"), C.follow_up(persona, F.col(key), dialect.banks, general=dialect.questions))})


def curated(records: DataFrame, share: float = 0.1, sample: int | None = None, review: float = 0.0, key: tuple = ("intent_id",), seed: str = "curate") -> DataFrame:
    """Exact duplicates dropped, a sample taken, a share flagged for review, and rows split. Each step reads its input twice, so that is written first."""
    out = written(U.keep_first(written(records), ["persona_archetype", "application_prompt", "ideal_response_final"], list(key)))
    if sample is not None:
        out = U.sample(out, sample, list(key), seed)
    if review:
        out = U.flag_for_review(out, review, list(key), "ideal_response_final", A.paraphrase(F.col("ideal_response_final"), F.col(key[0]), seed="review"))
    return U.split(out, share, list(key), seed)


def training_batches(records: DataFrame, tokenizer: T.Tokenizer, template: list[int], batch: Column, key: str | None = None, most: int = 2048, percent: int = 50, chat_template=plain) -> DataFrame:
    """Intent records to batches of ids, masks and labels of equal length."""
    texts = U.drop_blank(render(records, key, percent, chat_template))
    ids = T.tokenize(texts, tokenizer, most=most).withColumn("batch_id", batch)
    return T.collate(ids, "batch_id", template, tokenizer.pad)


def pairs_of_chats(chats: DataFrame, key: str = "conv_id") -> DataFrame:
    """Preference pairs of chats in nested form; chats without messages, user or assistant text give none."""
    usable = chats.where(F.coalesce(F.size("messages") > 0, F.lit(False)))
    return P.preference_pairs(usable.select(key, first_of(F.col("messages"), "user").alias("prompt"), first_of(F.col("messages"), "assistant").alias("response")), key)
