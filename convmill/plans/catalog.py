"""Named queries over the test tables, with the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dialects as L
from ..functions import draw as D
from ..functions import vocab as V
from ..functions.durable import fresh_path
from ..functions.rules import Rule, classify_by_table, table as rule_table
from ..functions.text import SPACES, words
from ..operators import augment as A
from ..operators import calls as N
from ..operators import chat as H
from ..operators import classify as C
from ..operators import curate as U
from ..operators import messages as M
from ..operators import metrics as R
from ..operators import preference as P
from ..operators import rounds as G
from ..operators import rowwise as W
from ..operators import presets, tokens as T, toolcalls as K
from ..operators import variants as X
from ..operators.memo import Memo
from ..sources import jsonl, sinks
from . import pipelines, sql as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Rules in words that the test texts have.
PERSONAS = [Rule("the|And", "English > Reader"), Rule("und|der|die", "German > Fitness Seeker"), Rule("que|los|las", "Spanish > Business Professional"), Rule("le|les|des", "French > Carla")]
INTENTS = [Rule(k, v, "part") for k, v in (("tion", "Name an action"), ("ING", "Describe a process"), ("ung", "Name a state"), ("ment", "Qualify"))]
CONTEXTS = [Rule(k, v, "part") for k, v in (("the", "limited text about a busy professional"), ("der", "tight text with a 30th birthday"), ("que", "nervous text on a dive watch"))]
LAYERS = [Rule("of|from", "Aspirational"), Rule("nicht|und|le", "Transformational")]
CHAPTERS = [Rule("to|in|der", "Chapter 1"), Rule("was|les", "Chapter 2")]
SYNONYMS = {"the": ["this", "that"], "and": ["plus", "with", "also"], "und": ["sowie", "samt"], "que": ["cual", "quien"], "le": ["ce", "un"]}
CUES = [(["the", "der"], "First"), (["ing"], "Second"), (["ung", "que"], "Third")]
BANKS = [("German", ["Weiter?", "Mehr dazu?"]), ("Reader", ["Read on?"])]
TOPICS = [("the", ["search_web", "calc_tool"]), ("der", ["write_file"]), ("que", ["unlisted"])]
TOOLS = ["search_web", "calc_tool", "news_tool", "python_repl", "write_file", "get_current_weather"]
DIALECT = pipelines.Dialect(factor=3, synonyms=SYNONYMS, persona_rules=PERSONAS, intent_rules=INTENTS, context_rules=CONTEXTS)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(oracle: str | None = None):
    """Registers a query under its function's name, and its SQL."""

    def keep(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLE_SQL[f.__name__] = oracle
        return f

    return keep


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.chat_pairs(read(spark, sf_dir, "conversations"))


def pair_query(name: str, column: Callable[[], Column], oracle: str, out: str = "label") -> None:
    """A query of one column, made when it runs, over the first user and assistant texts."""
    QUERIES[name] = lambda spark, sf_dir: pairs(spark, sf_dir).select("conv_id", column().alias(out))
    ORACLE_SQL[name] = f"WITH {S.PAIRS} SELECT conv_id, {oracle} AS {out} FROM pairs"


def joined(array: Column) -> Column:
    return F.array_join(array, "; ")


# Projections and filters
QUERIES["chat_pairs"] = pairs
ORACLE_SQL["chat_pairs"] = f"WITH {S.PAIRS} SELECT * FROM pairs"


@query("SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS content FROM conversations GROUP BY conv_id")
def chat_concat(spark, sf_dir):
    return M.nested(read(spark, sf_dir, "conversations")).select("conv_id", M.all_content(F.col("messages")).alias("content"))


@query("SELECT c.conv_id, c.turn, c.role, CASE WHEN c.turn = l.last THEN 'Replaced.' ELSE c.text END AS text FROM conversations c LEFT JOIN (SELECT conv_id, max(turn) AS last FROM conversations WHERE role = 'assistant' GROUP BY conv_id) l USING (conv_id)")
def last_assistant_replace(spark, sf_dir):
    chats = M.nested(read(spark, sf_dir, "conversations"))
    return M.unnested(chats.select("conv_id", M.replace_last(F.col("messages"), "assistant", F.lit("Replaced.")).alias("messages")))


@query("""SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM (SELECT conv_id, CASE WHEN coalesce(arg_min(text, turn) FILTER (WHERE role = 'user'), '') = '' THEN 'no_user'
    WHEN coalesce(arg_min(text, turn) FILTER (WHERE role = 'assistant'), '') = '' THEN 'no_assistant' END AS reason FROM conversations GROUP BY conv_id) GROUP BY 1""")
def stage_counts(spark, sf_dir):
    chats = M.nested(read(spark, sf_dir, "conversations"))
    return chats.groupBy(F.coalesce(M.reject_reason(F.col("messages")), F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


# Classification
pair_query("persona_classify", lambda: C.persona(F.col("prompt"), PERSONAS), S.classify("prompt", PERSONAS, S.q(V.DEFAULT_PERSONA)))
_PARTS = [Rule(r.key.split("|")[0], r.label, "part") for r in PERSONAS]
pair_query("persona_parts", lambda: C.persona(F.col("prompt"), _PARTS), S.classify("prompt", _PARTS, S.q(V.DEFAULT_PERSONA)))
pair_query("intent_classify", lambda: C.intent(F.col("prompt"), INTENTS), S.classify("prompt", INTENTS, S.q(V.DEFAULT_INTENT)))
pair_query("context_plain", lambda: C.context(F.col("prompt"), rules=CONTEXTS), S.classify("prompt", CONTEXTS, S.q(V.CONTEXT_DEFAULT)))
_CONTEXT = f"{S.classify('prompt', CONTEXTS, S.q(V.CONTEXT_DEFAULT))} || {S.choice(S.lst(V.CONTEXT_SUFFIXES), 'context', 'conv_id')}"
pair_query("context_summary", lambda: C.context(F.col("prompt"), F.col("conv_id"), CONTEXTS), _CONTEXT)
pair_query("layer_classify", lambda: C.layer(F.col("response"), F.col("conv_id"), rules=LAYERS), S.layer("response", "conv_id", rules=LAYERS))
pair_query("layer_cues", lambda: C.layer_by_cues(F.col("response")), S.classify("response", V.LAYER_CUES, S.q(V.DEFAULT_LAYER)))
pair_query("principle_weighted", lambda: C.principle(F.col("prompt"), F.col("conv_id"), {"Chapter 1": 0, "Chapter 2": 1, "Chapter 3": 3}, rules=CHAPTERS), S.principle("prompt", "conv_id", {"Chapter 1": 0, "Chapter 2": 1, "Chapter 3": 3}, rules=CHAPTERS))
pair_query("principle_cues", lambda: C.principle_by_cues(F.col("response")), S.classify("response", V.PRINCIPLE_CUES, S.q(V.DEFAULT_PRINCIPLE)))
_LAYER_SQL = S.layer("response", "conv_id")


def _layer() -> Column:
    return C.layer(F.col("response"), F.col("conv_id"))


pair_query("response_attributes", lambda: joined(C.attributes(_layer(), F.col("conv_id"))), f"array_to_string({S.attributes(_LAYER_SQL, 'conv_id')}, '; ')", "attributes")
pair_query("reasoning_steps", lambda: joined(C.steps(_layer(), F.col("conv_id"))), f"array_to_string({S.steps(_LAYER_SQL, 'conv_id')}, '; ')", "steps")
pair_query("attributes_cues", lambda: joined(C.attributes_by_cues(F.col("response"), CUES)), f"array_to_string(list_filter([{S.q(V.ATTRIBUTES_ALWAYS[0])}, {S.q(V.ATTRIBUTES_ALWAYS[1])}, {S.cues('response', CUES)}], lambda x: x IS NOT NULL), '; ')", "attributes")
_FOUND = f"list_filter([{S.cues('response', CUES[1:])}], lambda x: x IS NOT NULL)"
pair_query("steps_cues", lambda: joined(C.steps_by_cues(F.col("response"), CUES[1:])), f"CASE WHEN len({_FOUND}) = 0 THEN {S.q(V.DEFAULT_STEP)} ELSE array_to_string({_FOUND}, '; ') END", "steps")
_PERSONA_SQL = S.classify("prompt", PERSONAS, S.q(V.DEFAULT_PERSONA))


def _persona() -> Column:
    return C.persona(F.col("prompt"), PERSONAS)


_BANK = S.case([(f"contains({_PERSONA_SQL}, {S.q(n)})", S.lst(p)) for n, p in BANKS], S.lst(V.FOLLOW_UPS))
pair_query("follow_up", lambda: C.follow_up(_persona(), F.col("conv_id"), BANKS), S.choice(_BANK, "follow", "conv_id"), "question")
_ALLOWED = S.case([(f"contains(lower(prompt), {S.q(n)})", S.lst([t for t in ts if t in TOOLS])) for n, ts in TOPICS], S.lst(TOOLS))
pair_query("select_tools", lambda: joined(C.relevant_tools(F.col("prompt"), TOOLS, TOPICS)), f"array_to_string(CASE WHEN len({_ALLOWED}) > 0 THEN {_ALLOWED} ELSE {S.lst(TOOLS)} END, '; ')", "tools")


@query(f"WITH {S.PAIRS} SELECT {_LAYER_SQL} AS layer, count(*) AS n FROM pairs GROUP BY 1")
def layer_distribution(spark, sf_dir):
    return pairs(spark, sf_dir).groupBy(C.layer(F.col("response"), F.col("conv_id")).alias("layer")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {S.PAIRS} SELECT conv_id, {_PERSONA_SQL} AS label FROM pairs")
def persona_by_table(spark, sf_dir):
    return classify_by_table(pairs(spark, sf_dir), "prompt", ["conv_id"], rule_table(spark, PERSONAS), V.DEFAULT_PERSONA).select("conv_id", "label")


# Augmentation
pair_query("paraphrase", lambda: A.paraphrase(F.col("response"), F.col("conv_id"), SYNONYMS), S.paraphrase("response", "conv_id", SYNONYMS), "text")
pair_query("paraphrase_unstripped", lambda: A.paraphrase(F.col("response"), F.col("conv_id"), SYNONYMS, strip=""), S.paraphrase("response", "conv_id", SYNONYMS, strip=""), "text")
pair_query("dynamic_perturbation", lambda: A.dynamic_perturbation(C.context(F.col("prompt"), rules=CONTEXTS), 3, F.col("conv_id")), S.perturbation(S.classify("prompt", CONTEXTS, S.q(V.CONTEXT_DEFAULT)), 3, "conv_id"), "text")
_SHOWN = S.classify("prompt", CONTEXTS, S.q(V.CONTEXT_DEFAULT))
pair_query("context_shift", lambda: A.adjust_prompt(F.col("prompt"), A.shift_context(C.context(F.col("prompt"), rules=CONTEXTS), C.persona(F.col("response"), PERSONAS))), S.adjust_prompt("prompt", S.shift_context(_SHOWN, S.classify("response", PERSONAS, S.q(V.DEFAULT_PERSONA)))), "text")
_AT = f"{S.draw('shift', 'conv_id')} % {len(V.PERSONA_SHIFTS)}"
_SHIFTED = S.case([(f"{_AT} = {i} AND contains('Business Professional', {S.q(n)})", S.replaced(_SHOWN, [(a, b)])) for i, (n, a, b, _) in enumerate(V.PERSONA_SHIFTS)], _SHOWN)
pair_query("persona_shift", lambda: A.adjust_by_persona(F.col("prompt"), A.shift_by_persona(C.context(F.col("prompt"), rules=CONTEXTS), F.lit("Business Professional"), F.col("conv_id"))), S.case([(f"contains({_SHIFTED}, {S.q(b)})", f"prompt || {S.q(s)}") for _, _, b, s in V.PERSONA_SHIFTS], "prompt"), "text")
pair_query("bernoulli_gate", lambda: D.gate(50, "gate", F.col("conv_id")), f"{S.draw('gate', 'conv_id')} % 100 < 50", "taken")
pair_query("head_words", lambda: F.array_join(F.slice(words(F.lower(F.col("prompt"))), 1, 5), " "), f"array_to_string({S.words('lower(prompt)')}[1:5], ' ')", "head")
pair_query("question_appended", lambda: A.with_question(F.when(F.col("conv_id") % 2 == 0, F.concat(F.col("response"), F.lit("? "))).otherwise(F.col("response")), F.lit("More?")), "CASE WHEN conv_id % 2 = 0 THEN response || '? ' ELSE trim(response) || ' More?' END", "text")

_POOL_SQL = S.pairs(_PERSONA_SQL, _CONTEXT, "prompt", "conv_id")


@query(f"WITH {S.PAIRS}, made AS (SELECT conv_id, unnest({_POOL_SQL}) AS p, generate_subscripts({_POOL_SQL}, 1) AS i FROM pairs) SELECT conv_id, i - 1 AS at, p.context AS context, p.prompt AS prompt FROM made")
def augment_pairs(spark, sf_dir):
    made = pairs(spark, sf_dir).select("conv_id", F.posexplode(A.pairs(_persona(), C.context(F.col("prompt"), F.col("conv_id"), CONTEXTS), F.col("prompt"), F.col("conv_id"))).alias("at", "p"))
    return made.select("conv_id", F.col("at").cast("bigint").alias("at"), "p.context", "p.prompt")


_EXTRA = {"Reader": [(" In a hurry.", " Be quick."), (" At ease.", " Take time.")]}
_DEPTH_BASE = f"[{{'context': {S.perturbation(_SHOWN, 2, 'conv_id', 'depth')}, 'prompt': prompt}}]"
_DEPTH_MORE = "CASE WHEN contains(%s, 'Reader') THEN [%s] ELSE [] END" % (_PERSONA_SQL, ", ".join(f"{{'context': {_SHOWN} || {S.q(c)}, 'prompt': prompt || {S.q(p)}}}" for c, p in _EXTRA["Reader"]))
_DEPTH = S.shuffled(f"list_concat(list_concat({_DEPTH_BASE}, {S.pairs(_PERSONA_SQL, _SHOWN, 'prompt', 'conv_id')}), {_DEPTH_MORE})", "depth", "conv_id")


@query(f"WITH {S.PAIRS}, made AS (SELECT conv_id, unnest({_DEPTH}) AS p, generate_subscripts({_DEPTH}, 1) AS i FROM pairs) SELECT conv_id, i - 1 AS at, p.context AS context, p.prompt AS prompt FROM made")
def augment_depth(spark, sf_dir):
    pool = A.pairs_in_depth(_persona(), C.context(F.col("prompt"), rules=CONTEXTS), F.col("prompt"), 2, F.col("conv_id"), _EXTRA)
    return pairs(spark, sf_dir).select("conv_id", F.posexplode(pool).alias("at", "p")).select("conv_id", F.col("at").cast("bigint").alias("at"), "p.context", "p.prompt")


# The dialects' own tables
_DRAWN_PERSONA = lambda names: D.choice(D.strings(names), "dialect", F.col("conv_id"))
_SEEKERS = [*L.PUBLICATION_PERSONA_PAIRS, "Fitness Seeker > Parent", "Other"]
_PUBLIC = S.choice(S.lst(_SEEKERS), "dialect", "conv_id")
for _name, _synonyms, _suffixes, _strip in (("proactive", L.PROACTIVE_SYNONYMS, L.PROACTIVE_SUFFIXES, ".,?!"), ("publication", L.PUBLICATION_SYNONYMS, L.PUBLICATION_SUFFIXES, "")):
    # Every other word of a text becomes one that has synonyms, so that all entries are met.
    _fed = lambda s: F.concat_ws(" ", F.col("response"), F.lit(" ".join([*s, *(w.title() + "." for w in s)])))
    pair_query(f"paraphrase_{_name}", lambda s=_synonyms, x=_strip, f=_fed: A.paraphrase(f(s), F.col("conv_id"), s, x), S.paraphrase(f"(response || ' ' || {S.q(' '.join([*_synonyms, *(w.title() + '.' for w in _synonyms)]))})", "conv_id", _synonyms, strip=_strip), "text")
    pair_query(f"context_{_name}", lambda s=_suffixes: C.context(F.col("prompt"), F.col("conv_id"), CONTEXTS, s), f"{S.classify('prompt', CONTEXTS, S.q(V.CONTEXT_DEFAULT))} || {S.choice(S.lst(_suffixes), 'context', 'conv_id')}")
pair_query("attributes_publication", lambda: joined(C.attributes(_layer(), F.col("conv_id"), pools=L.PUBLICATION_ATTRIBUTES)), f"array_to_string({S.attributes(_LAYER_SQL, 'conv_id', L.PUBLICATION_ATTRIBUTES)}, '; ')", "attributes")
pair_query("steps_publication", lambda: joined(C.steps(_layer(), F.col("conv_id"), pools=L.PUBLICATION_STEPS, most=4)), f"array_to_string({S.steps(_LAYER_SQL, 'conv_id', L.PUBLICATION_STEPS, 4)}, '; ')", "steps")
_ASKERS = [*(name for name, _ in L.PROACTIVE_BANKS), "Other"]
_ASKER = S.choice(S.lst(_ASKERS), "dialect", "conv_id")
pair_query("follow_up_proactive", lambda: C.follow_up(_DRAWN_PERSONA(_ASKERS), F.col("conv_id"), L.PROACTIVE_BANKS, general=L.PROACTIVE_QUESTIONS), S.choice(S.case([(f"contains({_ASKER}, {S.q(n)})", S.lst(b)) for n, b in L.PROACTIVE_BANKS], S.lst(L.PROACTIVE_QUESTIONS)), "follow", "conv_id"), "question")
_PAIR_SQL = "SELECT conv_id, i - 1 AS at, p.context AS context, p.prompt AS prompt FROM made"
_PROACTIVE_POOL = S.pairs(_PUBLIC, _SHOWN, "prompt", "conv_id", L.PROACTIVE_PAIRS)
_PUBLIC_MORE = S.case([(f"contains({_PUBLIC}, {S.q(k)})", "[" + ", ".join(f"{{'context': {_SHOWN} || {S.q(c)}, 'prompt': prompt || {S.q(p)}}}" for c, p in v) + "]") for k, v in L.PUBLICATION_PERSONA_PAIRS.items()], "[]")
_PUBLIC_POOL = S.shuffled(f"list_concat(list_concat({_DEPTH_BASE}, {S.pairs(_PUBLIC, _SHOWN, 'prompt', 'conv_id', L.PUBLICATION_PAIRS)}), {_PUBLIC_MORE})", "depth", "conv_id")


def _pairs_shown(spark: SparkSession, sf_dir: str, pool: Column) -> DataFrame:
    return pairs(spark, sf_dir).select("conv_id", F.posexplode(pool).alias("at", "p")).select("conv_id", F.col("at").cast("bigint").alias("at"), "p.context", "p.prompt")


@query(f"WITH {S.PAIRS}, made AS (SELECT conv_id, unnest({_PROACTIVE_POOL}) AS p, generate_subscripts({_PROACTIVE_POOL}, 1) AS i FROM pairs) {_PAIR_SQL}")
def augment_proactive(spark, sf_dir):
    return _pairs_shown(spark, sf_dir, A.pairs(_DRAWN_PERSONA(_SEEKERS), C.context(F.col("prompt"), rules=CONTEXTS), F.col("prompt"), F.col("conv_id"), L.PROACTIVE_PAIRS))


@query(f"WITH {S.PAIRS}, pooled AS (SELECT conv_id, {_PUBLIC_POOL} AS pool FROM pairs), made AS (SELECT conv_id, unnest(pool) AS p, generate_subscripts(pool, 1) AS i FROM pooled) {_PAIR_SQL}")
def augment_publication(spark, sf_dir):
    return _pairs_shown(spark, sf_dir, A.pairs_in_depth(_DRAWN_PERSONA(_SEEKERS), C.context(F.col("prompt"), rules=CONTEXTS), F.col("prompt"), 2, F.col("conv_id"), L.PUBLICATION_PERSONA_PAIRS, pool=L.PUBLICATION_PAIRS))


_RECORDS = f"""{S.PAIRS},
ctx AS (SELECT *, {S.classify('prompt', CONTEXTS, S.q(V.CONTEXT_DEFAULT))} || {S.choice(S.lst(V.CONTEXT_SUFFIXES), 'convmill-context', 'conv_id')} AS context, {_PERSONA_SQL} AS persona0, {S.layer('response', 'conv_id', 'convmill-layer')} AS layer FROM pairs),
pool AS (SELECT *, {S.pairs('persona0', 'context', 'prompt', 'conv_id')} AS pool FROM ctx),
drawn AS (SELECT *, list_transform([1, 2], lambda n: pool[{S.draw('drawn', 'conv_id', 'n')} % len(pool) + 1]) AS d FROM pool),
flat AS (SELECT conv_id, response, layer, unnest(range(3)) AS variant, unnest(list_concat([{{'context': context, 'prompt': prompt}}], d)) AS p FROM drawn),
rows AS (SELECT conv_id, response, layer, variant, p.context AS context, p.prompt AS prompt, conv_id || '-' || variant AS one, {S.classify('p.prompt', PERSONAS, S.q(V.DEFAULT_PERSONA))} AS persona FROM flat),
records AS (SELECT conv_id, variant, {S.digest('convmill', 'conv_id', 'variant')} AS intent_id, persona AS persona_archetype, {S.principle('prompt', 'one')} AS governing_principle, layer AS capability_layer,
    {S.classify('prompt', INTENTS, S.q(V.DEFAULT_INTENT))} AS user_intent, context AS context_summary, prompt AS application_prompt,
    {S.paraphrase('response', 'one', SYNONYMS)} || ' ' || {S.choice(S.lst(V.FOLLOW_UPS), 'follow', 'one')} AS ideal_response_final,
    array_to_string({S.attributes('layer', 'one')}, '; ') AS ideal_response_attributes, array_to_string({S.steps('layer', 'one')}, '; ') AS ideal_response_cot FROM rows)"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipelines.intent_records(pairs(spark, sf_dir), dialect=DIALECT)


@query(f"WITH {_RECORDS} SELECT * FROM records")
def intent_record(spark, sf_dir):
    return records(spark, sf_dir).withColumns({c: joined(F.col(c)) for c in ("ideal_response_attributes", "ideal_response_cot")})


@query(f"WITH {_RECORDS} SELECT conv_id, variant, context_summary, application_prompt FROM records")
def augment_explode(spark, sf_dir):
    return records(spark, sf_dir).select("conv_id", "variant", "context_summary", "application_prompt")


_ASKED = "CASE WHEN conv_id % 2 = 0 THEN ideal_response_final ELSE 'Done.' END"


@query(f"WITH {_RECORDS} SELECT intent_id, CASE WHEN conv_id % 2 = 0 THEN ideal_response_final ELSE 'Done. ' || {S.choice(S.lst(V.FOLLOW_UPS), 'follow', 'intent_id')} END AS ideal_response_final, CASE WHEN conv_id % 2 = 0 THEN ideal_response_cot ELSE array_to_string({S.steps('capability_layer', 'intent_id')}, '; ') END AS ideal_response_cot FROM records")
def intent_update(spark, sf_dir):
    made = records(spark, sf_dir).withColumn("ideal_response_final", F.when(F.col("conv_id") % 2 == 0, F.col("ideal_response_final")).otherwise("Done."))
    return pipelines.updated(made).select("intent_id", "ideal_response_final", joined(F.col("ideal_response_cot")).alias("ideal_response_cot"))


_CURATED_N = "(SELECT count(*) FROM unique_records)"
_CURATED_RANK = S.digest("curate", "intent_id")


@query(f"""WITH {_RECORDS}, unique_records AS (SELECT * FROM records QUALIFY row_number() OVER (PARTITION BY persona_archetype, application_prompt, ideal_response_final ORDER BY intent_id) = 1)
SELECT intent_id, CASE WHEN row_number() OVER (ORDER BY {_CURATED_RANK}, intent_id) <= ceil(0.1 * {_CURATED_N}) THEN 'validation' ELSE 'train' END AS split FROM unique_records""")
def curated_records(spark, sf_dir):
    return pipelines.curated(records(spark, sf_dir), 0.1).select("intent_id", "split")


# Variants with tool calls
_KINDS = S.variant_kinds(5, "conv_id")
_VARIANT = f"""{S.PAIRS},
dealt AS (SELECT conv_id, prompt, response, unnest(range(1, 6)) AS variant, unnest({_KINDS}) AS kind FROM pairs),
picked AS (SELECT *, {S.shuffled(S.lst(TOOLS), 'variant', "conv_id || '-' || (variant - 1)")} AS tools FROM dealt),
lines AS (SELECT *, {S.call('tools[1]', 'prompt')} AS c1, {S.answer('tools[1]', 'prompt')} AS a1, {S.call('tools[2]', 'prompt')} AS c2, {S.answer('tools[2]', 'prompt')} AS a2 FROM picked),
made AS (SELECT conv_id, variant, kind, CASE kind WHEN 'none' THEN response WHEN 'single' THEN concat_ws(chr(10), c1, a1, {S.q(V.ADVICE)} || response) ELSE concat_ws(chr(10), c1, a1, c2, a2, {S.q(V.ADVICE)} || response) END AS content FROM lines)"""
_LAST = "(SELECT conv_id, arg_max(text, turn) AS content FROM conversations WHERE role = 'assistant' GROUP BY conv_id)"


def made_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.variants(M.nested(read(spark, sf_dir, "conversations")), 5, TOOLS)


def _last_text(messages: Column) -> Column:
    return F.get(messages, M.last_index(messages, "assistant"))["content"]


@query(f"WITH {_VARIANT} SELECT * FROM made UNION ALL SELECT conv_id, 0, 'original', content FROM {_LAST}")
def variant_tool_call(spark, sf_dir):
    return made_variants(spark, sf_dir).select("conv_id", "variant", "kind", _last_text(F.col("messages")).alias("content")).where("content IS NOT NULL")


@query(f"WITH {_VARIANT} SELECT kind, count(*) AS n FROM (SELECT kind FROM made UNION ALL SELECT 'original' FROM (SELECT DISTINCT conv_id FROM conversations)) GROUP BY kind")
def variant_kinds(spark, sf_dir):
    return made_variants(spark, sf_dir).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_VARIANT} SELECT conv_id, variant, NOT (conv_id % 5 IN (1, 3) OR conv_id % 5 = 2 AND contains(content, 'tool_call')) AS valid FROM made")
def variant_valid(spark, sf_dir):
    # Some answers get an unfinished call, a call that doesn't parse, or lose their last brace, or no message at all.
    made, k = made_variants(spark, sf_dir).where("variant > 0"), F.col("conv_id") % 5
    broken = F.when(k == 1, F.concat(F.col("content"), F.lit(' {"tool_call": {"name": "x"'))).when(k == 2, F.replace(F.col("content"), F.lit('"arguments": {'), F.lit('"arguments": {,'))).otherwise(F.col("content"))
    messages = M.replace_last(F.col("messages"), "assistant", broken)
    some = made.withColumn("content", _last_text(F.col("messages"))).withColumn("messages", F.when(k == 3, F.slice("messages", 1, 0)).otherwise(messages))
    return some.select("conv_id", "variant", X.valid(F.col("messages")).alias("valid"))


_ONE_TOOL = S.choice(S.lst(V.TOOLS), "tool", "conv_id")


def _args() -> Column:
    return X.arguments(D.choice(D.strings(V.TOOLS), "tool", F.col("conv_id")), F.col("prompt"))


pair_query("tool_arguments", lambda: F.array_join(F.transform(F.map_entries(_args()), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";"), S.arguments_text(_ONE_TOOL, "prompt"), "arguments")
pair_query("tool_answers", lambda: X.answer(D.choice(D.strings(V.TOOLS), "tool", F.col("conv_id")), _args()), S.answer(_ONE_TOOL, "prompt"), "answer")


@query(f"SELECT p_partkey, {S.calculation('text')} AS expression FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE p_brand || ' ' || p_size || CASE WHEN p_partkey % 3 = 1 THEN ' at ' || p_partkey || '.5' ELSE '' END END AS text FROM part)")
def calc_args(spark, sf_dir):
    text = F.when(F.col("p_partkey") % 3 == 0, F.col("p_type")).otherwise(F.concat("p_brand", F.lit(" "), F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 3 == 1, F.concat(F.lit(" at "), F.col("p_partkey").cast("string"), F.lit(".5"))).otherwise("")))
    return read(spark, sf_dir, "part").select("p_partkey", X.calculation(text).alias("expression"))


@query(f"WITH {_VARIANT}, c AS (SELECT conv_id, variant, prompt, unnest(CASE kind WHEN 'single' THEN tools[1:1] WHEN 'multi' THEN tools[1:2] ELSE [] END) AS name, unnest(range(2)) AS call FROM picked) SELECT conv_id, variant, call, name, {S.arguments_text('name', 'prompt')} AS arguments FROM c WHERE name IS NOT NULL")
def tool_call_extract(spark, sf_dir):
    texts = made_variants(spark, sf_dir).where("variant > 0").select("conv_id", "variant", _last_text(F.col("messages")).alias("content"))
    shown = F.array_join(F.transform(F.map_entries("arguments"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return K.extract_calls(texts, "content", ["conv_id", "variant"]).select("conv_id", "variant", "call", "name", shown.alias("arguments"))


_RUNNABLE = ["news_tool", "calendar_tool", "get_current_weather", "missing_tool"]


@query(f"WITH {S.PAIRS} SELECT conv_id, " + S.case([(f"t = {S.q(n)}", f"{S.q(f'Tool {n} result: ' + V.LOOKUPS[n].split('{}')[0])} || prompt || {S.q(V.LOOKUPS[n].split('{}')[1])}") for n in _RUNNABLE[:3]], "'Unknown tool: ' || t") + f" AS result FROM (SELECT *, {S.choice(S.lst(_RUNNABLE), 'run', 'conv_id')} AS t FROM pairs)")
def tool_execute(spark, sf_dir):
    calls = pairs(spark, sf_dir).select("conv_id", D.choice(D.strings(_RUNNABLE), "run", F.col("conv_id")).alias("name"), F.create_map(F.lit("query"), F.col("prompt")).alias("arguments"))
    return K.execute_calls(calls).select("conv_id", "result")


@query("SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'Tool shout result: ' || upper(s_name) WHEN 1 THEN 'Tool mirror result: ' || reverse(s_name) WHEN 2 THEN 'Tool shout invalid args: Missing required argument for shout' ELSE 'Unknown tool: whisper' END AS result FROM supplier")
def tool_registry(spark, sf_dir):
    registry = K.Registry()
    registry.register("shout")(F.upper)
    registry.register_function(spark, "mirror", lambda x: x[::-1])
    k = F.col("s_suppkey") % 4
    name = F.when(k == 1, "mirror").when(k == 3, "whisper").otherwise("shout")
    args = F.create_map(F.lit("query"), F.when(k != 2, F.col("s_name")))
    return read(spark, sf_dir, "supplier").select("s_suppkey", registry.execute(name, args).alias("result"))


def _asks_once(messages: list[dict]) -> str:
    """A model that has its question worked out, then tells the result."""
    if len(messages) == 1:
        return f'Need data: {{"tool_call": {{"name": "calc_tool", "arguments": {{"query": "{messages[0]["content"]}"}}}}}}'
    return "It is " + messages[-1]["content"].removeprefix("Tool results: ")


@query("SELECT p_partkey, 'It is ' || (p_partkey * 3 + p_size) AS answer FROM part")
def agent_loop(spark, sf_dir):
    @F.pandas_udf("string")
    def asked(questions: pd.Series) -> pd.Series:
        return questions.map(lambda q: K.converse(_asks_once, q, lambda name, args: K.calculate(args["query"]), strict=True))

    question = F.concat(F.col("p_partkey").cast("string"), F.lit(" * 3 + "), F.col("p_size").cast("string"))
    return read(spark, sf_dir, "part").select("p_partkey", asked(question).alias("answer"))


@query("""SELECT p_partkey, CAST(0 AS BIGINT) AS call, 'nested' AS name, CASE WHEN p_partkey % 8 = 0 THEN p_name ELSE repeat('{"a":', p_partkey % 8) || '"' || p_name || '"' || repeat('}', p_partkey % 8) END AS a FROM part UNION ALL SELECT p_partkey, 1, 'inner', p_name FROM part WHERE p_partkey % 3 = 0""")
def nested_calls(spark, sf_dir):
    # Arguments nest one to eight levels; some texts go on with a call whose name has braces around it in a string, or one that is not closed.
    k = (F.col("p_partkey") % 8 + 1).cast("int")
    told = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(' {"tool_call": {"name": "inner", "note": "}{\\"", "arguments": {"a": "'), "p_name", F.lit('"}}}'))).when(F.col("p_partkey") % 3 == 1, ' {"tool_call": {"name": "open"').otherwise("")
    text = F.concat(F.lit('Need data: {"tool_call": {"name": "nested", "arguments": '), F.repeat(F.lit('{"a": '), k), F.lit('"'), "p_name", F.lit('"'), F.repeat(F.lit("}"), k), F.lit("}}"), told)
    texts = read(spark, sf_dir, "part").select("p_partkey", text.alias("text"))
    N.register(spark)
    found = spark.sql("SELECT p_partkey, c.call, c.name, c.arguments FROM {t} AS t, LATERAL tool_calls(t.text) AS c", t=texts)
    return found.select("p_partkey", "call", "name", F.from_json("arguments", "map<string,string>")["a"].alias("a"))


_TOLD = lambda r: f"CASE WHEN {r} > conv_id % 4 THEN '' WHEN {r} = 1 THEN ' {{\"tool_call\": {{\"name\": \"news_tool\", \"arguments\": {{\"query\": \"a' || conv_id || '\"}}}}}} {{\"tool_call\": {{\"name\": \"none\", \"arguments\": {{}}}}}}' ELSE ' {{\"tool_call\": {{\"name\": \"news_tool\", \"arguments\": {{\"query\": \"b' || conv_id || '\"}}}}}}' END"
_NEWS = [S.q(x) for x in V.LOOKUPS["news_tool"].split("{}")]
_GOT = lambda r: f"'Tool news_tool result: ' || {_NEWS[0]} || CASE WHEN {r} = 1 THEN 'a' ELSE 'b' END || conv_id || {_NEWS[1]} || CASE WHEN {r} = 1 THEN chr(10) || 'Unknown tool: none' ELSE '' END"


@query(f"""WITH {S.PAIRS}, said AS (SELECT conv_id, list(coalesce(text, '') ORDER BY turn) AS turns FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
t AS (SELECT conv_id, trim(prompt) AS question, turns, least(conv_id % 4 + 1, len(turns) + 1, 3) AS ends FROM pairs JOIN said USING (conv_id))
SELECT conv_id, ends AS rounds, CASE WHEN ends > len(turns) THEN 'failed' WHEN conv_id % 4 < ends THEN 'answered' ELSE 'unfinished' END AS status, CASE WHEN ends > len(turns) THEN 'Error in model inference: no turn is left' ELSE turns[ends] || {_TOLD('ends')} END AS answer,
md5(question || array_to_string(list_transform(range(1, ends), lambda r: chr(10) || 'Previous output: ' || turns[r] || {_TOLD('r')} || chr(10) || 'Tool results:' || chr(10) || {_GOT('r')} || chr(10) || 'Now integrate and continue:'), '')) AS prompt_md5 FROM t""")
def agent_rounds(spark, sf_dir):
    # Each chat is played again: its answers come turn by turn from the table, the first ones with calls worked in.
    turns = read(spark, sf_dir, "conversations").where("role = 'assistant'")
    said = turns.select(F.col("conv_id").alias("said_id"), F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).alias("at"), F.coalesce("text", F.lit("")).alias("said"))

    def ask(open_: DataFrame, k: int) -> DataFrame:
        call = lambda q: F.concat(F.lit(' {"tool_call": {"name": "news_tool", "arguments": {"query": "' + q), F.col("conv_id").cast("string"), F.lit('"}}}'))
        calls = F.when(F.lit(k) > F.col("conv_id") % 4, "").otherwise(F.concat(call("a"), F.lit(' {"tool_call": {"name": "none", "arguments": {}}}')) if k == 1 else call("b"))
        joined_ = open_.join(said.where(F.col("at") == k), F.col("conv_id") == F.col("said_id"), "left")
        return joined_.withColumns({"output": F.concat("said", calls), "error": F.when(F.col("said").isNull(), "no turn is left")})

    asked = G.converse(pairs(spark, sf_dir).select("conv_id", F.col("prompt").alias("question")), ask, most=3)
    return asked.select("conv_id", "rounds", "status", "answer", F.md5("prompt").alias("prompt_md5"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 2 THEN 'Error: Calculation failed - integer modulo by zero' ELSE CAST(CASE WHEN l_linenumber % 3 = 0 THEN l_orderkey + 3 * l_partkey ELSE -(l_suppkey // 7) END AS VARCHAR) END AS result FROM lineitem")
def safe_calc(spark, sf_dir):
    k = F.col("l_linenumber") % 3
    s = lambda c: F.col(c).cast("string")
    text = F.when(k == 0, F.concat(s("l_orderkey"), F.lit(" + 3 * "), s("l_partkey"))).when(k == 1, F.concat(F.lit("-("), s("l_suppkey"), F.lit(" // 7)"))).otherwise(F.concat(s("l_suppkey"), F.lit(" % 0")))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", K.calculate_column(text).alias("result"))


# Preference pairs
_HAS = "(contains(response, 'tool_call') OR contains(response, 'Need data:'))"
_MARKED = "CASE WHEN conv_id % 3 = 0 THEN response || ' Need data: {x}' WHEN conv_id % 3 = 1 THEN '  tool_call ' || response ELSE response END"
_UNUSED = f"list_filter({S.lst(V.TOOLS)}, lambda t: NOT contains(response, t))"
_SAFE = """substr(replace(replace(replace(prompt, '''', '\\'''), '"', '\\"'), chr(10), ' '), 1, 64)"""
_WRONG = S.case([(f"tool = {S.q(t)}", f"'Need data: {{\"tool_call\": {{\"name\": \"{t}\", \"arguments\": {{' || {a} || '}}}}}}'") for t, a in [("calc_tool", "'\"query\": \"2+2\"'"), ("python_repl", "'\"code\": \"print(''test'')\"'"), ("read_file", "'\"filepath\": \"example.txt\"'"), ("write_file", "'\"filepath\": \"example.txt\", \"content\": \"test\"'"), ("get_current_weather", f"'\"location\": \"' || {S.json_body(_SAFE)} || '\"'")]], f"'Need data: {{\"tool_call\": {{\"name\": \"' || tool || '\", \"arguments\": {{\"query\": \"' || {S.json_body(_SAFE)} || '\"}}}}}}'")
_WITHOUT = f"coalesce(nullif(regexp_replace(CASE WHEN contains(response, 'Need data:') THEN split_part(response, 'Need data:', 1) WHEN contains(response, 'tool_call') THEN split_part(response, 'tool_call', 1) ELSE response END, {S.q(f'^{SPACES}|{SPACES}$')}, '', 'g'), ''), {S.q(V.UNSURE)})"


def marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("conv_id") % 3 == 0, F.concat(F.col("response"), F.lit(" Need data: {x}"))).when(F.col("conv_id") % 3 == 1, F.concat(F.lit("  tool_call "), F.col("response"))).otherwise(F.col("response"))
    return pairs(spark, sf_dir).withColumn("response", text)


_MARKED_CTE = f"{S.PAIRS}, marked AS (SELECT conv_id, prompt, {_MARKED} AS response FROM pairs), tooled AS (SELECT *, {S.choice(_UNUSED, 'wrong', 'conv_id')} AS tool FROM marked)"


@query(f"WITH {_MARKED_CTE} SELECT conv_id, '[INST]' || prompt || '[/INST]' AS prompt, response AS chosen, CASE WHEN {_HAS} THEN {_WITHOUT} ELSE {_WRONG} END AS rejected FROM tooled")
def preference_pairs(spark, sf_dir):
    return P.preference_pairs(marked(spark, sf_dir))


@query(f"WITH {_MARKED_CTE} SELECT conv_id, CASE WHEN {_HAS} THEN {_WITHOUT} ELSE {_WRONG} END AS rejected FROM tooled")
def preference_checked(spark, sf_dir):
    return P.checked(P.preference_pairs(marked(spark, sf_dir))).select("conv_id", "rejected")


@query(f"WITH {_MARKED_CTE} SELECT conv_id, {_HAS} AS has_call, {_WITHOUT} AS remainder FROM marked")
def tool_presence(spark, sf_dir):
    return marked(spark, sf_dir).select("conv_id", P.has_call(F.col("response")).alias("has_call"), P.without_call(F.col("response")).alias("remainder"))


@query(f"SELECT s_suppkey, array_to_string(list_filter({S.lst(V.TOOLS)}, lambda t: NOT contains('search_web calc_tool' || s_name, t)), '; ') AS unused FROM supplier")
def unused_tools(spark, sf_dir):
    used = F.filter(D.strings(V.TOOLS), lambda t: F.contains(F.concat(F.lit("search_web calc_tool"), F.col("s_name")), t))
    return read(spark, sf_dir, "supplier").select("s_suppkey", joined(F.array_except(D.strings(V.TOOLS), used)).alias("unused"))


# Dedup, sampling, splits
@query("SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lang, source, text ORDER BY doc_id) = 1")
def dedup_exact(spark, sf_dir):
    return U.keep_first(read(spark, sf_dir, "documents"), ["lang", "source", "text"], ["doc_id"]).select("doc_id")


@query("SELECT md5(coalesce(text, '')) AS digest, min(doc_id // 4) AS place FROM documents GROUP BY text")
def dedup_ties(spark, sf_dir):
    some = read(spark, sf_dir, "documents").select("text", F.floor(F.col("doc_id") / 4).alias("place"))
    return U.keep_first(some.unionAll(some), ["text"], ["place"]).select(F.md5(F.coalesce("text", F.lit(""))).alias("digest"), "place")


@query(f"SELECT doc_id FROM documents ORDER BY {S.digest('sample', 'doc_id')}, doc_id LIMIT 100")
def sample_n(spark, sf_dir):
    return U.sample(read(spark, sf_dir, "documents").select("doc_id"), 100, ["doc_id"])


@query(f"SELECT d.range AS draw, r.doc_id FROM range(150) d JOIN {S.ranked('documents', 'doc_id', 'resample-rows')} r ON r.rank = {S.draw('resample', 'd.range')} % (SELECT count(*) FROM documents) + 1")
def sample_replace(spark, sf_dir):
    return U.sample_with_replacement(read(spark, sf_dir, "documents").select("doc_id"), 150, ["doc_id"]).select("draw", "doc_id")


@query(f"SELECT doc_id, CASE WHEN rank <= ceil(0.15 * (SELECT count(*) FROM documents)) THEN 'validation' ELSE 'train' END AS split FROM {S.ranked('documents', 'doc_id', 'split')}")
def split_exact(spark, sf_dir):
    return U.split(read(spark, sf_dir, "documents").select("doc_id"), 0.15, ["doc_id"]).select("doc_id", "split")


@query("SELECT count(*) AS n, 'train' AS split FROM region")
def split_of_one(spark, sf_dir):
    return U.split(read(spark, sf_dir, "region").agg(F.count(F.lit(1)).alias("n")), 0.5, ["n"])


@query("SELECT doc_id FROM documents WHERE doc_id % 5 > 1 AND text IS NOT NULL AND regexp_matches(text, '[^\\s]')")
def blank_dropped(spark, sf_dir):
    # Texts of white space and missing ones are planted: one in five each.
    text = F.when(F.col("doc_id") % 5 == 0, " \n\t ").when(F.col("doc_id") % 5 > 1, F.col("text"))
    return U.drop_blank(read(spark, sf_dir, "documents").withColumn("text", text)).select("doc_id")


@query(f"WITH {S.PAIRS}, r AS {S.ranked('pairs', 'conv_id', 'review')} SELECT conv_id, rank <= greatest(1, floor(0.1 * (SELECT count(*) FROM pairs))) AS review, CASE WHEN rank <= greatest(1, floor(0.1 * (SELECT count(*) FROM pairs))) THEN {S.paraphrase('response', 'conv_id', SYNONYMS)} ELSE response END AS response FROM r")
def review_flag(spark, sf_dir):
    return U.flag_for_review(pairs(spark, sf_dir), 0.1, ["conv_id"], "response", A.paraphrase(F.col("response"), F.col("conv_id"), SYNONYMS)).select("conv_id", "review", "response")


@query(f"SELECT doc_id, len({S.words('text')}) AS n_ids FROM documents")
def length_buckets(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("doc_id", T.WordTokenizer().ids(F.col("text")).alias("input_ids"))
    return U.length_bucketed(rows, "input_ids", 8).select("doc_id", F.size("input_ids").cast("bigint").alias("n_ids"))


@query("WITH m AS (SELECT conv_id, text FROM conversations WHERE role = 'user') SELECT conv_id, 0 AS variant, text FROM m UNION ALL SELECT conv_id, v, text || ' v' || v FROM m, range(1, 3) r(v)")
def union_variants(spark, sf_dir):
    users = read(spark, sf_dir, "conversations").where("role = 'user'")
    made = users.select("conv_id", F.explode(F.sequence(F.lit(1), F.lit(2))).alias("v"), "text").select("conv_id", F.col("v").cast("bigint").alias("variant"), F.concat("text", F.lit(" v"), F.col("v").cast("string")).alias("text"))
    return users.select("conv_id", F.lit(0).cast("bigint").alias("variant"), "text").unionByName(made)


# Reports
@query("SELECT 'lang' AS field, lang AS value, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents WHERE source IS NOT NULL GROUP BY source")
def distribution_sets(spark, sf_dir):
    return R.distribution(read(spark, sf_dir, "documents"), "lang", "source")


@query("SELECT lang, round(count(DISTINCT text) / count(text), 9) AS unique_ratio FROM documents GROUP BY lang")
def unique_ratio(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy("lang").agg(F.round(F.count_distinct("text") / F.count("text"), 9).alias("unique_ratio"))


def _diversity_sql(source: str, field: str, key: str, most: int) -> str:
    n = f"(SELECT count(*) FROM {source})"
    i, j = f"{S.draw('pairs-a', 'd.range')} % {n}", f"{S.draw('pairs-b', 'd.range')} % ({n} - 1)"
    ranked = S.ranked(source, key, "pairs-rows")
    a, b = (f"list_distinct({S.words(f'{t}.{field}')})" for t in "ab")
    return f"""SELECT {S.q(field)} AS field, (SELECT round(count(DISTINCT {field}) / count({field}), 9) FROM {source}) AS unique_ratio, round(avg(coalesce(len(list_intersect({a}, {b})) / nullif(len(list_distinct(list_concat({a}, {b}))), 0), 0)), 9) AS avg_jaccard,
    avg(coalesce(len(list_intersect({a}, {b})) / nullif(len(list_distinct(list_concat({a}, {b}))), 0), 0)) < 0.7 AS is_diverse
    FROM range(least({n} * ({n} - 1) // 2, {most})) d JOIN {ranked} a ON a.rank = {i} + 1 JOIN {ranked} b ON b.rank = {j} + CASE WHEN {j} >= {i} THEN 1 ELSE 0 END + 1"""


@query(f"WITH {S.PAIRS} {_diversity_sql('pairs', 'prompt', 'conv_id', R.PAIRS_MOST)} UNION ALL {_diversity_sql('pairs', 'response', 'conv_id', R.PAIRS_MOST)}")
def diversity_report(spark, sf_dir):
    report = R.diversity_report(pairs(spark, sf_dir), ["prompt", "response"], ["conv_id"])
    return report.withColumns({c: F.round(c, 9) for c in ("unique_ratio", "avg_jaccard")})


@query(f"SELECT d.item_id AS item_id, round(len(list_intersect(list_distinct({S.words('d.text')}), list_distinct({S.words('e.text')}))) / len(list_distinct(list_concat({S.words('d.text')}, {S.words('e.text')}))), 9) AS likeness FROM benchmark d JOIN benchmark e ON e.item_id = d.item_id + 1")
def word_sets(spark, sf_dir):
    items = read(spark, sf_dir, "benchmark")
    after = items.select((F.col("item_id") - 1).alias("item_id"), F.col("text").alias("next"))
    return items.join(after, "item_id").select("item_id", F.round(R.jaccard(F.col("text"), F.col("next")), 9).alias("likeness"))


# Rendering and tokens
_SYSTEM = S.case([(f"capability_layer = {S.q(k)}", S.q(v)) for k, v in V.SYSTEM_PROMPTS.items()], S.q(V.DEFAULT_SYSTEM_PROMPT))
_GATE = f"{S.draw('render', 'intent_id')} % 100 < 50"


@query(f"""WITH {_RECORDS}, g AS (SELECT *, CASE WHEN {_GATE} THEN {S.shift_context('context_summary', 'persona_archetype')} ELSE context_summary END AS ctx FROM records)
SELECT intent_id, 'System: ' || {_SYSTEM} || chr(10) || 'Context: ' || ctx || chr(10) || 'User Intent: ' || user_intent || chr(10) || 'Persona: ' || persona_archetype || chr(10) || 'User: ' || CASE WHEN {_GATE} THEN {S.adjust_prompt('application_prompt', 'ctx')} ELSE application_prompt END || chr(10) || 'Assistant: ' || ideal_response_final || chr(10) AS text FROM g""")
def chat_render(spark, sf_dir):
    return H.render(records(spark, sf_dir), "intent_id").select("intent_id", "text")


@query(f"WITH {_RECORDS} SELECT conv_id, variant, CASE WHEN variant = 1 THEN 'missing_field' END AS reject_reason FROM records")
def required_fields(spark, sf_dir):
    some = records(spark, sf_dir).withColumn("user_intent", F.when(F.col("variant") != 1, F.col("user_intent")))
    return H.render(some).select("conv_id", "variant", "reject_reason")


pair_query("instruction_prompt", lambda: H.instruction(F.col("prompt")), "'[INST]' || prompt || '[/INST]'", "text")
_CODES = "list_transform(list_filter(string_split(%s, ''), lambda c: c <> ''), lambda c: unicode(c) %% 255)"


def ints(array: Column) -> Column:
    return F.array_join(F.transform(array, lambda x: x.cast("string")), " ")


@query(f"SELECT item_id, array_to_string({_CODES % 'text'}[1:2048], ' ') AS ids FROM benchmark")
def char_tokens(spark, sf_dir):
    return T.tokenize(read(spark, sf_dir, "benchmark"), T.CharacterTokenizer()).select("item_id", ints(F.col("input_ids")).alias("ids"))


_TEMPLATE = [101, 114]
_BATCH = f"""t AS (SELECT item_id, item_id // 8 AS batch_id, {_CODES % 'text'}[1:2048] AS ids FROM benchmark), w AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS n FROM t),
p AS (SELECT item_id, batch_id, len(ids) AS k, ids || list_transform(range(n - len(ids)), lambda z: 0) AS ids FROM w),
s AS (SELECT *, coalesce(list_min(list_filter(range(1, len(ids)), lambda i: ids[i] = {_TEMPLATE[0]} AND ids[i + 1] = {_TEMPLATE[1]})) + 1, len(ids)) AS start FROM p)"""


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.tokenize(read(spark, sf_dir, "benchmark"), T.CharacterTokenizer()).select("item_id", F.floor(F.col("item_id") / 8).alias("batch_id"), "input_ids")
    return T.collate(rows, "batch_id", _TEMPLATE)


@query(f"WITH {_BATCH} SELECT item_id, array_to_string(ids, ' ') AS ids, array_to_string(list_transform(ids, lambda x: CASE WHEN x = 0 THEN 0 ELSE 1 END), ' ') AS mask FROM s")
def pad_batch(spark, sf_dir):
    return batches(spark, sf_dir).select("item_id", ints(F.col("input_ids")).alias("ids"), ints(F.col("attention_mask")).alias("mask"))


@query(f"WITH {_BATCH} SELECT item_id, start, array_to_string(list_transform(ids, lambda x, i: CASE WHEN i - 1 < start OR x = 0 THEN -100 ELSE x END), ' ') AS labels FROM s")
def label_mask(spark, sf_dir):
    return batches(spark, sf_dir).select("item_id", T.response_start(F.col("input_ids"), _TEMPLATE).cast("bigint").alias("start"), ints(F.col("labels")).alias("labels"))


@query(f"SELECT item_id, CASE WHEN item_id % 3 = 2 THEN array_to_string({_CODES % 'text'}[1:2048], ' ') ELSE '0' END AS ids, CASE WHEN item_id % 3 = 2 THEN least(len(text), 2048) ELSE 1 END AS n_mask FROM benchmark")
def pad_for_empty(spark, sf_dir):
    text = F.when(F.col("item_id") % 3 == 0, "").when(F.col("item_id") % 3 == 2, F.col("text"))
    rows = T.tokenize(read(spark, sf_dir, "benchmark").withColumn("text", text), T.CharacterTokenizer())
    return rows.select("item_id", ints(F.col("input_ids")).alias("ids"), F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("bigint").alias("n_mask"))


@query(f"""WITH t AS (SELECT item_id, item_id // 8 AS batch_id, CASE WHEN item_id % 5 = 0 THEN [] WHEN item_id % 5 > 1 THEN {_CODES % 'text'}[1:2048] END AS ids FROM benchmark), k AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS n FROM t)
SELECT item_id, n, array_to_string(ids || list_transform(range(n - len(ids)), lambda z: 0), ' ') AS ids FROM k WHERE len(ids) > 0""")
def batch_without_ids(spark, sf_dir):
    # Rows whose ids are empty or missing are planted: one in five each.
    ids = F.when(F.col("item_id") % 5 == 0, F.array().cast("array<int>")).when(F.col("item_id") % 5 > 1, F.col("input_ids"))
    rows = T.tokenize(read(spark, sf_dir, "benchmark"), T.CharacterTokenizer()).select("item_id", F.floor(F.col("item_id") / 8).alias("batch_id"), ids.alias("input_ids"))
    return T.collate(rows, "batch_id", _TEMPLATE).select("item_id", F.size("labels").cast("bigint").alias("n"), ints(F.col("input_ids")).alias("ids"))


@query(f"""WITH t AS (SELECT item_id, len(text) AS n, list_transform({_CODES % 'text'}[1:2048], lambda x: CASE WHEN x = 32 THEN 0 ELSE x END) AS ids FROM benchmark)
SELECT item_id, CASE item_id % 4 WHEN 0 THEN array_to_string(list_transform(ids, lambda x: CASE WHEN x = 0 THEN 0 ELSE 1 END), ' ') WHEN 1 THEN array_to_string(list_transform(ids, lambda x: 1), ' ')
WHEN 2 THEN array_to_string(list_transform(ids, lambda x, i: CASE WHEN i - 1 < n // 2 AND (i - 1) % 3 = 0 THEN 0 ELSE 1 END), ' ') ELSE array_to_string(list_transform(ids, lambda x, i: (i - 1) % 2), ' ') END AS mask FROM t""")
def mask_repair(spark, sf_dir):
    # Masks that are missing, empty, half as long as the ids, and longer; ids with a pad in place of each space.
    rows = T.tokenize(read(spark, sf_dir, "benchmark"), T.CharacterTokenizer())
    n, k = F.length("text"), F.col("item_id") % 4
    half = F.transform(F.sequence(F.lit(0), F.floor(n / 2).cast("int") - 1), lambda i: F.when(i % 3 == 0, 0).otherwise(1))
    mask = F.when(k == 1, F.array().cast("array<int>")).when(k == 2, half).when(k == 3, F.transform(F.sequence(F.lit(0), n + 9), lambda i: i % 2))
    return rows.select("item_id", ints(T.mended(mask, F.transform("input_ids", lambda x: F.when(x == 32, 0).otherwise(x)))).alias("mask"))


@query(f"SELECT doc_id, len({S.words('text')}) <= 300 AS fits FROM documents")
def token_length(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", (F.size(words(F.col("text"))) <= 300).alias("fits"))


# Sources
_LINE_SQL = """CASE event_id % 7 WHEN 0 THEN '  ' WHEN 1 THEN substr(props, 1, len(props) - 1) WHEN 2 THEN '[' || props || ']' WHEN 3 THEN '{"messages": [' || '{"role": "user", "content": "' || event_type || '"}' || ']}' WHEN 4 THEN '{"messages": "none"}' WHEN 5 THEN 'null' ELSE props END"""


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, p = F.col("event_id") % 7, F.col("props")
    line = F.when(k == 0, "  ").when(k == 1, F.expr("substr(props, 1, length(props) - 1)")).when(k == 2, F.concat(F.lit("["), p, F.lit("]"))).when(k == 3, F.concat(F.lit('{"messages": [{"role": "user", "content": "'), F.col("event_type"), F.lit('"}]}'))).when(k == 4, F.lit('{"messages": "none"}')).when(k == 5, "null").otherwise(p)
    return read(spark, sf_dir, "events").select("event_id", line.alias("value"))


def _reason_sql(dialect: str) -> str:
    of = {"chat": "WHEN 2 THEN 'not_object' WHEN 4 THEN 'no_messages' WHEN 5 THEN 'not_object' WHEN 6 THEN 'no_messages'", "object": "WHEN 2 THEN 'not_object' WHEN 5 THEN 'not_object'", "any": ""}[dialect]
    return f"CASE event_id % 7 WHEN 0 THEN 'blank' WHEN 1 THEN 'malformed' {of} END"


def _jsonl(dialect: str) -> None:
    QUERIES[f"jsonl_{dialect}"] = lambda spark, sf_dir: jsonl.parsed(event_lines(spark, sf_dir), dialect).select("event_id", "reject_reason", F.get("messages", F.lit(0))["content"].alias("first"))
    ORACLE_SQL[f"jsonl_{dialect}"] = f"SELECT event_id, {_reason_sql(dialect)} AS reject_reason, CASE WHEN event_id % 7 = 3 THEN event_type END AS first FROM events"


for _d in ("chat", "object", "any"):
    _jsonl(_d)


@query("SELECT event_id, CASE WHEN event_id % 7 IN (0, 1) THEN 'malformed' END AS reject_reason FROM events")
def jsonl_legacy(spark, sf_dir):
    return jsonl.parsed(event_lines(spark, sf_dir), "legacy").select("event_id", "reject_reason")


@query("SELECT event_id, CASE event_id % 7 WHEN 3 THEN event_type END AS first FROM events WHERE event_id % 7 <> 0")
def jsonl_strict(spark, sf_dir):
    # Malformed lines would end the read, so they are mended first.
    lines = event_lines(spark, sf_dir).withColumn("value", F.when(F.col("event_id") % 7 == 1, "[]").otherwise(F.col("value")))
    return jsonl.kept(lines, "strict").select("event_id", F.get("messages", F.lit(0))["content"].alias("first"))


# Sinks, read back
@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS priority, o_orderstatus = 'F' AS finished FROM orders")
def saved_lines(spark, sf_dir):
    path = fresh_path(spark)
    priority = F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority")).alias("priority")
    sinks.save(read(spark, sf_dir, "orders").select("o_orderkey", priority, (F.col("o_orderstatus") == "F").alias("finished")), path)
    kinds = {"o_orderkey": "bigint", "priority": "string", "finished": "boolean"}
    return jsonl.load(spark, path, "object").select(*(F.try_variant_get("record", f"$.{c}", t).alias(c) for c, t in kinds.items()))


@query("SELECT count(*) FILTER (WHERE c_custkey % 4 < 2) AS skipped, count(*) FILTER (WHERE c_custkey % 4 >= 2) AS saved FROM customer")
def saved_with_skips(spark, sf_dir):
    path = fresh_path(spark)
    k = F.col("c_custkey") % 4
    skipped = sinks.save_lines(read(spark, sf_dir, "customer").select("c_name", F.when(k == 0, float("nan")).when(k == 1, float("inf")).when(k == 2, 0.5).alias("share")), path)
    return jsonl.load(spark, path, "object").agg(F.lit(skipped).cast("bigint").alias("skipped"), F.count(F.lit(1)).alias("saved"))


@query(f"SELECT doc_id, text, CASE WHEN rank <= ceil(0.15 * (SELECT count(*) FROM documents)) THEN 'validation' ELSE 'train' END AS split FROM {S.ranked('documents', 'doc_id', 'split')}")
def saved_splits(spark, sf_dir):
    path = fresh_path(spark)
    sinks.save_splits(U.split(read(spark, sf_dir, "documents").select("doc_id", "text"), 0.15, ["doc_id"]), path)
    back = jsonl.load_splits(spark, {s: f"{path}/split={s}" for s in ("train", "validation")})
    return back.select(F.try_variant_get("record", "$.doc_id", "bigint").alias("doc_id"), F.try_variant_get("record", "$.text", "string").alias("text"), "split")


@query("SELECT lang AS value, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def saved_metrics(spark, sf_dir):
    path = fresh_path(spark)
    sinks.save_metrics(R.distribution(read(spark, sf_dir, "documents"), "lang"), path)
    return spark.read.schema("value string, n bigint").json(path)


@query("SELECT row_number() OVER (ORDER BY s_name) AS id, s_name AS task_details, 'pending' AS status FROM supplier UNION ALL SELECT (SELECT count(*) FROM supplier) + row_number() OVER (ORDER BY c_name), c_name, 'pending' FROM customer")
def appended_tasks(spark, sf_dir):
    path = fresh_path(spark)
    for name, column in (("supplier", "s_name"), ("customer", "c_name")):
        sinks.append_tasks(spark, path, read(spark, sf_dir, name).select(F.col(column).alias("task_details")))
    return sinks.tasks_of(spark, path).select("id", "task_details", "status")


@query("SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, len(n_name) + 1 AS length, CASE WHEN len(n_name) < 8 THEN n_name || chr(10) END AS text FROM nation")
def text_files(spark, sf_dir):
    path = fresh_path(spark)
    read(spark, sf_dir, "nation").select("n_nationkey", "n_name").write.partitionBy("n_nationkey").text(path)
    texts = jsonl.whole_texts(spark, path, most=8, allowed=[path])
    return texts.select(F.regexp_extract("path", "n_nationkey=([0-9]+)", 1).cast("bigint").alias("n_nationkey"), "length", "text")


@query("SELECT CASE WHEN event_id % 7 = 3 THEN 'chat' ELSE 'other' END AS kind, count(*) AS n FROM events WHERE event_id % 7 NOT IN (0, 1) GROUP BY 1")
def jsonl_kinds(spark, sf_dir):
    return jsonl.kept(event_lines(spark, sf_dir), "any").groupBy(F.col("record_kind").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH l AS (SELECT page_id, regexp_extract_all(html, '(?s)<a [^>]*?href="(.*?)"[^>]*>(.*?)</a>', 1)[1:5] AS u, regexp_extract_all(html, '(?s)<a [^>]*?href="(.*?)"[^>]*>(.*?)</a>', 2)[1:5] AS t FROM pages), x AS (SELECT page_id, unnest(u) AS u, unnest(t) AS t, unnest(range(len(u))) AS "at" FROM l) SELECT page_id, "at", trim(u) AS url, trim(t) AS title FROM x""")
def anchor_extract(spark, sf_dir):
    links = read(spark, sf_dir, "pages").select("page_id", F.posexplode(K.anchors(F.col("html"))).alias("at", "a"))
    return links.select("page_id", F.col("at").cast("bigint").alias("at"), "a.url", "a.title")


_PROFILES = "SELECT s_suppkey, (s_suppkey % 5 + 1) * 4294967296 AS vram, (s_suppkey % 4 + 1) * 10737418240 AS ram, s_suppkey % 3 AS gpus, CASE WHEN s_suppkey % 2 = 0 THEN 'Windows' ELSE 'Linux' END AS os, ['fast', 'quality', 'balanced', 'low_memory'][s_suppkey % 4 + 1] AS preset FROM supplier"


@query(f"""WITH p AS ({_PROFILES}), b AS (SELECT *, CASE WHEN vram < 8589934592 THEN CASE WHEN preset = 'low_memory' THEN 2 ELSE 4 END WHEN vram < 12884901888 THEN 4 WHEN preset = 'fast' THEN 8 ELSE 4 END AS batch, CASE preset WHEN 'fast' THEN 16 WHEN 'low_memory' THEN 4 ELSE 8 END AS least FROM p)
SELECT s_suppkey, CAST(batch AS BIGINT) AS batch, CAST(greatest(1, ceil(least / (batch * greatest(gpus, 1)))) AS BIGINT) AS accumulation, CAST(CASE WHEN os = 'Windows' THEN CASE WHEN preset = 'low_memory' THEN 0 ELSE 2 END WHEN ram < 17179869184 THEN 0 WHEN ram < 34359738368 THEN 2 WHEN preset = 'low_memory' THEN 2 ELSE 4 END AS BIGINT) AS workers FROM b""")
def hardware_presets(spark, sf_dir):
    k = F.col("s_suppkey")
    profiles = read(spark, sf_dir, "supplier").select("s_suppkey", ((k % 5 + 1) * 4 * presets.GIB).alias("vram_bytes"), ((k % 4 + 1) * 10 * presets.GIB).alias("system_ram_bytes"), (k % 3).alias("gpu_count"), F.when(k % 2 == 0, "Windows").otherwise("Linux").alias("os_name"), F.element_at(D.strings(list(presets.PRESETS)), (k % 4 + 1).cast("int")).alias("preset"))
    return presets.recommended(profiles).select("s_suppkey", *(F.col(c).cast("bigint").alias(c) for c in ("batch", "accumulation", "workers")))


# Rules as data, batches, caches, row functions and reports
_BENCH_WORDS = "SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS key FROM benchmark"
_BENCH_PHRASES = "SELECT DISTINCT array_to_string(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')[1:2], ' ') AS key FROM benchmark"
_EDGE = "[^\\p{L}\\p{N}_]"


@query(f"""WITH keys AS ({_BENCH_WORDS} UNION {_BENCH_PHRASES}), rules AS (SELECT key, row_number() OVER (ORDER BY md5(key), key) AS ord, list_sort(list_transform(string_split(key, ' '), lambda w: {{'n': len(w), 'w': w}}))[-1].w AS word FROM keys QUALIFY ord <= {10_000}),
said AS (SELECT doc_id, lower(text) AS low, unnest(list_distinct(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+'))) AS word FROM documents),
hits AS (SELECT doc_id, arg_min(key, ord) AS key FROM said JOIN rules USING (word) WHERE key = word OR regexp_matches(low, '(^|{_EDGE})' || key || '($|{_EDGE})') GROUP BY doc_id)
SELECT doc_id, coalesce('about ' || key, 'other') AS label FROM documents LEFT JOIN hits USING (doc_id)""")
def rules_at_scale(spark, sf_dir):
    # Up to 10,000 rules: every word of the benchmark and the first two of each item as a phrase.
    words_ = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    items = read(spark, sf_dir, "benchmark").select(words_.alias("w"))
    keys = items.select(F.explode("w").alias("key")).union(items.select(F.array_join(F.slice("w", 1, 2), " "))).distinct()
    ranked = keys.orderBy(F.md5("key"), "key").limit(10_000).collect()
    rules = rule_table(spark, [Rule(r.key, f"about {r.key}") for r in ranked])
    return classify_by_table(read(spark, sf_dir, "documents"), "text", ["doc_id"], rules, "other").select("doc_id", "label")


@query(f"""WITH t AS (SELECT doc_id, greatest(coalesce(len({S.words('text')}), 1), 1) AS n FROM documents), c AS (SELECT *, CAST(ceil(n / 8) * 8 AS BIGINT) AS wide FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY wide ORDER BY n, {S.digest('batch', 'doc_id')}, doc_id) - 1 AS rank, greatest(4096 // wide, 1) AS per FROM c),
f AS (SELECT wide, coalesce(sum(batches) OVER (ORDER BY wide ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM (SELECT wide, CAST(ceil(count(*) / any_value(per)) AS BIGINT) AS batches FROM r GROUP BY wide))
SELECT CAST(first + rank // per AS BIGINT) AS batch_id, count(*) AS n_rows, max(n) AS longest, CAST(max(n) * count(*) - sum(n) AS BIGINT) AS padding FROM r JOIN f USING (wide) GROUP BY 1""")
def length_batches(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("doc_id", T.WordTokenizer().ids(F.col("text")).alias("input_ids"))
    n = F.greatest(F.coalesce(F.size("input_ids"), F.lit(1)), F.lit(1)).cast("bigint")
    return U.batched(rows, "input_ids", ["doc_id"], 4096).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rows"), F.max(n).alias("longest"), (F.max(n) * F.count(F.lit(1)) - F.sum(n)).alias("padding"))


@query("SELECT c_custkey, 'Tool shout result: ' || upper(c_mktsegment || c_nationkey) AS result, c_custkey % 2 = 0 OR EXISTS (SELECT 1 FROM customer o WHERE o.c_custkey % 2 = 0 AND o.c_mktsegment = c.c_mktsegment AND o.c_nationkey = c.c_nationkey) AS cached FROM customer c")
def memo_execute(spark, sf_dir):
    # The calls of every other customer are executed by an earlier run; the second one works out only what that has not met.
    registry = K.Registry()
    registry.register("shout")(F.upper)
    called = read(spark, sf_dir, "customer").select("c_custkey", F.lit("shout").alias("name"), F.create_map(F.lit("query"), F.concat("c_mktsegment", F.col("c_nationkey").cast("string"))).alias("arguments"))
    memo = Memo(fresh_path(spark))
    memo.execute(called.where("c_custkey % 2 = 0"), registry)
    return memo.execute(called, registry).select("c_custkey", "result", "cached")


@query("SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'ValueError: nothing to share' END AS error, CASE WHEN p_size % 5 > 0 THEN upper(p_name) END AS name, CASE WHEN p_size % 5 > 0 THEN 60 // (p_size % 5) END AS share FROM part")
def mapped_records(spark, sf_dir):
    # One row in five raises; its record is kept with what it raised.
    rows = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")

    def shared(r: dict) -> dict:
        if r["p_size"] % 5 == 0:
            raise ValueError("nothing to share")
        return {"p_partkey": r["p_partkey"], "name": r["p_name"].upper(), "share": 60 // (r["p_size"] % 5)}

    good, bad = W.mapped(rows, shared, "p_partkey bigint, name string, share bigint", rows=100)
    failed = bad.select(F.get_json_object("record", "$.p_partkey").cast("bigint").alias("p_partkey"), "error", F.lit(None).cast("string").alias("name"), F.lit(None).cast("bigint").alias("share"))
    return good.select("p_partkey", F.lit(None).cast("string").alias("error"), "name", "share").unionByName(failed)


@query("SELECT p_partkey FROM part WHERE length(p_name) % 2 = 0")
def filtered_records(spark, sf_dir):
    kept, _ = W.filtered(read(spark, sf_dir, "part"), lambda r: len(r["p_name"]) % 2 == 0)
    return kept.select("p_partkey")


@query(f"SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS line, {_reason_sql('chat')} AS reason FROM events QUALIFY reason IS NOT NULL")
def reject_report(spark, sf_dir):
    # One file for each type of event, in the order of events; lines are numbered throughout, in however many blocks a file is read.
    path = fresh_path(spark)
    lines = event_lines(spark, sf_dir).join(read(spark, sf_dir, "events").select("event_id", "event_type"), "event_id")
    lines.repartition("event_type").sortWithinPartitions("event_type", "event_id").select("event_type", "value").write.partitionBy("event_type").text(path)
    return jsonl.report(spark, path).select(F.regexp_extract("file", "event_type=([^/]+)", 1).alias("event_type"), "line", "reason")


@query()
def token_counts(spark, sf_dir):
    import public_tokenizers

    count = T.SubwordTokenizer(public_tokenizers.path("word_bpe_49k.json")).count(F.col("text"))
    return read(spark, sf_dir, "documents").select("doc_id", count.alias("n_tokens")).withColumn("fits", F.col("n_tokens") <= 1000)
