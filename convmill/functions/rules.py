"""Ordered rule tables: the first rule that fits gives the label.

A table is a list of rules or a DataFrame of the same columns. Lists fold into one CASE; a DataFrame becomes an index from
a word, or a part's first three characters, to its rules, which the words and parts of texts are looked up in by equality. What is found that way
is held against the text where the key is more than that, and the least ``ord`` that fits is kept. Keys are compared in lower
case, so capitals in a table do no harm.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .names import fresh
from .text import any_word, characters, let

#: Rule tables of up to so many rows are broadcast; a table is checked before it is.
RULES_MOST = 10_000
#: Characters of a part by which it is looked up.
GRAM = 3
#: Groups into which copies of one text are dealt.
DEALS = 64
#: Keys without signs of patterns, and what separates words.
_PLAIN = re.compile(r"[^\W_][\w' -]*")
_BETWEEN = r"[^\p{L}\p{N}_]+"
_TABLE = "ord int, pattern string, label string, kind string, keys array<string>"


@dataclass(frozen=True)
class Rule:
    """``kind``: ``word`` (any of the |-separated words), ``part`` (the text has the key) or ``regex``."""

    key: str
    label: str
    kind: str = "word"

    def pattern(self) -> str:
        return any_word(self.key.lower()) if self.kind == "word" else self.key

    def keys(self) -> list[str] | None:
        """The texts one of which is in all that the rule fits; null where it isn't known."""
        if self.kind == "part":
            return [self.key.lower()] if len(self.key) >= GRAM else None
        some = self.key.lower().split("|") if self.kind == "word" else []
        return some if some and all(_PLAIN.fullmatch(k) for k in some) else None

    def fits(self, lowered: Column) -> Column:
        return lowered.contains(self.key.lower()) if self.kind == "part" else lowered.rlike(self.pattern())


def classify(text: Column, rules: list[Rule], default: Column | str | None, lower: bool = True) -> Column:
    """The label of the first rule that fits ``text``, else ``default``; null text fits none."""
    text = F.lower(text) if lower else text
    out = None
    for r in rules:
        out = F.when(r.fits(text), F.lit(r.label)) if out is None else out.when(r.fits(text), F.lit(r.label))
    default = default if isinstance(default, Column) else F.lit(default)
    return default if out is None else out.otherwise(default)


def table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    return spark.createDataFrame([(i, r.pattern() if r.kind != "part" else r.key.lower(), r.label, r.kind, r.keys()) for i, r in enumerate(rules)], _TABLE)


def _index(rules: DataFrame) -> DataFrame:
    """token, at, sure (whether the token alone decides) of rules with keys: a word stands for itself, a phrase goes by its longest word, a part by its beginning."""
    keyed = rules.where("keys IS NOT NULL").select("at", "kind", F.explode("keys").alias("key"))
    parts = F.filter(F.split("key", _BETWEEN), lambda w: w != "")
    longest = F.array_max(F.transform(parts, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    one = (F.size(parts) == 1) & (F.get(parts, F.lit(0)) == F.col("key"))
    token = F.when(F.col("kind") == "part", F.concat(F.lit(":"), F.left("key", F.lit(GRAM)))).otherwise(longest)
    decided = F.when(F.col("kind") == "part", F.length("key") == GRAM).otherwise(one)
    return keyed.select(token.alias("token"), "at", decided.alias("sure"))


def _tokens(low: Column, parts: bool) -> Column:
    """The words of a text, and with ``parts`` its runs of GRAM characters after a colon, which no word has; each once."""
    words = F.split(low, _BETWEEN)
    if not parts:
        return F.array_distinct(words)
    grams = let(characters(low), lambda cs: F.transform(F.slice(cs, F.lit(1), F.greatest(F.size(cs) - (GRAM - 1), F.lit(0))), lambda c, i: F.concat(F.lit(":"), c, *(F.get(cs, i + k) for k in range(1, GRAM)))))
    return F.array_distinct(F.concat(words, grams))


def _fit(low: Column, rule: Column) -> Column:
    # A key that isn't in the text at all is found out by less than a pattern.
    word = F.exists(rule["keys"], lambda k: F.contains(low, k)) & F.call_function("regexp_like", low, rule["pattern"])
    return F.when(rule["kind"] == "part", F.contains(low, rule["pattern"])).otherwise(word)


def classify_by_table(df: DataFrame, text: str, key: list[str], rules: DataFrame, default: str, out: str = "label") -> DataFrame:
    """``df`` plus ``out``, from rules held as data (ord, pattern, label, kind, and keys as ``table`` makes them).

    Words meet their rules by a join on equality with the broadcast index, whose size is checked; no text is held against all rules. What a
    word decides alone leaves only earlier rules to be held against the text, in turn, until one fits. Rules
    without keys (patterns, parts of fewer than GRAM characters) are tried on every text, as in a CASE. Null text fits none; equal texts are told apart from others by SHA-256,
    and copies of one are dealt apart by ``key``. Of rules of equal ord the lesser label goes first.
    """
    if "keys" not in rules.columns:
        rules = rules.withColumn("keys", F.lit(None).cast("array<string>"))
    # The table is bounded, so its rows may come to the driver and go to all tasks.
    rows = rules.select("ord", "pattern", "label", "kind", "keys").orderBy("ord", "label").limit(RULES_MOST + 1).collect()
    if len(rows) > RULES_MOST:
        raise ValueError(f"a rule table has at most {RULES_MOST} rows")
    index = _index(df.sparkSession.createDataFrame([(i, r.kind, r.keys) for i, r in enumerate(rows)], "at int, kind string, keys array<string>"))
    if index.count() > 10 * RULES_MOST:
        raise ValueError(f"a rule table has at most {10 * RULES_MOST} alternatives")
    held = F.from_json(F.lit(json.dumps([{"pattern": r.pattern, "label": r.label, "kind": r.kind, "keys": r.keys} for r in rows])), "array<struct<pattern:string,label:string,kind:string,keys:array<string>>>")
    rule = lambda at: F.get(held, at)
    digest, deal, sure, maybe = fresh(df, "digest", "deal", "sure", "maybe", also=[out])
    low = F.lower(F.col(text))
    # Rows without a text have no hits to meet; by their keys they don't meet each other either.
    named = F.sha2(F.col(text), 256)
    spread = F.xxhash64(*key) if key else F.lit(0).cast("long")
    marked = df.withColumns({digest: F.coalesce(named, F.concat(F.lit("none-"), spread.cast("string"))) if key else named, deal: F.pmod(spread, F.lit(DEALS))})
    parts = any(r.kind == "part" and r.keys for r in rows)
    words = marked.select(F.col(digest).alias("digest"), F.col(deal).alias("deal"), F.explode(_tokens(low, parts)).alias("token"))
    # First one row a text for what is sure and one for each rule to be tried: numbers alone, which add up before they are shuffled.
    met = words.join(F.broadcast(index), "token").groupBy("digest", "deal", F.when(~F.col("sure"), F.col("at")).alias("maybe")).agg(F.min("at").alias("at"))
    hits = met.groupBy("digest", "deal").agg(F.min(F.when(F.col("maybe").isNull(), F.col("at"))).alias(sure), F.collect_set("maybe").alias(maybe))
    joined = marked.join(hits.select(F.col("digest").alias(digest), F.col("deal").alias(deal), sure, maybe), [digest, deal], "left")
    plain = F.lit(None).cast("int")
    for at, r in reversed([(i, r) for i, r in enumerate(rows) if r.keys is None]):
        plain = F.when(low.contains(r.pattern) if r.kind == "part" else F.call_function("regexp_like", low, F.lit(r.pattern)), F.lit(at)).otherwise(plain)
    earlier = F.array_sort(F.filter(F.col(maybe), lambda at: F.col(sure).isNull() | (at < F.col(sure))))
    tried = let(low, lambda t: F.aggregate(earlier, F.lit(None).cast("int"), lambda found, at: F.coalesce(found, F.when(_fit(t, rule(at)), at))))
    best = F.array_min(F.array(F.col(sure), tried, plain))
    return joined.withColumn(out, F.coalesce(rule(best)["label"], F.lit(default))).drop(digest, deal, sure, maybe)
