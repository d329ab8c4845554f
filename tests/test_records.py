"""Loading, classifying, augmenting and curating on small tables."""

import json

import pytest
from pyspark.sql import functions as F

from convmill.functions import draw as D
from convmill.functions import vocab as V
from convmill.functions.rules import Rule, classify, classify_by_table, table
from convmill.functions.text import json_string, stripped, words
from convmill.operators import augment as A
from convmill.operators import classify as C
from convmill.operators import curate as U
from convmill.operators import messages as M
from convmill.operators import metrics as R
from convmill.plans import pipelines
from convmill.sources import jsonl, sinks

MESSAGES = "conv_id long, messages array<struct<role: string, content: string>>"


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'long' if isinstance(v, int) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


def test_words_and_json_equal_python(spark):
    text = "a b c \t\n\x1cd  é😀"
    assert one(spark, words(F.col("t")), t=text) == text.split()
    assert one(spark, stripped(F.col("t")), t=f" 　{text}\n ") == text.strip()
    for t in ('say "hi"\\\n\t\x01é😀', "plain", ""):
        assert one(spark, json_string(F.col("t"), ascii_only=True), t=t) == json.dumps(t)[1:-1]
        assert one(spark, json_string(F.col("t")), t=t) == json.dumps(t, ensure_ascii=False)[1:-1]


def test_draws_do_not_depend_on_partitions(spark):
    df = spark.range(1000).select("id", D.index(10, "s", F.col("id")).alias("a"), D.weighted({"x": 0, "y": 1, "z": 3}, "w", F.col("id")).alias("b"), D.shuffled(D.strings(list("abcd")), "p", F.col("id")).alias("c"))
    rows = df.collect()
    assert sorted(rows) == sorted(df.repartition(7).collect())
    share = {b: sum(r.b == b for r in rows) for b in "xyz"}
    assert share["x"] == 0 and 180 < share["y"] < 320
    assert {r.a for r in rows} == set(range(10)) and all(sorted(r.c) == list("abcd") for r in rows) and len({tuple(r.c) for r in rows}) == 24


def test_first_rule_wins_and_table_agrees(spark):
    rules = [Rule("Start small|plan", "A"), Rule("ART", "B", "part"), Rule("^x+$", "C", "regex")]
    texts = ["a PLAN b", "explan", "start", "xxx", "", None, "start small", "plan_b", "éplan"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    got = [r.x for r in df.select("id", classify(F.col("t"), rules, "none").alias("x")).orderBy("id").collect()]
    assert got == ["A", "none", "B", "C", "none", "none", "A", "none", "none"]
    assert [r.label for r in classify_by_table(df, "t", ["id"], table(spark, rules), "none").orderBy("id").collect()] == got


@pytest.mark.parametrize("dialect,kept", [("chat", [0, 7]), ("object", [0, 4, 5, 7]), ("any", [0, 3, 4, 5, 6, 7])])
def test_jsonl_dialects(spark, dialect, kept):
    lines = ['{"messages": [{"role": "user", "content": "hi"}]}', "  ", "{bad", "[1, 2]", '{"messages": "x"}', '{"application_prompt": "p"}', "7", '{"messages": []}']
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "n long, value string")
    parsed = jsonl.parsed(df, dialect).orderBy("n").collect()
    assert len(parsed) == 8 and [r.n for r in parsed if r.reject_reason is None] == kept
    assert parsed[1].reject_reason == "blank" and parsed[2].reject_reason == "malformed"
    assert [r.record_kind for r in parsed if r.n in (0, 5, 6)] == ["chat", "intent", "other"]
    assert parsed[0].messages[0].content == "hi" and parsed[4].messages is None


def test_strict_dialect_fails_and_files_load(spark, tmp_path):
    bad = spark.createDataFrame([("",), ("{bad",)], "value string")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        jsonl.kept(bad, "strict").collect()
    assert jsonl.kept(spark.createDataFrame([("",)], "value string"), "strict").count() == 0
    with pytest.raises(ValueError):
        jsonl.reason(F.col("value"), "other")
    (tmp_path / "a.jsonl").write_text('{"x": "é"}\n\n{oops\n', encoding="utf-8")
    assert jsonl.load(spark, str(tmp_path / "a.jsonl"), "object").count() == 1
    both = jsonl.load_splits(spark, {"train": str(tmp_path / "a.jsonl"), "validation": str(tmp_path / "a.jsonl")})
    assert both.groupBy("split").count().count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jsonl.load(spark, str(tmp_path / "none.jsonl")).count()
    assert jsonl.whole_texts(spark, str(tmp_path / "a.jsonl"), most=3, allowed=[str(tmp_path)]).first().text is None
    with pytest.raises(ValueError):
        jsonl.whole_texts(spark, "/etc/hostname", allowed=[str(tmp_path)])


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", "train"), (2, None, "train")], "id long, t string, split string")
    sinks.save(df, str(tmp_path / "o"))
    lines = [json.loads(x) for f in (tmp_path / "o").glob("*.json") for x in f.read_text(encoding="utf-8").splitlines()]
    assert {"id": 2, "t": None, "split": "train"} in lines and any("é" in f.read_text(encoding="utf-8") for f in (tmp_path / "o").glob("*.json"))
    sinks.save_splits(df, str(tmp_path / "s"))
    assert [p.name for p in (tmp_path / "s").iterdir() if p.is_dir()] == ["split=train"]
    sinks.save_metrics(df.limit(1), str(tmp_path / "m"))
    tasks = spark.createDataFrame([("b",), ("a",), (None,)], "task_details string")
    assert [r.id for r in sinks.append_tasks(spark, str(tmp_path / "t"), tasks).orderBy("id").collect()] == [1, 2]
    assert [r.id for r in sinks.append_tasks(spark, str(tmp_path / "t"), tasks).orderBy("id").collect()] == [3, 4]


def test_messages(spark):
    chats = spark.createDataFrame([(1, [("system", "s"), ("user", "u1"), ("assistant", "a1"), ("user", "u2"), ("assistant", "a2")]), (2, [("user", "x")]), (3, []), (4, None), (5, [("user", ""), ("assistant", "y")])], MESSAGES)
    m = F.col("messages")
    rows = {r.conv_id: r for r in chats.select("conv_id", M.first_of(m, "user").alias("u"), M.replace_last(m, "assistant", F.lit("N")).alias("n"), M.reject_reason(m).alias("why"), M.all_content(m).alias("all")).collect()}
    assert rows[1].u == "u1" and [x.content for x in rows[1].n] == ["s", "u1", "a1", "u2", "N"] and rows[1]["all"] == "s u1 a1 u2 a2"
    assert [rows[i].why for i in (1, 2, 3, 4, 5)] == [None, "no_assistant", "empty_messages", "no_messages", "no_user"]
    assert [x.content for x in rows[2].n] == ["x"]
    back = M.nested(M.unnested(chats.where("conv_id = 1")))
    assert back.first().messages == chats.first().messages


def test_classifiers(spark):
    of = lambda c, **v: one(spark, c, **({"k": 1} | v))
    assert of(C.persona(F.col("t")), t="") == V.DEFAULT_PERSONA
    assert of(C.layer(F.col("t"), F.col("k")), t="A Growth plan that is simple") == "Aspirational"
    assert of(C.layer_by_cues(F.col("t")), t="we clarify") == "Transformational" and of(C.layer_by_cues(F.col("t")), t="?") == "Foundational"
    assert of(C.principle(F.col("t"), F.col("k"), {"Chapter 1": 0, "Chapter 2": 0, "Chapter 3": 1}), t="zzz").startswith("Chapter 3 > ")
    assert of(C.principle_by_cues(F.col("t")), t="TOOLS") == "Chapter 2 > Tools"
    got = of(C.attributes(F.lit("Aspirational"), F.col("k")), t="")
    assert len(set(got)) == 3 and set(got) <= set(V.ATTRIBUTES["Aspirational"])
    assert 3 <= len(of(C.steps(F.lit("none"), F.col("k")), t="")) <= 4
    assert of(C.attributes_by_cues(F.col("t")), t="Specific empathy") == ["Encouraging", "Actionable", "Empathetic", "Factual"]
    assert of(C.steps_by_cues(F.col("t")), t="") == [V.DEFAULT_STEP]
    assert of(C.relevant_tools(F.col("t"), ["write_file", "calc_tool"]), t="Novel Writing") == ["write_file"]
    assert of(C.relevant_tools(F.col("t"), ["calc_tool"]), t="onboard") == ["calc_tool"]
    assert of(C.follow_up(F.col("t"), F.col("k"), [("Parent", ["How?"])]), t="Parent > X") == "How?"


def test_augmentation(spark):
    of = lambda c, **v: one(spark, c, **({"k": 1} | v))
    assert of(A.paraphrase(F.col("t"), F.col("k"), {"small": ["tiny"]}), t="Small, but  small\tbig") == "tiny but tiny big"
    assert of(A.with_question(F.col("t"), F.lit("So?")), t=" done ") == "done So?" and of(A.with_question(F.col("t"), F.lit("So?")), t="really? ") == "really? "
    assert len(of(A.pairs(F.lit("Fitness Seeker > B"), F.lit("c"), F.lit("p"), F.col("k")), t="")) == 3
    assert len(of(A.drawn(D.strings(["a", "b"]), 5, F.col("k")), t="")) == 5 and of(A.drawn(D.strings(["a"]), 0, F.col("k")), t="") == []
    text = of(A.dynamic_perturbation(F.lit("tight"), 9, F.col("k")), t="")
    assert all(p[0] in text for p in V.PERTURBATION_TEMPLATES) and "Inverted constraint: generous" in text
    assert of(A.adjust_prompt(F.col("t"), A.shift_context(F.lit("a dive watch"), F.lit("Alex"))), t="p") == "p I'm curious about limited-edition options."
    assert of(A.shift_context(F.col("t"), F.lit("Nobody")), t="c") == "c"


def test_curation(spark):
    rows = [(i, a, b) for i, (a, b) in enumerate([("x", "1"), ("x", "1"), (None, "1"), ("", "1"), (None, "1")])]
    df = spark.createDataFrame(rows, "id long, a string, b string")
    once = U.keep_first(df, ["a", "b"], ["id"])
    assert sorted(r.id for r in once.collect()) == [0, 2, 3] and sorted(U.keep_first(once, ["a", "b"], ["id"]).collect()) == sorted(once.collect())
    ids = spark.range(101)
    parts = U.split(ids, 0.1, ["id"])
    assert parts.where("split = 'validation'").count() == 11 and parts.count() == 101
    assert sorted(parts.collect()) == sorted(U.split(ids.repartition(9), 0.1, ["id"]).collect())
    assert [r.split for r in U.split(ids.limit(1), 0.5, ["id"]).collect()] == ["train"]
    assert U.sample(ids, 500, ["id"]).count() == 101 and U.sample(ids, 7, ["id"]).count() == 7
    assert U.sample_with_replacement(ids, 300, ["id"]).count() == 300 and U.sample_with_replacement(ids.limit(0), 5, ["id"]).count() == 0
    flagged = U.flag_for_review(ids.withColumn("t", F.lit("a")), 0.05, ["id"], "t", F.lit("b"))
    assert flagged.where("review AND t = 'b'").count() == 5 and flagged.where("t = 'b'").count() == 5
    assert U.flag_for_review(ids.withColumn("t", F.lit("a")), 0.001, ["id"], "t", F.lit("b")).where("review").count() == 1
    for bad in (-0.1, 1.1):
        with pytest.raises(ValueError):
            U.split(ids, bad, ["id"])
    assert [r.id for r in U.drop_blank(spark.createDataFrame([(1, "  "), (2, "x"), (3, None)], "id long, text string"), name="n").collect()] == [2]


def test_ranks_are_whole(spark):
    assert sorted(r["rank"] for r in U.ranked(spark.range(1000), ["id"], "s").collect()) == list(range(1, 1001))


def test_diversity(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "a c"), (4, ""), (5, None)], "id long, t string")
    r = R.diversity(df, "t", ["id"]).first()
    assert round(r.unique_ratio, 9) == round(2 / 3, 9) and 0 < r.avg_jaccard <= 1
    nothing = R.diversity(df.where("id > 3"), "t", ["id"]).first()
    assert (nothing.unique_ratio, nothing.avg_jaccard, nothing.is_diverse) == (0.0, 0.0, False)
    assert R.diversity(df.limit(0), "t", ["id"], keep_empty=True).first().is_diverse is True
    counts = {(r.field, r.value): r.n for r in R.distribution(df, "t", missing="").collect()}
    assert counts == {("t", "a b"): 2, ("t", "a c"): 1, ("t", ""): 2}


@pytest.mark.parametrize("name,rows", [("master", 3), ("proactive", 3), ("publication", 3)])
def test_intent_records_by_dialect(spark, name, rows):
    from dataclasses import replace

    pairs = spark.createDataFrame([(1, "How do I start a workout?", "Start small."), (2, "", "x"), (3, "p", None)], "conv_id long, prompt string, response string")
    got = pipelines.intent_records(pairs, dialect=replace(pipelines.DIALECTS[name], factor=3)).orderBy("variant").collect()
    assert len(got) == rows and [r.variant for r in got] == [0, 1, 2] and len({r.intent_id for r in got}) == rows
    assert got[0].application_prompt == "How do I start a workout?" and got[0].persona_archetype == "Fitness Seeker > Beginner"
    assert got[0].ideal_response_final.endswith("?") == (name != "publication")
    out = pipelines.curated(pipelines.intent_records(pairs, dialect=pipelines.DIALECTS[name]), 0.2, sample=3, review=0.5)
    assert out.count() <= 3 and {"split", "review"} <= set(out.columns)


def test_update_keeps_questions(spark):
    rows = [("a", "p", "Is it? ", "P", "Foundational", ["s"]), ("b", "p", "It is. ", "P", "Foundational", ["s"]), ("c", "", "r", "P", "L", ["s"]), ("d", "p", None, "P", "L", ["s"])]
    df = spark.createDataFrame(rows, "intent_id string, application_prompt string, ideal_response_final string, persona_archetype string, capability_layer string, ideal_response_cot array<string>")
    got = {r.intent_id: r for r in pipelines.updated(df).collect()}
    assert set(got) == {"a", "b"} and got["a"].ideal_response_final == "Is it? " and got["a"].ideal_response_cot == ["s"]
    assert got["b"].ideal_response_final.startswith("It is. ") and got["b"].ideal_response_final.endswith("?") and len(got["b"].ideal_response_cot) >= 3
