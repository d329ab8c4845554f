"""Rendering, tokens, tool calls, preference pairs, streams and the catalog."""

import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from convmill.functions import vocab as V
from convmill.operators import chat as H
from convmill.operators import preference as P
from convmill.operators import presets
from convmill.operators import tokens as T
from convmill.operators import toolcalls as K
from convmill.operators import variants as X
from convmill.plans import catalog, pipelines
from convmill.streaming import chats as S

MESSAGES = "conv_id long, messages array<struct<role: string, content: string>>"
CHATS = [(1, [("user", "Add 3 and 4.5 to \"it\" é\nnow"), ("assistant", "Sure."), ("user", "more"), ("assistant", "Done.")]), (2, [("user", "hi")])]


def test_safe_arithmetic():
    cases = {"2 + 3 * 4": "14", "15 / 3": "5.0", "2 ** 3": "8", "-7 // 2": "-4", "7 % 4": "3", "+(1.5)": "1.5"}
    assert {k: K.calculate(k) for k in cases} == cases
    for bad in ("__import__('os')", "a + 1", "1 +", "'x'", "[1]", "1 if 1 else 2", "9**9**9", "1/0", "2 << 3", None, ""):
        assert K.calculate(bad).startswith("Error: ")


def test_variants_leave_originals_alone_and_parse(spark):
    chats = spark.createDataFrame(CHATS, MESSAGES)
    out = X.variants(chats, 5, V.TOOLS)
    rows = out.collect()
    assert [r for r in rows if r.variant == 0 and r.conv_id == 1][0].messages == chats.first().messages
    assert sorted(r.kind for r in rows) == sorted(["original"] * 2 + X.kinds(5)) and X.kinds(5) == ["single", "single", "multi", "multi", "none"]
    assert all(r.v for r in out.select(X.valid(F.col("messages")).alias("v")).collect())
    for r in rows:
        if r.kind in ("single", "multi"):
            text = r.messages[-1].content.split("\n")
            calls = [json.loads(x.removeprefix("Need data: "))["tool_call"] for x in text if x.startswith("Need data: ")]
            assert len(calls) == {"single": 1, "multi": 2}[r.kind] == len({c["name"] for c in calls}) and text[-1] == "Integrated advice: Sure."
            assert r.messages[1].content == "Sure."
    assert X.variants(chats, 0, V.TOOLS).count() == 2
    with pytest.raises(ValueError):
        X.variants(chats, -1, V.TOOLS)


def test_tool_arguments(spark):
    df = spark.createDataFrame([(t,) for t in V.TOOLS + ["other"]], "tool string").withColumn("q", F.lit('What IS "x" 12 plus 3.5 today'))
    got = {r.tool: r.a for r in df.select("tool", X.arguments(F.col("tool"), F.col("q")).alias("a")).collect()}
    assert got["calc_tool"] == {"query": "12 + 3.5"} and got["other"] == {} and got["search_web"] == {"query": 'what is \\"x\\" 12 plus'}
    assert got["get_current_weather"] == {"location": "plus"} and list(got["write_file"]) == ["filepath", "content"]


def test_validation(spark):
    cases = [('{"tool_call": {"name": "a", "arguments": {"q": "}{"}}}', True), ('{"tool_call": {"name": }', False), ("no call", True), ('{"tool_call": {"a": {"b": {"c": 1}}}}', True)]
    df = spark.createDataFrame([(i, [("assistant", t)]) for i, (t, _) in enumerate(cases)] + [(9, [])], MESSAGES)
    got = {r.conv_id: r.v for r in df.select("conv_id", X.valid(F.col("messages")).alias("v")).collect()}
    assert [got[i] for i in range(4)] == [v for _, v in cases] and got[9] is False
    assert df.where("conv_id = 2").select(X.valid(F.col("messages"), 1).alias("v")).first().v is False


def test_extract_and_execute(spark):
    text = 'x {"tool_call": {"name": "news_tool", "arguments": {"query": "a {b}"}}} y {"tool_call": {"name": "z"}} {"tool_call": bad} {"tool_call": {"name": "calc_tool", "arguments": {"query": "6 * 7"}}} {"tool_call": {"name": "nope", "arguments": {}}}'
    calls = K.extract_calls(spark.createDataFrame([(1, text), (2, None)], "id long, t string"), "t", ["id"])
    assert [(r.call, r.name) for r in calls.orderBy("call").collect()] == [(0, "news_tool"), (1, "calc_tool"), (2, "nope")]
    got = {r.name: r.result for r in K.execute_calls(calls).collect()}
    assert got["calc_tool"] == "Tool calc_tool result: 42" and got["nope"] == "Unknown tool: nope" and "a {b}" in got["news_tool"]
    registry = K.Registry()
    registry.register_function(spark, "shout", lambda x: x.upper())
    registry.register("echo")(lambda x: x)
    more = spark.createDataFrame([("shout", {"a": "hi"}), ("echo", {"a": "yo"}), ("echo", {})], "name string, arguments map<string,string>")
    assert sorted(r.result for r in K.execute_calls(more, registry).collect()) == sorted(["Tool shout result: HI", "Tool echo result: yo", "Tool echo invalid args: Missing required argument for echo"])
    assert spark.sql("SELECT shout('x')").first()[0] == "X"


def test_preference_pairs(spark):
    chats = spark.createDataFrame(CHATS + [(3, []), (4, None), (5, [("user", "q"), ("assistant", "Look. Need data: {} tool_call")]), (6, [("user", "q"), ("assistant", "tool_call x")]), (7, [("user", "q"), ("assistant", "TOOL_CALL")])], MESSAGES)
    got = {r.conv_id: r for r in pipelines.pairs_of_chats(chats).collect()}
    assert set(got) == {1, 5, 6, 7} and got[5].rejected == "Look." and got[6].rejected == V.UNSURE and got[5].prompt == "[INST]q[/INST]"
    for i in (1, 7):
        call = json.loads(got[i].rejected.removeprefix("Need data: "))["tool_call"]
        assert call["name"] in V.TOOLS and all(len(v) <= 64 for v in call["arguments"].values())
    named = spark.createDataFrame([(i, "q", " ".join(t for t in V.TOOLS if t != "calc_tool").replace("tool_call", "")) for i in range(5)], "conv_id long, prompt string, response string")
    assert all('"calc_tool"' in r.rejected for r in P.preference_pairs(named).collect())
    assert P.checked(pipelines.pairs_of_chats(chats)).count() == 4
    for bad, why in ((chats, "lack prompt"), (pipelines.pairs_of_chats(chats.limit(0)), "no preference pairs")):
        with pytest.raises(ValueError, match=why):
            P.checked(bad)


def test_rendering(spark):
    fields = ", ".join(f"{f} string" for f in V.REQUIRED_FIELDS)
    rows = [("p", "r", "Ben", "Aspirational", "c", "i"), ("p", "r", "x", "Other", "c", "i"), (None, "r", "x", "y", "c", "i")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"id long, {fields}")
    got = {r.id: r for r in H.render(df).collect()}
    assert got[0].text == f"System: {V.SYSTEM_PROMPTS['Aspirational']}\nContext: c\nUser Intent: i\nPersona: Ben\nUser: p\nAssistant: r\n"
    assert V.DEFAULT_SYSTEM_PROMPT in got[1].text and got[2].text == "" and got[2].reject_reason == "missing_field"
    always = {r.id: r.text for r in H.render(df, "id", percent=100, template=H.tagged).collect()}
    assert "modern, techy look" in always[0] and always[0].startswith("<|system|>\n")


def test_tokens_and_labels(spark):
    df = spark.createDataFrame([(0, [1, 2, 7, 8, 3], [1]), (0, [7, 8], None), (0, [], None), (1, [7, 9, 0], [1, 1, 1, 1, 1])], "b int, input_ids array<int>, attention_mask array<int>")
    rows = T.collate(df, "b", [7, 8]).collect()
    by = {tuple(r.input_ids): r for r in rows}
    assert len(rows) == 3
    assert by[(1, 2, 7, 8, 3)].labels == [-100, -100, -100, -100, 3] and by[(1, 2, 7, 8, 3)].attention_mask == [1, 1, 1, 1, 1]
    assert by[(7, 8, 0, 0, 0)].labels == [-100] * 5 and by[(7, 8, 0, 0, 0)].attention_mask == [1, 1, 0, 0, 0]
    assert by[(7, 9, 0)].labels == [-100] * 3 and by[(7, 9, 0)].attention_mask == [1, 1, 1]
    with pytest.raises(ValueError):
        T.collate(df, "b", [])
    texts = spark.createDataFrame([(1, "aé😀"), (2, ""), (3, None)], "id long, text string")
    ids = {r.id: r.input_ids for r in T.tokenize(texts, T.CharacterTokenizer(), most=2).collect()}
    assert ids == {1: [97, 233], 2: [0], 3: [0]}
    other = T.VocabularyTokenizer(lambda: lambda t: [len(w) for w in t.split()])
    assert [r.input_ids for r in T.tokenize(spark.createDataFrame([("ab c",)], "text string"), other).collect()] == [[2, 1]]


def test_training_batches(spark):
    pairs = spark.createDataFrame([(i, f"how do I plan {i}", "start small") for i in range(6)], "conv_id long, prompt string, response string")
    records = pipelines.intent_records(pairs, dialect=pipelines.Dialect(factor=2))
    template = [ord(c) % 255 for c in "Assistant: "]
    rows = pipelines.training_batches(records, T.CharacterTokenizer(), template, F.col("conv_id") % 2, "intent_id").collect()
    assert len(rows) == 12
    for r in rows:
        shown = "".join(chr(x) for x in r.labels if x != -100)
        assert shown == r.ideal_response_final + "\n" and len(r.input_ids) == len(r.labels) == len(r.attention_mask)


def test_presets(spark):
    df = spark.createDataFrame([(6 * presets.GIB, 64 * presets.GIB, 1, "Linux", "low_memory"), (24 * presets.GIB, 8 * presets.GIB, 2, "Windows", "fast"), (8 * presets.GIB, 20 * presets.GIB, 0, "Linux", "other")], "vram_bytes long, system_ram_bytes long, gpu_count int, os_name string, preset string")
    a, b, c = presets.recommended(df).collect()
    assert (a.tier, a.batch, a.accumulation, a.workers) == ("low", 2, 2, 2) and (b.tier, b.batch, b.accumulation, b.workers, b.save_steps) == ("high", 8, 1, 2, 400)
    assert c.batch is None and c.tier == "medium"
    base = {"a": {"x": 1}, "b": 2}
    assert presets.merged(base, {"a": {"y": 3}, "c": {"z": 4}}) == {"a": {"x": 1, "y": 3}, "b": 2, "c": {"z": 4}} and base == {"a": {"x": 1}, "b": 2}


def test_stream_equals_batch(spark, tmp_path):
    lines = [json.dumps({"messages": [{"role": "user", "content": f"plan {i}"}, {"role": "assistant", "content": "simple growth"}]}) for i in range(20)] + ["", "{bad", "[]"]
    (tmp_path / "in").mkdir()
    for k in range(4):
        (tmp_path / "in" / f"{k}.jsonl").write_text("\n".join(lines[k::4]))
    stream = S.labelled(S.chat_stream(spark, str(tmp_path / "in"), 1))
    q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    from convmill.sources.jsonl import load

    batch = S.labelled(load(spark, str(tmp_path / "in")).select(F.md5("value").alias("conv_id"), "messages"))
    assert sorted(spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(batch.collect()) and batch.count() == 20


def test_entry_imports_without_a_session_and_catalog_agrees_with_duckdb(spark):
    d, c = "/root/testdata/sf0.001", duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(d):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{d}/{f}'")
    plain = lambda rows: sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in rows)
    wrong = []
    for name, run in catalog.QUERIES.items():
        df = run(spark, d)
        rows = df.collect()
        if name in catalog.ORACLE_SQL:
            got = c.execute(catalog.ORACLE_SQL[name])
            columns = [x[0] for x in got.description]
            want = [[r[columns.index(k)] for k in sorted(columns)] for r in got.fetchall()]
            if sorted(columns) != sorted(df.columns) or plain([[r[k] for k in sorted(columns)] for r in rows]) != plain(want):
                wrong.append(name)
    assert not wrong
