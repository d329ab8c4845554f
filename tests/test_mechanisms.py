"""Calls at any depth, agent rounds, safe appends, the result cache, batches, line numbers, row functions and rules as data."""

import json
import threading
import time
from concurrent.futures import ThreadPoolExecutor

import public_tokenizers
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from convmill.functions.commits import Commits
from convmill.functions.names import fresh
from convmill.functions.rules import Rule, classify, classify_by_table, table
from convmill.operators import calls, curate, rounds, rowwise, toolcalls, tokens, variants
from convmill.operators.memo import Memo
from convmill.plans import config
from convmill.sources import jsonl, sinks

SF = "/root/testdata/sf0.001"


def nested(depth):
    return '{"tool_call": {"name": "n", "arguments": ' + '{"a": ' * depth + "1" + "}" * depth + "}}"


# Calls
def test_scanner_minds_strings_and_depth():
    inner = '{"tool_call": {"name": "i", "arguments": {}}}'
    text = f'x {nested(30)} {{"tool_call": {{"name": "q", "arguments": {{"s": "}}{{\\" {{"}}}}}} {{"tool_call": {{"name": "o", "arguments": {inner}}}}} {{"tool_call": {{bad}}}} {{"tool_call": {{"name": "no"}}}} {{"tool_call": 3}} {{ "tool_call": {{"name": "open", "arguments": {{'
    assert [c["name"] for c in calls.find_calls(text)] == ["n", "q", "o", "i"]
    assert [end is None for _, end in calls.spans(text)] == [False] * 7 + [True]
    assert [p is None for p in calls.parsed(text)] == [False, False, False, False, True, False, False, True]
    assert calls.find_calls(None) == calls.find_calls("") == [] and list(calls.parsed("[" * 10)) == []
    assert list(calls.parsed('{"tool_call": ' + "[" * 200_000 + "]" * 200_000 + "}")) == [None]


def test_many_open_calls_take_time_in_proportion():
    took = []
    for n in (20_000, 80_000):
        start = time.perf_counter()
        assert all(end is None for _, end in calls.spans('{"tool_call": {' * n))
        took.append(time.perf_counter() - start)
    assert took[1] < 16 * took[0] + 0.5


def test_table_function_in_sql_and_frames(spark):
    rows = [(1, f"a {nested(6)} b {nested(1)}", "x"), (2, None, "y"), (3, "no calls", "z"), (3, nested(2), "z")]
    df = spark.createDataFrame(rows, "id long, t string, _content string")
    got = [(r.id, r["_content"], r.call, r.name, json.loads(r.arguments)) for r in calls.extract(df, "t", ["id", "_content"]).orderBy("id", "call").collect()]
    six = {"a": 1}
    for _ in range(5):
        six = {"a": six}
    assert got == [(1, "x", 0, "n", six), (1, "x", 1, "n", {"a": 1}), (3, "z", 0, "n", {"a": {"a": 1}})]
    calls.register(spark)
    df.createOrReplaceTempView("told")
    assert spark.sql("SELECT id, c.name FROM told, LATERAL tool_calls(told.t) AS c").count() == 3
    assert toolcalls.extract_calls(df, "t", ["id"]).where("arguments['a'] = '1'").count() == 1
    assert toolcalls.extract_calls(df.limit(0), "t", ["id"]).collect() == []


def test_deep_calls_are_valid(spark):
    message = "array<struct<role: string, content: string>>"
    texts = [[("user", "hi"), ("assistant", nested(7))], [("assistant", nested(7)[:-1])], [("assistant", '{"tool_call": {bad}}')], [], None, [("assistant", None)]]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(texts)], f"id long, messages {message}")
    assert [r.ok for r in df.select("id", variants.valid(F.col("messages")).alias("ok")).orderBy("id").collect()] == [True, False, False, False, False, True]
    few = df.select("id", variants.valid(F.col("messages"), 3, tokens.SubwordTokenizer(public_tokenizers.path("word_bpe_49k.json")).count).alias("ok"))
    assert [r.ok for r in few.orderBy("id").collect()] == [False, False, False, False, False, True]


# Agent rounds
def scripted(told):
    return lambda open_, k: open_.withColumns(told(k))


def test_rounds_end_each_in_its_way(spark):
    asked = spark.createDataFrame([(1, "two plus two"), (2, "never ends"), (3, "fails"), (4, None), (1, "two plus two")], "id long, question string")
    call = '{"tool_call": {"name": "calc_tool", "arguments": {"query": "2+2"}}}'

    def ask(open_, k):
        again = F.col("question") == "never ends"
        output = F.when(again | (F.col("question") == "two plus two") & (F.lit(k) == 1), f"{call} {call}").otherwise(F.concat(F.lit("done after "), F.length("prompt").cast("string")))
        return open_.withColumns({"output": output, "error": F.when(F.col("question") == "fails", "no model")})

    rows = rounds.converse(asked, ask, most=3).orderBy("id", "question").collect()
    assert [(r.id, r.rounds, r.status) for r in rows] == [(1, 2, "answered"), (1, 2, "answered"), (2, 3, "unfinished"), (3, 1, "failed"), (4, 1, "answered")]
    assert rows[0].prompt == f"two plus two\nPrevious output: {call} {call}\nTool results:\nTool calc_tool result: 4\nTool calc_tool result: 4\nNow integrate and continue:"
    assert rows[2].answer == f"{call} {call}" and rows[3].answer == "Error in model inference: no model"
    assert rounds.converse(asked.limit(0), ask).collect() == []
    for some, why in ((asked.where("id = 4"), "question is blank"), (asked.where("id = 3"), "asking failed: no model")):
        with pytest.raises(PySparkException, match=why):
            rounds.converse(some, ask, strict=True).collect()
    with pytest.raises(PySparkException, match="answer is blank"):
        rounds.converse(asked.where("id = 1"), lambda open_, k: open_.withColumn("output", F.lit(" ")), strict=True).collect()
    with pytest.raises(ValueError):
        rounds.converse(asked, ask, most=0)


def test_each_distinct_call_of_a_round_is_executed_once(spark, tmp_path):
    log = tmp_path / "log"
    log.touch()

    def slow(x):
        with log.open("a") as out:
            out.write("x\n")
        return x[::-1]

    registry = toolcalls.Registry()
    registry.register_function(spark, "slow", slow)
    asked = spark.range(40).select("id", F.lit("q").alias("question"))
    ask = lambda open_, k: open_.withColumn("output", F.lit('{"tool_call": {"name": "slow", "arguments": {"query": "abc"}}}' if k == 1 else "end"))
    assert rounds.converse(asked, ask, registry).where("prompt LIKE '%result: cba%'").count() == 40
    assert log.read_text().count("x") == 1


# Appends
def test_two_appends_from_one_state_leave_no_gap(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "tasks")
    sinks.append_tasks(spark, path, spark.createDataFrame([("first",)], "task_details string"))
    both = threading.Barrier(2, timeout=300)
    commit, met = Commits.commit, threading.local()

    def together(self, number, entry):
        # Both have read the same state before either commits.
        if not getattr(met, "once", False):
            met.once = True
            both.wait()
        return commit(self, number, entry)

    monkeypatch.setattr(Commits, "commit", together)
    tables = [spark.range(n).select(F.concat(F.lit(f"{n}-"), F.col("id").cast("string")).alias("task_details")) for n in (7, 5)]
    with ThreadPoolExecutor(2) as pool:
        added = [f.result() for f in [pool.submit(sinks.append_tasks, spark, path, t) for t in tables]]
    assert sorted(a.count() for a in added) == [5, 7]
    assert sorted(r.id for r in sinks.tasks_of(spark, path).collect()) == list(range(1, 14))
    ids = sorted(sorted(r.id for r in a.collect()) for a in added)
    assert all(x == list(range(x[0], x[0] + len(x))) for x in ids)


def test_a_repeated_append_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "tasks")
    some = spark.createDataFrame([("b",), (None,), ("a",), ("a",)], "task_details string").withColumn("id", F.lit("mine"))
    for _ in range(2):
        rows = sinks.append_tasks(spark, path, some, append="monday").orderBy("id").collect()
        assert [(r.id, r.task_details) for r in rows] == [(1, "a"), (2, "a"), (3, "b")]
    # A writer that died after writing its rows left no commit: its rows are never seen.
    sinks._numbered(some).write.parquet(f"{path}/rows/folder=rows-lost")
    assert sinks.append_tasks(spark, path, some.limit(0)).count() == 0 and sinks.tasks_of(spark, path).count() == 3
    assert [r.id for r in sinks.append_tasks(spark, path, some.where("task_details = 'b'")).collect()] == [4]


def test_a_number_is_given_once(spark, tmp_path):
    log = Commits(spark, str(tmp_path), "by string")
    assert log.latest() == (0, None) and log.commit(1, {"by": "a"}) and not log.commit(1, {"by": "b"})
    assert log.latest()[0] == 1 and log.latest()[1]["by"] == "a" and [r.by for r in log.entries().collect()] == ["a"]


# Cache
def test_cache_executes_nothing_twice_and_forgets_the_oldest(spark, tmp_path):
    log = tmp_path / "log"
    log.touch()

    def shout(x):
        with log.open("a") as out:
            out.write(f"{x}\n")
        return x.upper()

    registry = toolcalls.Registry()
    registry.register_function(spark, "shout", shout)
    memo = Memo(str(tmp_path / "memo"), most=3)
    run = lambda *xs: {r.q: (r.result, r.cached) for r in memo.execute(spark.createDataFrame([("shout", {"q": x}, x, "kept") for x in xs], "name string, arguments map<string,string>, q string, _digest string"), registry).collect()}
    assert run("a", "b", "a") == {"a": ("Tool shout result: A", False), "b": ("Tool shout result: B", False)}
    assert run("b", "a") == {"a": ("Tool shout result: A", True), "b": ("Tool shout result: B", True)} and len(log.read_text().split()) == 2
    run("c"), run("a", "d")
    # Four were used; b, used least recently, has left.
    assert memo.known(spark)[1].count() == 3 and run("b")["b"][1] is False and run("a")["a"][1] is True
    old = Memo(str(tmp_path / "memo"), age=1)
    assert old.execute(spark.createDataFrame([("shout", {"q": "a"})], "name string, arguments map<string,string>"), registry).first().cached is False
    assert memo.execute(spark.createDataFrame([], "name string, arguments map<string,string>"), registry).collect() == []
    null = memo.execute(spark.createDataFrame([("shout", None), (None, {"q": "a"})], "name string, arguments map<string,string>"), registry).collect()
    assert len(null) == 2


# Tokens and batches
def test_labels_take_time_in_proportion(spark):
    took = []
    for n in (1000, 4000):
        rows = spark.range(40).select((F.col("id") / 8).cast("int").alias("batch"), F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: (i % 50 + 1).cast("int")).alias("input_ids"))
        tokens.collate(rows, "batch", [7, 8]).agg(F.sum(F.size("labels"))).collect()
        start = time.perf_counter()
        out = tokens.collate(rows, "batch", [7, 8])
        assert out.select(F.sum(F.size(F.filter("labels", lambda x: x == tokens.IGNORED)))).first()[0] == 40 * 7
        took.append(time.perf_counter() - start)
    assert took[1] < 10 * took[0] + 2


def test_a_batch_without_ids_fails_by_name(spark):
    rows = spark.createDataFrame([(1, [5, 6], "x"), (1, [], "x"), (2, None, "x"), (2, [], "x")], "batch int, input_ids array<int>, _n string")
    good = tokens.collate(rows.where("batch = 1"), "batch", [5])
    assert [(r.input_ids, r.labels, r["_n"]) for r in good.collect()] == [([5, 6], [-100, 6], "x")]
    with pytest.raises(PySparkException, match="no row has ids in batch 2"):
        tokens.collate(rows, "batch", [5]).collect()
    assert tokens.collate(rows.limit(0), "batch", [5]).collect() == []
    with pytest.raises(ValueError):
        tokens.collate(rows, "batch", [])


def test_batches_keep_to_their_budget(spark):
    rows = spark.range(500).select("id", F.when(F.col("id") % 9 == 0, None).otherwise(F.sequence(F.lit(1), (F.col("id") % 70 + 1).cast("int"))).alias("ids"), F.lit("x").alias("_n"), F.lit("y").alias("_wide"))
    out = curate.batched(rows.repartition(7), "ids", ["id"], 128).collect()
    again = curate.batched(rows.repartition(3), "ids", ["id"], 128).collect()
    assert sorted((r.id, r.batch_id) for r in out) == sorted((r.id, r.batch_id) for r in again) and {(r["_n"], r["_wide"]) for r in out} == {("x", "y")}
    by_batch = {}
    for r in out:
        by_batch.setdefault(r.batch_id, []).append(len(r.ids or [0]))
    assert sorted(by_batch) == list(range(len(by_batch)))
    assert all(max(ns) * len(ns) <= 128 for ns in by_batch.values())
    longest = [max(by_batch[b]) for b in sorted(by_batch)]
    assert longest == sorted(longest)
    assert curate.batched(rows.limit(0), "ids", ["id"], 128).collect() == []
    assert [r.batch_id for r in curate.batched(rows.where("id = 69"), "ids", ["id"], 4).collect()] == [0]


def test_subword_counts_equal_whole_texts(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    odd = [None, "", " \n", "IT'S <|endoftext|> a b　c É. ΟΔΟΣ ΟΔΟΣ. \x1c x", "word " * 3000]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text").unionAll(spark.createDataFrame([(t,) for t in odd], "text string"))
    tokenizer = tokens.SubwordTokenizer(path)
    tokenizer.words_most = 400
    for r in docs.select("text", tokenizer.count(F.col("text")).alias("n"), tokenizer.ids(F.col("text")).alias("ids")).collect():
        assert list(r.ids) == whole.encode(r.text or "", add_special_tokens=False).ids and r.n == len(r.ids)


def test_padding_falls_back_to_the_end_token(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert tokens.SubwordTokenizer.padded_by(path, "<|endoftext|>", "<pad>").pad == tokens.SubwordTokenizer.padded_by(path, "<|endoftext|>").pad == 49407
    tokenizer = tokens.SubwordTokenizer.padded_by(path, "<|endoftext|>", "<|startoftext|>")
    assert tokenizer.pad == 49406
    rows = tokens.tokenize(spark.createDataFrame([("",), (None,), ("hello world",)], "text string"), tokenizer).select("input_ids").collect()
    assert [r.input_ids for r in rows[:2]] == [[49406]] * 2 and len(rows[2].input_ids) == 2
    with pytest.raises(ValueError):
        tokens.SubwordTokenizer.padded_by(path, "<none>")


# Sources and row functions
def test_paths_are_checked_before_any_work(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text("{}\n")
    (tmp_path / "file").write_text("x")
    made = lambda i, o: config.Config(config.DataConfig(input=str(tmp_path / i), output=str(tmp_path / o)))
    assert config.check_paths(spark, made("*.jsonl", "out")).data.output.endswith("out")
    for bad, why in ((made("none.jsonl", "out"), "no such input"), (made("in.jsonl", "file"), "output is a file")):
        with pytest.raises(ValueError, match=why):
            config.check_paths(spark, bad)


def test_lines_are_numbered_through_all_blocks(spark, tmp_path):
    good = '{"messages": []}'
    texts = {"a.jsonl": [good, "", "{bad", "[1]"] * 700, "b.jsonl": [good] * 3 + ["{}"], "empty.jsonl": []}
    for name, lines in texts.items():
        (tmp_path / name).write_text("".join(line + "\n" for line in lines))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = jsonl.numbered(spark, str(tmp_path)).collect()
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() >= 20
        bad = jsonl.report(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.file.rsplit("/", 1)[1], r.line, r.value) for r in rows) == sorted((n, i + 1, line) for n, lines in texts.items() for i, line in enumerate(lines))
    reasons = {"": "blank", "{bad": "malformed", "[1]": "not_object", "{}": "no_messages"}
    assert sorted((r.file.rsplit("/", 1)[1], r.line, r.reason) for r in bad) == sorted((n, i + 1, reasons[line]) for n, lines in texts.items() for i, line in enumerate(lines) if line in reasons)


def test_row_functions_keep_what_raised(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, None, 1.5), (3, "c", 2.5)], "made int, error string, record double")
    good, bad = rowwise.mapped(rows, lambda r: None if r["made"] == 3 else {"made": r["made"], "up": r["error"].upper()}, "made int, up string, more string")
    assert [tuple(r) for r in good.collect()] == [(1, "A", None)]
    (failed,) = bad.collect()
    assert failed.error.startswith("AttributeError") and json.loads(failed.record) == {"made": 2, "error": None, "record": 1.5}
    wrong, why = rowwise.mapped(rows, lambda r: {"n": "text" if r["made"] == 2 else r["made"]}, "n int", rows=2)
    assert sorted(r.n for r in wrong.collect()) == [1, 3] and why.count() == 1
    kept, bad = rowwise.filtered(rows, lambda r: r["error"] > "a")
    assert [tuple(r) for r in kept.collect()] == [(3, "c", 2.5)] and kept.columns == rows.columns and bad.count() == 1
    empty, none = rowwise.mapped(rows.limit(0), lambda r: r, "made int")
    assert empty.collect() == [] and none.collect() == []


# Rules
def test_rules_as_data_equal_the_case(spark):
    rules = [Rule("New York|old town", "place"), Rule("york", "name"), Rule("ing", "doing", "part"), Rule("er t", "gram", "part"), Rule("a", "short", "part"), Rule(r"\d{3}", "number", "regex"), Rule("d.g", "pattern"), Rule("über", "word")]
    texts = ["in new york now", "NEW  YORK", "york", "newyork", "the old town hall", "singing", "after three", "xyz 123", "dig it", "Über uns", "zzz", "", None, "old-town", "old town", "er tx"] * 2
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").withColumn("_digest", F.lit("x")).withColumn("token", F.lit(1)).withColumn("ord", F.lit(2))
    for some in (rules, rules[:2], [rules[5]], []):
        given = table(spark, some)
        out = classify_by_table(df, "t", ["id"], given, "none")
        want = df.select("id", classify(F.col("t"), some, "none").alias("label"))
        assert sorted((r.id, r.label) for r in out.collect()) == sorted((r.id, r.label) for r in want.collect())
        assert out.columns == [*df.columns, "label"]
    bare = classify_by_table(df, "t", ["id"], table(spark, rules).drop("keys"), "none")
    assert sorted((r.id, r.label) for r in bare.collect()) == sorted((r.id, r.label) for r in df.select("id", classify(F.col("t"), rules, "none").alias("label")).collect())


def test_many_rules_need_no_nested_loop(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    words = docs.select(F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}_]+")).alias("w")).where("length(w) > 5").distinct().orderBy(F.md5("w")).limit(9_000)
    rules = [Rule(r.w, f"l{i % 50}") for i, r in enumerate(words.collect())]
    out = classify_by_table(docs, "text", ["doc_id"], table(spark, rules), "none")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "BroadcastHashJoin" in plan and len(rules) == 9_000
    first = {r.key: r.label for r in reversed(rules)}
    order = {r.key: i for i, r in reversed(list(enumerate(rules)))}
    import re

    for r in out.collect():
        said = {w for w in re.split(r"[^\w]+", (r.text or "").lower()) if w in first}
        assert r.label == (first[min(said, key=order.__getitem__)] if said else "none")


# Inner names
def test_inner_names_leave_the_users_columns(spark):
    taken = ["_d", "_mine", "_digest", "_first", "_row", "_h", "_b", "_off", "_rank", "_args", "_tool", "_told", "_n"]
    df = spark.range(30).select("id", *(F.concat(F.lit(n), F.col("id").cast("string")).alias(n) for n in taken))
    row = {r.id: r for r in df.collect()}
    for out in (curate.keep_first(df, ["id"], ["_d"]), curate.sample(df, 12, ["id"]), curate.split(df, 0.2, ["id"]), curate.sample_with_replacement(df, 9, ["id"]), curate.flag_for_review(df, 0.2, ["id"], "_h", F.col("_h")), curate.ranked(df, ["id"], "s")):
        rows = out.collect()
        assert rows and all(r[n] == row[r.id][n] for r in rows for n in taken)
    called = df.withColumns({"name": F.lit("x"), "arguments": F.create_map(F.lit("a"), F.lit("b"))})
    assert all(r[n] == row[r.id][n] for r in toolcalls.execute_calls(called).collect() for n in taken)
    assert fresh(df, "d", "D", "new", also=["_NEW"]) == ["_d_", "_D__", "_new_"]
