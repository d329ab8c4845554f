from pyspark.sql import functions as F

from convmill.operators import curate
from convmill.plans import pipelines
from convmill.sources import sinks
from convmill.sources.jsonl import load


def test_save_lines_leaves_out_what_json_cannot_write(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1.5, "a"), (2, float("nan"), "b"), (3, None, "c"), (4, float("inf"), None)], "id long, x double, t string")
    assert sinks.save_lines(rows, str(tmp_path / "lines")) == 2
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "lines")).collect()) == ['{"id":1,"x":1.5,"t":"a"}', '{"id":3,"x":null,"t":"c"}']


def test_tasks_are_numbered_on(spark, tmp_path):
    tasks, path = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "task_details string"), str(tmp_path / "tasks")
    for first in (1, 4):
        assert [(r.id, r.task_details) for r in sinks.append_tasks(spark, path, tasks).orderBy("id").collect()] == [(first, "a"), (first + 1, "b"), (first + 2, "c")]


def test_keep_first_leaves_one_of_ties(spark):
    rows = spark.createDataFrame([("x", 1, "b"), ("x", 1, "a"), ("x", 1, "a"), ("x", 2, "a"), (None, 5, None), (None, 5, None), ("", 5, None)], "k string, o long, v string")
    assert sorted(map(str, curate.keep_first(rows, ["k"], ["o"]).collect())) == sorted(["Row(k='x', o=1, v='a')", "Row(k=None, o=5, v=None)", "Row(k='', o=5, v=None)"])


def test_repeated_lines_give_one_record(spark, tmp_path):
    line = '{"messages": [{"role": "user", "content": "How do I plan a small habit?"}, {"role": "assistant", "content": "Start small."}]}'
    (tmp_path / "chats.jsonl").write_text("\n".join([line] * 3))
    chats = load(spark, str(tmp_path / "chats.jsonl")).selectExpr("md5(value) AS conv_id", "messages")
    pairs = chats.select("conv_id", F.col("messages")[0]["content"].alias("prompt"), F.col("messages")[1]["content"].alias("response"))
    records = pipelines.intent_records(pairs)
    out = pipelines.curated(records).collect()
    assert records.count() == 30 and len(out) == len({r.application_prompt + r.ideal_response_final for r in out}) and len({r.intent_id for r in out}) == len(out) <= 10
