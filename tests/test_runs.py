"""Settings, the command line and the agent loop."""

import json

import pytest

from convmill.__main__ import main
from convmill.operators import calls as N
from convmill.operators import toolcalls as K
from convmill.plans import config as C

CHAT = '{"messages": [{"role": "user", "content": "How do I plan %d?"}, {"role": "assistant", "content": "Start small %d."}]}'


def test_config_files_and_checks(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"data": {"input": "in.jsonl", "output": "/o", "share": 0.2}, "tokens": {"most": 9}}))
    c = C.load(str(tmp_path / "c.json"))
    assert c.checked().data.input == str(tmp_path / "in.jsonl") and c.data.output == "/o" and c.tokens.most == 9 and c.data.factor == 10
    C.save(c, str(tmp_path / "d.json"))
    assert C.load(str(tmp_path / "d.json")) == c
    (tmp_path / "bad.json").write_text('{"data": {"nope": 1}}')
    with pytest.raises(ValueError, match="nope"):
        C.load(str(tmp_path / "bad.json"))
    for change, why in (({"share": 1.5}, "share"), ({"factor": 0}, "factor"), ({"output": ""}, "needed"), ({"output": c.data.input}, "differ"), ({"dialect": "x"}, "dialect")):
        with pytest.raises(ValueError, match=why):
            C.Config(C.DataConfig(**{**vars(c.data), **change})).checked()


@pytest.mark.parametrize("task", ["records", "pairs", "variants"])
def test_command_line(spark, tmp_path, task):
    (tmp_path / "in.jsonl").write_text("\n".join(CHAT % (i, i) for i in range(6)) + "\n{bad\n")
    assert main([task, "--input", str(tmp_path / "in.jsonl"), "--output", str(tmp_path / "out"), "--factor", "3", "--share", "0.5"]) == 0
    rows = spark.read.json(str(tmp_path / "out"))
    assert rows.count() == {"records": 18, "pairs": 6, "variants": 24}[task]


def test_calls_at_any_depth(spark):
    deep = '{"tool_call": {"name": "n", "arguments": {"a": {"b": {"c": {"d": {"e": [1, "}"]}}}}}}}'
    df = spark.createDataFrame([(1, f"x {deep} y {{\"tool_call\": 3}} {{\"tool_call\" {deep}"), (2, None)], "id long, t string")
    rows = N.extract(df, "t", ["id"]).orderBy("call").collect()
    assert [(r.call, r.name) for r in rows] == [(0, "n"), (1, "n")] and json.loads(rows[0].arguments)["a"]["b"]["c"]["d"]["e"] == [1, "}"]


def test_agent_loop():
    script = ['Need data: {"tool_call": {"name": "calc", "arguments": {"query": "6*7"}}}', "It is 42."]
    seen = []

    def step(messages):
        seen.append([m["content"] for m in messages])
        return script[min(len(seen) - 1, 1)]

    assert K.converse(step, "6 times 7?", lambda name, args: K.calculate(args["query"])) == "It is 42." and seen[1][-1] == "Tool results: 42"
    always = lambda messages: script[0]
    assert K.converse(always, "q", lambda n, a: "x", most=3) == script[0]

    def fail(name, args):
        raise RuntimeError("down")

    assert K.converse(always, "q", fail, most=1) == script[0]
    for bad in (lambda: K.converse(always, " ", fail, strict=True), lambda: K.converse(lambda m: "", "q", fail, strict=True)):
        with pytest.raises(ValueError):
            bad()
    with pytest.raises(RuntimeError):
        K.converse(always, "q", fail, strict=True)
