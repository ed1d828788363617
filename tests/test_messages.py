from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import messages as msg

KIND = "id int, c array<struct<role:string,content:string,tool_calls:string,tools:string,reasoning_content:string>>"
NAMES = {"s": "system", "u": "user", "a": "assistant", "T": "assistant", "t": "tool", "x": "other"}


def conv(*ms):
    return [(m + (None,) * 5)[:5] for m in ms]


def run(spark, rows, *cols):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], KIND)
    return [tuple(r)[1:] for r in df.select("id", *cols).orderBy("id").collect()]


def chain(letters: str):
    """The rule in words: optional system before a user, then user and assistant by turns; calls need tools."""
    n, i = len(letters), 0
    if not n:
        return "empty"
    if letters[0] == "s":
        i = 1
        if n == 1 or letters[1] != "u":
            return "after_system_expect_user"
    while i < n:
        if letters[i] != "u":
            return f"expect_user_at_{i}"
        i += 1
        if i == n or letters[i] not in "aT":
            return f"expect_assistant_at_{i}"
        calls = letters[i] == "T"
        i += 1
        if calls:
            first = i
            while i < n and letters[i] == "t":
                i += 1
            if i == first:
                return "tool_calls_without_tool_messages"
            if i == n or letters[i] not in "aT":
                return "expect_assistant_after_tool"
            i += 1
    return None


def test_role_chain_on_all_short_strings(spark):
    words = ["".join(w) for n in range(5) for w in itertools.product("suaTt", repeat=n)]
    rows = [conv(*[(NAMES[x], "y", '[{"name":"f"}]' if x == "T" else None) for x in w]) for w in words]
    got = run(spark, rows, msg.role_chain_reason(F.col("c")), msg.role_chain_ok(F.col("c")))
    assert [g[0] for g in got] == [chain(w) for w in words]
    assert [g[1] for g in got] == [chain(w) is None for w in words]


def test_predicates(spark):
    rows = [
        conv(("user", "a <think>"), ("assistant", "I cannot answer")), conv(("user", "q"), ("user", "r")), conv(("assistant", None, "[]")), conv(("assistant", "x", "[1]")), [], conv(("system", "s", None, "[]")),
    ]
    got = run(spark, rows, msg.has_think(F.col("c"), ["<think>", ""]), msg.is_refusal(F.col("c")), msg.is_multi_turn(F.col("c")), msg.is_tool_related(F.col("c")), msg.count_turns(F.col("c")), msg.tool_call_chars(F.col("c")))
    assert got[0] == (True, True, False, False, 1, 0)
    assert [g[2] for g in got] == [False, True, False, False, False, False]
    assert [g[3] for g in got] == [False, False, False, True, False, True]
    assert got[3][5] == 3


def test_repair(spark):
    rows = [conv(("assistant", "a", "```json\n[{\"n\": 1,}]\n```"), ("user", "b", "junk")), conv(("assistant", "a", "null")), conv(("assistant", "a", '[{"a":1')), conv(("assistant", "a", '[{"a":1}'))]
    got = [r[0] for r in run(spark, rows, msg.repair_tool_calls(F.col("c")))]
    assert got[0][0]["tool_calls"] == '[{"n": 1}]' and got[0][1]["tool_calls"] == "junk"
    assert got[1][0]["tool_calls"] is None and got[2][0]["tool_calls"] is None and got[3][0]["tool_calls"] == '[{"a":1}]'


def test_render(spark):
    c = conv(("system", "S"), ("user", "Q"), ("assistant", "<think>t</think>\n\nA", '[{"function":{"name":"f","arguments":"{}"}},{"name":"g","arguments":{"x":1}}]'), ("tool", "r1"), ("tool", "r2"), ("system", "again"), ("weird", "w"), ("assistant", None))
    plain, tooled, prompted = run(spark, [c], msg.render(F.col("c")), msg.render(F.col("c"), F.lit('[{"n":1}]')), msg.render(F.col("c"), generation_prompt=True))[0]
    call = '<tool_call>\n{"name": "f", "arguments": {}}\n</tool_call>\n<tool_call>\n{"name": "g", "arguments": {"x":1}}\n</tool_call>'
    body = (
        f"<|im_start|>user\nQ<|im_end|>\n<|im_start|>assistant\nA\n{call}<|im_end|>\n<|im_start|>user\n<tool_response>\nr1\n</tool_response>\n<tool_response>\nr2\n</tool_response><|im_end|>\n"
        "<|im_start|>system\nagain<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    )
    assert plain == "<|im_start|>system\nS<|im_end|>\n" + body
    assert tooled.startswith("<|im_start|>system\nS\n\n# Tools\n\nYou may call") and '<tools>\n{"n":1}\n</tools>' in tooled and tooled.endswith(body)
    assert prompted == plain + "<|im_start|>assistant\n"


def test_preferences(spark):
    a, b = conv(("user", "q"), ("assistant", "good")), conv(("user", "q"), ("assistant", "bad"))
    df = spark.createDataFrame([(0, a, b), (1, a, []), (2, conv(("user", "z"), ("user", "q")), b), (3, a, conv(("user", "other"), ("assistant", "bad")))], "id int, x " + KIND.split("c ", 1)[1] + ", y " + KIND.split("c ", 1)[1])
    got = df.select("id", msg.dpo_triplet(F.col("x"), F.col("y")).alias("d"), msg.same_prefix(F.col("x"), F.col("y")).alias("p")).orderBy("id").collect()
    assert tuple(got[0]["d"]) == ("<|im_start|>user\nq<|im_end|>\n", "good", "bad") and got[0]["p"]
    assert got[1]["d"] is None and got[2]["d"] is None and not got[3]["p"]


@pytest.mark.parametrize("ratio", [0.0, 1.0])
def test_injection(spark, ratio):
    rows = [conv(("user", "q")), conv(("system", ""), ("user", "q")), conv(("system", "s"), ("user", "q"))]
    got = [r[0] for r in run(spark, rows, msg.inject_system(F.col("c"), F.col("id"), ratio))]
    assert len(got[0]) == 1 + int(ratio) and got[1][0]["content"] in msg.PROMPTS and got[2][0]["content"] == "s"
