from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import messages as msg
from corpusloom.operators import packing, samples, tokenizing
from corpusloom.sources import tables

KIND = "conv_id long, conversations array<struct<role:string,content:string,tool_calls:string,tools:string,reasoning_content:string>>"
TOOLS = '[{"name": "f"}]'


def rows(spark, *convs):
    return spark.createDataFrame([(i, c if c is None else [(m + (None,) * 5)[:5] for m in c]) for i, c in enumerate(convs)], KIND)


def test_samples_by_a_tokenizer(spark):
    df = rows(
        spark, [("user", "hi"), ("assistant", "hello there")], [], None, [("user", "only a question")], [("system", "s", None, "not json"), ("user", "a"), ("assistant", "b")],
        [("system", "s", None, TOOLS), ("user", "q"), ("assistant", "c", "broken["), ("tool", "r"), ("assistant", "word " * 400)], [("system", ""), ("user", "x"), ("assistant", "y", '[{"name": "f", "arguments": {}}]')],
    )
    load = tokenizing.file_tokenizer("/opt/tokenizers/byte_bpe_50k.json")
    got = {r["conv_id"]: r for r in samples.sft_samples(df, "conv_id", samples.by_file(load), 200, ratio=0.0).collect()}
    assert [got[i]["status"] for i in range(7)] == ["emitted", "empty", "empty", "no_supervision", "tools", "long", "emitted"]
    assert all((r["input_ids"] is not None) == (r["status"] == "emitted") for r in got.values())
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    said = [x for x in got[0]["labels"] if x != packing.IGNORE]
    assert tok.decode(said, skip_special_tokens=False).startswith("hello there") and all(a in (b, packing.IGNORE) for a, b in zip(got[0]["labels"], got[0]["input_ids"]))
    text = tok.decode(got[6]["input_ids"], skip_special_tokens=False)
    assert text.startswith("<|im_start|>system\n") and not text.startswith("<|im_start|>system\n<|im_end|>") and '{"name": "f", "arguments": {}}' in text
    report = samples.shard_report(samples.sft_samples(df, "conv_id", samples.by_file(load), 200, ratio=0.0), "conv_id", 2).orderBy("shard").collect()
    assert [(r["rows"], r["emitted"]) for r in report] == [(4, 2), (3, 0)]


def test_a_share_gets_a_system_prompt(spark):
    df = rows(spark, *[[("user", f"question {i}"), ("assistant", "yes")] for i in range(300)])
    n = samples.transcripts(df, "conv_id").where(F.startswith("text", F.lit("<|im_start|>system"))).count()
    assert 30 <= n <= 95
    assert samples.transcripts(df, "conv_id", ratio=0.0).where(F.startswith("text", F.lit("<|im_start|>system"))).count() == 0


def test_preference_rows(spark, tmp_path):
    p = tmp_path / "p.jsonl"
    p.write_text('{"chosen": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "good"}], "rejected": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "bad"}]}\n')
    got = samples.strict_pairs(tables.preferences(spark, str(p))).first()
    assert (got["chosen"], got["rejected"]) == ("good", "bad") and got["prompt"].endswith("q<|im_end|>\n")
    for bad in ('{"chosen": [{"role": "user", "content": "q"}], "rejected": []}', '{"chosen": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "rejected": [{"role": "user", "content": "other"}, {"role": "assistant", "content": "b"}]}'):
        p.write_text(bad + "\n")
        with pytest.raises(Exception, match="preference pair"):
            samples.strict_pairs(tables.preferences(spark, str(p))).collect()
    p.write_text("{broken\n")
    with pytest.raises(Exception, match="bad JSON"):
        tables.preferences(spark, str(p), flat=True).collect()
    with pytest.raises(KeyError, match="rejected"):
        tables.require_columns(spark.createDataFrame([(1,)], "chosen int"), "chosen", "rejected")


def test_tools_and_calls(spark):
    df = rows(spark, [("system", "s", None, " " + TOOLS + " ")], [("user", "u", None, TOOLS)], [("system", "s", None, "{bad")], [("system", "s")], [("assistant", "a", " [1] "), ("assistant", "b", "[1"), ("user", "c", "[1")])
    got = [r[0] for r in df.select("conv_id", msg.parsed_tools(F.col("conversations")).alias("t")).orderBy("conv_id").select("t").collect()]
    assert got == [TOOLS, None, "", None, None]
    calls = df.where("conv_id = 4").select(msg.fill_tool_calls(F.col("conversations")).alias("c")).first()["c"]
    assert [m["tool_calls"] for m in calls] == ["[1]", None, "[1"]


def test_long_conversations_cost_by_their_length(spark):
    """150,000 characters in 150 replies; spans were worked out anew for every character before (minutes)."""
    import time

    turns = [m for i in range(150) for m in (("user", f"q{i}"), ("assistant", "é" + "x" * 950))]
    began = time.time()
    got = samples.sft_samples(rows(spark, turns, [("user", "a"), ("assistant", "\U0001f600b")]), "conv_id", samples.characters, 1_000_000, ratio=0.0).orderBy("conv_id").collect()
    assert time.time() - began < 60
    said = lambda r: "".join(chr(x) for x in r["labels"] if x != packing.IGNORE)
    assert said(got[0]) == ("é" + "x" * 950 + "<|im_end|>") * 150 and said(got[1]) == "\U0001f600b<|im_end|>"
    report = samples.shard_report(samples.sft_samples(rows(spark, turns), "conv_id", samples.characters, 2000, ratio=0.0), "conv_id", 1).first()
    assert (report["rows"], report["long"]) == (1, 1)
