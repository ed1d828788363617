from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import tokenizing
from corpusloom.operators.cleaning import QualityConfig
from corpusloom.plans import jobs
from corpusloom.sources import sinks, tables
from corpusloom.streaming import jobs as streaming


def test_pretrain_fixture(spark):
    rows = [(i, "short") for i in range(20)] + [(i, f"a duplicated text number {(i - 20) // 2} of some length") for i in range(20, 40)] + [(i, f"a distinct text number {i} of some length") for i in range(40, 100)]
    df = spark.createDataFrame(rows, "pos long, text string")
    out, counts = jobs.pretrain(df, jobs.PretrainConfig(near_dedup=False))
    c = counts.first().asDict()
    assert [c[k] for k in ("input_lines", "after_basic_clean", "after_exact_dedup", "after_near_dedup", "output_lines")] == [100, 80, 70, 70, 70]
    assert c["rejects"] == {"length": 20} and out.select("text").distinct().count() == 70


def test_chat_fixture(spark):
    def m(*ms):
        return [(x + (None,) * 5)[:5] for x in ms]

    good = lambda i: m(("user", f"<think>a question number {i}</think>"), ("assistant", f"an answer of some length {i}"))
    rows = [(i, []) for i in range(10)] + [(i, m(("assistant", "hello there, how are you today"))) for i in range(10, 20)]
    rows += [(i, m(("user", f"please tell me {i}"), ("assistant", "I cannot answer that question"))) for i in range(20, 30)] + [(i, m(("user", "hi"), ("assistant", "ok"))) for i in range(30, 40)]
    rows += [(i, good((i - 40) // 2)) for i in range(40, 60)]
    tool = m(("user", "look something up for me"), ("assistant", "calling", '[{"name": "f", "arguments": {},},]'), ("tool", "result"), ("assistant", "here is what I found"))
    rows += [(60, tool)] + [(i, good(1000 + i)) for i in range(61, 100)]
    kind = "pos long, conversations array<struct<role:string,content:string,tool_calls:string,tools:string,reasoning_content:string>>"
    cfg = jobs.ChatConfig(quality=QualityConfig(min_chars=20), strict_roles=True, markers={"<think>": "[t]", "</think>": "[/t]"}, near_dedup=False)
    out, counts = jobs.chat(spark.createDataFrame(rows, kind), cfg)
    c = counts.first()
    assert (c["skipped_empty_conversations"], c["skipped_role_order"], c["skipped_refuse_reply"], c["skipped_length"]) == (10, 10, 10, 10)
    assert (c["after_exact_dedup"], c["after_near_dedup"], c["output_lines"], c["markers_normalized_rows"]) == (50, 60, 50, 90)
    assert c["tool_calls_repaired"] >= 1 and len(c["role_examples"]) == 8
    assert out.where("pos = 60").first()["conversations"][1]["tool_calls"] == '[{"name": "f", "arguments": {}}]'


def test_job_file(spark, tmp_path):
    src = tmp_path / "in.jsonl"
    src.write_text("\n".join(json.dumps({"text": f"this is document number {i}"}) for i in range(30)) + "\n\n", encoding="utf-8")
    job = jobs.parse_job({"kind": "pretrain", "input": str(src), "output": str(tmp_path / "out.jsonl"), "unknown": 1, "pretrain": {"near_dedup": False, "quality": {"min_chars": 5}}, "split": {"val": 5}, "stats_path": str(tmp_path / "stats.json")})
    written = jobs.run(spark, job)
    assert spark.read.json(written["output"]).count() == 25 and spark.read.json(written["val"]).count() == 5
    assert json.loads((tmp_path / "stats.json").read_text())["output_lines"] == 30
    for bad in ({"kind": "x", "input": "a", "output": "b"}, {"kind": "sft", "output": "b"}):
        with pytest.raises(ValueError):
            jobs.parse_job(bad)
    with pytest.raises(TypeError):
        jobs.parse_job({"kind": "pretrain", "input": "a", "output": "b", "pretrain": []})


def test_scan_policies(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"text": "a"}\n\n{bad\n[1]\n{"text": "b"}\n')
    assert tables.json_lines(spark, str(p), policy="skip").count() == 2
    good, bad = tables.split_corrupt(tables.json_lines(spark, str(p), policy="log").cache())
    assert good.count() == 2 and bad.count() == 2
    for policy in ("strict", "raise"):
        with pytest.raises(Exception, match="(?i)malformed|bad JSON"):
            tables.json_lines(spark, str(p), policy=policy).collect()


def test_token_files(spark, tmp_path):
    df = spark.createDataFrame([(i, f"some words {i}" if i % 5 else "  ") for i in range(50)], "pos long, text string")
    path = "/opt/tokenizers/word_bpe_49k.json"
    ids = tokenizing.corpus_to_tokens(df, tokenizing.file_tokenizer(path))
    assert ids.count() == 40
    sinks.write_tokens(ids.repartition(1), str(tmp_path / "tok"), rows_per_file=15)
    assert len(list((tmp_path / "tok").glob("*.parquet"))) == 3
    assert tables.detect(str(tmp_path / "tok")) == "parquet_dir" and tables.load(spark, str(tmp_path / "tok")).count() == 40
    shards = tables.file_sharded(spark, str(tmp_path / "tok"), 2).groupBy("shard").count().orderBy("shard").collect()
    assert [r["count"] for r in shards] in ([30, 10], [25, 15])
    with_pos = spark.createDataFrame([(i, [i] if i % 2 else []) for i in range(10)], "pos long, input_ids array<int>")
    assert [r["pos"] for r in tables.row_shard(with_pos, "pos", 1, 3).orderBy("pos").collect()] == [1, 7]
    with pytest.raises(KeyError):
        tables.token_rows(spark, "/root/testdata/sf0.001/nation.parquet")


def test_positions_are_contiguous(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(6)
    got = tables.with_position(df, ["k"]).collect()
    assert all(r["k"] == r["pos"] for r in got) and len(got) == 1000


def test_stream_equals_batch(spark, small, tmp_path):
    schema = spark.read.parquet(f"{small}/documents.parquet").schema
    src = tmp_path / "docs"
    spark.read.parquet(f"{small}/documents.parquet").repartition(3).write.parquet(str(src))
    cfg = QualityConfig(max_punctuation=0.1)
    stream = streaming.unique_stream(streaming.clean_stream(spark.readStream.schema(schema).parquet(str(src)), cfg))
    streaming.run_available(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    batch = streaming.clean_stream(spark.read.parquet(str(src)), cfg).select("fingerprint").distinct()
    got = spark.read.parquet(str(tmp_path / "out")).select("fingerprint")
    assert got.count() == batch.count() and got.exceptAll(batch).isEmpty()


def test_paths():
    p = sinks.derived_paths("/x/data.jsonl", val="/y/v.jsonl")
    assert p["val"] == "/y/v.jsonl" and p["tool_val"] == "/x/data_tool_val.jsonl" and p["report"] == "/x/data_report"


SECTIONS = {
    "kind": "pretrain", "write_plots": True,
    "split": {"pretrain": {"enabled": True, "val_size": 5, "seed": 42}},
    "pipeline": {
        "text_field": "body", "intra_doc_dedupe_paragraphs": True, "exact_dedup": True, "near_dedup": {"enabled": False, "threshold": 0.88, "num_perm": 128, "shingle_size": 5},
        "basic": {"min_chars": 5, "max_chars": 200000, "truncate": True, "allowed_langs": [], "lang_backend": "fasttext", "fasttext_model_path": "lid.bin", "max_punctuation_ratio": 0.55},
        "ppl_enable": True, "ppl_apply_percentile_filter": True, "ppl_sort_ascending": True, "ppl": {"model_name": "unigram"}, "ppl_low_percentile": 1.0, "ppl_high_percentile": 95.0,
        "tokenizer_path_for_diagnostics": "/opt/tokenizers/word_bpe_49k.json", "topic": {"enabled": False},
    },
}


def test_section_layout_is_run_as_it_says(spark, tmp_path):
    src = tmp_path / "in.jsonl"
    src.write_text("\n".join(json.dumps({"body": f"this is document number {i} of many words {i * i}"}) for i in range(40)) + "\n")
    values = SECTIONS | {"input": str(src), "output": str(tmp_path / "o" / "out.jsonl"), "stats_path": str(tmp_path / "stats.json")}
    job = jobs.parse_job(values)
    assert (job.pretrain.text_field, job.pretrain.quality.min_chars, job.pretrain.near_dedup, job.split.val, job.pretrain.score.apply_filter) == ("body", 5, False, 5, True)
    written = jobs.run(spark, job)
    stats = json.loads((tmp_path / "stats.json").read_text())
    assert stats["input_lines"] == 40 and 36 <= stats["output_lines"] < 40
    assert spark.read.json(written["output"]).count() + spark.read.json(written["val"]).count() == stats["output_lines"]
    report = json.loads(open(written["report"]).read())
    assert report["funnel"][0]["n"] == 40 and sum(b["n"] for b in report["tokens"]) == stats["output_lines"] and len(report["scores"]) == 30
    assert report["top_tokens"][0]["piece"] and report["top_tokens"][0]["count"] >= report["top_tokens"][1]["count"]


def test_gates_that_cannot_run_are_refused(spark, tmp_path):
    src = tmp_path / "in.jsonl"
    src.write_text(json.dumps({"text": "a text of some length that stays"}) + "\n")
    base = {"kind": "pretrain", "input": str(src), "output": str(tmp_path / "out.jsonl"), "split": {"pretrain": {"enabled": False}}}
    with pytest.raises(ValueError, match="language"):
        jobs.run(spark, jobs.parse_job(base | {"pipeline": {"near_dedup": {"enabled": False}}}))
    with pytest.raises(ValueError, match="fasttext"):
        jobs.parse_job(base | {"pipeline": {"basic": {"lang_backend": "other"}}})
    off = {"allowed_langs": []}
    with pytest.raises(ValueError, match="token"):
        jobs.run(spark, jobs.parse_job(base | {"pipeline": {"basic": off | {"min_tokens": 3}}}))
    with pytest.raises(ValueError, match="scor"):
        jobs.run(spark, jobs.parse_job(base | {"pipeline": {"basic": off, "ppl_enable": True, "ppl": {"model_name": "some/model"}}}))
    with pytest.raises(ValueError, match="topic"):
        jobs.parse_job(base | {"pipeline": {"topic": {"enabled": True}}})
    with pytest.raises(TypeError):
        jobs.parse_job(base | {"pipeline": {"basic": {"allowed_langs": "en", "lang_backend": "x"}}})
    with pytest.warns(UserWarning, match="surprise"):
        jobs.parse_job(base | {"pipeline": {"surprise": 1}})
    # given what they need, gates decide
    known = F.array(F.struct(F.lit("fr").alias("lang"), F.lit(0.9).alias("confidence")))
    job = jobs.parse_job(base | {"stats_path": str(tmp_path / "s.json"), "pipeline": {"basic": {"allowed_langs": ["en"]}, "near_dedup": {"enabled": False}}})
    jobs.run(spark, job, jobs.Seams(languages=lambda c: known))
    assert json.loads((tmp_path / "s.json").read_text())["rejects"] == {"language": 1}
    tokens = {"basic": off | {"min_tokens": 500}, "near_dedup": {"enabled": False}, "tokenizer_path_for_diagnostics": "/opt/tokenizers/word_bpe_49k.json"}
    jobs.run(spark, jobs.parse_job(base | {"stats_path": str(tmp_path / "s.json"), "pipeline": tokens}))
    assert json.loads((tmp_path / "s.json").read_text())["rejects"] == {"tokens": 1}


def test_chat_sections(spark, tmp_path):
    src = tmp_path / "c.jsonl"
    say = lambda i: [{"role": "user", "content": f"<think>please tell me about number {i}"}, {"role": "assistant", "content": f"number {i} is a number of some length"}]
    rows = [{"talk": say(i)} for i in range(6)] + [{"talk": []}] + [{"talk": [{"role": "user", "content": "a question of some length"}, {"role": "assistant", "content": "an answer of some length"}]}] * 2
    src.write_text("\n".join(map(json.dumps, rows)) + "\n")
    job = jobs.parse_job({
        "kind": "sft", "input": str(src), "output": str(tmp_path / "out.jsonl"), "stats_path": str(tmp_path / "s.json"), "write_plots": True,
        "split": {"sft": {"enabled": True, "tool_call_val_size": 1, "multi_turn_val_size": 1}},
        "sft": {"conversations_field": "talk", "drop_think_samples": True, "allowed_langs": [], "near_dedup": {"enabled": False}, "exact": {"algorithm": "md5"}, "tokenizer_path_for_diagnostics": "/opt/tokenizers/word_bpe_49k.json"},
    })
    written = jobs.run(spark, job)
    stats = json.loads((tmp_path / "s.json").read_text())
    assert (stats["skipped_think_samples"], stats["skipped_empty_conversations"], stats["after_exact_dedup"], stats["output_lines"]) == (6, 1, 1, 1)
    report = json.loads(open(written["report"]).read())
    assert report["mean_turns"] == 1.0 and report["user_tokens"][0]["n"] == 1 and report["turns"]
    assert "talk" in spark.read.json(written["output"]).columns
