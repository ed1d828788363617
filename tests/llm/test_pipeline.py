from __future__ import annotations

from collections import Counter

import corpus_pipeline
from corpusloom.llm import decontam, dedup, quality, tokens


def test_stages(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small)
        out.write.mode("overwrite").parquet(f"{tmp_path}/{name.replace(' ', '-')}")
        docs = spark.read.parquet(f"{tmp_path}/{name.replace(' ', '-')}")
        kept[name] = [r["doc_id"] for r in docs.collect()]
        if name != "token output":
            assert docs.columns == names
    first = {r["doc_id"] for r in quality.quality(spark.read.parquet(f"{small}/documents.parquet")).collect() if r["kept"]}
    assert set(kept["quality rules"]) == first
    # each group of near-duplicates among the kept is down to one, its smallest id
    assert len(set(kept["near-duplicates"])) == len(kept["near-duplicates"])
    texts = spark.read.parquet(f"{tmp_path}/near-duplicates")
    assert dedup.near_duplicates(texts).where("not kept").count() == 0
    bench = spark.read.parquet(f"{small}/benchmark.parquet")
    assert decontam.leaks(spark.read.parquet(f"{tmp_path}/decontamination"), bench).count() == 0
    assert set(kept["mixing"]) <= set(kept["decontamination"]) and max(Counter(kept["mixing"]).values()) <= 2
    mixed = spark.read.parquet(f"{tmp_path}/mixing")
    out = spark.read.parquet(f"{tmp_path}/token-output").collect()
    sizes = Counter((r["doc_id"], r["n_tokens"] + 1) for r in tokens.token_counts(mixed).collect())
    assert Counter((r["doc_id"], r["n_tokens"]) for r in out) == sizes
    ordered = sorted(out, key=lambda r: r["start"])
    assert [r["doc_id"] for r in ordered] == sorted(kept["mixing"])
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(ordered, ordered[1:]))


def test_run(spark, small):
    rows = corpus_pipeline.run(spark, small).collect()
    assert rows and len({r["start"] for r in rows}) == len(rows)


def test_odd_rows_pass_all_stages(spark, odd, empty, small, tmp_path):
    for name, docs in (("odd", odd.select("doc_id", "text", "lang", "source", "n_words")), ("empty", empty.select("doc_id", "text", "lang", "source", "n_words"))):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, small).write.parquet(f"{tmp_path}/{name}{k}")
            docs = spark.read.parquet(f"{tmp_path}/{name}{k}")


def test_what_each_stage_keeps(spark, small, tmp_path):
    """Ids shared by different texts, null ids, a null source, a word of 70,000 characters."""
    words = lambda k: " ".join(f"w{k}n{j}{'abcdefg'[j % 7]}" for j in range(80))
    long = words(9) + " " + " ".join(f"w9m{j}" for j in range(20_000)) + " " + "don't.x" * 10_000  # enough words to pass the rules
    bench = spark.read.parquet(f"{small}/benchmark.parquet").first()["text"]
    rows = [
        (1, words(1), "a"), (1, words(2), "a"), (1, words(1), "a"), (2, words(1), "b"), (None, words(3), None), (None, words(4), "a"), (None, words(2), "a"),
        (5, long, "b"), (6, f"{words(6)} {bench} {words(7)}", "a"), (7, None, "a"), (8, "few words", "b"),
    ]
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, small).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append(docs.collect())
    texts = [sorted(Counter((r["doc_id"], (r["text"] or "")[:12]) for r in own).items(), key=repr) for own in kept[:3]]
    first = [t[:12] for t in (words(1), words(2), words(3), words(4), words(6), words(9))]
    assert len(kept[0]) == 9 and not {7, 8} & {r["doc_id"] for r in kept[0]}
    assert [x for x, _ in texts[1]] == sorted([(1, first[0]), (1, first[1]), (None, first[2]), (None, first[3]), (6, first[4]), (5, first[5])], key=repr)
    assert [x for x, _ in texts[2]] == [x for x in [x for x, _ in texts[1]] if x[0] != 6]
    assert {r["doc_id"] for r in kept[3]} <= {1, 5, None} and kept[3]
    sizes = Counter((r["doc_id"], r["n_tokens"] + 1) for r in tokens.token_counts(spark.read.parquet(f"{tmp_path}/3")).collect())
    assert Counter((r["doc_id"], r["n_tokens"]) for r in kept[4]) == sizes
