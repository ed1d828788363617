from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import cleaning
from corpusloom.operators.cleaning import QualityConfig


def reasons(spark, rows, cfg, **kw):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "pos int, text string")
    return [(r["reject"], r["clean"]) for r in cleaning.quality_chain(df, cfg, **kw).orderBy("pos").collect()]


def test_first_reason_wins(spark):
    cfg = QualityConfig(min_chars=5, max_chars=30, max_non_printable=0.01, max_punctuation=0.1)
    got = reasons(spark, ["   ", "abc", "abc\x01defgh", "!!!!!!hello??????", None, "one two three"], cfg)
    assert [r for r, _ in got] == ["empty", "length", "non_printable", "punctuation", "empty", None]
    assert got[-1][1] == "one two three"


def test_language_and_token_gates(spark):
    fr = F.array(F.struct(F.lit("fr").alias("lang"), F.lit(0.9).alias("confidence")))
    cfg = QualityConfig(min_chars=3, allowed_langs=("en",))
    assert reasons(spark, ["hello"], cfg, languages=fr)[0][0] == "language"
    assert reasons(spark, ["hello"], QualityConfig(min_chars=3, allowed_langs=("fr-CA",)), languages=fr)[0][0] is None
    assert reasons(spark, ["hello"], QualityConfig(min_chars=3, allowed_langs=None), languages=fr)[0][0] == "language"
    assert reasons(spark, ["one two"], QualityConfig(min_chars=3, min_tokens=3), n_tokens=F.size(F.split("text", " ")))[0][0] == "tokens"


def test_exact_dedup_keeps_the_first_at_any_partitioning(spark):
    rows = [(i, f"text {i % 7}") for i in range(100)]
    for n in (1, 3, 8):
        df = spark.createDataFrame(rows, "pos int, text string").repartition(n)
        assert sorted(r["pos"] for r in cleaning.exact_dedup(df, "text", "pos").collect()) == list(range(7))


def test_counts_and_funnel(spark):
    cfg = QualityConfig(min_chars=3)
    df = spark.createDataFrame([(0, "aaaa"), (1, "aaaa"), (2, "b"), (3, None)], "doc_id int, text string")
    x = cleaning.quality_chain(df, cfg)
    assert cleaning.stage_counts(x).first().asDict() == {"input_lines": 4, "after_basic_clean": 2, "after_exact_dedup": 1}
    assert [r["dropped"] for r in cleaning.funnel(cleaning.stage_counts(x)).orderBy("step").collect()] == [0, 2, 1]
    none = cleaning.stage_counts(cleaning.quality_chain(df.limit(0), cfg)).first()
    assert none["input_lines"] == 0 and none["after_exact_dedup"] == 0


def test_no_language_is_a_verdict(spark, tmp_path):
    from corpusloom import catalogue

    spark.createDataFrame([(1, "a", "en"), (2, "b", None), (3, "c", "fr")], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["passes"] for r in catalogue.QUERIES["lang_filter"](spark, str(tmp_path)).collect()}
    assert got == {1: True, 2: False, 3: False}
