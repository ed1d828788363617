from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import packing, splitting, stats
from corpusloom.operators.packing import Stage


def sequential(docs, schedule, sep):
    buffer = [x for i, d in enumerate(docs) for x in (([sep] if i else []) + d)]
    out, stage = [], 0
    while buffer:
        while schedule[stage].until is not None and len(out) >= schedule[stage].until:
            stage += 1
        out.append(buffer[: schedule[stage].size])
        del buffer[: schedule[stage].size]
    return out


@pytest.mark.parametrize("schedule", [(Stage(7),), (Stage(3, 2), Stage(5, 6), Stage(11))])
def test_packing_is_the_sequential_loop(spark, schedule):
    rng = random.Random(5)
    docs = [(s, p, [rng.randrange(1, 99) for _ in range(rng.randrange(0, 20))]) for s in range(3) for p in range(15)]
    df = spark.createDataFrame(docs, "shard long, pos long, input_ids array<int>").repartition(5)
    got = packing.pack(df, schedule=schedule, separator=0).orderBy("shard", "chunk").collect()
    for s in range(3):
        want = sequential([d for x, _, d in docs if x == s and d], schedule, 0)
        assert [r["input_ids"] for r in got if r["shard"] == s] == want
    assert all(r["labels"] == r["input_ids"] for r in got)


def test_schedule_rules():
    assert packing.parse_schedule([{"until_index": 2, "pack_bin_size": 8}, {"pack_bin_size": 16}]) == (Stage(8, 2), Stage(16))
    assert packing.parse_schedule(None, 5) == (Stage(5),)
    for bad in ([{"until_index": 2, "pack_bin_size": 8}], [{"pack_bin_size": 8}, {"pack_bin_size": 8}], [{"pack_bin_size": 0}]):
        with pytest.raises(ValueError):
            packing.parse_schedule(bad)


def test_segments_positions_masks(spark):
    sep, pad = 9, 0
    df = spark.createDataFrame([(0, [10, 11, 12, sep, 13, 14, 15, 0, 0])], "row int, input_ids array<int>")
    long = packing.tokens_long(df, ["row"], pad=pad)
    pos = packing.position_ids(packing.segment_ids(long, ["row"], sep), ["row"], sep).orderBy("idx").collect()
    assert [r["position"] for r in pos] == [0, 1, 2, 0, 1, 2, 3, 0, 0]
    assert [r["segment"] for r in pos] == [0, 0, 0, 0, 1, 1, 1, -1, -1]
    pairs = {(r["q"], r["k"]) for r in packing.mask_pairs(packing.segment_ids(long, ["row"], sep), ["row"]).collect()}
    seg = [r["segment"] for r in pos]
    assert pairs == {(q, k) for q in range(7) for k in range(q + 1) if seg[q] == seg[k]}


def test_padding_and_labels(spark):
    df = spark.createDataFrame([(0, [1, 2], [1, 2]), (0, [3], [3]), (1, [4], [4])], "b int, input_ids array<int>, labels array<int>")
    got = sorted((r["b"], r["input_ids"], r["labels"]) for r in packing.pad_batches(df, "b").collect())
    assert got == [(0, [1, 2], [1, 2]), (0, [3, 0], [3, -100]), (1, [4], [4])]
    text = "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\nabc<|im_end|>\n<|im_start|>assistant\nd<|im_end|>\n"
    spans = spark.createDataFrame([(text,)], "t string").select(packing.supervised_spans(F.col("t"))).first()[0]
    assert [text[s["lo"] : s["hi"]] for s in spans] == ["abc<|im_end|>", "d<|im_end|>"]


def test_histogram_edges(spark):
    h = lambda xs, n: [(r["bin"], r["n"]) for r in stats.equal_width_histogram(spark.createDataFrame([(x,) for x in xs], "v double"), "v", n).orderBy("bin").collect()]
    assert h([0.0, 1.0, 2.0, 4.0, float("nan"), float("inf"), None], 4) == [(0, 1), (1, 1), (2, 1), (3, 1)]
    assert h([3.0, 3.0], 5) == [(0, 2)]
    assert h([], 5) == []
    p = stats.percentile_bounds(spark.createDataFrame([(float(i),) for i in range(10)] + [(float("nan"),)], "v double"), "v", 1, 95).first()
    assert abs(p["lo"] - 0.09) < 1e-12 and abs(p["hi"] - 8.55) < 1e-12


def test_splits(spark):
    df = spark.range(100).withColumnRenamed("id", "pos")
    a = {r["pos"] for r in splitting.with_split(df, "pos", 10).where("split = 'val'").collect()}
    b = {r["pos"] for r in splitting.with_split(df.repartition(7), "pos", 10).where("split = 'val'").collect()}
    assert a == b and len(a) == 10
    assert splitting.with_split(df, "pos", 500).where("split = 'train'").count() == 0
    assert splitting.with_split(df, "pos", 0).where("split = 'val'").count() == 0
    exact = {r["pos"] for r in splitting.exact_split(df, "pos", 10).where("split = 'val'").collect()}
    assert exact == set(random.Random(42).sample(range(100), 10))


@pytest.mark.parametrize("n_in,n_out,want", [(50, 50, (10, 10)), (3, 50, (3, 17)), (50, 4, (16, 4)), (3, 4, (3, 4))])
def test_quota_backfill(spark, n_in, n_out, want):
    df = spark.createDataFrame([(i, i < n_in) for i in range(n_in + n_out)], "id int, s boolean")
    got = splitting.quota_sample(df, "id", F.col("s"), 20, 0.5).collect()
    assert (sum(r["s"] for r in got), sum(not r["s"] for r in got)) == want


def test_order_statistics_are_exact_in_rounds(spark):
    """Ranks among many ties, outliers and spread-out values, with few values ever fetched."""
    rng = random.Random(6)
    values = [rng.choice((1.0, 2.5, -7.0)) for _ in range(3000)] + [rng.lognormvariate(0, 9) for _ in range(3000)] + [-1e300, 1e300, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    ranks = [0, 1, 2, 700, 2999, 3500, 5200, len(values) - 2, len(values) - 1]
    want = sorted(values)
    for few in (20, 700, 50_000):
        assert stats.order_statistics(df, ranks, few) == [want[r] for r in ranks]


def test_packing_does_not_depend_on_the_parts(spark):
    """A shard that holds nearly all rows, null shards, empty documents, cut into parts in several ways."""
    rng = random.Random(2)
    rows = [(i, None if i % 50 == 0 else 0 if i % 7 else 1, [rng.randrange(1, 99) for _ in range(rng.randrange(0, 9))]) for i in range(400)]
    df = spark.createDataFrame(rows, "pos long, shard int, input_ids array<int>")
    want = {}
    for s in (None, 0, 1):
        flat = []
        for _, own, ids in rows:
            if own == s and ids:
                flat += ([0] if flat else []) + ids
        want |= {(s, k // 16): flat[k : k + 16] for k in range(0, len(flat), 16)}
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got = {(r["shard"], r["chunk"]): r["input_ids"] for r in packing.pack(df, schedule=(packing.Stage(16),)).collect()}
        assert got == want
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_arrays_equal_the_long_form(spark):
    """Separators at both ends, in a row and none; no window and no join."""
    rng = random.Random(3)
    rows = [(i, [rng.choice((0, 1, 2, 3)) for _ in range(rng.randrange(1, 30))]) for i in range(60)] + [(100, [0]), (101, [0, 0, 5]), (102, [7, 0]), (103, [1, 2])]
    df = spark.createDataFrame(rows, "row int, input_ids array<int>")
    seg = packing.segment_ids(packing.tokens_long(df, ["row"]), ["row"], 0)
    c = F.col("input_ids")
    got = df.select("row", packing.segments_of(c, 0).alias("s"), packing.positions_of(c, 0).alias("p"), packing.mask_pair_count(c, 0).alias("n"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    long = got.select("row", F.posexplode(F.arrays_zip("s", "p")).alias("idx", "x")).select("row", "idx", "x.s", "x.p")
    want = packing.position_ids(seg, ["row"], 0).select("row", "idx", "segment", "position")
    assert sorted(map(tuple, long.collect())) == sorted(map(tuple, want.collect()))
    pairs = {r["row"]: r["count"] for r in packing.mask_pairs(seg, ["row"]).groupBy("row").count().collect()}
    assert {r["row"]: r["n"] for r in got.collect()} == pairs


def test_ids_are_worked_out_once(spark):
    """A filter on the ids isn't pushed below them; a report works them out in one pass; words parted and hashed as in SQL."""
    import hashlib

    from corpusloom.operators import tokenizing

    texts = ["a b\x1cc\x85d\xa0e　f ​g", "", None, " \t", "x" * 200 + " x", "É é"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select("doc_id", tokenizing.hashed_words(F.col("text")).alias("input_ids"))
    want = [[int(hashlib.md5(w.encode()).hexdigest()[:7], 16) % 32768 + 1 for w in (x or "").split()] for x in texts]
    assert [r["input_ids"] for r in df.orderBy("doc_id").collect()] == want
    plan = df.where(F.size("input_ids") > 0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    report = stats.corpus_report(df)
    assert "EvalPython" not in report._jdf.queryExecution().executedPlan().toString()
    assert report.first().asDict() == {"rows": 6, "kept": 3, "dropped": 3, "first_length": 7, "head_tokens": 11}
