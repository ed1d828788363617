from __future__ import annotations

import random
from collections import defaultdict
from itertools import combinations

from corpusloom.operators import neardup
from corpusloom.operators.neardup import MinHashConfig
from corpusloom.sources.tables import Shared


def test_banding():
    assert MinHashConfig(threshold=0.88).banding() == (6, 21)
    assert MinHashConfig(threshold=0.90).banding() == (5, 25)


def test_greedy_fixpoint_is_the_sequential_scan(spark):
    for seed in range(3):
        rng = random.Random(seed)
        rows = [(d, b, str(rng.randrange(12))) for d in range(60) for b in range(2)]
        kept: list[int] = []
        by = {d: {(b, k) for e, b, k in rows if e == d} for d in range(60)}
        for d in range(60):
            if not any(by[d] & by[k] for k in kept):
                kept.append(d)
        df = spark.createDataFrame(rows, "doc_id long, band int, bucket string")
        drops = {r[0] for r in neardup.greedy_drops(df, Shared(spark, "t")).collect()}
        assert drops == set(range(60)) - set(kept)


def test_chain_keeps_both_ends(spark):
    a, b, c = "a b c d e f g h i j k l".split(), "a b c d e f g h i j x y".split(), "a b c d e f p q r s x y".split()
    df = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate((a, a, b, c))] + [(9, None), (10, "")], "doc_id long, text string")
    kept = {r["doc_id"] for r in neardup.near_dedup(df, MinHashConfig(threshold=0.9, shingle_size=2)).collect()}
    assert 0 in kept and 1 not in kept and {9, 10} <= kept


def test_pairs_equal_brute_force(spark, small):
    d = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    sets = {}
    for r in d.collect():
        w = r["text"].lower().split()
        sets[r["doc_id"]] = {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {" ".join(w)} if w else set()
    want = {(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.5}
    members, classes = neardup.shingle_sets(d)
    own = defaultdict(list)
    for r in members.collect():
        own[r["class_id"]].append(r["doc_id"])
    # pairs of classes and membership hold every link between documents
    got = {(min(x, y), max(x, y)) for r in neardup.pairs_above(classes, 0.5).collect() for x in own[r["a"]] for y in own[r["b"]]}
    got |= {p for m in own.values() for p in combinations(sorted(m), 2)}
    assert got == want
    links = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in neardup.links_above(d, 0.5).collect()}
    assert links == {x: (min(y for y in sets if sets[y] == sets[x]), sum(x in p for p in want)) for x in sets if sets[x]}


def test_copies_are_counted_and_not_listed(spark):
    rows = [(i, "one two three four five six seven") for i in range(500)] + [(900 + i, f"one two three four five six seven {i}") for i in range(3)] + [(999, None), (1000, " ")]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in neardup.links_above(spark.createDataFrame(rows, "doc_id long, text string"), 0.7).collect()}
    assert len(got) == 503 and all(got[i] == (0, 502) for i in range(500)) and all(got[900 + i] == (900 + i, 500) for i in range(3))


def test_verified_greedy_is_the_sequential_scan(spark):
    rng = random.Random(5)
    base = [f"w{k}" for k in range(30)]
    rows = []
    for i in range(60):
        w = list(base if i % 3 else base[::-1])
        for _ in range(rng.randrange(6)):
            w[rng.randrange(30)] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(w)))
    rows += [(100, rows[3][1]), (101, None), (102, "")]
    grams = {i: {tuple(t.split()[k : k + 2]) for k in range(len(t.split()) - 1)} for i, t in rows if t}
    kept: list[int] = []
    for i in grams:
        if not any(len(grams[i] & grams[k]) / len(grams[i] | grams[k]) >= 0.6 for k in kept):
            kept.append(i)
    got = {r["doc_id"] for r in neardup.near_dedup_verified(spark.createDataFrame(rows, "doc_id long, text string"), 0.6, 2).collect()}
    assert got == {*kept, 101, 102} and len(kept) < 58


def test_sets_are_hashes_and_lone_shingles_stay_behind(spark):
    """Shingles were kept and shuffled as texts, each set three times, those of one set alone as well."""
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(40))) for i in range(30)]
    rows += [(100 + i, t + f" end {i}") for i, t in rows[:10]]
    _, sets = neardup.shingle_sets(spark.createDataFrame(rows, "doc_id long, text string"), 5)
    assert dict(sets.dtypes)["s"] == "array<bigint>"
    got = {(r["a"], r["b"]): r["jaccard"] for r in neardup.pairs_above(sets, 0.9).collect()}
    assert got == {(i, 100 + i): 36 / 38 for i in range(10)}


def test_signatures_in_steps(spark):
    """More shingles than are hashed at a time give the least of all of them; null ids, texts without words."""
    import numpy as np

    cfg = MinHashConfig(threshold=0.6, num_perm=16)
    long = " ".join(f"w{k}" for k in range(neardup.STEP * 2 + 100))
    df = spark.createDataFrame([(1, long), (None, "a b"), (3, " ")], "doc_id long, text string")
    got = {r["doc_id"]: r["signature"] for r in neardup.signatures(df, cfg).collect()}
    h = neardup.shingle_hashes(long, 5)
    assert got[1] == [int(((a * h + b) % neardup.PRIME).min()) for a, b in cfg.permutations()] and got[3] is None and len(got[None]) == 16
    assert isinstance(h, np.ndarray) and len(h) > neardup.STEP * 2 and int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
