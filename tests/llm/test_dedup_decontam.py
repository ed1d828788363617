from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpusloom.llm import decontam, dedup

LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """(n_shingles, component_id) of each row by all pairs that share a shingle."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().translate(LOW).split()
        sets.append(frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    inv = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            inv[g].append(i)
    both = Counter((a, b) for own in inv.values() for k, a in enumerate(own) for b in own[k + 1 :])
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, b), n in both.items():
        if 100 * n >= 70 * (len(sets[a]) + len(sets[b]) - n):
            up[max(find(a), find(b))] = min(find(a), find(b))
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(x for x in (low.get(find(i)), d) if x is not None) if d is not None or low.get(find(i)) is not None else None
    return sorted(((d, len(s), low[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def variants(seed, n, edits):
    """A text and near-copies of it, some of them near each other only in a chain."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(8, 120))]
    out, w = [], base
    for _ in range(n):
        w = list(w if rng.random() < 0.5 else base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
        out.append(" ".join(w).upper() if rng.random() < 0.2 else " ".join(w))
    return out


def test_components_equal_brute_force(spark, odd):
    passage = " ".join(f"shared{i}" for i in range(60))
    texts = [t for s in range(25) for t in variants(s, 6, 4)] + variants(99, 150, 3) + [f"{passage} " + " ".join(f"own{k}x{j}" for j in range(40 + k)) for k in range(40)]
    rng = random.Random(1)
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(10_000 + i, t) for i, t in enumerate(["a b", "A b", "", None, "a b c d e", "a b c d e f"])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in dedup.near_duplicates(df).collect()), key=repr)
    assert got == brute(rows)
    kept = dedup.deduplicate(df)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in got})


def test_dense_regions_lose_no_links(spark, monkeypatch):
    """Tiny regions force every depth, the salts and the exact rest."""
    monkeypatch.setattr(dedup, "REGION", 8)
    rows = list(enumerate([t for s in range(4) for t in variants(s, 30, 5)] + variants(50, 60, 1)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in dedup.near_duplicates(df).collect()), key=repr)
    assert got == brute(rows)


def test_dense_rest_compares_all_rows(spark, monkeypatch):
    """A region that no further value cuts: a row meets every row of the other components, not the next few."""
    from corpusloom.llm.common import Scratch

    monkeypatch.setattr(dedup, "REGION", 8)
    name = [b"n%03d" % i for i in range(60)]
    label = dict.fromkeys(name[:40], name[0]) | dict.fromkeys(name[40:57], name[40])  # and three rows by themselves
    size = {x: 100 for x in name} | {name[59]: 10}  # too small for any link
    level0 = spark.createDataFrame([(1, x, size[x], bytes(16) + bytes([i // 30, i]), 60) for i, x in enumerate(name)], "region long, node binary, n long, tail binary, count long")
    labels = spark.createDataFrame(list(label.items()), "node binary, label binary")
    got = {(bytes(r["a"]), bytes(r["b"])) for r in dedup._dense_rest(level0, labels, Scratch(spark, "t")).collect()}
    assert got == {(a, b) for a in name[:59] for b in name[:59] if a < b and label.get(a, a) != label.get(b, b)}


def test_each_group_keeps_one_row(spark):
    """Ids that are null or shared by different texts decide about their own texts only."""
    def words(k):
        return " ".join(f"t{k}x{i}" for i in range(30))

    rows = [
        (1, words(0)), (None, words(0).upper()), (None, words(1)), (None, words(2)),  # null ids: a copy, two texts of their own
        (2, words(3)), (3, words(3) + " end"), (3, words(4)),  # id 3: a near copy of 2, and another text
        (4, words(5)), (4, words(6)), (4, words(6)),  # id 4: two texts, one of them twice
        (5, words(7)), (5, words(7) + " end"),  # id 5: two texts of one group
        (None, words(8)), (None, words(8) + " end"), (6, ""), (6, None), (6, " "),
        (None, words(9)), (7, words(9)),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = dedup.deduplicate(df).collect()
    worded = sorted((r["text"].split()[0].lower().split("x")[0], r["doc_id"] or 0) for r in got if (r["text"] or "").strip())
    assert worded == [("t0", 1), ("t1", 0), ("t2", 0), ("t3", 2), ("t4", 3), ("t5", 4), ("t6", 4), ("t7", 5), ("t8", 0), ("t9", 7)]
    assert sum(r["doc_id"] == 6 for r in got) == 3
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in dedup.near_duplicates(df.where("text like 't9%'")).collect()} == {(None, 7, False), (7, 7, True)}


def test_odd_rows(odd, empty):
    rows = dedup.near_duplicates(odd).collect()
    assert len(rows) == 8 and {r["component_id"] for r in rows if r["doc_id"] == 5} == {5}
    assert all(r["kept"] and r["n_shingles"] == 0 for r in rows if r["doc_id"] in (1, 2, 3))
    out = dedup.deduplicate(odd)
    assert out.columns == odd.columns and out.where("doc_id = 5").count() == 1 and out.count() == 7
    assert dedup.near_duplicates(empty).count() == 0 and dedup.deduplicate(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    from corpusloom.llm.common import Scratch

    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + k) for k in range(1, 30)] + [(200, 201)]
    name = {i: bytes(rng.randrange(256) for _ in range(16)) for e in edges for i in e}
    df = spark.createDataFrame([(name[a], name[b]) for a, b in edges], "a binary, b binary")
    got = {bytes(r["node"]): bytes(r["label"]) for r in dedup.components(df, Scratch(spark, "t"), "t").collect()}
    for lo, hi in ((0, 50), (100, 129), (200, 201)):
        own = [name[i] for i in range(lo, hi + 1)]
        assert {got[x] for x in own} == {min(own)}


def edited(words, k, rng, vocab):
    w = list(words)
    for _ in range(k):
        p = rng.randrange(len(w))
        kind = rng.randrange(3)
        if kind == 0:
            w[p] = f"zz{rng.randrange(99)}"
        elif kind == 1:
            del w[p]
        else:
            w.insert(p, rng.choice(vocab))
    return w


def distance(item, text):
    """Least edit distance of item to any part of text, the plain way."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_search_equals_plain_distance():
    rng = random.Random(5)
    for _ in range(300):
        a, b = [rng.randrange(5) for _ in range(rng.randrange(1, 80))], [rng.randrange(5) for _ in range(rng.randrange(0, 60))]
        assert decontam.search(a, b)[0] == (distance(a, b) if b else len(a))


@pytest.mark.parametrize("share", [0.0, 1.0])
def test_recall_at_the_tolerance(spark, small, share):
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    docs = [r["text"].split(" ")[:150] for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rng = random.Random(6)
    with np.errstate(over="ignore"):
        index = decontam.Index.build(bench)
        vocab = [w.decode() for w in index.vocab]
        texts, want = [], []
        for i, t in bench * 5:
            w = [x.decode() for x in decontam.words_of(t)]
            base = rng.choice(docs)
            p = rng.randrange(len(base) + 1)
            texts.append(" ".join(base[:p] + edited(w, int(share * decontam.edits_allowed(len(w))), rng, vocab) + base[p:]))
            want.append(i)
        found = [any(m[0] == i for m in g) for g, i in zip(index.scan(texts), want)]
    assert np.mean(found) >= 0.99


def test_matches_equal_brute_force(spark):
    rng = random.Random(7)
    vocab = [f"v{i}" for i in range(30)]
    items = [(i, " ".join(rng.choices(vocab, k=n))) for i, n in enumerate([1, 2, 4, 5, 7, 10, 12, 15, 20, 30])] + [(99, None), (98, "")]
    texts = [None, ""] + [" ".join(rng.choices(vocab, k=60)) for _ in range(20)]
    for _, t in items[2:10]:
        for k in range(4):
            texts.append(" ".join(rng.choices(vocab, k=20) + edited((t or "").split(), k, rng, vocab) + rng.choices(vocab, k=20)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["distance"]) for r in decontam.leaks(docs, bench).collect()}
    want = set()
    for d, t in enumerate(texts):
        for i, x in items:
            a, b = (x or "").split(), (t or "").split()
            if a and b and (k := distance(a, b)) <= decontam.edits_allowed(len(a)):
                want.add((d, i, k))
    assert {x[:2] for x in got} <= {x[:2] for x in want}
    assert len(got & want) >= 0.98 * len(want)
    left = {r["doc_id"] for r in decontam.decontaminate(docs, bench).collect()}
    assert left == set(range(len(texts))) - {d for d, _, _ in got}


def test_odd_tables(odd, empty, spark):
    bench = spark.createDataFrame([(1, "one two three"), (2, None)], "item_id long, text string")
    assert {r["doc_id"] for r in decontam.leaks(odd, bench).collect()} == {5}
    out = decontam.decontaminate(odd, bench)
    assert out.columns == odd.columns and out.count() == 6
    assert decontam.leaks(empty, bench).count() == 0 and decontam.leaks(odd, bench.limit(0)).count() == 0


def test_blocks_of_items(odd, spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 2)
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(["one two three", "nothing like it here", "lorem ipsum dolor sit amet"])], "item_id long, text string")
    assert len(list(decontam.blocks(bench))) > 1
    assert {(r["doc_id"], r["item_id"]) for r in decontam.leaks(odd, bench).collect()} == {(5, 0), (4, 2)}


def test_place_of_a_match_does_not_depend_on_the_batch():
    """Three verbatim copies of an item, one of them altered before: the first verbatim one, after any texts."""
    item = " ".join(f"item{k}" for k in range(20))
    rng = random.Random(4)
    fill = lambda n: " ".join(f"f{rng.randrange(10**6)}" for _ in range(n))
    near = item.replace("item3 ", "other ")
    text = f"{fill(5)} {near} {fill(5)} {item} {fill(22)} {item} {fill(22)} {item}"
    index = decontam.Index.build([(1, item)])
    got = set()
    with np.errstate(over="ignore"):
        for n in (0, 1, 2, 7, 50):
            got.add(tuple(index.scan([fill(rng.randrange(40)) + item for _ in range(n)] + [text])[-1]))
    assert got == {((1, 30, 50, 0),)}


def test_blocks_hold_a_bounded_number_of_words(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 10)
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(4))) for k in range(6)] + [(9, " ".join("a" for _ in range(30))), (10, None)]
    own = list(decontam.blocks(spark.createDataFrame(rows, "item_id long, text string").coalesce(1)))
    sizes = [[len(w) for _, w in i.items] for i in own]
    assert sorted(x for s in sizes for x in s) == [4] * 6 + [30] and all(sum(s) <= 10 or len(s) == 1 for s in sizes)
