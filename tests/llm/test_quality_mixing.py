from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

from corpusloom.llm import mixing, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    w = WORD.findall(text or "")
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_measures_equal_brute_force(spark, odd):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("a b c d e ## \n \x0b".split(" ")) for _ in range(n))) for i, n in enumerate([0, 1, 2, 3, 5, 50, 400] * 12)]
    rows += [(1000 + i, f"{x} " * 200) for i, x in enumerate(("z", "x y", "\n"))] + [(r["doc_id"] or -1, r["text"]) for r in odd.collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in quality.quality(df).collect())
    assert got == sorted((i, *measures(t)) for i, t in rows)


def test_few_and_many_repeated_windows_agree(spark, monkeypatch):
    rows = [(i, " ".join(random.Random(i).choices("abcdefg", k=300))) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    few = {r["doc_id"]: r["n_repeat_words"] for r in quality.quality(df).collect()}
    monkeypatch.setattr(quality, "FEW", 10_000)
    assert few == {r["doc_id"]: r["n_repeat_words"] for r in quality.quality(df).collect()}


def test_ledger_and_ablations(spark, small):
    led = quality.ledger(quality.measure(spark.read.parquet(f"{small}/documents.parquet"))).cache()
    rows = led.collect()
    for policy, mask in quality.POLICIES.items():
        kept = {r["doc_id"] for r in quality.apply_policy(led, policy).where("kept").collect()}
        assert kept == {r["doc_id"] for r in rows if not r["fail_bits"] & mask}
        for a in quality.ablations(led, policy).collect():
            bit = 1 << next(r.bit for r in quality.RULES if r.name == a["rule"])
            assert a["failed"] == sum(bool(r["fail_bits"] & bit) for r in rows)
            assert a["failed_only_here"] == sum(r["fail_bits"] & mask == bit for r in rows)


def test_filter_passes_columns_through(odd, empty):
    out = quality.filter_documents(odd)
    assert out.columns == odd.columns and {r["doc_id"] for r in out.collect()} <= {1, 2, 3, 4, 5, None, 7}
    assert quality.filter_documents(empty).count() == 0 and quality.quality(empty).count() == 0


def test_no_python_on_the_main_path(odd):
    plan = quality.quality(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def u(i):
    return int(hashlib.md5(f"mix-1|{'' if i is None else i}".encode()).hexdigest()[:15], 16)


def mix_by_hand(rows):
    sized = [(i, s, len(WORD.findall(t or ""))) for i, t, s in rows]
    sources = sorted({s for _, s, _ in sized if s is not None}) + ([None] if any(s is None for _, s, _ in sized) else [])
    size = {s: sum(n for _, x, n in sized if x == s) for s in sources}
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sources)}
    total, full = sum(size.values()) * 1.5, set()
    while True:
        free = [s for s in sources if s not in full]
        level = (total - sum(2 * size[s] for s in full)) / max(1e-300, sum(weight[s] for s in free))
        more = {s for s in free if 2 * size[s] < level * weight[s]}
        if not more:
            break
        full |= more
    target = {s: float(2 * size[s]) if s in full else level * weight[s] for s in sources}
    out = []
    for s in sources:
        own = sorted((u(i), n, i) for i, x, n in sized if x == s)
        whole = int(target[s] // size[s]) if size[s] else 0
        rest, before = target[s] - whole * size[s], 0
        for h in sorted({h for h, _, _ in own}):
            group = [(n, i) for g, n, i in own if g == h]
            n = sum(x for x, _ in group)
            extra = before + n / 2 <= rest
            before += n
            out += [(i, k, size[s], round(target[s], 6), k * (whole + extra)) for k, i in group]
    return sorted(out, key=repr)


def test_mixture_equals_brute_force(spark, odd, empty):
    rng = random.Random(8)
    rows = [(i, "w " * rng.randrange(0, 300), rng.choice(["a", "a", "a", "b", "c", None, "é", "nothing"])) for i in range(400)]
    rows = [(i, "" if s == "nothing" else t, s) for i, t, s in rows] + rows[:5] + [(None, None, "a"), (None, "x y", "b")]
    for n in (1, 5):
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(n)
        got = sorted(((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in mixing.mix_report(df).collect()), key=repr)
        assert got == mix_by_hand(rows)
        assert all(r[4] <= 2 * r[1] for r in got)
    assert mixing.mix_report(empty).count() == 0 and mixing.mix_report(odd).count() == 8


def test_mix_emits_what_the_report_says(spark, odd):
    rows = [(i, "w " * (i % 40), "ab"[i % 2] if i % 3 else "a") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    copies = Counter(r["doc_id"] for r in mixing.mix(df).collect())
    for r in mixing.mix_report(df).where("size > 0").collect():
        assert copies.get(r["doc_id"], 0) * r["size"] == r["taken"]
    assert mixing.mix(odd).columns == odd.columns


def test_empty_texts_keep_the_cap(spark):
    """A source at its cap and one without words: no row more often than the cap, none of a source without words."""
    rows = [(i, "" if i % 3 else "w " * (1 + i % 5), "a" if i % 2 else "b", "x") for i in range(300)] + [(1000 + i, None, "c", "x") for i in range(20)]
    rows += [(2000 + i, "many words here " * 50, "d", "x") for i in range(40)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string, size string")).collect()
    often = Counter(r["doc_id"] for r in out)
    assert max(often.values()) <= mixing.MAX_EPOCHS and not any(1000 <= i < 2000 for i in often)
