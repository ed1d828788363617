from __future__ import annotations

import math

from corpusloom import catalogue
from corpusloom.operators import scoring


def key(r):
    """The reference's key: NaN (and null) last, then score, length, input order."""
    s = math.nan if r["value"] is None else r["value"]
    return math.isnan(s), math.inf if math.isnan(s) else s, len(r["event_type"]), r["event_id"]


def test_every_row_has_its_place(spark):
    scores = [0.5, math.nan, 0.5, None, math.inf, -1.0, math.inf, 0.25, math.nan] * 200
    rows = [(i, s, "ab" * (1 + i % 3)) for i, s in enumerate(scores)]
    df = spark.createDataFrame(rows, "event_id long, value double, event_type string")
    got = {r["event_id"]: r["place"] for r in scoring.places(df, "value", "event_type", "event_id").collect()}
    want = sorted(df.collect(), key=key)
    assert got == {r["event_id"]: i for i, r in enumerate(want, 1)}
    assert scoring.places(df.limit(0), "value", "event_type", "event_id").count() == 0


def test_query_keeps_all_events(spark, small):
    from corpusloom.session import table

    want = sorted(table(spark, small, "events").select("event_id", "value", "event_type").collect(), key=key)
    got = {r["event_id"]: r["place"] for r in catalogue.QUERIES["score_sort"](spark, small).collect()}
    assert got == {r["event_id"]: i for i, r in enumerate(want, 1)}


def test_perplexity_of_repeated_keys_in_several_blocks(spark, monkeypatch):
    """Keys that occur twice count together, null is a key; blocks of three rows; no row per document and word is shuffled."""
    import math
    from collections import Counter, defaultdict

    from corpusloom.operators import scoring

    monkeypatch.setattr(scoring, "BLOCK_ROWS", 3)
    rows = [(i % 7 if i % 5 else None, " ".join(f"W{(i * k) % 11}\x1cé" for k in range(i % 6))) for i in range(40)] + [(50, None), (51, " \t")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    own = defaultdict(list)
    for k, x in rows:
        own[k] += (x or "").lower().split()
    n = Counter(w for ws in own.values() for w in ws)
    a, v = sum(n.values()), len(n)
    want = {k: (len(ws), math.exp(sum(-math.log((n[w] + 1) / (a + v)) for w in ws) / len(ws))) for k, ws in own.items() if ws}
    out = scoring.unigram_perplexity(df)
    assert "CoGroup" in out._jdf.queryExecution().executedPlan().toString()
    got = {r["doc_id"]: (r["n_tokens"], r["ppl"]) for r in out.collect()}
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)
    assert scoring.unigram_perplexity(df.limit(0)).count() == 0
