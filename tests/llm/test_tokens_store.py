from __future__ import annotations

import random
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm import store, tokens

PARTS = (
    "it's I'll don't über Ünïcode étude 漢字テスト 한국어 <|endoftext|> a<|startoftext|>b ...!! x1y22 ΑΣ İstanbul 가x ab\x1ccd '' 're 'rex \U0001f600ok ﬁne aaaaaaa the é̂x naïve, Ⅷx ²3 a_b_, \"'s,\" "
    "l'été 'r 'v've ''s .'s 'lL 'Ll 9's नमस्ते क्षत्रिय éȩ̀x Å 각 ́a <|endoftext <|startof a\xa0b x\u2003y aİ \x00\x1b <|endoftext|><|endoftext|> '<|endoftext|>s 's<|startoftext|>'t ß ª µ word, (word) a-b"
).split(" ")


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(tokens.default_path())


def texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) + rng.choice([" ", "  ", "\n", "\t", ""]) for _ in range(rng.randrange(0, 9))) for _ in range(n)]


def test_every_prefix_is_exact(lib):
    p = tokens.Pieces.get(tokens.default_path())
    for x in texts(150):
        want = [len(e.ids) for e in lib.encode_batch([x[:k] for k in range(len(x) + 1)], add_special_tokens=False)]
        assert tokens.counts(p.prefix_deltas([x])[0]).tolist() == want, x


def test_pieces_without_spaces(lib):
    """Pieces glued of all kinds, counted without the library's help."""
    p, rng = tokens.Pieces.get(tokens.default_path()), random.Random(8)
    for _ in range(120):
        x = "".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 8))).replace("\n", "").replace(" ", "")
        want = [len(e.ids) for e in lib.encode_batch([x[:k] for k in range(1, len(x) + 1)], add_special_tokens=False)]
        assert tokens.Walk(p).counts(x) == want, x


def test_long_pieces_take_bounded_memory_and_time(lib):
    """A text of 1 MB without a space, with apostrophes; another of combining marks; special strings in a third."""
    script = (
        "import resource, time, numpy as np\n"
        "from corpusloom.llm import tokens\n"
        "p = tokens.Pieces.get(tokens.default_path())\n"
        "for x in ('abc\\'d.e' * 142_858, 'e\\u0301don\\'t' * 6000, 'a' + '\\u0301' * 2000, 'ab<|endoftext|>' * 3000):\n"
        "    d = p.prefix_deltas([x])[0]\n"
        "    assert len(tokens.unpack(d)) == len(x) and tokens.counts(d)[-1] == len(p.encode([x])[0]) == len(p.id_bytes([x])[0]) // 2\n"
        "assert max(map(len, p.deltas)) <= tokens.LONG_PIECE and max(map(len, p.ids)) <= tokens.LONG_PIECE\n"
        "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)\n"
    )
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=120, cwd=Path(tokens.__file__).parents[2])
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) < 1000


def test_clashing_names_give_way(spark):
    x = tokens.prefix_token_counts(spark.createDataFrame([(1, "one two", 9)], "doc_id long, text string, n_tokens int"))
    assert x.columns == ["doc_id", "text", "n_tokens", "prefix_store"] and x.first()["n_tokens"] == 2


def test_ids_are_the_librarys(lib):
    p = tokens.Pieces.get(tokens.default_path())
    own = texts(400, 2)
    for x, raw in zip(own, p.id_bytes(own)):
        assert np.frombuffer(raw, "<u2").tolist() == lib.encode(x, add_special_tokens=False).ids, x


def test_full_cache_changes_nothing(monkeypatch, lib):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 40)
    p = tokens.Pieces(tokens.default_path())
    for x in texts(60, 3):
        assert len(p.id_bytes([x])[0]) == 2 * len(lib.encode(x, add_special_tokens=False).ids)
        assert tokens.counts(p.prefix_deltas([x])[0])[-1] == len(lib.encode(x, add_special_tokens=False).ids)


def test_wide_stores():
    store_ = tokens.WIDE + np.asarray([300, -299, 5], "<i4").tobytes()
    assert tokens.counts(store_).tolist() == [0, 300, 1, 6] and tokens.longest_within(store_, 4) == 2


def test_token_counts(spark, odd, empty, lib):
    for r in tokens.token_counts(odd).collect():
        t = odd.where(F.col("doc_id").eqNullSafe(F.lit(r["doc_id"]))).first()["text"] or ""
        n = len(lib.encode(t, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), n, n > 2048)
        assert len(lib.encode(t[: r["fit_chars"]], add_special_tokens=False).ids) <= 2048
    assert tokens.token_counts(empty).count() == 0
    x = tokens.prefix_token_counts(odd.select("doc_id", "text"))
    got = x.where("doc_id = 5").select(tokens.count_at("prefix_store", 7), tokens.fits_budget("prefix_store", 2), "n_tokens").first()
    assert got[0] == len(lib.encode("one two", add_special_tokens=False).ids) and got[1] == len("one two ") and got[2] == 3


def test_store_round_trip(spark, small, odd, lib, tmp_path):
    for name, df in (("docs", spark.read.parquet(f"{small}/documents.parquet")), ("odd", odd)):
        root = f"file://{tmp_path}/{name}"
        store.write(df, root)
        rows = sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
        ids = {r["start"]: r["ids"] for r in store.read_ids(spark, root).collect()}
        got = sorted(store.digests(spark, root).collect(), key=lambda r: r["start"])
        at = 0
        assert [r["doc_id"] for r in got] == [i for i, _ in rows]
        for (i, t), r in zip(rows, got):
            want = [*lib.encode(t, add_special_tokens=False).ids, store.END_ID]
            assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(want), zlib.crc32(np.asarray(want, "<u4").tobytes()))
            assert ids[at] == want
            at += len(want)
        check = store.verify(spark, root)
        assert check["damaged_documents"] == check["damaged_parts"] == 0
        chunks = spark.read.parquet(f"{root}/chunks")
        assert chunks.select("hash").distinct().count() == chunks.count()


def test_empty_store(spark, empty, tmp_path):
    assert store.encode_and_digest(empty, f"file://{tmp_path}/none").count() == 0


def test_damage_is_found(spark, small, tmp_path):
    root = f"file://{tmp_path}/a"
    store.write(spark.read.parquet(f"{small}/documents.parquet"), root)
    rows = spark.read.parquet(f"{root}/chunks").collect()
    rows = [(bytes(r["hash"]), r["n_ids"], r["refs"], b"\xff\xff" + bytes(r["payload"])[2:]) for r in rows]
    bad = spark.createDataFrame(rows, "hash binary, n_ids int, refs long, payload binary")
    bad.write.mode("overwrite").parquet(f"{root}/chunks")
    with pytest.raises(Exception, match="damaged"):
        store.verify(spark, root)


def test_swapped_chunks_are_found(spark, tmp_path):
    """Reordered chunks keep every chunk's hash and the number of ids, not the document's root."""
    root = f"file://{tmp_path}/s"
    text = " ".join(f"word{i} of {i * i}" for i in range(2000))
    store.write(spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string"), root)
    rows = spark.read.parquet(f"{root}/recipes")
    assert rows.agg(F.max(F.size("hashes"))).first()[0] > 1
    bad = rows.withColumn("hashes", F.reverse("hashes")).withColumn("lens", F.reverse("lens"))
    bad = spark.createDataFrame(bad.collect(), bad.schema)
    bad.write.mode("overwrite").parquet(f"{root}/recipes")
    with pytest.raises(Exception, match="damaged"):
        store.digests(spark, root).collect()


def test_runs_of_roots(spark, tmp_path, monkeypatch):
    """Roots over runs of a few documents; a changed place, total or root of one document is found."""
    monkeypatch.setattr(store, "RUN", 3)
    root = f"file://{tmp_path}/r"
    store.write(spark.createDataFrame([(i % 40, f"text {i} " * (i % 5)) for i in range(100)], "doc_id long, text string"), root)
    good = spark.read.parquet(f"{root}/recipes")
    rows, schema = good.collect(), good.schema
    assert store._damaged_roots(spark, root) == (0, 0)
    starts = sorted((r["start"], r["n_tokens"]) for r in store.recipes(spark, root).collect())
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    top = sum(r["run_root"] is not None for r in rows)
    assert top >= len(rows) / 3
    for change in ({"before": 1}, {"place": 0}, {"n_tokens": 9}, {"root": b"0" * 32}):
        k, v = next(iter(change.items()))
        at = next(i for i, r in enumerate(rows) if r["place"] == 4)
        bad = [tuple(r.asDict().values()) if i != at else tuple((r.asDict() | {k: v}).values()) for i, r in enumerate(rows)]
        spark.createDataFrame(bad, schema).write.mode("overwrite").parquet(f"{root}/recipes")
        with pytest.raises(Exception, match="damaged"):
            store.digests(spark, root).collect()


def test_cuts_are_local():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 49_000, 20_000).astype("<u2")
    b = np.concatenate([a[:5000], rng.integers(0, 49_000, 7).astype("<u2"), a[5000:]])
    for x in (a, b):
        sizes = np.diff([0, *store.cuts(x)])
        assert sizes.sum() == len(x) and sizes.max() <= store.MOST and sizes[:-1].min() >= store.LEAST
    same = {a[i:j].tobytes() for i, j in zip([0, *store.cuts(a)], store.cuts(a))} & {b[i:j].tobytes() for i, j in zip([0, *store.cuts(b)], store.cuts(b))}
    assert len(same) >= len(store.cuts(a)) - 4


def test_joined_checksums():
    rng = random.Random(2)
    parts = [bytes(rng.randrange(256) for _ in range(4 * rng.randrange(1, 300))) for _ in range(20)]
    assert store.joined_crc([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))
