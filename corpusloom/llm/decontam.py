"""Benchmark decontamination: passages of a document within an edit distance of a benchmark item.

Unit of edits is the word (lower case, punctuation dropped); an item of n words is found where some
passage differs from it by at most ``floor(0.2 n)`` insertions, deletions and substitutions.

1. Windows: a document's words are mapped to the benchmark's vocabulary.  By the q-gram lemma a passage
   within k edits shares at least ``n - q + 1 - qk`` of the item's q-grams on diagonals at most k apart, so
   only item-sized windows at such diagonals are looked at; none within the tolerance is lost.
2. CGK embedding: a random walk over the window repeats or steps on each word as a random function of
   step and word says, which turns few edits into a small Hamming distance.  ``WALKS`` walks with ``SAMPLES``
   samples of ``BITS`` positions each give the keys under which items of the same length are looked up.
3. Every candidate is verified by exact edit distance (bit-parallel dynamic programming over the whole
   item against the window and its margin).

Items are taken in blocks of a fixed number of words, so the index sent to the executors has a bound; a
larger benchmark takes more passes over the documents.

Defined results: null or empty texts and items without words match nothing; repeated rows are judged one
by one; items with the same words are all reported; of several passages that match an item the nearest is
reported, of those the first, whatever texts stand beside it; an empty table on either side gives no matches;
other columns are ignored, or pass through ``decontaminate``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import arrow_batches

TOLERANCE = 0.2
GRAM = 3
WALKS, SAMPLES, BITS = 4, 16, 2
#: Words of a block of items; an item longer than this is a block of its own.
BLOCK_WORDS = 2_000_000
WORD_BITS = 21
SEED = 11

_ASCII = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))
_PUNCTUATION = dict.fromkeys(map(ord, "¡¿«»“”„‘’‚…–—·、。，；：？！（）《》「」"), " ")


def words_of(text: str) -> list[bytes]:
    low = text.lower()
    if not low.isascii():
        low = low.translate(_PUNCTUATION)
    return low.encode("utf-8", "replace").translate(_ASCII).split()


def edits_allowed(n: int) -> int:
    return int(TOLERANCE * n)


def search(item: list[int], text: list[int]) -> tuple[int, int]:
    """Least edit distance of ``item`` to any part of ``text``, and the end of the first such part."""
    m = len(item)
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << m - 1
    vp, vn, score, best, end = full, 0, m, m, 0
    for j, w in enumerate(text):
        x = masks.get(w, 0) | vn
        d0 = ((x & vp) + vp ^ vp | x) & full
        hn, hp = vp & d0, vn | ~(vp | d0) & full
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp, hn = hp << 1 & full, hn << 1 & full
        vp, vn = hn | ~(d0 | hp) & full, d0 & hp
        if score < best:
            best, end = score, j + 1
    return best, end


def embed(windows: np.ndarray, walk: int) -> np.ndarray:
    """CGK embedding of rows of n words into 3n; beyond its end a row gives the filler -1."""
    rows, n = windows.shape
    padded = np.concatenate([windows, np.full((rows, 1), -1, windows.dtype)], axis=1)
    at, out = np.zeros(rows, np.int64), np.empty((3 * n, rows), windows.dtype)
    take = np.arange(rows)
    for step in range(3 * n):
        s = padded[take, at]
        out[step] = s
        h = s.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((step + 1 + walk * 1_000_003) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        at = np.minimum(at + ((h >> np.uint64(40)) & np.uint64(1)).astype(np.int64), n)
    return out


def keys(windows: np.ndarray) -> np.ndarray:
    """LSH keys of rows of n words: (walks * samples, rows)."""
    n = windows.shape[1]
    out = []
    for walk in range(WALKS):
        e = embed(windows, walk)
        rng = np.random.default_rng([SEED, n, walk])
        for s in range(SAMPLES):
            h = np.full(windows.shape[0], walk * SAMPLES + s + 1, np.uint64)
            for p in rng.integers(0, 3 * n, BITS):
                h = (h ^ e[p].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            out.append(h)
    return np.asarray(out)


@dataclass
class Index:
    """A block of items, ready to search texts for."""

    items: list[tuple[object, list[int]]]  # id, words as numbers from 1
    vocab: dict[bytes, int]
    grams: dict[int, tuple] = field(default_factory=dict)  # q -> sorted codes, starts, items, offsets
    tables: dict[int, tuple] = field(default_factory=dict)  # n -> per table sorted keys and their items

    @classmethod
    def build(cls, rows: list[tuple[object, str | None]]) -> "Index":
        vocab: dict[bytes, int] = {}
        items = []
        for i, t in rows:
            w = words_of(t or "")
            if w:
                items.append((i, [vocab.setdefault(x, len(vocab) + 1) for x in w]))
        if len(vocab) >= 1 << WORD_BITS:
            raise ValueError("a block of items has too many distinct words to number")
        own = cls(items, vocab)
        posts: dict[int, list] = {}
        by_n: dict[int, list[int]] = {}
        for k, (_, w) in enumerate(items):
            q = own.gram(len(w))
            by_n.setdefault(len(w), []).append(k)
            for j in range(len(w) - q + 1):
                code = 0
                for x in w[j : j + q]:
                    code = code << WORD_BITS | x
                posts.setdefault(q, []).append((code, k, j))
        for q, p in posts.items():
            a = np.asarray(sorted(p), np.int64)
            codes, starts = np.unique(a[:, 0], return_index=True)
            own.grams[q] = (codes, np.append(starts, len(a)), a[:, 1], a[:, 2])
        with np.errstate(over="ignore"):
            for n, ks in by_n.items():
                h = keys(np.asarray([items[k][1] for k in ks], np.int64))
                order = np.argsort(h, axis=1, kind="stable")
                own.tables[n] = (np.take_along_axis(h, order, 1), np.asarray(ks)[order])
        return own

    @staticmethod
    def gram(n: int) -> int:
        return max(1, min(GRAM, n // (edits_allowed(n) + 1)))

    def scan(self, texts: list[str | None]) -> list[list[tuple[object, int, int, int]]]:
        """For each text its matches: item id, first word, end word, distance; one per item, the best."""
        words = [words_of(t or "") for t in texts]
        sizes = np.asarray([len(w) for w in words])
        flat = np.fromiter(map(self.vocab.get, chain.from_iterable(words), repeat(0)), np.int64, int(sizes.sum()))
        starts = np.concatenate([[0], np.cumsum(sizes)])
        out: list[dict] = [{} for _ in texts]
        lens = np.asarray([len(w) for _, w in self.items], np.int64)
        allowed = (TOLERANCE * lens).astype(np.int64)
        for q, (codes, first, item, offset) in self.grams.items():
            n = len(flat) - q + 1
            if n <= 0:
                continue
            ok = flat[:n] > 0
            for j in range(1, q):
                ok &= flat[j : n + j] > 0
            at = np.flatnonzero(ok)
            code = flat[at]
            for j in range(1, q):
                code = code << WORD_BITS | flat[at + j]
            where = np.searchsorted(codes, code)
            where[where == len(codes)] = 0
            hit = codes[where] == code
            at, where = at[hit], where[hit]
            doc = np.searchsorted(starts, at, "right") - 1
            inside = at + q <= starts[doc + 1]  # no gram across two texts
            at, where, doc = at[inside], where[inside], doc[inside]
            many = first[where + 1] - first[where]
            post = np.repeat(first[where], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            at, doc = np.repeat(at, many), np.repeat(doc, many)
            it = item[post]
            diag = at - offset[post] - starts[doc] + (1 << 20)  # may be before the text's start
            order = np.lexsort((diag, it, doc))
            it, doc, diag = it[order], doc[order], diag[order]
            group = np.cumsum(np.concatenate([[0], (np.diff(it) != 0) | (np.diff(doc) != 0)])) if len(it) else np.zeros(0, np.int64)
            key = group * (1 << 34) + diag
            need = np.maximum(1, lens[it] - q + 1 - q * allowed[it])
            # a gram's diagonal and the needed number of others within k of it on either side
            upto = np.searchsorted(key, key + 2 * allowed[it], "right") - np.arange(len(key))
            good = upto >= need
            lo = np.flatnonzero(good)
            if not len(lo):
                continue
            # every diagonal of a run that is dense enough is a window's start
            mark = np.zeros(len(key) + 1, np.int64)
            np.add.at(mark, lo, 1)
            np.add.at(mark, lo + upto[lo], -1)
            keep = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
            windows = np.unique(np.stack([doc[keep], lens[it[keep]], diag[keep] - (1 << 20)]), axis=1)
            self._look_up(windows, flat, starts, out)
        return [[(self.items[k][0], *m) for k, m in sorted(o.items())] for o in out]

    def _look_up(self, windows: np.ndarray, flat: np.ndarray, starts: np.ndarray, out: list[dict]) -> None:
        for n in np.unique(windows[1]):
            own = windows[:, windows[1] == n]
            table, names = self.tables[int(n)]
            for lo in range(0, own.shape[1], 20_000):
                doc, _, start = own[:, lo : lo + 20_000]
                pos = start[:, None] + np.arange(n)
                size = (starts[doc + 1] - starts[doc])[:, None]
                inside = (pos >= 0) & (pos < size)
                rows = np.where(inside, flat[np.minimum(starts[doc][:, None] + np.clip(pos, 0, None), len(flat) - 1)], 0)
                h = keys(rows)
                found: set[tuple[int, int, int]] = set()
                for t in range(len(h)):
                    a, b = np.searchsorted(table[t], h[t], "left"), np.searchsorted(table[t], h[t], "right")
                    for r in np.flatnonzero(b > a):
                        found.update((int(doc[r]), int(start[r]), int(k)) for k in names[t, a[r] : b[r]])
                for d, s, k in sorted(found):
                    self._verify(d, s, k, flat, starts, out)

    def _verify(self, d: int, s: int, k: int, flat: np.ndarray, starts: np.ndarray, out: list[dict]) -> None:
        item = self.items[k][1]
        allowed = edits_allowed(len(item))
        known = out[d].get(k)
        lo = max(0, s - allowed)
        if known and known[2] == 0 and known[0] <= lo:
            return  # nothing nearer, nothing earlier
        part = flat[starts[d] + lo : min(starts[d + 1], starts[d] + s + len(item) + allowed)].tolist()
        best, end = search(item, part)
        if best <= allowed and (not known or best <= known[2]):
            _, back = search(item[::-1], part[:end][::-1])
            now = (lo + end - back, lo + end, best)
            if not known or (best, *now) < (known[2], *known):
                out[d][k] = now


def blocks(items: DataFrame) -> Iterator[Index]:
    """Indexes over the benchmark, a block of bounded size at a time."""
    rows, size = [], 0
    for r in items.select("item_id", F.col("text").cast("string")).toLocalIterator():
        n = len(words_of(r[1] or ""))
        if rows and size + n > BLOCK_WORDS:
            yield Index.build(rows)
            rows, size = [], 0
        rows.append((r[0], r[1]))
        size += n
    if rows:
        yield Index.build(rows)


def leaks(df: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, start_word, end_word, distance, item_words): every item found in every document."""
    spark = df.sparkSession
    slim = arrow_batches(df.select("doc_id", F.col("text").cast("string").alias("text")))
    schema = T.StructType([
        slim.schema["doc_id"], T.StructField("item_id", items.schema["item_id"].dataType),
        *[T.StructField(c, T.LongType()) for c in ("start_word", "end_word", "distance", "item_words")],
    ])
    out = spark.createDataFrame([], schema)
    for index in blocks(items):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            sizes = {i: len(w) for i, w in shared.value.items}
            with np.errstate(over="ignore"):
                for b in batches:
                    ids = b.column("doc_id").to_pylist()
                    rows = [(d, i, s, e, k, sizes[i]) for d, found in zip(ids, shared.value.scan(b.column("text").to_pylist())) for i, s, e, k in found]
                    cols = list(zip(*rows)) or [[]] * 6
                    types = [b.schema.field("doc_id").type, None, *[pa.int64()] * 4]
                    types[1] = pa.int64() if isinstance(schema[1].dataType, T.LongType) else pa.int32() if isinstance(schema[1].dataType, T.IntegerType) else pa.string()
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], schema.names)

        out = out.unionByName(slim.mapInArrow(run, schema))
    return out


def decontaminate(df: DataFrame, items: DataFrame) -> DataFrame:
    """The rows, with all columns, in which no item is found; one pass for each block of items."""
    spark = df.sparkSession
    names = [f"c{i}" for i in range(len(df.columns))]
    at = df.columns.index("text")
    out = arrow_batches(df).toDF(*names)
    for index in blocks(items):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            with np.errstate(over="ignore"):
                for b in batches:
                    found = shared.value.scan(b.column(at).cast(pa.string()).to_pylist())
                    yield b.filter(pa.array([not f for f in found], pa.bool_()))

        out = out.mapInArrow(run, out.schema)
    return out.toDF(*df.columns)
