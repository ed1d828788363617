"""Near-duplicates by an LSH forest over MinHash signatures, every link confirmed on full shingle sets.

1. One pass turns each text into its set of distinct 5-word shingles and keeps the set's size, a digest
   of the words and a signature of 128 minima.  Texts with the same words become one node, numbered as written.
2. Forest: 40 orders of the signature's positions, the first three of each order disjoint from those of
   all others.  In each order, nodes that share the first three values form a region; a region of more
   than ``REGION`` nodes is cut by further values (adaptive depth 3, 5, 8, 12), and one that stays dense
   to the end is salted.  Inside a region, sorted by the rest of the order, a node's candidates are its
   neighbours in longest common prefix (the next two) and the region's first node.
3. Each node confirms its most frequent and its smallest candidate first; confirmed links give
   components.  What this bound on partners leaves out is then done: all pairs of a region that lie in
   different components and whose sizes allow the threshold, dense regions under eight choices of further
   values at each step (``_dense_rest``), and all candidates not yet tried.  Of the pairs between two
   components the one met most often comes first, and all others only where it links nothing.
   Pairs inside one component need no check, as they can't change it.
4. Links count by 100 * intersection >= 70 * union over 48-bit shingle hashes of whole texts.

A pair at the threshold misses all 40 regions of depth three with probability (1 - 0.7^3)^40 = 5e-8, and
meets fewer than two with 1e-6; a pair of Jaccard 0.85 in dense regions (depth 8) is missed with 1e-6.

Defined results: null and wordless texts have no shingles, are linked with nothing and are kept; fewer
than five words make one shingle; rows are judged by their own text, so repeated rows link; a null
doc_id is never kept if its group has an id; an empty table gives an empty result; other columns are
ignored here and pass through ``deduplicate``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from corpusloom.llm.common import LOWER, UPPER, Scratch, arrow_batches

SHINGLE, THRESHOLD = 5, 70
MINIMA, TREES, DEPTHS = 128, 40, (3, 5, 8, 12)
REGION, NEXT = 64, 2
WORDS_KEPT = 500_000
BITMAP = (23, 28)  # powers of two: least and most bits of the filter over ids
SENT = 1_000_000  # most ids of documents to drop that are sent to every executor

_RNG = np.random.default_rng(7)
_MULT = _RNG.integers(0, 1 << 64, SHINGLE, dtype=np.uint64) | np.uint64(1)
_A = (_RNG.integers(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32) | np.uint32(1))[:, None]
_B = _RNG.integers(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32)[:, None]
_TABLE = bytes.maketrans(UPPER.encode(), LOWER.encode())


def _orders() -> np.ndarray:
    """For each tree the positions it reads; the first DEPTHS[0] are disjoint between trees."""
    own = _RNG.permutation(MINIMA)[: TREES * DEPTHS[0]].reshape(TREES, DEPTHS[0])
    rest = [_RNG.permutation(np.setdiff1d(np.arange(MINIMA), o))[: DEPTHS[-1] - DEPTHS[0]] for o in own]
    return np.concatenate([own, np.asarray(rest)], axis=1)


ORDERS = _orders()
#: For each step inside a dense region, eight choices of further values of an order.
WAYS = [[sorted(_RNG.permutation(DEPTHS[-1] - DEPTHS[0])[:k].tolist()) for _ in range(8)] for k in (2, 3)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Words and shingle hashes of texts given as UTF-8; word hashes are cached, the full cache emptied."""

    def __init__(self) -> None:
        import xxhash

        self.hash, self.known = xxhash.xxh64_intdigest, {}

    def words(self, raw: list[bytes | None]) -> list[list[bytes]]:
        """bytes.split() splits at space, tab, LF, VT, FF and CR, and at these alone."""
        return [(t or b"").translate(_TABLE).split() for t in raw]

    def sets(self, words: list[list[bytes]]) -> list[np.ndarray]:
        """The sorted distinct shingle hashes of each list of words."""
        new = set().union(*words).difference(self.known)
        if len(self.known) + len(new) > WORDS_KEPT:
            self.known = {}
            new = set().union(*words)
        self.known.update(zip(new, map(self.hash, new)))
        flat = np.fromiter(map(self.known.__getitem__, chain.from_iterable(words)), np.uint64)
        out, at = [], 0
        for own in words:
            n = len(own)
            w = flat[at : at + n]
            at += n
            if n >= SHINGLE:
                h = w[: n - SHINGLE + 1] * _MULT[0]
                for j in range(1, SHINGLE):
                    h = h + w[j : n - SHINGLE + 1 + j] * _MULT[j]
                out.append(np.unique(_mix(h)))
            elif n:
                h = np.uint64(n)
                for x in w:
                    h = _mix(np.asarray([h * np.uint64(31) + x], np.uint64))[0]
                out.append(np.asarray([h], np.uint64))
            else:
                out.append(np.empty(0, np.uint64))
        return out


def signature(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(x), 4096):
        np.minimum(best, (x[None, lo : lo + 4096] * _A + _B).min(axis=1), out=best)
    return best


def sketches(df: DataFrame) -> DataFrame:
    """Per row: doc_id, node (digest of the words; null without words), n_shingles, sig."""
    slim = df.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"))
    schema = T.StructType([slim.schema["doc_id"], T.StructField("node", T.BinaryType()), T.StructField("n_shingles", T.LongType()), T.StructField("sig", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            s = Shingler()
            for b in batches:
                words = s.words(b.column("text").to_pylist())
                sets = s.sets(words)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id"),
                        pa.array([hashlib.md5(b" ".join(w)).digest() if w else None for w in words], pa.binary()),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array([signature(x).tobytes() if len(x) else None for x in sets], pa.binary()),
                    ],
                    schema.names,
                )

    return arrow_batches(slim).mapInArrow(run, schema)


@F.pandas_udf(T.BinaryType())
def _node(texts: pd.Series) -> pd.Series:
    """The digest of the words of texts given as UTF-8, as in ``sketches``."""
    words = Shingler().words(texts.tolist())
    return pd.Series([hashlib.md5(b" ".join(w)).digest() if w else None for w in words], dtype=object)


def forest(nodes: DataFrame) -> DataFrame:
    """Per node and tree: region of depth three, the order's further values, size."""
    deep = DEPTHS[-1] - DEPTHS[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for b in batches:
                n = b.num_rows
                if not n:
                    continue
                sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint32).reshape(n, MINIMA).astype(np.uint64)
                for t, order in enumerate(ORDERS):
                    h = np.full(n, t + 1, np.uint64)
                    for p in order[: DEPTHS[0]]:
                        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, p])
                    tail = np.ascontiguousarray(sig[:, order[DEPTHS[0] :]].astype(">u2"))
                    tails = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * deep), n, [None, pa.py_buffer(tail.tobytes())]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), b.column("node"), b.column("n_shingles"), tails], ["region", "node", "n", "tail"]
                    )

    return nodes.select("node", "n_shingles", "sig").mapInArrow(run, "region long, node long, n long, tail binary")


def _regions(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows of regions of two nodes or more, dense regions cut deeper, those still dense salted."""
    done, at, level = None, rows, 0
    while True:
        counted = at.groupBy("region").count().where("count > 1")
        # each level reads the rows of the level before once for the counts and once for the split; regions
        # of one node, nearly all at small depth, leave at the first join
        kept = scratch.write(at.join(counted, "region"), f"level{level}", "lz4")
        small = kept.where(F.col("count") <= REGION).drop("count")
        dense = kept.where(F.col("count") > REGION).drop("count")
        done = small if done is None else done.unionByName(small)
        if dense.isEmpty():
            return done
        level += 1
        if level == len(DEPTHS):
            # salted by node, with the region's first node in each salt as the bridge between them
            first = dense.groupBy("region").agg(F.min(F.struct("node", "n", "tail")).alias("f"), F.count("*").alias("c"))
            salts = F.ceil(F.col("c") / REGION)
            salted = dense.join(first.select("region", salts.alias("s")), "region").select(
                F.xxhash64("region", F.pmod(F.xxhash64("node"), F.col("s"))).alias("region"), "node", "n", "tail")
            bridges = first.select(F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("k"), "region", "f").select(
                F.xxhash64("region", F.col("k")).alias("region"), "f.node", "f.n", "f.tail")
            return done.unionByName(salted.unionByName(bridges).dropDuplicates(["region", "node"]))
        bits = 2 * (DEPTHS[level] - DEPTHS[0])
        at = dense.withColumn("region", F.xxhash64("region", F.lit(level), F.substring("tail", 1, bits)))


def _dense_rest(level0: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b, hits): pairs across components inside regions that were too dense to keep whole.

    Cutting a dense region by one continuation of its order would lose pairs that part at the next value.
    Here each row goes on under ``WAYS`` different choices of further values, so that a pair at the
    threshold still meets (1 - (1 - 0.7^2)^8 = 99.5 % at the first step, 1 - (1 - 0.7^3)^8 = 96.5 % at the
    second, in each of the orders in which it shares a region).  Regions of one component, above all the
    large groups of copies, are left out at every step, so only mixed dense regions are multiplied.  What is
    dense after both steps is compared in whole (``_whole``)."""
    rows = level0.where(F.col("count") > REGION).drop("count").join(labels, "node", "left").withColumn("c", F.coalesce("label", "node")).drop("label")
    out = None
    for step, ways in enumerate(WAYS):
        mixed = rows.groupBy("region").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 <> c1").select("region")
        rows = rows.join(mixed, "region")
        keys = [F.xxhash64("region", F.lit(k), *[F.substring("tail", 2 * v + 1, 2) for v in own]) for k, own in enumerate(ways)]
        keyed = rows.select(F.explode(F.array(*keys)).alias("region"), "node", "n", "tail", "c")
        sizes = keyed.groupBy("region").agg(F.count("*").alias("count"), F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 <> c1").select("region", "count")
        keyed = scratch.write(keyed.join(sizes, "region"), f"ways{step}", "lz4")
        out = _across(keyed.where(F.col("count") <= REGION)) if out is None else out.union(_across(keyed.where(F.col("count") <= REGION)))
        rows = keyed.where(F.col("count") > REGION).drop("count")
        if rows.isEmpty():
            return out
    return out.union(_whole(rows))


def _whole(rows: DataFrame) -> DataFrame:
    """Pairs of regions that share eight values and more and are dense still, in whole: each row outside its
    region's largest component with all rows of the components that it meets.

    A row meets a component in many regions, so the two are told first and once.  Both joins are salted: a
    task takes about ``REGION`` components of a region, or members of a component, at a time."""
    parts = rows.groupBy("region", "c").agg(F.count("*").alias("k"))
    top = parts.groupBy("region").agg(F.max(F.struct("k", "c")).alias("m"), F.ceil(F.count("*") / REGION).alias("s")).select("region", F.col("m.c").alias("top"), "s")
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("s") - 1)).alias("block")
    asks = rows.join(top, "region").where("c <> top").select("region", "node", "n", "c", salts)
    has = parts.join(top, "region").select("region", F.col("c").alias("o"), F.pmod(F.xxhash64("c"), F.col("s")).alias("block"))
    met = asks.join(has, ["region", "block"]).where("c <> o").select("node", "n", "o").distinct()
    members = rows.select("node", "n", "c").distinct()
    blocks = members.groupBy("c").agg(F.ceil(F.count("*") / REGION).alias("s"))
    asked = met.join(blocks.withColumnRenamed("c", "o"), "o").select("o", "node", "n", salts)
    own = members.join(blocks, "c").select(F.col("c").alias("o"), F.col("node").alias("other"), F.col("n").alias("m"), F.pmod(F.xxhash64("node"), F.col("s")).alias("block"))
    pairs = asked.join(own, ["o", "block"]).where(_fair("n", "m"))
    # found once is enough here: their orders agree far
    return pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"), F.lit(2).alias("hits"))


def _across(rows: DataFrame) -> DataFrame:
    """Pairs of one region, of bounded size, that lie in different components and may meet the threshold."""
    x, y = rows.select("region", F.col("node").alias("a"), F.col("n").alias("na"), F.col("c").alias("ca")), rows.select("region", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("c").alias("cb"))
    return x.join(y, "region").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _fair("na", "nb")).select("a", "b", F.lit(1).alias("hits"))


def _fair(n: str, m: str) -> F.Column:
    """Sizes that allow the threshold."""
    return (100 * F.least(n, m)) >= (THRESHOLD * F.greatest(n, m))


def neighbours(regions: DataFrame) -> DataFrame:
    """(a, b, hits): pairs of neighbours in some order, a < b, with the number of orders."""
    w = Window.partitionBy("region").orderBy("tail", "node")
    me = F.struct("node", "n")
    near = [F.lead(me, k).over(w) for k in range(1, NEXT + 1)] + [F.first(me).over(w)]
    x = regions.select("node", "n", F.array(*near).alias("near")).select("node", "n", F.explode("near").alias("o"))
    x = x.where(F.col("o").isNotNull() & (F.col("o.node") != F.col("node")) & _fair("n", "o.n"))
    return x.select(F.least("node", "o.node").alias("a"), F.greatest("node", "o.node").alias("b")).groupBy("a", "b").agg(F.count("*").alias("hits"))


def _bitmap(ids: DataFrame, bits: int) -> bytes:
    """A bit per id hash.  Its size has a bound, so it may be sent to every executor; a full bitmap only means
    that nothing is skipped."""
    h = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    rows = ids.select(h.alias("h")).groupBy(F.bitmap_bucket_number(F.col("h") + 1).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("h") + 1)).alias("m")).collect()
    out = bytearray(bits // 8 + 8192)
    for r in rows:
        out[4096 * (r["k"] - 1) : 4096 * r["k"]] = bytes(r["m"])
    return bytes(out)


def confirm(df: DataFrame, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets meet the threshold.  Texts are read again, and only the
    nodes in question are shingled and shuffled."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    ends = ends.join(nodes, "node").select("node", "digest", "doc_id")
    # 16 bits for each node that may be asked for, within the bound
    size = 1 << min(max((32 * pairs.count()).bit_length(), BITMAP[0]), BITMAP[1])
    bits = df.sparkSession.sparkContext.broadcast(_bitmap(ends, size))
    hashed = df.select(F.pmod(F.xxhash64("doc_id"), F.lit(size)).alias("h"), F.col("text").cast("string").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits.value, np.uint8)
        with np.errstate(over="ignore"):
            s = Shingler()
            for b in batches:
                h = b.column("h").to_numpy(zero_copy_only=False)
                b = b.filter(pa.array((table[h >> 3] >> (h & 7).astype(np.uint8)) & 1 == 1))
                words = [w for w in s.words(b.column("text").to_pylist()) if w]
                node = [hashlib.md5(b" ".join(w)).digest() for w in words]
                packed = [np.unique(x >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for x in s.sets(words)]
                for lo in range(0, len(node), 200):
                    yield pa.RecordBatch.from_arrays([pa.array(node[lo : lo + 200], pa.binary()), pa.array(packed[lo : lo + 200], pa.binary())], ["digest", "set"])

    # copies of a text that slip through the bitmap hold the same set; one is enough
    sets = hashed.mapInArrow(run, "digest binary, set binary").join(ends.select("node", "digest"), "digest").dropDuplicates(["digest"]).select("node", "set")

    def unpack(x: bytes) -> np.ndarray:
        out = np.zeros((len(x) // 6, 8), np.uint8)
        out[:, :6] = np.frombuffer(x, np.uint8).reshape(-1, 6)
        return out.view(np.uint64)[:, 0]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column("sa").to_pylist(), b.column("sb").to_pylist()):
                p, q = unpack(x), unpack(y)
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(100 * both >= THRESHOLD * (len(p) + len(q) - both))
            yield b.filter(pa.array(ok, pa.bool_())).select(["a", "b"])

    left = pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
    return left.join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b").select("a", "b", "sa", "sb").mapInArrow(check, "a long, b long")


def components(edges: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """(node, label) of every node with an edge; the label is its component's smallest node.

    Each round hooks every label to the smallest neighbouring one and contracts the edges; labels only
    fall, and the rounds end when no edge joins two labels."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = scratch.write(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), f"{tag}-label0")
    k = 0
    while True:
        la, lb = labels.select(F.col("node").alias("a"), F.col("label").alias("la")), labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        left = edges.join(la, "a").join(lb, "b").where("la <> lb").select(F.greatest("la", "lb").alias("a"), F.least("la", "lb").alias("b")).distinct()
        left = scratch.write(left, f"{tag}-edges{k}")
        if left.isEmpty():
            return labels
        k += 1
        # labels are nodes, so the contracted graph's components relabel them
        inner = components(left, scratch, f"{tag}-{k}")
        i = inner.select(F.col("node").alias("label"), F.col("label").alias("root"))
        return scratch.write(labels.join(i, "label", "left").select("node", F.coalesce("root", "label").alias("label")), f"{tag}-done{k}")


def _apart(pairs: DataFrame, labels: DataFrame, keep: bool = False) -> DataFrame:
    """Pairs whose nodes are not in one component yet; ``keep``: with the components, ca and cb."""
    la, lb = labels.select(F.col("node").alias("a"), F.col("label").alias("la")), labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    j = pairs.join(la, "a", "left").join(lb, "b", "left").withColumn("ca", F.coalesce("la", "a")).withColumn("cb", F.coalesce("lb", "b"))
    out = j.where(F.col("ca") != F.col("cb")).drop("la", "lb")
    return out if keep else out.drop("ca", "cb")


def link(df: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Per row: doc_id, n_shingles, node, group, component_id, kept.  The result reads tables of ``scratch``; what
    only led to it is deleted on the way."""
    scratch = scratch or Scratch(df.sparkSession, "near-dedup")
    rows = scratch.write(sketches(df), "sketches")
    per_node = rows.where("node is not null").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "n_shingles", "sig")).alias("m"))
    # nodes are numbered in the table as written, and by these numbers from then on
    numbered = per_node.select(F.monotonically_increasing_id().alias("node"), F.col("node").alias("digest"), F.col("m.doc_id").alias("doc_id"), F.col("m.n_shingles").alias("n_shingles"), F.col("m.sig").alias("sig"))
    signed = scratch.write(numbered, "signed")
    nodes = signed.select("node", "digest", "doc_id", "n_shingles")
    regions = scratch.write(_regions(forest(signed), scratch), "regions", "lz4")
    pairs = scratch.write(neighbours(regions), "pairs")
    # first each node's most frequent and its smallest candidate; one of several orders alone says little
    many = pairs.where("hits > 1")
    both = many.select(F.col("a").alias("x"), F.col("b").alias("y"), "hits").union(many.select(F.col("b").alias("x"), F.col("a").alias("y"), "hits"))
    picks = both.groupBy("x").agg(F.max(F.struct("hits", "y")).alias("p"), F.min("y").alias("q"))
    first = picks.select("x", F.explode(F.array("p.y", "q")).alias("y")).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    first = scratch.write(first, "first")
    edges = scratch.write(confirm(df, first, nodes), "edges")
    labels = components(edges, scratch, "one")
    # the rest: neighbours not tried yet, and whole regions, wherever components differ
    r = regions.join(labels, "node", "left").select("region", "node", "n", F.coalesce("label", "node").alias("c"))
    mixed = scratch.write(r.join(r.groupBy("region").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.count("*").alias("k")).where(f"c0 <> c1 and k > {NEXT + 1}").select("region"), "region"), "mixed")
    hits = _across(mixed).union(_dense_rest(df.sparkSession.read.parquet(f"{scratch.root}/level0"), labels, scratch))
    hits = hits.union(_apart(pairs, labels).select("a", "b", F.col("hits").cast("int")))
    rest = hits.groupBy("a", "b").agg(F.sum("hits").alias("hits")).where("hits > 1")
    rest = scratch.write(rest.join(first, ["a", "b"], "left_anti"), "rest")
    # of each two components the pair that met most often, then what that leaves apart
    two = _apart(rest, labels, keep=True)
    best = two.groupBy(F.least("ca", "cb").alias("x"), F.greatest("ca", "cb").alias("y")).agg(F.max(F.struct("hits", "a", "b")).alias("p")).select("p.a", "p.b")
    for tag, todo in (("best", best), ("more", rest)):
        todo = scratch.write(_apart(todo, labels).select("a", "b") if tag == "more" else todo, f"{tag}-pairs")
        if todo.isEmpty():
            break
        edges = edges.union(scratch.write(confirm(df, todo, nodes), f"{tag}-edges"))
        labels = components(edges, scratch, tag)
    for name in ("regions", "pairs", "first", "mixed", "rest", "best-pairs", "more-pairs", *(f"{t}{k}" for t in ("level", "ways") for k in range(len(DEPTHS)))):
        scratch.drop(name)
    owner = labels.join(nodes, "node").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    per_node = nodes.join(labels, "node", "left").join(owner, "label", "left").select(F.col("digest").alias("node"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("label", "node").alias("group"))
    out = rows.drop("sig").join(per_node, "node", "left")
    out = out.withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "n_shingles", "node", "group", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def near_duplicates(df: DataFrame) -> DataFrame:
    return link(df).select("doc_id", "n_shingles", "component_id", "kept")


def _without(rows: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The rows whose id isn't in ``gone`` (__id), with whole texts shuffled only where they may be.

    Up to ``SENT`` ids are sent to every executor.  Beyond, a bitmap of bounded size tells most rows that stay;
    the others meet the ids in a join."""
    same, n = F.col(key).eqNullSafe(F.col("__id")), gone.count()
    if n <= SENT:
        return rows.join(F.broadcast(gone), same, "left_anti")
    size = 1 << min(max((16 * n).bit_length(), BITMAP[0]), BITMAP[1])
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(size)) + 1
    bits = gone.select(place("__id").alias("h")).groupBy(F.bitmap_bucket_number("h").alias("__k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("__m"))
    at = F.bitmap_bit_position(place(key))
    byte = F.conv(F.hex(F.expr("substring(__m, __byte, 1)")), 16, 10).cast("long")
    told = rows.join(F.broadcast(bits), F.bitmap_bucket_number(place(key)) == F.col("__k"), "left").withColumn("__byte", (F.floor(at / 8) + 1).cast("int"))
    told = told.withColumn("__may", F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False)))
    maybe = told.where("__may").select(*rows.columns).join(gone, same, "left_anti")
    return told.where("not __may").select(*rows.columns).unionByName(maybe)


def deduplicate(df: DataFrame) -> DataFrame:
    """The rows, with all columns, of one document per group: of its smallest id (null only if it has no
    other), and of one text if this id has several in the group.

    Verdicts are joined back on doc_id where ids tell rows apart, else on doc_id and words.  Of rows equal
    in both one stays; rows without words are in no group and all stay."""
    scratch = Scratch(df.sparkSession, "near-dedup-out")
    links = Scratch(df.sparkSession, "near-dedup")
    verdicts = scratch.write(link(df, links), "verdicts")
    links.drop()
    names = [f"__c{i}" for i in range(len(df.columns))]
    inner = df.toDF(*names)
    key, text = names[df.columns.index("doc_id")], names[df.columns.index("text")]
    if verdicts.groupBy("doc_id").count().where("count > 1").isEmpty():
        gone = verdicts.where("not kept").select(F.col("doc_id").alias("__id"))
        left = _without(inner, key, scratch.write(gone, "gone"))
    else:
        own = verdicts.where("node is not null").select("group", "doc_id", "node").distinct()
        first = own.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("m")).select("group", F.col("m.doc_id").alias("__first"), F.col("m.node").alias("__text"))
        gone = own.join(first, "group").where(~(F.col("doc_id").eqNullSafe(F.col("__first")) & (F.col("node") == F.col("__text"))))
        gone = gone.select(F.col("doc_id").alias("__id"), F.col("node").alias("__gone"))
        told = arrow_batches(inner).withColumn("__node", _node(F.col(text).cast("string").cast("binary")))
        left = told.join(gone, F.col(key).eqNullSafe(F.col("__id")) & (F.col("__node") == F.col("__gone")), "left_anti")
        alone = F.when(F.col("__node").isNull(), F.monotonically_increasing_id())
        left = left.withColumn("__alone", alone).dropDuplicates([key, "__node", "__alone"])
    return left.select(*[F.col(n).alias(c) for n, c in zip(names, df.columns)])
