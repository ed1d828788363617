"""Near-duplicates with greedy, order-dependent semantics: a document is dropped iff an earlier kept one
shares a signature band with it.  Components would be wrong here: of a chain A~B~C with A and C apart,
both A and C stay."""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions import text as t
from corpusloom.llm.common import arrow_batches
from corpusloom.sources.tables import Shared

PRIME = (1 << 31) - 1
#: Shingles hashed, and texts signed, at a time.
STEP, ROWS = 2048, 500


@dataclass(frozen=True)
class MinHashConfig:
    threshold: float = 0.88
    num_perm: int = 128
    shingle_size: int = 5
    bands: int | None = None
    rows: int | None = None
    seed: int = 1

    def banding(self) -> tuple[int, int]:
        """Bands and rows that minimise half the area of false positives plus half that of false negatives."""
        if self.bands and self.rows:
            return self.bands, self.rows
        grid = np.linspace(0, 1, 1001)
        best = (float("inf"), 1, 1)
        for b in range(1, self.num_perm + 1):
            for r in range(1, self.num_perm // b + 1):
                p = 1 - (1 - grid**r) ** b
                low, high = grid <= self.threshold, grid >= self.threshold
                cost = 0.5 * np.trapezoid(p[low], grid[low]) + 0.5 * np.trapezoid(1 - p[high], grid[high])
                best = min(best, (float(cost), b, r))
        return best[1], best[2]

    def permutations(self) -> list[tuple[int, int]]:
        rng = random.Random(self.seed)
        return [(rng.randrange(1, PRIME), rng.randrange(PRIME)) for _ in range(self.num_perm)]


def shingle_hashes(text: str, n: int) -> np.ndarray:
    """28-bit md5 hashes of the distinct word n-grams, as SQL can compute them too."""
    w = text.lower().split()
    grams = {" ".join(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {" ".join(w)} if w else set()
    return np.asarray([int(hashlib.md5(g.encode()).hexdigest()[:7], 16) for g in grams], np.int64)


def signatures(df: DataFrame, cfg: MinHashConfig, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, signature array<bigint>); null where a text has no words."""
    a, b = (np.asarray(x, np.int64)[:, None] for x in zip(*cfg.permutations()))
    n = cfg.shingle_size

    def least(h: np.ndarray) -> np.ndarray:
        low = np.full(len(a), PRIME, np.int64)
        for k in range(0, len(h), STEP):
            np.minimum(low, ((a * h[k : k + STEP] + b) % PRIME).min(axis=1), out=low)
        return low

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):  # few texts and signatures at once, whatever the session's batches
                own = batch.slice(lo, ROWS)
                hashes = (shingle_hashes(x.as_py(), n) for x in own.column(1))
                out = pa.array([least(h) if len(h) else None for h in hashes], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([own.column(0), out], ["k", "s"])

    slim = arrow_batches(df).select(F.col(key).alias("k"), t.as_text(F.col(text)).alias("x"))
    kind = slim.schema["k"].dataType.simpleString()
    return slim.mapInArrow(run, f"k {kind}, s array<bigint>").select(F.col("k").alias(key), F.col("s").alias("signature"))


def buckets(signed: DataFrame, cfg: MinHashConfig, key: str = "doc_id") -> DataFrame:
    """(key, band, bucket): one row per band of a signature."""
    b, r = cfg.banding()
    bands = F.array(*[F.struct(F.lit(i).alias("band"), F.md5(F.array_join(F.slice("signature", i * r + 1, r), ",").cast("binary")).alias("bucket")) for i in range(b)])
    return signed.where("signature is not null").select(key, F.explode(bands).alias("x")).select(key, "x.band", "x.bucket")


def greedy_drops(bucketed: DataFrame, shared: Shared, key: str = "doc_id") -> DataFrame:
    """Keys to drop.  Each round decides, from per-bucket minima alone: a document goes if a kept one comes
    before it in some bucket, and stays if it is the first undropped one in all its buckets.  The smallest
    undecided document is always decided, no pairs are made, and rounds are written to the shared folder."""
    b = shared.write(bucketed.select(F.col(key).alias("pos"), F.concat_ws(":", "band", "bucket").alias("bucket")), "buckets")
    # a bucket of one can't decide anything
    b = shared.write(b.join(b.groupBy("bucket").count().where("count > 1").select("bucket"), "bucket"), "crowded")
    state = b.select("pos", F.lit(0).alias("state")).distinct()  # 0 undecided, 1 kept, 2 dropped
    k = 0
    while True:
        state = shared.write(state, f"state{k}")
        if state.where("state = 0").isEmpty():
            return state.where("state = 2").select(F.col("pos").alias(key))
        j = b.join(state, "pos").where("state <> 2")
        low = j.groupBy("bucket").agg(F.min(F.when(F.col("state") == 1, F.col("pos"))).alias("kept"), F.min("pos").alias("first"))
        verdict = j.where("state = 0").join(low, "bucket").groupBy("pos").agg(
            F.max(F.coalesce(F.col("kept") < F.col("pos"), F.lit(False))).alias("drop"), F.min(F.col("first") == F.col("pos")).alias("keep"))
        now = F.when(F.col("drop"), 2).when(F.col("keep"), 1).otherwise(F.col("state"))
        state = state.join(verdict, "pos", "left").select("pos", now.alias("state"))
        k += 1


def near_dedup(df: DataFrame, cfg: MinHashConfig, text: str = "text", key: str = "doc_id") -> DataFrame:
    shared = Shared(df.sparkSession, "greedy")
    return df.join(greedy_drops(buckets(signatures(df, cfg, text, key), cfg, key), shared, key), key, "left_anti")


def near_dedup_verified(df: DataFrame, threshold: float, n: int = 5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """As ``near_dedup`` with exact Jaccard in the place of bands: a document goes iff an earlier kept one is at or
    above the threshold.  Copies of a set go with its first; the rest is decided among classes, a pair being
    a bucket of two.  Documents without words stay."""
    members, sets = shingle_sets(df, n, text, key)
    pairs = pairs_above(sets, threshold).select(F.concat_ws("-", "a", "b").alias("bucket"), F.explode(F.array("a", "b")).alias("d"))
    drops = greedy_drops(pairs.select(F.col("d").alias(key), F.lit(0).alias("band"), "bucket"), Shared(df.sparkSession, "verified"), key)
    copies = members.where(F.col(key) != F.col("class_id")).select(key)
    return df.join(copies.unionByName(drops.select(F.col(key))), key, "left_anti")


def shingle_sets(df: DataFrame, n: int = 5, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(key, class_id) of every document with words, and (class_id, s, size, members) of every distinct shingle
    set; a class is named by its smallest key.  Copies of a text cost one row here and nothing later.  A set is the
    sorted 64-bit hashes of its shingles; among those of two texts of 1000 words two are equal by chance in one pair of
    texts of about 10^13."""
    shared = Shared(df.sparkSession, "classes")
    w = df.select(F.col(key).alias("d"), t.words(F.lower(t.as_text(F.col(text)))).alias("w")).where(F.size("w") > 0)
    s = w.select("d", F.array_sort(F.array_distinct(F.transform(t.shingles(F.col("w"), n), lambda g: F.xxhash64(g)))).alias("s"))
    s = shared.write(s.select(F.monotonically_increasing_id().alias("r"), "d", "s", F.sha2(F.array_join("s", ","), 256).alias("h")), "sets")
    # sets themselves move once, to the rows that stand for their classes
    named = shared.write(s.groupBy("h").agg(F.min(F.struct("d", "r")).alias("x"), F.count("*").alias("members")), "named")
    members = s.select("d", "h").join(named.select("h", F.col("x.d").alias("class_id")), "h").select(F.col("d").alias(key), "class_id")
    one = named.select(F.col("x.r").alias("r"), F.col("x.d").alias("class_id"), "members")
    sets = s.select("r", "s").join(one, "r").select("class_id", "s", F.size("s").alias("size"), "members")
    return members, shared.write(sets, "distinct")


def pairs_above(sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b, jaccard), a < b: classes of ``shingle_sets`` whose exact Jaccard is at or above a threshold, by
    prefix filtering: shingles in order of rising frequency, and only the first ``size - ceil(t * size) + 1``
    of each set join.  Shingles of one set alone come first in that order and join with nothing, so they are counted
    and go no further.  A pair's first common shingle leaves room for enough others in both sets; matches that don't are
    no candidates."""
    shared = Shared(sets.sparkSession, "pairs")
    each = sets.select(F.col("class_id").alias("d"), F.size("s").alias("n"), F.explode("s").alias("g"))
    several = each.withColumn("count", F.count("*").over(Window.partitionBy("g"))).where("count > 1")
    own = several.groupBy("d", "n").agg(F.array_sort(F.collect_list(F.struct("count", "g"))).alias("x"))  # of one text
    alone = F.col("n") - F.size("x")
    most = F.col("n") - F.ceil(threshold * F.col("n")).cast("int") + 1 - alone
    prefix = own.where(most > 0).select("d", "n", alone.alias("alone"), F.posexplode(F.slice("x", F.lit(1), most)).alias("k", "e"))
    # tokens after this one
    prefix = shared.write(prefix.select("d", "n", F.col("e.g").alias("g"), (F.col("n") - F.col("alone") - F.col("k") - 1).alias("rest")), "prefix")
    a, b = (prefix.select(F.col("d").alias(x), F.col("n").alias("n" + x), F.col("rest").alias("r" + x), "g") for x in "ab")
    fair = F.least("na", "nb") >= threshold * F.greatest("na", "nb")
    # an overlap of t / (1 + t) of both sizes; a little less, for rounding
    room = F.least("ra", "rb") + 1 >= threshold / (1 + threshold) * (F.col("na") + F.col("nb")) - 1e-6
    cand = shared.write(a.join(b, "g").where((F.col("a") < F.col("b")) & fair & room).select("a", "b").distinct(), "candidates")
    slim = sets.select(F.col("class_id").alias("d"), "s")
    both = cand.join(slim.select(F.col("d").alias("a"), F.col("s").alias("sa")), "a").join(slim.select(F.col("d").alias("b"), F.col("s").alias("sb")), "b")
    sizes = both.select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("i"), (F.size("sa") + F.size("sb")).alias("n"))
    return sizes.select("a", "b", (F.col("i") / (F.col("n") - F.col("i"))).alias("jaccard")).where(F.col("jaccard") >= threshold)


def links_above(df: DataFrame, threshold: float, n: int = 5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, class_id, n_links) of every document with words: its class and the number of other documents whose
    exact Jaccard is at or above a threshold.  Links are counted by classes, never listed by documents."""
    members, sets = shingle_sets(df, n, text, key)
    pairs = pairs_above(sets, threshold)
    both = pairs.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(pairs.select(F.col("b").alias("x"), F.col("a").alias("y")))
    size = sets.select("class_id", "members")
    far = both.join(size.withColumnRenamed("class_id", "y"), "y").groupBy("x").agg(F.sum("members").alias("far"))
    per = size.join(far.withColumnRenamed("x", "class_id"), "class_id", "left")
    per = per.select("class_id", (F.coalesce("far", F.lit(0)) + F.col("members") - 1).cast("long").alias("n_links"))
    return members.join(per, "class_id").select(key, "class_id", "n_links")
