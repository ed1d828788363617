"""Splits, samples and quotas.

Exact modes replay a seeded generator over positions on the driver, for inputs whose row count is known
to be small.  The scalable modes order rows by a hash of seed and key: the same distribution, a result
that doesn't depend on partitioning, and a top-k plan instead of a full sort.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions import messages as msg

#: Most rows for which the exact mode may list positions on the driver.
EXACT_LIMIT = 5_000_000


def hash_order(key: str, seed: int = 42) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))


def sampled_positions(n: int, k: int, seed: int = 42) -> list[int]:
    """Positions that a seeded sample without replacement of a list of n takes."""
    if n > EXACT_LIMIT:
        raise ValueError("too many rows for the exact mode; use the hash mode")
    return random.Random(seed).sample(range(n), min(max(k, 0), n))


def with_split(df: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """Adds ``split``: ``val`` for k rows in hash order, else ``train``.  With k rows or fewer, all go to
    ``val`` and the training set is empty."""
    if k <= 0:
        return df.withColumn("split", F.lit("train"))
    # k smallest (hash, key): a top-k plan; the threshold is one row, so it may meet every row
    cut = df.select(hash_order(key, seed).alias("h"), F.col(key).alias("k")).orderBy("h", "k").limit(k).agg(F.max(F.struct("h", "k")).alias("cut"))
    me = F.struct(hash_order(key, seed).alias("h"), F.col(key).alias("k"))
    return df.crossJoin(F.broadcast(cut)).withColumn("split", F.when(me <= F.col("cut"), "val").otherwise("train")).drop("cut")


def exact_split(df: DataFrame, pos: str, k: int, seed: int = 42) -> DataFrame:
    """As the replayed generator splits rows with contiguous positions."""
    spark = df.sparkSession
    picks = spark.createDataFrame([(p,) for p in sampled_positions(df.count(), k, seed)], "p long")
    # Spark broadcasts the picks only while they are below the session's size limit
    return df.join(picks, F.col(pos) == F.col("p"), "left").withColumn("split", F.when(F.col("p").isNotNull(), "val").otherwise("train")).drop("p")


def conversation_split(df: DataFrame, key: str = "conv_id", conv: str = "conversations", k_tool: int = 1000, k_multi: int = 5000, seed: int = 42) -> DataFrame:
    """Adds ``split``: first tool conversations, then multi-turn ones of those left, then ``train``."""
    tool = with_split(df.where(msg.is_tool_related(F.col(conv))), key, k_tool, seed)
    rest = df.where(~F.coalesce(msg.is_tool_related(F.col(conv)), F.lit(False))).withColumn("split", F.lit("train")).unionByName(tool.where("split = 'train'"))
    multi = with_split(rest.drop("split").where(msg.is_multi_turn(F.col(conv))), key, k_multi, seed + 1)
    out = multi.withColumn("split", F.when(F.col("split") == "val", "multi_turn_val").otherwise("train"))
    single = rest.where(~F.coalesce(msg.is_multi_turn(F.col(conv)), F.lit(False)))
    return out.unionByName(single).unionByName(tool.where("split = 'val'").withColumn("split", F.lit("tool_val")))


def uniform_sample(df: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """k rows without replacement (all, if there are fewer), in hash order."""
    return df.orderBy(hash_order(key, seed), key).limit(k)


def quota_sample(df: DataFrame, key: str, stratum: Column, most: int, ratio: float, seed: int = 42) -> DataFrame:
    """``most`` rows of which ``ratio`` lie in the stratum; what one side lacks the other fills up."""
    target = int(most * min(1.0, max(0.0, ratio)))
    x = df.withColumn("__in", F.coalesce(stratum, F.lit(False)))
    # more than ``most`` of a side are never taken, so a top-k of each side is all that is ranked
    sides = [x.where(c).orderBy(hash_order(key, seed), key).limit(most) for c in ("__in", "not __in")]
    both = sides[0].unionByName(sides[1])
    pools = both.agg(F.count_if("__in").alias("a"), F.count_if(~F.col("__in")).alias("b"))
    a0, b0 = F.least(F.lit(target), F.col("a")), F.least(F.lit(most - target), F.col("b"))
    quota = pools.select(a0.alias("a0"), b0.alias("b0"), "a", "b")
    b1 = F.when(F.col("a0") < target, F.least(F.col("b"), F.col("b0") + target - F.col("a0"))).otherwise(F.col("b0"))
    quota = quota.withColumn("b1", b1)
    quota = quota.withColumn("a1", F.when(F.col("b1") < most - target, F.least(F.col("a"), F.col("a0") + (most - target) - F.col("b1"))).otherwise(F.col("a0")))
    rn = F.row_number().over(Window.partitionBy("__in").orderBy(hash_order(key, seed), key))  # at most ``most`` rows a side
    ranked = both.withColumn("__rn", rn).crossJoin(F.broadcast(quota.select("a1", "b1")))
    return ranked.where(F.col("__rn") <= F.when(F.col("__in"), F.col("a1")).otherwise(F.col("b1"))).drop("__in", "__rn", "a1", "b1")


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    return df.orderBy(hash_order(key, seed), key)
