"""Score thresholds: keep-masks, order, a native n-gram perplexity, pluggable scorers."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from corpusloom.functions import text as t
from corpusloom.llm.common import arrow_batches
from corpusloom.operators.stats import finite, percentile_bounds
from corpusloom.sources.tables import Shared

#: Most rows of a block, and bytes of its words' numbers, twice.
BLOCK_ROWS, BLOCK_BYTES = 10_000, 32_000_000


def keep_mask(df: DataFrame, score: str, low: float = 1.0, high: float = 95.0, structured: Column | None = None) -> DataFrame:
    """Adds ``kept``: finite scores within the percentiles (inclusive); below the lower one only rows that
    ``structured`` marks."""
    bounds = F.broadcast(percentile_bounds(df, score, low, high))  # one row
    s = F.col(score).cast("double")
    below = structured if structured is not None else F.lit(False)
    kept = F.when(~finite(score), False).when(s > F.col("hi"), False).when(s < F.col("lo"), below).otherwise(True)
    return df.crossJoin(bounds).withColumn("kept", F.coalesce(kept, F.lit(False))).drop("lo", "hi")


def would_remove(masked: DataFrame) -> DataFrame:
    return masked.agg(F.count_if(~F.col("kept")).alias("would_remove"))


def score_order(score: str, text: str, pos: str) -> list[Column]:
    """Ascending scores, NaN last, then shorter texts, then input order."""
    s = F.coalesce(F.col(score).cast("double"), F.lit(float("nan")))
    return [F.isnan(s), F.when(F.isnan(s), float("inf")).otherwise(s), F.length(F.col(text)), F.col(pos)]


def places(df: DataFrame, score: str, text: str, pos: str) -> DataFrame:
    """The rows in parts by range, with ``place``, from 1, in ``score_order``.  Each part is numbered by
    itself, on top of the rows of the parts before, so no task orders the whole table."""
    spark = df.sparkSession
    order = score_order(score, text, pos)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # written once: ranges come from a sample, and the counts and the numbers must see the same ones
    at = Shared(spark, "places").write(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), "ranged")
    base, n = [], 0
    for p, k in sorted(at.groupBy("__part").count().collect()):  # one row per partition
        base.append((p, n))
        n += k
    offsets = spark.createDataFrame(base, "__part int, __base long")
    rn = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    out = at.withColumn("__rn", rn).join(F.broadcast(offsets), "__part")
    return out.withColumn("place", F.col("__base") + F.col("__rn")).drop("__base", "__rn", "__part")


def unigram_perplexity(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ppl): exp of the mean negative log of add-one word probabilities over the table
    itself; rows of one key count together, rows without words give none.

    Texts are numbered by blocks, each with its own dictionary, and written.  What is shuffled is one row per block and
    distinct word, and each text's numbers once; no row per document and word."""
    shared = Shared(df.sparkSession, "perplexity")
    slim = arrow_batches(df).select(F.col(key).alias("key"), F.lower(t.as_text(F.col(text))).alias("x"))
    kind = T.StructField("key", slim.schema["key"].dataType)
    schema = T.StructType([T.StructField("block", T.LongType()), kind, T.StructField("ids", T.BinaryType()), T.StructField("words", T.ArrayType(T.StringType())), T.StructField("counts", T.ArrayType(T.LongType()))])

    def flush(block: int, keys: list[pa.Array], ids: list[np.ndarray], number: dict[str, int]) -> Iterator[pa.RecordBatch]:
        n, own, words = len(ids), pa.concat_arrays(keys), list(number)
        counts = np.bincount(np.concatenate([np.empty(0, np.uint32), *ids]), minlength=len(words))
        parts = pa.array([x.tobytes() if len(x) else None for x in ids], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([block] * n, pa.int64()), own, parts, pa.nulls(n, pa.list_(pa.string())), pa.nulls(n, pa.list_(pa.int64()))], schema.names)
        for lo in range(0, len(words), 10_000):
            # the dictionary in slices; word k of the slice that starts at lo has number lo + k
            part = [pa.array([words[lo : lo + 10_000]], pa.list_(pa.string())), pa.array([counts[lo : lo + 10_000].tolist()], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.nulls(1, own.type), pa.array([str(lo).encode()]), *part], schema.names)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        keys, ids, size = [], [], 0
        number: defaultdict[str, int] = defaultdict()
        number.default_factory = number.__len__  # a new word gets the next number
        for b in batches:
            keys.append(b.column(0))
            for x in b.column(1):
                # parts at the same characters as text.words
                w = x.as_py().split()
                ids.append(np.fromiter(map(number.__getitem__, w), np.uint32, len(w)))
                size += 8 * len(w)
            if len(ids) >= BLOCK_ROWS or size >= BLOCK_BYTES:
                yield from flush(block, keys, ids, number)
                block, keys, ids, size = block + 1, [], [], 0
                number.clear()
        if ids:
            yield from flush(block, keys, ids, number)

    both = shared.write(slim.mapInArrow(encode, schema), "encoded")
    entries = both.where("words is not null").select("block", F.col("ids").cast("string").cast("int").alias("lo"), F.posexplode(F.arrays_zip("words", "counts")).alias("k", "x"))
    entries = shared.write(entries.select("block", (F.col("lo") + F.col("k")).alias("k"), F.col("x.words").alias("w"), F.col("x.counts").alias("c")), "entries")
    total = shared.write(entries.groupBy("w").agg(F.sum("c").alias("n")), "words")
    size = F.broadcast(total.agg(F.sum("n").alias("all"), F.count("*").alias("v")))  # one row
    known = entries.join(total.crossJoin(size), "w").select("block", "k", (-F.log((F.col("n") + 1) / (F.col("all") + F.col("v")))).alias("nll"))
    rows = both.where("words is null and ids is not null").select("block", "key", "ids")

    def add(docs: pa.Table, table: pa.Table) -> pa.Table:
        own = np.zeros(table.num_rows)
        own[table.column("k").to_numpy()] = table.column("nll").to_numpy()
        numbers = [np.frombuffer(x.as_py(), np.uint32) for x in docs.column("ids")]
        sums = pa.array([float(own[x].sum()) for x in numbers], pa.float64())
        return pa.Table.from_arrays([docs.column("key"), pa.array([len(x) for x in numbers], pa.int64()), sums], ["key", "n", "nll"])

    each = rows.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(add, T.StructType([kind, T.StructField("n", T.LongType()), T.StructField("nll", T.DoubleType())]))
    return each.groupBy(F.col("key").alias(key)).agg(F.sum("n").alias("n_tokens"), F.exp(F.sum("nll") / F.sum("n")).alias("ppl"))


def scorer(load: Callable[[], Callable[[list[str]], list[float]]], max_chars: int | None = None) -> Callable[[Column], Column]:
    """A model-backed score as an iterator UDF: ``load`` runs once per Python worker and returns a function
    from texts to scores.  ``max_chars`` cuts texts before they leave the JVM, where the model has a limit."""

    @F.pandas_udf(T.DoubleType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for s in batches:
            yield pd.Series(model(s.fillna("").tolist()), dtype="float64")

    return lambda c: run(F.substring(c, 1, max_chars) if max_chars else c)


def predictor(load: Callable[[], Callable[[list[str]], list[list[tuple[str, float]]]]], max_chars: int = 5000) -> Callable[[Column], Column]:
    """A language model's candidates as array<struct<lang, confidence>>."""

    @F.pandas_udf("array<struct<lang:string,confidence:double>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for s in batches:
            yield pd.Series([[{"lang": a, "confidence": float(b)} for a, b in c] for c in model(s.fillna("").tolist())])

    return lambda c: run(F.replace(F.substring(c, 1, max_chars), F.lit("\n"), F.lit(" ")))


def sample_mean(df: DataFrame, score: Column, order: str, n: int = 256) -> DataFrame:
    """Mean score of the first n rows; one NaN makes it NaN."""
    return df.orderBy(order).limit(n).agg(F.avg(score).alias("mean_score"))
