"""Mixing sources to target weights by capped water-filling, with seeded repetition of whole documents.

A source's target is its weighted share of the wanted total, at most ``max_epochs`` times its size; what
a cap cuts off is shared among the other sources by weight, until no target is above its cap.  Each
document is then taken ``floor(target / source size)`` times, and once more where its hash lies below
the source's cut.  The cut is chosen so that the words taken come within half a document of the target.

No step orders a source's documents in one task: sizes are first summed by (source, hash bucket), and
only the one bucket that holds the cut is ordered.  Hashes depend on seed and doc_id alone, so reruns,
other partitionings and retried tasks choose the same documents.

Defined results: null text has size 0 and is taken as often as its hash says, at most ``max_epochs`` times; null source is a source of its own, last in order; rows with the
same doc_id share a hash and are taken together; a source without words has target 0 and gives no rows; an empty table
gives an empty result; a null doc_id hashes as the empty string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.common import WORD, Scratch, text_or_empty

SEED = "mix-1"
WEIGHTS = (3, 1, 2)
TOTAL_HALVES = 3  # the wanted total is 3/2 of all sizes
MAX_EPOCHS = 2
BUCKET_BITS = 12


def size_words(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def draw(doc_id: str = "doc_id", seed: str = SEED) -> Column:
    """60 uniform bits of a document, the same in every engine that has md5."""
    text = F.concat(F.lit(seed + "|"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_sizes(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source: size and weight.  Weights repeat over the sources in code point order, null last."""
    agg = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # the table has one row per source, so its single ordered partition holds names, not documents
    k = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return agg.select(
        "source", "source_size",
        F.element_at(F.array(*[F.lit(w) for w in weights]), (k % len(weights) + 1).cast("int")).cast("long").alias("weight"),
    )


def water_fill(sources: DataFrame, halves: int = TOTAL_HALVES, epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target``.  Each round is one aggregate over the sources; capped sources stay capped, so the
    rounds end at the latest when all are, in practice after a few."""
    cap = F.col("source_size") * epochs
    level, capped = F.lit(float("-inf")), -1
    while True:
        over = cap < level * F.col("weight")
        row = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(over, cap).otherwise(0)).alias("full"),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("weight"),
            F.sum(F.when(over, 1).otherwise(0)).alias("n"),
        ).first()
        if not row["weight"] or row["n"] == capped:
            break
        capped = row["n"]
        level = F.lit((halves * row["all"] - 2 * row["full"]) / (2.0 * row["weight"]))
    if not row["weight"]:
        return sources.withColumn("target", cap.cast("double"))
    return sources.withColumn("target", F.least(cap.cast("double"), level * F.col("weight")))


def plan(sized: DataFrame, scratch: Scratch, seed: str = SEED, weights: tuple[int, ...] = WEIGHTS, halves: int = TOTAL_HALVES, epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: size, weight, target, whole repetitions and the hash up to which documents are
    taken once more.  ``sized`` has doc_id, source, size."""
    sources = scratch.write(source_sizes(sized, weights), "sources")
    filled = water_fill(sources, halves, epochs).select(
        "*",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("whole"),
    ).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    hashed = sized.select("source", "size", draw("doc_id", seed).alias("u"))
    shift = 60 - BUCKET_BITS
    buckets = hashed.groupBy("source", F.shiftright("u", shift).alias("bucket")).agg(F.sum("size").alias("words"))
    ends = buckets.select(
        "source", "bucket", "words",
        F.sum("words").over(Window.partitionBy("source").orderBy("bucket")).alias("end"),
    )
    f = filled.alias("f")
    same = F.col("e.source").eqNullSafe(F.col("f.source"))
    # the bucket in which the running sum passes the rest; none where the rest takes every document
    edge = scratch.write(
        ends.alias("e").join(f, same).where((F.col("end") > F.col("rest")) & (F.col("end") - F.col("words") <= F.col("rest")))
        .groupBy("f.source").agg(F.min("bucket").alias("bucket"), F.min(F.col("end") - F.col("words")).alias("before"), F.first("rest").alias("rest")),
        "edges",
    )
    inside = hashed.alias("h").join(
        edge.alias("e"), F.col("h.source").eqNullSafe(F.col("e.source")) & (F.shiftright("u", shift) == F.col("e.bucket"))
    ).groupBy("h.source", "u").agg(F.sum("size").alias("words"), F.first("before").alias("before"), F.first("rest").alias("rest"))
    run = F.sum("words").over(Window.partitionBy("source").orderBy("u"))
    cuts = (
        inside.select("source", "u", "words", "before", "rest", run.alias("run"))
        .where(F.col("before") + F.col("run") - F.col("words") + F.col("words") / 2 <= F.col("rest"))
        .groupBy("source").agg(F.max("u").alias("cut"))
    )
    e, c = edge.select(F.col("source").alias("es"), "bucket"), cuts.select(F.col("source").alias("cs"), "cut")
    out = filled.join(e, F.col("source").eqNullSafe(F.col("es")), "left").join(c, F.col("source").eqNullSafe(F.col("cs")), "left")
    all_bits = (1 << 60) - 1
    low = F.shiftleft("bucket", shift) - 1  # all of the buckets before the edge
    cut = F.when(F.col("rest") <= 0, F.lit(-1)).when(F.col("bucket").isNull(), F.lit(all_bits)).otherwise(F.coalesce(F.col("cut"), low))
    return scratch.write(out.select("source", "source_size", "weight", "target", "whole", cut.alias("cut")), "plan")


def decide(df: DataFrame, planned: DataFrame, seed: str = SEED) -> DataFrame:
    """Adds source_size, target and ``copies`` to rows with doc_id and source.  The plan has one row per
    source; Spark broadcasts it only while it is below the session's size limit."""
    p = planned.withColumnRenamed("source", "__source")
    joined = df.join(p, F.col("source").eqNullSafe(F.col("__source")))
    extra = F.when(draw("doc_id", seed) <= F.col("cut"), 1).otherwise(0)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], "source_size", "target", (F.col("whole") + extra).alias("copies"))


def mix_report(df: DataFrame, seed: str = SEED) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken."""
    scratch = Scratch(df.sparkSession, "mixing")
    sized = scratch.write(df.select("doc_id", F.col("source").cast("string").alias("source"), size_words().alias("size")), "sized")
    done = decide(sized, plan(sized, scratch, seed), seed)
    return done.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def mix(df: DataFrame, seed: str = SEED) -> DataFrame:
    """The mixture itself: every row, with its own columns, as often as it is taken."""
    scratch = Scratch(df.sparkSession, "mixing")
    sized = scratch.write(df.select("doc_id", F.col("source").cast("string").alias("source"), size_words().alias("size")), "sized")
    planned = plan(sized, scratch, seed)
    names = [f"__c{i}" for i in range(len(df.columns))]
    inner = df.toDF(*names).withColumns({"doc_id": F.col(names[df.columns.index("doc_id")]), "source": F.col(names[df.columns.index("source")]).cast("string")})
    done = decide(inner, planned, seed)
    copies = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return done.where("copies > 0").select(*[F.col(n).alias(c) for n, c in zip(names, df.columns)], copies.alias("__copy")).drop("__copy")
