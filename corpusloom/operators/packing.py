"""Packing token streams into chunks, segment and position ids, masks, padding, supervision labels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions import text as t
from corpusloom.sources.tables import Shared

IGNORE = -100


@dataclass(frozen=True)
class Stage:
    """Chunks of ``size`` tokens until ``until`` chunks are out; the last stage is open."""

    size: int
    until: int | None = None


def parse_schedule(rows: list[dict] | None, default: int = 8192) -> tuple[Stage, ...]:
    if not rows:
        return (Stage(default),)
    out, last = [], 0
    for i, r in enumerate(rows):
        size, until = int(r["pack_bin_size"]), r.get("until_index")
        if size <= 0:
            raise ValueError("sizes must be positive")
        if i == len(rows) - 1:
            if until is not None:
                raise ValueError("the last stage must be open")
        elif until is None or int(until) <= last:
            raise ValueError("bounds must rise from stage to stage")
        else:
            last = int(until)
        out.append(Stage(size, None if until is None else int(until)))
    return tuple(out)


def _bases(schedule: tuple[Stage, ...]) -> list[tuple[int, int, int]]:
    """(first chunk, first token, size) of each stage."""
    out, chunk, token = [], 0, 0
    for s in schedule:
        out.append((chunk, token, s.size))
        if s.until is not None:
            token, chunk = token + (s.until - chunk) * s.size, s.until
    return out


def chunk_of(offset: Column, schedule: tuple[Stage, ...]) -> Column:
    """Chunk of a token offset: the last stage whose first token is not beyond it decides."""
    out = F.lit(None).cast("long")
    for chunk, token, size in _bases(schedule):
        out = F.when(offset >= token, F.lit(chunk) + F.floor((offset - token) / size)).otherwise(out)
    return out.cast("long")


def pack(df: DataFrame, ids: str = "input_ids", shard: str = "shard", pos: str = "pos", schedule: tuple[Stage, ...] = (Stage(8192),), separator: int = 0) -> DataFrame:
    """(shard, chunk, input_ids, labels): documents of a shard in order, one separator between two, cut into
    chunks; the last may be short.  Empty documents are skipped.

    A document's place is a running sum of lengths inside its shard: rows go to parts by range of (shard, pos),
    each part is summed by itself, on top of the totals of the shard's parts before.  Documents are then cut
    at the chunks they overlap, so no step works token by token or holds a shard in one task."""
    spark = df.sparkSession
    shared = Shared(spark, "packing")
    d = df.select(F.col(shard).alias("shard"), F.col(pos).alias("pos"), F.col(ids).alias("ids")).where(F.size("ids") > 0)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # written before, so that the sample that ranges come from doesn't work out the ids once more
    d = shared.write(d, "rows")
    # written once: ranges come from a sample, and both readers must see the same ones
    d = shared.write(d.repartitionByRange(parts, "shard", "pos").withColumn("__part", F.spark_partition_id()), "ranged")
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    totals = d.groupBy("shard", "__part").agg(F.sum(F.size("ids") + 1).alias("n"))
    # one row per part of a shard
    bases = totals.select(F.col("shard").alias("__shard"), F.col("__part").alias("__p"), F.coalesce(F.sum("n").over(before("shard").orderBy("__part")), F.lit(0)).alias("__base"))
    d = d.withColumn("at", F.coalesce(F.sum(F.size("ids") + 1).over(before("shard", "__part").orderBy("pos")), F.lit(0)))
    d = d.join(bases, F.col("shard").eqNullSafe(F.col("__shard")) & (F.col("__part") == F.col("__p"))).withColumn("at", F.col("at") + F.col("__base"))
    # the separator stands in the slot before every document but the first
    d = d.select("shard", F.when(F.col("at") > 0, F.concat(F.array(F.lit(separator)), "ids")).otherwise(F.col("ids")).alias("ids"), F.when(F.col("at") > 0, F.col("at") - 1).otherwise(0).alias("lo"))
    first, last = chunk_of(F.col("lo"), schedule), chunk_of(F.col("lo") + F.size("ids") - 1, schedule)
    d = d.withColumn("chunk", F.explode(F.sequence(first, last)))
    start, size = F.lit(0), F.lit(0)
    for chunk, token, n in _bases(schedule):
        start = F.when(F.col("chunk") >= chunk, F.lit(token) + (F.col("chunk") - chunk) * n).otherwise(start)
        size = F.when(F.col("chunk") >= chunk, F.lit(n)).otherwise(size)
    a = F.greatest(start, F.col("lo"))
    b = F.least(start + size, F.col("lo") + F.size("ids"))
    piece = F.slice("ids", (a - F.col("lo") + 1).cast("int"), (b - a).cast("int"))
    parts = d.select("shard", "chunk", F.struct(a.alias("at"), piece.alias("ids")).alias("p"))
    packed = parts.groupBy("shard", "chunk").agg(F.array_sort(F.collect_list("p")).alias("p"))
    ids_ = F.flatten(F.transform("p", lambda x: x["ids"]))
    return packed.select("shard", "chunk", ids_.alias("input_ids")).withColumn("labels", F.col("input_ids"))


def tokens_long(df: DataFrame, keys: list[str], ids: str = "input_ids", pad: int | None = None) -> DataFrame:
    """(keys, idx, token, is_pad)."""
    x = df.select(*keys, F.posexplode(ids).alias("idx", "token"))
    return x.withColumn("is_pad", F.lit(False) if pad is None else F.col("token") == pad)


def segment_ids(long: DataFrame, keys: list[str], separator: int) -> DataFrame:
    """Adds ``segment``: separators before the token, so a separator belongs to the segment it ends; -1 on pads."""
    w = Window.partitionBy(*keys).orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    n = F.coalesce(F.sum(F.when(F.col("token") == separator, 1).otherwise(0)).over(w), F.lit(0))
    return long.withColumn("segment", F.when(F.col("is_pad"), -1).otherwise(n).cast("long"))


def position_ids(long: DataFrame, keys: list[str], separator: int) -> DataFrame:
    """Adds ``position``: restarts with 0 at every separator; pads are 0 and don't count."""
    upto = Window.partitionBy(*keys).orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    isl = F.sum(F.when((F.col("token") == separator) & ~F.col("is_pad"), 1).otherwise(0)).over(upto)
    x = long.withColumn("__island", isl)
    w = Window.partitionBy(*keys, "__island").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    n = F.sum(F.when(F.col("is_pad"), 0).otherwise(1)).over(w) - 1
    return x.withColumn("position", F.when(F.col("is_pad"), 0).otherwise(n).cast("long")).drop("__island")


def _cuts(ids: Column, separator: int) -> Column:
    """Places of the separators, from 0."""
    return F.filter(F.transform(ids, lambda x, i: F.when(x == separator, i)), lambda i: i.isNotNull())


def _segment_sizes(ids: Column, cuts: Column) -> Column:
    """Tokens of each segment, its separator included; the last may have none."""
    ends = F.concat(cuts, F.array(F.size(ids) - 1))
    return F.transform(ends, lambda e, k: e - F.coalesce(F.get(cuts, k - 1), F.lit(-1)))


def segments_of(ids: Column, separator: int) -> Column:
    """``segment_ids`` of one row without pads as an array: no row per token, sort or shuffle."""
    return t.let(_cuts(ids, separator), lambda cuts: F.flatten(F.transform(_segment_sizes(ids, cuts), lambda n, k: F.array_repeat(k.cast("long"), n))))


def positions_of(ids: Column, separator: int) -> Column:
    """``position_ids`` of one row without pads as an array."""
    none = F.array().cast("array<long>")

    def islands(cuts: Column) -> Column:
        starts = F.concat(F.array(F.lit(0)), cuts)
        sizes = F.transform(starts, lambda a, k: F.coalesce(F.get(cuts, k), F.size(ids)) - a)
        return F.flatten(F.transform(sizes, lambda n: F.when(n > 0, F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)).otherwise(none)))

    return t.let(_cuts(ids, separator), islands)


def mask_pair_count(ids: Column, separator: int) -> Column:
    """Number of the pairs that ``mask_pairs`` lists for one row without pads: n (n + 1) / 2 in a segment of n."""
    each = lambda cuts: F.transform(_segment_sizes(ids, cuts), lambda n: n.cast("long") * (n + 1) / 2)
    return t.let(_cuts(ids, separator), lambda cuts: F.aggregate(each(cuts), F.lit(0.0), lambda a, n: a + n)).cast("long")


def mask_pairs(segmented: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, q, k) that attend: same segment, key not after query, no pads.  An equi-join on the segment;
    quadratic in a segment by nature, so only on demand."""
    s = segmented.where(~F.col("is_pad")).select(*keys, "segment", "idx")
    q, k = s.withColumnRenamed("idx", "q"), s.withColumnRenamed("idx", "k")
    return q.join(k, [*keys, "segment"]).where("k <= q").select(*keys, "q", "k")


def pad_batches(df: DataFrame, batch: str, ids: str = "input_ids", labels: str = "labels", pad: int = 0) -> DataFrame:
    """Right-pads ids with ``pad`` and labels with the ignored label to the longest of the batch."""
    w = Window.partitionBy(batch)
    n = F.max(F.size(ids)).over(w)
    x = df.withColumn("__n", n)
    fill = lambda c, v: F.concat(F.col(c), F.array_repeat(F.lit(v), F.col("__n") - F.size(c)))
    return x.withColumn(ids, fill(ids, pad)).withColumn(labels, fill(labels, IGNORE)).drop("__n")


def overlap_labels(ids: Column, starts: Column, ends: Column, spans: Column) -> Column:
    """Labels of one sample: tokens [a, b) that overlap a span [lo, hi) keep their id, others are ignored."""
    toks = F.arrays_zip(ids.alias("t"), starts.alias("a"), ends.alias("b"))
    return t.let(spans, lambda own: F.transform(toks, lambda x: F.when(F.exists(own, lambda s: (x["a"] < s["hi"]) & (x["b"] > s["lo"])), x["t"]).otherwise(IGNORE)))


def supervised_spans(text: Column, opening: str = "<|im_start|>assistant\n", closing: str = "<|im_end|>") -> Column:
    """(lo, hi) of each assistant reply in a transcript, its closing mark included."""

    def spans(heads: Column) -> Column:
        at = F.transform(F.slice(heads, 2, 1 << 30), lambda p, i: F.struct(
            (F.aggregate(F.slice(heads, F.lit(1), i + 1), F.lit(0), lambda a, h: a + F.length(h)) + (i + 1) * len(opening)).alias("lo"),
            F.instr(p, closing).alias("end")))
        good = F.filter(at, lambda s: s["end"] > 0)
        return F.transform(good, lambda s: F.struct(s["lo"].alias("lo"), (s["lo"] + s["end"] - 1 + len(closing)).alias("hi")))

    return t.let(F.split(text, opening.replace("|", r"\|")), spans)


def supervised(labels: str = "labels") -> Column:
    return F.exists(F.col(labels), lambda x: x != IGNORE)


def within(ids: str, most: int) -> Column:
    return F.size(ids) <= most


def shard_of(pos: str, shards: int) -> Column:
    return F.pmod(F.col(pos), F.lit(shards)).cast("long")
