"""Histograms, percentiles, top tokens and other aggregates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions import text as t
from corpusloom.sources.tables import Shared


def finite(c: str) -> Column:
    x = F.col(c).cast("double")
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def equal_width_histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """(bin, lo, hi, n) over the finite values, empty bins included; the last bin holds the maximum.  Equal
    values make one bin from v to v + 1; no values make no bins."""
    x = df.where(finite(value)).select(F.col(value).cast("double").alias("v"))
    ends = x.agg(F.min("v").alias("mn"), F.max("v").alias("mx")).where("mn is not null")
    # one row beside every row: the only join is with a single aggregate row
    j = x.crossJoin(F.broadcast(ends))
    step = (F.col("mx") - F.col("mn")) / bins
    counts = j.select(F.when(F.col("mx") == F.col("mn"), 0).otherwise(F.least(((F.col("v") - F.col("mn")) / step).cast("int"), F.lit(bins - 1))).alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))
    same = F.col("mx") == F.col("mn")
    grid = ends.select("mn", "mx", F.explode(F.when(same, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(bins - 1)))).alias("bin"))
    out = grid.join(counts, "bin", "left")
    lo = F.when(same, F.col("mn")).otherwise(F.col("mn") + F.col("bin") * step)
    hi = F.when(same, F.col("mn") + 1).otherwise(F.col("mn") + (F.col("bin") + 1) * step)
    return out.select(F.col("bin").cast("long").alias("bin"), lo.alias("lo"), hi.alias("hi"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


#: Most values that are fetched to pick order statistics from.
FEW = 50_000


def order_statistics(values: DataFrame, ranks: list[int], few: int = FEW) -> list[float]:
    """The values at the given places, from 0, of the sorted one-column frame ``values`` without nulls.

    Each round brackets every rank by two quantiles of a sketch of fixed size, counts exactly what lies below
    them, and goes on strictly between (or, where the sketch erred, beside) them.  The quantiles themselves are
    told at once, so each round leaves fewer distinct values, as a rule a thousandth of the rows, and no task
    ever holds more than the sketch or ``few`` values."""
    v, accuracy = F.col(values.columns[0]), 10_000
    out: dict[int, float] = {}
    # low, high (both outside), values up to low, values between
    open_ = {r: (-math.inf, math.inf, 0, values.count()) for r in ranks}
    while open_:
        sketches = {}
        for r, (lo, hi, below, n) in list(open_.items()):
            inside = (v > F.lit(lo)) & (v < F.lit(hi))
            if n <= few:
                for x in values.where(inside).groupBy(v.alias("v")).count().orderBy("v").collect():
                    below += x["count"]
                    if below > r:
                        out[r] = x["v"]
                        break
                del open_[r]
            else:
                edges = [min(1.0, max(0.0, (r - below) / n + d / accuracy)) for d in (-2, 2)]
                sketches[r] = F.percentile_approx(F.when(inside, v), F.array(*map(F.lit, edges)), F.lit(accuracy)).alias(f"q{r}")
        if not sketches:
            break
        row = values.agg(*sketches.values()).first()
        edges = {r: tuple(row[f"q{r}"]) for r in sketches}
        marks = sorted({x for e in edges.values() for x in e})
        row = values.agg(*[c.alias(f"{k}{i}") for i, x in enumerate(marks) for k, c in (("lt", F.count_if(v < F.lit(x))), ("le", F.count_if(v <= F.lit(x))))]).first()
        lt, le = ({x: row[f"{k}{i}"] for i, x in enumerate(marks)} for k in ("lt", "le"))
        for r, (x, y) in edges.items():
            lo, hi, below, n = open_[r]
            for z in (x, y):
                if lt[z] <= r < le[z]:
                    out[r] = z
                    del open_[r]
                    break
            else:
                if r < lt[x]:
                    open_[r] = (lo, x, below, lt[x] - below)
                elif r >= le[y]:
                    open_[r] = (y, hi, le[y], below + n - le[y])
                else:
                    open_[r] = (x, y, le[x], lt[y] - le[x])
    return [float(out[r]) for r in ranks]


def percentile_bounds(df: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """One row (lo, hi): exact percentiles with linear interpolation over the finite values; NaN without any."""
    spark = df.sparkSession
    values = df.where(finite(value)).select(F.col(value).cast("double").alias("v"))
    n = values.count()
    places = [p / 100 * (n - 1) for p in (low, high)]
    ranks = sorted({int(f(x)) for x in places for f in (math.floor, math.ceil)}) if n else []
    at = dict(zip(ranks, order_statistics(values, ranks)))

    def between(x: float) -> float:
        a, b = math.floor(x), math.ceil(x)
        return at[a] if a == b or at[a] == at[b] else (b - x) * at[a] + (x - a) * at[b]

    got = tuple(map(between, places)) if n else (math.nan, math.nan)
    return spark.createDataFrame([got], "lo double, hi double")


def turn_histogram(turns: DataFrame) -> DataFrame:
    """Histogram of a one-column frame of turn counts, with one bin per count between 5 and 20 bins."""
    most = turns.agg(F.max(turns.columns[0])).first()[0]
    return equal_width_histogram(turns, turns.columns[0], min(20, max(5, int(most or 0) + 1)))


def messages_long(df: DataFrame, conv: str = "conversations") -> DataFrame:
    """(role, content) of all messages with a content that isn't blank."""
    m = df.select(F.explode(conv).alias("m")).select("m.role", "m.content")
    return m.where(t.strip(t.as_text(F.col("content"))) != "")


def top_ids(df: DataFrame, pieces: dict[int, str], k: int = 40, ids: str = "ids") -> DataFrame:
    """(id, count, piece) of the k most frequent ids, the smaller id first among equals."""
    top = df.select(F.explode(ids).alias("id")).groupBy("id").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "id").limit(k)
    names = df.sparkSession.createDataFrame([(i, p) for i, p in pieces.items()] or [(0, "")], "id int, piece string")
    return top.join(names, "id", "left").select("id", "count", "piece").orderBy(F.desc("count"), "id")


def top_tokens(df: DataFrame, k: int = 40, text: str = "text", order: str = "doc_id") -> DataFrame:
    """The k most frequent white-space tokens, ties by first occurrence."""
    tok = df.select(F.col(order).alias("d"), F.posexplode(t.words(t.as_text(F.col(text)))).alias("i", "token"))
    agg = tok.groupBy("token").agg(F.count("*").alias("n"), F.min(F.struct("d", "i")).alias("first"))
    return agg.orderBy(F.desc("n"), "first").limit(k).select("token", "n")


def tokenizer_report(df: DataFrame, tokens: Column, unknown: str | None = None, text: str = "text") -> DataFrame:
    """One row: samples, characters, tokens, their means, mean characters per token, unknown share.

    Texts without tokens take no part in the ratios, which are taken row by row."""
    x = df.select(F.length(t.as_text(F.col(text))).alias("c"), tokens.alias("t"))
    bad = F.size(F.filter("t", lambda v: v == F.lit(unknown))) if unknown else F.lit(0)
    x = x.select("c", F.size("t").alias("n"), bad.alias("u"))
    return x.agg(
        F.count("*").alias("samples"), F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("chars"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("tokens"),
        F.avg("n").alias("mean_tokens"), F.avg("c").alias("mean_chars"), F.avg(F.when(F.col("n") > 0, F.col("c") / F.col("n"))).alias("mean_chars_per_token"),
        F.try_divide(F.sum("u"), F.sum("n")).alias("unknown_share"),
    )


def corpus_report(df: DataFrame, ids: str = "input_ids", order: str = "doc_id", first: int = 100) -> DataFrame:
    """Rows, kept rows, dropped rows, first length, tokens in the first rows kept.  The lengths are written once, so
    that both readers don't work out the ids."""
    df = Shared(df.sparkSession, "lengths").write(df.select(F.col(order).alias("o"), F.size(ids).alias("n")), "rows")
    kept = F.col("n") > 0
    total = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.when(kept, 1)), F.lit(0)).cast("long").alias("kept"))
    head = df.where(kept).orderBy("o").limit(first)
    own = head.agg(F.min_by("n", "o").cast("long").alias("first_length"), F.sum("n").alias("head_tokens"))
    return total.crossJoin(F.broadcast(own)).select("*", (F.col("rows") - F.col("kept")).alias("dropped"))


def top1_accuracy(tokens: DataFrame, logits: DataFrame, ignore: int = -100) -> DataFrame:
    """One row (accuracy, entropy, n) of next-token prediction: ``tokens`` (row, idx, label), ``logits``
    (row, idx, token, logit); labels shift by one, ignored ones don't count; NaN without any."""
    nxt = tokens.select("row", "idx", F.lead("label").over(Window.partitionBy("row").orderBy("idx")).alias("target")).where(F.col("target") != ignore)
    top = F.max("logit").over(Window.partitionBy("row", "idx"))
    e = logits.select("row", "idx", "token", "logit", F.exp(F.col("logit") - top).alias("e"))
    z = e.groupBy("row", "idx").agg(F.max_by("token", F.struct("logit", -F.col("token"))).alias("best"), F.sum("e").alias("z"), F.sum(F.col("e") * F.log("e")).alias("s"))
    # -sum p ln p with p = e / z
    j = nxt.join(z, ["row", "idx"]).select((F.col("best") == F.col("target")).cast("int").alias("hit"), (F.log("z") - F.col("s") / F.col("z")).alias("h"))
    nan = F.lit(float("nan"))
    return j.agg(F.coalesce(F.avg("hit"), nan).alias("accuracy"), F.coalesce(F.avg("h"), nan).alias("entropy"), F.count("*").alias("n"))


def expert_fractions(df: DataFrame, group: str, expert: str) -> DataFrame:
    """(group, expert, n, fraction): load of each expert in its group."""
    n = df.groupBy(group, expert).agg(F.count("*").alias("n"))
    return n.select(group, expert, "n", (F.col("n") / F.sum("n").over(Window.partitionBy(group))).alias("fraction"))


def top_experts(scores: DataFrame, keys: list[str], k: int) -> DataFrame:
    """(keys, rank, expert, weight): the k experts of the highest scores of each row of a long table (keys, expert, score),
    the smaller number first among equals, with their softmax weights scaled to one."""
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), "expert")
    top = scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    e = F.exp(F.col("score") - F.max("score").over(Window.partitionBy(*keys)))
    return top.withColumn("e", e).select(*keys, F.col("rank").cast("long").alias("rank"), "expert", (F.col("e") / F.sum("e").over(Window.partitionBy(*keys))).alias("weight"))


def load_entropy(fractions: DataFrame, group: str) -> DataFrame:
    return fractions.groupBy(group).agg(F.avg("fraction").alias("mean"), F.stddev_pop("fraction").alias("std"), F.sum(-F.col("fraction") * F.log("fraction")).alias("entropy"))


def json_parse_rate(df: DataFrame, text: str) -> DataFrame:
    ok = F.try_parse_json(t.first_balanced_object(F.col(text))).isNotNull()
    return df.agg(F.avg(ok.cast("int")).alias("rate"), F.count("*").alias("n"))


def latest_checkpoint(names: list[str]) -> str:
    """The ``checkpoint-<n>`` name of the largest n."""
    steps = [(int(x.rsplit("-", 1)[1]), x) for x in names if x.rsplit("/", 1)[-1].startswith("checkpoint-") and x.rsplit("-", 1)[1].isdigit()]
    if not steps:
        raise FileNotFoundError("no checkpoint")
    return max(steps)[1]
