"""Supervised samples of conversations: system prompts, tools, transcript, ids, labels, and what is skipped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import messages as msg
from corpusloom.operators import packing, tokenizing

#: Each status a row can have, in the order in which they are decided.
STATUS = ("empty", "tools", "long", "no_supervision", "emitted")


def transcripts(df: DataFrame, key: str, conv: str = "conversations", ratio: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``text`` (null where the conversation is empty or its tools don't parse) and ``status`` of such rows.

    Empty system messages are filled and a share of the others get one, by hash of the key; tools come from the
    leading system message; tool calls that don't parse are left out."""
    c = F.col(conv)
    tools = msg.parsed_tools(c)
    x = df.withColumns({"__tools": tools, "__conv": msg.fill_tool_calls(msg.inject_system(c, F.col(key), ratio, seed=seed))})
    status = F.when(F.coalesce(F.size(c), F.lit(0)) <= 0, "empty").when(F.col("__tools") == "", "tools")
    text = F.when(F.col("status").isNull(), msg.render(F.col("__conv"), F.col("__tools")))
    return x.withColumn("status", status).withColumn("text", text).drop("__tools", "__conv")


def characters(df: DataFrame, text: str = "text") -> DataFrame:
    """A stand-in encoding inside the JVM: one id per code point, with its offsets.  The text is split once, so the
    work is in proportion to its length."""
    n = F.length(text)
    none = F.array().cast("array<int>")
    return df.withColumns({
        "input_ids": F.when(n > 0, F.transform(F.split(F.col(text), ""), F.ascii)).otherwise(none),
        "starts": F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(none), "ends": F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(none),
    })


def sft_samples(df: DataFrame, key: str, encode: Callable[[DataFrame], DataFrame], most: int = 8192, conv: str = "conversations", ratio: float = 0.2, seed: int = 42) -> DataFrame:
    """(key, status, input_ids, labels) of every row.  ``encode`` adds input_ids, starts and ends to rows with
    ``text`` (``tokenizing.encode``, ``characters``).  Labels are the ids of assistants' replies up to their closing mark;
    rows longer than ``most``, or without a label, are not emitted and carry no ids."""
    x = encode(transcripts(df, key, conv, ratio, seed).select(key, "status", "text"))
    # rows that are too long get a status and no labels
    own = packing.overlap_labels(F.col("input_ids"), F.col("starts"), F.col("ends"), packing.supervised_spans(F.col("text")))
    x = x.withColumn("labels", F.when(packing.within("input_ids", most), own))
    status = (
        F.when(F.col("status").isNotNull(), F.col("status")).when(F.coalesce(F.size("input_ids"), F.lit(0)) <= 0, "empty").when(~packing.within("input_ids", most), "long")
        .when(~F.coalesce(packing.supervised(), F.lit(False)), "no_supervision").otherwise("emitted")
    )
    x = x.withColumn("status", status)
    good = F.col("status") == "emitted"
    return x.select(key, "status", F.when(good, F.col("input_ids")).alias("input_ids"), F.when(good, F.col("labels")).alias("labels"))


def by_file(load: Callable[[], tokenizing.Encode]) -> Callable[[DataFrame], DataFrame]:
    """``encode`` of ``sft_samples`` by a tokenizer."""
    return lambda df: tokenizing.encode(df, load)


def shard_report(samples: DataFrame, pos: str, shards: int) -> DataFrame:
    """(shard, rows, one count per status): what each reader of a sharded stream emits and skips."""
    x = samples.groupBy(packing.shard_of(pos, shards).alias("shard"))
    return x.agg(F.count("*").alias("rows"), *[F.count_if(F.col("status") == s).alias(s) for s in STATUS])


def strict_pairs(df: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Preference rows as (prompt, chosen, rejected); a row that isn't a pair stops the job."""
    d = msg.strict_dpo_triplet(F.col(chosen), F.col(rejected))
    return df.select(d.alias("d")).select("d.prompt", "d.chosen", "d.rejected")


