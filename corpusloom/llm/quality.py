"""Quality rules as a bitmask ledger (built-in Spark expressions only).

Every rule is evaluated once per document.  The ledger keeps the measurements and one bit per failed
rule; a policy is a named, versioned mask over those bits, so changing a policy, comparing policies or
asking what a single rule costs never touches the texts again.

Defined results: null or empty text measures as zero words (and so fails ``few_words``); repeated rows
are judged one by one; an empty table gives an empty ledger; extra input columns are ignored unless
asked for with ``keep``; a null doc_id stays null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import SPACES, WORD, text_or_empty

SYMBOLS = r"[#*$%&|<>]"
#: Distinct repeated windows up to which a scan of their list beats sorting the positions.
FEW = 24


@dataclass(frozen=True)
class Rule:
    """``fails`` gets the measurement columns; bit numbers are never reused for another meaning."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "100 * n_symbols > 10 * n_words"),
    Rule(3, "duplicate_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule(4, "word_length_short", "word_chars < 2 * n_words"),
    Rule(5, "word_length_long", "word_chars > 16 * n_words"),
)

BASE = 1 << 0 | 1 << 1
#: Versioned policies: a document passes if no bit of the mask is set.
POLICIES = {
    "base-1": BASE,
    "web-1": BASE | 1 << 2 | 1 << 3 | 1 << 4 | 1 << 5,
    "web-2-no-lines": BASE | 1 << 2 | 1 << 4 | 1 << 5,
}
DEFAULT_POLICY = "web-1"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def _array(sql: str) -> Column:
    return F.expr(sql)


def measure(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The measurements of each row's whole text, beside the columns named in ``keep``.

    Steps are separate projections, so that Catalyst evaluates each array once.  Repeated windows are
    found by sorting the windows' hashes; positions are then looked up in the short list of repeated
    hashes or, when that is long, by a sort of (hash, position), so the work stays n log n."""
    held = [F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(keep)]
    names = [f"__k{i}" for i in range(len(keep))]
    t = df.select(*held, text_or_empty(text).alias("t"))
    t = t.select(*names, "t", F.btrim("t", F.lit(" \t\n\x0b\f\r")).alias("b"))
    t = t.select(
        *names,
        F.when(F.col("b") == "", F.array().cast("array<string>")).otherwise(F.split("b", SPACES + "+")).alias("w"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
        (F.length("t") - F.regexp_count("t", F.lit(SPACES))).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    t = t.select(
        *names, "word_chars", "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _array("if(size(w) < 3, array(), transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])))").cast("array<bigint>").alias("h"),
    )
    rest = ["word_chars", "n_symbols", "n_words", "n_lines", "n_dup_lines"]
    t = t.select(*names, *rest, "h", F.sort_array("h").alias("s"))
    t = t.select(*names, *rest, "h", _array("array_distinct(filter(s, (x, i) -> i > 0 and x = s[i - 1]))").alias("d"))
    t = t.select(
        *names, *rest, "h", "d",
        _array(f"if(size(d) > {FEW}, array_sort(transform(h, (x, i) -> struct(x as x, i as i))), null)").alias("z"),
    )
    t = t.select(
        *names, *rest,
        _array(
            f"""case when size(d) = 0 then array()
            when size(d) <= {FEW} then filter(transform(h, (x, i) -> if(array_contains(d, x), i, -1)), i -> i >= 0)
            else sort_array(transform(filter(z, (e, i) ->
                (i > 0 and z[i - 1].x = e.x) or (i < size(z) - 1 and z[i + 1].x = e.x)), e -> e.i)) end"""
        ).cast("array<int>").alias("p"),
    )
    t = t.select(
        *names, *rest,
        _array("cast(aggregate(p, struct(-3 as e, 0 as c), (a, i) -> struct(i as e, a.c + least(3, i - a.e) as c), a -> a.c) as bigint)").alias("n_repeat_words"),
    )
    return t.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], *MEASURES)


def ledger(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds ``fail_bits``: bit r is set where rule r fails."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in rules]
    total = F.lit(0)
    for b in bits:
        total = total.bitwiseOR(b)
    return measured.withColumn("fail_bits", total.cast("bigint"))


def apply_policy(led: DataFrame, policy: str = DEFAULT_POLICY, out: str = "kept") -> DataFrame:
    """Adds the verdict of a versioned policy; only ``fail_bits`` is read."""
    return led.withColumn(out, F.col("fail_bits").bitwiseAND(F.lit(POLICIES[policy])) == 0)


def ablations(led: DataFrame, policy: str = DEFAULT_POLICY, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of a policy: documents that fail it, and those that only it rejects.

    The ledger is first grouped to its distinct bit patterns (at most 2 to the number of rules), so the
    rest runs on a table of fixed size however many documents there are."""
    mask = POLICIES[policy]
    patterns = led.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("b")).agg(F.count("*").alias("n"))
    used = [r for r in rules if mask >> r.bit & 1]
    return patterns.select(
        F.explode(F.array(*[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.when(F.col("b").bitwiseAND(F.lit(1 << r.bit)) != 0, F.col("n")).otherwise(0).alias("failed"),
                F.when(F.col("b") == (1 << r.bit), F.col("n")).otherwise(0).alias("only"),
            )
            for r in used
        ])).alias("x")
    ).groupBy("x.rule").agg(F.sum("x.failed").alias("failed"), F.sum("x.only").alias("failed_only_here"))


def quality(df: DataFrame, policy: str = DEFAULT_POLICY, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Measurements, failure bits, the base verdict and the policy's verdict of each document."""
    led = apply_policy(ledger(measure(df, keep=keep)), policy)
    return led.withColumn("base_failed", F.col("fail_bits").bitwiseAND(F.lit(BASE)) != 0)


def filter_documents(df: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """The rows, with all their columns, that the policy keeps.  One pass: no join back to the texts."""
    names = [f"__c{i}" for i in range(len(df.columns))]
    led = measure(df.toDF(*names), text=names[df.columns.index("text")], keep=tuple(names))
    # a row number makes the last projection one that filters are not pushed through: pushed down, the
    # verdict would be written out in terms of the text, every measurement many times over
    led = apply_policy(ledger(led), policy, out="__kept").select(*names, "__kept", F.monotonically_increasing_id().alias("__row"))
    return led.where(F.col("__kept") & (F.col("__row") >= 0)).select(*[F.col(n).alias(c) for n, c in zip(names, df.columns)])
