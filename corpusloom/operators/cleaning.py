"""Quality chain with first-reason rejects, exact deduplication, stage counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions import text as t


@dataclass(frozen=True)
class QualityConfig:
    min_chars: int = 20
    max_chars: int | None = 200_000
    truncate: bool = True
    max_non_printable: float = 0.05
    max_punctuation: float = 0.55
    allowed_langs: tuple[str, ...] | None = ()  # empty: no language gate
    min_lang_confidence: float = 0.0
    min_tokens: int | None = None
    max_tokens: int | None = None
    compatibility: bool = True  # NFKC, the one step that needs Python


DEFAULT_LANGS = ("zh-cn", "en")


def allowed_languages(cfg: QualityConfig) -> tuple[str, ...]:
    """None means the default pair; an empty list switches the gate off."""
    return DEFAULT_LANGS if cfg.allowed_langs is None else cfg.allowed_langs


def language_passes(candidates: Column, cfg: QualityConfig) -> Column:
    """``candidates``: array of (lang, confidence); any confident one that matches any allowed one passes."""
    allowed = F.array(*map(F.lit, allowed_languages(cfg)))
    least = max(cfg.min_lang_confidence, 0.0)
    return F.exists(candidates, lambda c: (c["confidence"] >= least) & F.exists(allowed, lambda a: t.lang_matches(c["lang"], a)))


def quality_chain(df: DataFrame, cfg: QualityConfig, text: str = "text", languages: Column | None = None, n_tokens: Column | None = None) -> DataFrame:
    """Adds ``clean`` (null if rejected) and ``reject``, the first failing gate of: empty, length,
    non_printable, punctuation, language, tokens.

    Null text counts as empty.  A gate without its input (language candidates, token count) is off; jobs refuse
    such settings.  The last step is a generator: filters are not pushed through one, and pushed down they would
    be written out in terms of the text, every measure many times over."""
    out = df.withColumn("__raw", t.as_text(F.col(text)))
    out = out.withColumn("__norm", t.normalize_text(F.col("__raw"), cfg.compatibility))
    out = out.withColumn("__cut", t.length_bounds(F.col("__norm"), cfg.min_chars, cfg.max_chars, cfg.truncate))
    cut = F.col("__cut")
    reject = F.when(t.strip(F.col("__raw")) == "", "empty").when(cut.isNull(), "length")
    if cfg.max_non_printable < 1.0:
        reject = reject.when(t.non_printable_ratio(cut) > cfg.max_non_printable, "non_printable")
    reject = reject.when(t.punctuation_ratio(cut) > cfg.max_punctuation, "punctuation")
    if allowed_languages(cfg) and languages is not None:
        reject = reject.when(~F.coalesce(language_passes(languages, cfg), F.lit(False)), "language")
    if (cfg.min_tokens is not None or cfg.max_tokens is not None) and n_tokens is not None:
        low = n_tokens < (cfg.min_tokens if cfg.min_tokens is not None else 0)
        high = n_tokens > cfg.max_tokens if cfg.max_tokens is not None else F.lit(False)
        reject = reject.when(low | high, "tokens")
    told = F.array(F.struct(F.col("__reject").alias("reject"), F.when(F.col("__reject").isNull(), cut).alias("clean")))
    out = out.withColumn("__reject", reject)
    names = [F.col(f"`{c}`") for c in df.columns if c not in ("reject", "clean")]
    return out.select(*names, F.inline(told))


def as_candidate(lang: str = "lang") -> Column:
    """A known language column in the form of a predictor's answer."""
    return F.array(F.struct(F.col(lang).alias("lang"), F.lit(1.0).alias("confidence")))


def keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key; Spark plans a partial and a final group limit, so a hot key is cut down
    before the shuffle."""
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def exact_dedup(df: DataFrame, text: str, order: str, algorithm: str = "sha1") -> DataFrame:
    return keep_first(df.withColumn("fingerprint", t.fingerprint(F.col(text), algorithm)), "fingerprint", order)


def reject_counts(cleaned: DataFrame) -> DataFrame:
    return cleaned.where("reject is not null").groupBy("reject").agg(F.count("*").alias("n"))


def stage_counts(cleaned: DataFrame, order: str = "doc_id") -> DataFrame:
    """One row of counts through cleaning and exact deduplication, from one pass over flags."""
    prints = cleaned.select("reject", F.when(F.col("reject").isNull(), t.fingerprint(F.col("clean"))).alias("fp"))
    per = prints.groupBy("fp", F.col("reject").isNull().alias("ok")).agg(F.count("*").alias("n"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("input_lines"),
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("n"))), F.lit(0)).alias("after_basic_clean"),
        F.coalesce(F.sum(F.when(F.col("ok"), 1)), F.lit(0)).cast("long").alias("after_exact_dedup"),
    )


def funnel(counts: DataFrame) -> DataFrame:
    """Counts as ordered (step, label, n, dropped, retention)."""
    cols = counts.columns
    rows = counts.select(F.posexplode(F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).alias("n"), F.col(cols[max(i - 1, 0)]).alias("b"), F.col(cols[0]).alias("all")) for i, c in enumerate(cols)])).alias("step", "x"))
    return rows.select(
        F.col("step").cast("long").alias("step"), "x.label", "x.n", F.greatest(F.lit(0), F.col("x.b") - F.col("x.n")).cast("long").alias("dropped"),
        F.when(F.col("x.all") > 0, F.col("x.n") / F.col("x.all")).otherwise(0.0).alias("retention"),
    )
