"""Jobs: the pretraining and the conversation pipeline as flag-annotated plans, their settings and a CLI.

A job file has this module's own layout or the layout of ``pipeline`` / ``sft`` sections (``from_sections``).
A gate that is asked for but can't run is an error: a language gate without a predictor, a token gate without a
tokenizer, a score without a scorer."""

from __future__ import annotations

import argparse
import json
import warnings
from collections.abc import Callable
from dataclasses import dataclass, field, fields, is_dataclass
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import messages as msg
from corpusloom.functions import text as t
from corpusloom.operators import cleaning, neardup, scoring, splitting, stats, tokenizing
from corpusloom.operators.cleaning import QualityConfig
from corpusloom.operators.neardup import MinHashConfig
from corpusloom.sources import sinks, tables


@dataclass(frozen=True)
class ScoreConfig:
    enabled: bool = False
    model: str | None = None  # "unigram": perplexity under the corpus' own word counts; others need a scorer
    apply_filter: bool = False
    sort_ascending: bool = False
    low: float = 1.0
    high: float = 95.0
    keep_structured: bool = True


@dataclass(frozen=True)
class PretrainConfig:
    text_field: str = "text"
    quality: QualityConfig = field(default_factory=QualityConfig)
    dedupe_paragraphs: bool = True
    exact_dedup: bool = True
    exact_algorithm: str = "sha1"
    near_dedup: bool = True
    near: MinHashConfig = field(default_factory=MinHashConfig)
    score: ScoreConfig = field(default_factory=ScoreConfig)


@dataclass(frozen=True)
class ChatConfig:
    quality: QualityConfig = field(default_factory=QualityConfig)
    strict_roles: bool = False
    repair_tool_calls: bool = True
    filter_refusals: bool = True
    extra_refusals: tuple[str, ...] = ()
    drop_think: bool = False
    think_markers: tuple[str, ...] = ("<think>", "</think>")
    markers: dict[str, str] = field(default_factory=dict)
    exact_dedup: bool = True
    exact_algorithm: str = "sha1"
    near_dedup: bool = True
    near: MinHashConfig = field(default_factory=lambda: MinHashConfig(threshold=0.9))


@dataclass(frozen=True)
class SplitConfig:
    enabled: bool = True
    seed: int = 42
    val: int = 5000
    tool_val: int = 1000
    multi_turn_val: int = 5000
    val_path: str | None = None
    tool_val_path: str | None = None
    multi_turn_val_path: str | None = None


@dataclass(frozen=True)
class Job:
    kind: str
    input: str
    output: str
    stats_path: str | None = None
    pretrain: PretrainConfig = field(default_factory=PretrainConfig)
    chat: ChatConfig = field(default_factory=ChatConfig)
    split: SplitConfig | None = None
    report: bool = False  # histograms and the funnel as JSON in report_dir (beside the output if not given)
    report_dir: str | None = None
    tokenizer: str | None = None
    language_model: str | None = None
    report_rows: int | None = None  # rows that token histograms read, in input order; all by default
    conversations_field: str = "conversations"


@dataclass(frozen=True)
class Seams:
    """What a job needs from outside: language candidates and scores as Column functions."""

    languages: Callable[[Column], Column] | None = None
    score: Callable[[Column], Column] | None = None


#: Section names and this module's.
_QUALITY = {
    "min_chars": "min_chars", "max_chars": "max_chars", "truncate": "truncate", "max_non_printable_ratio": "max_non_printable", "max_punctuation_ratio": "max_punctuation",
    "allowed_langs": "allowed_langs", "min_lang_confidence": "min_lang_confidence", "min_tokens": "min_tokens", "max_tokens": "max_tokens",
}
_NEAR = {k: k for k in ("threshold", "num_perm", "shingle_size")}
_PRETRAIN = {"text_field": "text_field", "intra_doc_dedupe_paragraphs": "dedupe_paragraphs", "exact_dedup": "exact_dedup"}
_SCORE = {"ppl_enable": "enabled", "ppl_apply_percentile_filter": "apply_filter", "ppl_sort_ascending": "sort_ascending", "ppl_low_percentile": "low", "ppl_high_percentile": "high", "ppl_keep_low_if_structured": "keep_structured"}
_CHAT = {
    "strict_role_order": "strict_roles", "repair_tool_calls": "repair_tool_calls", "normalize_markers": "markers", "filter_refuse_replies": "filter_refusals",
    "drop_think_samples": "drop_think", "think_markers": "think_markers", "refuse_extra_substrings": "extra_refusals", "exact_dedup": "exact_dedup",
}
_LATER = {"bert_mlm_log", "topic", "run_diagnostics", "max_rows_token_histogram", "tokenizer_path_for_diagnostics", "lang_backend", "fasttext_model_path", "conversations_field", "stats_path"}


def _named(values: Any, names: dict[str, str], known: set[str] = frozenset(), where: str = "") -> dict:  # type: ignore[assignment]
    """The settings of one section under this module's names; a warning names those without a meaning here."""
    if not isinstance(values, dict):
        raise TypeError(f"{where} needs a mapping")
    if strange := sorted(set(values) - set(names) - set(known)):
        warnings.warn(f"{where}: no such settings: {', '.join(strange)}", stacklevel=4)
    return {names[k]: v for k, v in values.items() if k in names}


def from_sections(values: dict) -> dict:
    """A job of ``pipeline`` or ``sft`` (``sft_pipeline``), ``split.pretrain``, ``split.sft`` sections in this
    module's layout.  Their defaults hold: languages are limited to the default pair unless a list is
    given, splits are made, a report is written."""
    kind = str(values.get("kind", "pretrain")).strip().lower()
    out: dict[str, Any] = {"kind": kind, "input": values.get("input"), "output": values.get("output"), "stats_path": values.get("stats_path")}
    out |= {"report": bool(values.get("write_plots", True)), "report_dir": values.get("plots_dir")}
    _named(values, {}, {"kind", "input", "output", "stats_path", "write_plots", "plots_dir", "pipeline", "sft", "sft_pipeline", "split"}, "job")
    if kind == "pretrain":
        own = values.get("pipeline") or {}
        named = _named(own, _PRETRAIN, {*_SCORE, "basic", "exact", "near_dedup", "ppl", *_LATER}, "pipeline")
        basic = own.get("basic") or {}
        quality = {"allowed_langs": None} | _named(basic, _QUALITY, _LATER, "pipeline.basic")
        score = _named({k: v for k, v in own.items() if k in _SCORE}, _SCORE) | {"model": (own.get("ppl") or {}).get("model_name")}
        named |= {"quality": quality, "score": score}
        for unbuilt in ("bert_mlm_log", "topic"):
            on = own.get(unbuilt)
            if on.get("enabled") if isinstance(on, dict) else on:
                raise ValueError(f"pipeline.{unbuilt} is not built")
    else:
        own = basic = values.get("sft", values.get("sft_pipeline")) or {}
        named = _named(own, _CHAT, {*_QUALITY, "exact", "near_dedup", *_LATER}, "sft")
        named |= {"quality": {"allowed_langs": None} | {_QUALITY[k]: v for k, v in own.items() if k in _QUALITY}}
        named.setdefault("think_markers", ["<think>"])
    near = own.get("near_dedup") or {}
    named |= {"near_dedup": bool(near.get("enabled", True)), "near": _named(near, _NEAR, {"enabled"}, "near_dedup")}
    if isinstance(own.get("exact"), dict):
        named["exact_algorithm"] = str(own["exact"].get("algorithm", "sha1"))
    split = _named(values.get("split") or {}, {}, {"pretrain", "sft"}, "split") or (values.get("split") or {}).get(kind) or {}
    names = {"enabled": "enabled", "seed": "seed"} | (
        {"val_size": "val", "val_output_path": "val_path"} if kind == "pretrain" else
        {"tool_call_val_size": "tool_val", "multi_turn_val_size": "multi_turn_val", "tool_call_val_output_path": "tool_val_path", "multi_turn_val_output_path": "multi_turn_val_path"})
    out |= {"pretrain" if kind == "pretrain" else "chat": named, "split": _named(split, names, set(), f"split.{kind}")}
    out |= {"tokenizer": own.get("tokenizer_path_for_diagnostics"), "language_model": basic.get("fasttext_model_path"), "stats_path": values.get("stats_path") or own.get("stats_path")}
    if basic.get("lang_backend", "fasttext") != "fasttext" and quality_langs(named["quality"]):
        raise ValueError("the only language back end is fasttext")
    return out | {"report_rows": own.get("max_rows_token_histogram", 2000), "conversations_field": own.get("conversations_field", "conversations")}


def quality_langs(values: dict) -> tuple[str, ...]:
    langs = values.get("allowed_langs")
    if langs is not None and not isinstance(langs, (list, tuple)):
        raise TypeError("allowed_langs is a list or null")
    return cleaning.allowed_languages(QualityConfig(allowed_langs=None if langs is None else tuple(langs)))


def _build(kind: type, values: Any) -> Any:
    """A settings object from a mapping; unknown keys are warned of, other containers are an error."""
    if not isinstance(values, dict):
        raise TypeError(f"{kind.__name__} needs a mapping")
    if strange := sorted(set(values) - {f.name for f in fields(kind)}):
        warnings.warn(f"{kind.__name__}: no such settings: {', '.join(strange)}", stacklevel=3)
    out = {}
    for f in fields(kind):
        if f.name not in values:
            continue
        v, default = values[f.name], f.default_factory() if callable(f.default_factory) else f.default  # type: ignore[misc]
        if is_dataclass(default):
            v = _build(type(default), v)
        elif isinstance(default, tuple) and isinstance(v, list):
            v = tuple(v)
        out[f.name] = v
    return kind(**out)


def parse_job(values: dict) -> Job:
    """A job from a parsed YAML or JSON mapping of either layout."""
    if not isinstance(values, dict):
        raise TypeError("a job is a mapping")
    for key in ("input", "output"):
        if not str(values.get(key) or "").strip():
            raise ValueError(f"a job needs {key}")
    if str(values.get("kind", "pretrain")).strip().lower() not in ("pretrain", "sft"):
        raise ValueError("kind is pretrain or sft")
    for key in ("pipeline", "sft", "sft_pipeline", "split"):
        if values.get(key) is not None and not isinstance(values[key], dict):
            raise TypeError(f"{key} needs a mapping")
    sections = {"pipeline", "sft", "sft_pipeline"} & set(values) or {"pretrain", "sft"} & set(values.get("split") or {})
    values = from_sections(values) if sections else {"kind": "pretrain"} | values
    split = values.get("split")
    rest = {k: v for k, v in values.items() if k != "split"}
    job = _build(Job, rest)
    return job if split is None else Job(**{f.name: getattr(job, f.name) for f in fields(Job)} | {"split": _build(SplitConfig, split)})


def _gates(quality: QualityConfig, languages: Column | None, n_tokens: Column | None) -> None:
    """Refuses gates that can't run."""
    if cleaning.allowed_languages(quality) and languages is None:
        raise ValueError("the language gate needs a predictor; an empty list of languages switches it off")
    if (quality.min_tokens is not None or quality.max_tokens is not None) and n_tokens is None:
        raise ValueError("the token gate needs a tokenizer")


def pretrain(df: DataFrame, cfg: PretrainConfig, pos: str = "pos", languages: Column | None = None, score: Column | None = None, n_tokens: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows kept, one row of stage counts).  Stages: quality chain, paragraphs, exact, near, score.

    ``score`` reads the column ``clean``; without it the model "unigram" is built in."""
    _gates(cfg.quality, languages, n_tokens)
    if cfg.score.enabled and score is None and cfg.score.model != "unigram":
        raise ValueError("a score needs a scorer or the model unigram")
    shared = tables.Shared(df.sparkSession, "pretrain")
    x = cleaning.quality_chain(df, cfg.quality, cfg.text_field, languages, n_tokens)
    if cfg.dedupe_paragraphs:
        x = x.withColumn("clean", t.dedupe_paragraphs(F.col("clean")))
    x = shared.write(x, "cleaned")
    kept = x.where("reject is null")
    after_exact = cleaning.exact_dedup(kept, "clean", pos, cfg.exact_algorithm).drop("fingerprint") if cfg.exact_dedup else kept
    after_exact = shared.write(after_exact, "exact") if cfg.exact_dedup else after_exact
    after_near = shared.write(neardup.near_dedup(after_exact, cfg.near, "clean", pos), "near") if cfg.near_dedup else after_exact
    out = after_near
    if cfg.score.enabled:
        if score is None:
            scored = scoring.unigram_perplexity(out, "clean", pos).select(F.col(pos).alias("__pos"), F.col("ppl").alias("_ppl"))
            scored = out.join(scored, F.col(pos) == F.col("__pos"), "left").drop("__pos")
        else:
            scored = out.withColumn("_ppl", score)
        out = shared.write(scored, "scored")
        structured = t.looks_structured(F.col("clean")) if cfg.score.keep_structured else None
        masked = scoring.keep_mask(out, "_ppl", cfg.score.low, cfg.score.high, structured)
        out = masked.where("kept").drop("kept") if cfg.score.apply_filter else out
        if cfg.score.sort_ascending:
            out = out.orderBy(*scoring.score_order("_ppl", "clean", pos))
    rejects = x.where("reject is not null").groupBy("reject").count()
    counts = x.agg(F.count("*").alias("input_lines"), F.count_if(F.col("reject").isNull()).alias("after_basic_clean"))
    for name, part in (("after_exact_dedup", after_exact), ("after_near_dedup", after_near), ("output_lines", out)):
        counts = counts.crossJoin(part.agg(F.count("*").alias(name)))  # single rows
    counts = counts.crossJoin(rejects.agg(F.map_from_entries(F.collect_list(F.struct("reject", "count"))).alias("rejects")))
    # the cleaned text takes the text's place; helper columns go
    final = out.drop("reject", cfg.text_field).withColumnRenamed("clean", cfg.text_field)
    return final, counts


def chat(df: DataFrame, cfg: ChatConfig, pos: str = "pos", conv: str = "conversations", languages: Callable[[Column], Column] | None = None, n_tokens: Callable[[Column], Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows kept, one row of counters).  Steps in order, the first failing one owns the row: empty, think
    markers, [markers replaced, tool calls repaired], role chain, refusals, quality of the flattened text.
    Rows keep their messages as they stand after repair."""
    flat = F.col("__flat")
    lang, size = languages(flat) if languages else None, n_tokens(flat) if n_tokens else None
    _gates(cfg.quality, lang, size)
    shared = tables.Shared(df.sparkSession, "chat")
    c = F.col(conv)
    x = df.withColumn("__n", F.coalesce(F.size(c), F.lit(-1)))
    think = msg.has_think(c, cfg.think_markers) if cfg.drop_think else F.lit(False)
    x = x.withColumn("skip", F.when(F.col("__n") <= 0, "empty_conversations").when(think, "think_samples"))
    x = x.withColumn("__marked", F.col("skip").isNull() & F.lit(bool(cfg.markers)))
    if cfg.markers:
        x = x.withColumn(conv, msg.replace_markers(c, cfg.markers))
    if cfg.repair_tool_calls:
        x = x.withColumn("__fixed", msg.repair_tool_calls(c))
        n = F.size(F.filter(F.col("__fixed"), lambda m: (m["role"] == "assistant") & m["tool_calls"].isNotNull()))
        x = x.withColumn("__repaired", F.when(F.col("skip").isNull(), n).otherwise(0)).withColumn(conv, F.col("__fixed")).drop("__fixed")
    else:
        x = x.withColumn("__repaired", F.lit(0))
    reason = msg.role_chain_reason(c) if cfg.strict_roles else F.lit(None).cast("string")
    x = x.withColumn("role_reason", F.when(F.col("skip").isNull(), reason))
    refusal = msg.is_refusal(c, cfg.extra_refusals) if cfg.filter_refusals else F.lit(False)
    x = x.withColumn("skip", F.when(F.col("skip").isNotNull(), F.col("skip")).when(F.col("role_reason").isNotNull(), "role_order").when(refusal, "refuse_reply"))
    x = cleaning.quality_chain(x.withColumn("__flat", msg.concat_text(c)), cfg.quality, "__flat", lang, size)
    # an empty flattened text is dropped without a counter of its own
    x = x.withColumn("skip", F.coalesce("skip", "reject"))
    x = shared.write(x, "steps")
    kept = x.where("skip is null")
    exact = shared.write(cleaning.keep_first(kept.withColumn("__fp", msg.conversation_key(F.col(conv), cfg.exact_algorithm)), "__fp", pos), "exact") if cfg.exact_dedup else kept
    near = shared.write(neardup.near_dedup(exact, cfg.near, "clean", pos), "near") if cfg.near_dedup else exact
    counts = x.agg(
        F.count("*").alias("input_lines"),
        *[F.count_if(F.col("skip") == k).alias(f"skipped_{k}") for k in ("empty_conversations", "think_samples", "role_order", "refuse_reply", "length", "non_printable", "punctuation", "language", "tokens")],
        F.count_if(F.col("skip").isNull()).alias("after_basic_clean"),
        F.count_if(F.col("__marked")).alias("markers_normalized_rows"), F.sum("__repaired").cast("long").alias("tool_calls_repaired"),
    )
    first = x.where("role_reason is not null").orderBy(pos).limit(8).agg(F.array_sort(F.collect_list(F.struct(pos, "role_reason"))).alias("role_examples"))
    counts = counts.crossJoin(first)  # single rows
    counts = counts.crossJoin(exact.agg(F.count("*").alias("after_exact_dedup")))
    # with near-duplicates off, the counter keeps the count before exact deduplication
    counts = counts.crossJoin((near if cfg.near_dedup else kept).agg(F.count("*").alias("after_near_dedup")))
    counts = counts.crossJoin(near.agg(F.count("*").alias("output_lines")))
    return near.select(*df.columns), counts


def fasttext_languages(path: str) -> Callable[[Column], Column]:
    """Candidates of a fastText model file that is at the same path on every executor."""
    try:
        import fasttext  # noqa: F401
    except ImportError as e:
        raise ValueError("the language gate needs the fasttext package or another predictor") from e

    def load() -> Callable[[list[str]], list[list[tuple[str, float]]]]:
        import fasttext

        model = fasttext.load_model(path)

        def predict(texts: list[str]) -> list[list[tuple[str, float]]]:
            labels, sure = model.predict(texts, k=2)
            return [[(x.removeprefix("__label__"), float(p)) for x, p in zip(*one)] for one in zip(labels, sure)]

        return predict

    return scoring.predictor(load)


def _seams(job: Job, seams: Seams) -> tuple[Callable | None, Callable | None]:
    """Language candidates and token counts, as far as the job asks for them."""
    quality = (job.pretrain if job.kind == "pretrain" else job.chat).quality
    languages = seams.languages
    if cleaning.allowed_languages(quality) and languages is None:
        if not job.language_model:
            raise ValueError("the language gate needs a model's path; an empty list of languages switches it off")
        languages = fasttext_languages(job.language_model)
    return languages, tokenizing.token_counter(job.tokenizer) if job.tokenizer else None


def run(spark: SparkSession, job: Job, seams: Seams = Seams()) -> dict[str, str]:
    """Runs a job from JSON lines to JSON lines; returns the places written."""
    split = job.split if job.split and job.split.enabled else None
    given = {k: v for k, v in (("val", split.val_path), ("tool_val", split.tool_val_path), ("multi_turn_val", split.multi_turn_val_path)) if v} if split else {}
    paths = sinks.derived_paths(job.output, **given, report=job.report_dir)
    languages, n_tokens = _seams(job, seams)
    shared = tables.Shared(spark, "job")
    if job.kind == "pretrain":
        c = t.as_text(F.col(job.pretrain.text_field))
        kind = T.StructType([T.StructField(job.pretrain.text_field, T.StringType())])
        df = tables.with_position(tables.json_lines(spark, job.input, kind))
        score = seams.score(F.col("clean")) if seams.score and job.pretrain.score.enabled else None
        out, counts = pretrain(df, job.pretrain, languages=languages(c) if languages else None, score=score, n_tokens=n_tokens(c) if n_tokens else None)
    else:
        kind = T.StructType([T.StructField(job.conversations_field, T.ArrayType(tables.MESSAGE))])
        rows, _ = tables.split_corrupt(tables.json_lines(spark, job.input, kind, "log"))
        out, counts = chat(tables.with_position(rows), job.chat, conv=job.conversations_field, languages=languages, n_tokens=n_tokens)
    out, counts = shared.write(out, "out"), shared.write(counts, "counts")
    written = {"output": job.output}
    if job.report:
        sinks.write_document(_report(out, counts, job), f"{paths['report']}/report.json")
        written["report"] = f"{paths['report']}/report.json"
    if split and job.kind == "pretrain":
        marked = splitting.with_split(out, "pos", split.val, split.seed)
        sinks.write_json_lines(marked.where("split = 'val'").drop("split", "pos"), paths["val"])
        out, written["val"] = marked.where("split = 'train'").drop("split"), paths["val"]
    elif split:
        marked = splitting.conversation_split(out, "pos", job.conversations_field, split.tool_val, split.multi_turn_val, split.seed)
        for k in ("tool_val", "multi_turn_val"):
            sinks.write_json_lines(marked.where(F.col("split") == k).drop("split", "pos"), paths[k])
            written[k] = paths[k]
        out = marked.where("split = 'train'").drop("split")
    sinks.write_json_lines(out.drop("pos"), job.output)
    if job.stats_path:
        sinks.write_stats(counts, job.stats_path)
        written["stats"] = job.stats_path
    return written


def _report(out: DataFrame, counts: DataFrame, job: Job) -> dict[str, Any]:
    """The data of the charts: the funnel, and histograms of lengths, scores, tokens and turns."""
    rows = lambda df: [r.asDict() for r in df.collect()]  # noqa: E731 - one row per bin or stage
    stages = [c for c in ("input_lines", "after_basic_clean", "after_exact_dedup", "after_near_dedup", "output_lines") if c in counts.columns]
    report: dict[str, Any] = {"funnel": rows(cleaning.funnel(counts.select(*stages)))}
    tokens = tokenizing.tokens_of(job.tokenizer) if job.tokenizer else None
    head = out if job.report_rows is None else out.orderBy("pos").limit(job.report_rows)
    if job.kind == "pretrain":
        c = F.col(job.pretrain.text_field)
        report["characters"] = rows(stats.equal_width_histogram(out.select(F.length(c).alias("v")), "v", 30))
        if "_ppl" in out.columns:
            report["scores"] = rows(stats.equal_width_histogram(out, "_ppl", 30))
        if tokens:
            report["tokens"] = rows(stats.equal_width_histogram(head.select(F.size(tokens(c)).alias("v")), "v", 20))
            report["top_tokens"] = rows(stats.top_ids(head.select(tokens(c).alias("ids")), tokenizing.pieces_of(job.tokenizer)))
        return report
    c = F.col(job.conversations_field)
    report["mean_turns"] = head.agg(F.avg(msg.count_turns(c))).first()[0]
    report["turns"] = rows(stats.turn_histogram(head.select(msg.count_turns(c).alias("v"))))
    report["tool_call_characters"] = rows(stats.equal_width_histogram(head.select(msg.tool_call_chars(c).alias("v")), "v", 20))
    if tokens:
        said = stats.messages_long(head, job.conversations_field).withColumn("ids", tokens(F.col("content")))
        for role in ("user", "assistant"):
            report[f"{role}_tokens"] = rows(stats.equal_width_histogram(said.where(F.col("role") == role).select(F.size("ids").alias("v")), "v", 20))
        report["top_tokens"] = rows(stats.top_ids(said.select("ids"), tokenizing.pieces_of(job.tokenizer)))
    return report


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Runs a preprocessing job.")
    parser.add_argument("job", help="YAML or JSON file")
    args = parser.parse_args(argv)
    text = Path(args.job).read_text()
    if args.job.endswith(".json"):
        values = json.loads(text)
    else:
        import yaml

        values = yaml.safe_load(text)
    spark = SparkSession.builder.getOrCreate()
    print(json.dumps(run(spark, parse_job(values))))


if __name__ == "__main__":
    main()
