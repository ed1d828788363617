"""Sinks: JSON lines, statistics, token Parquet, tokenizer corpora, output paths."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import flatten_newlines


def write_json_lines(df: DataFrame, path: str, keep_nulls: bool = True) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", str(not keep_nulls).lower()).json(path)


def write_stats(df: DataFrame, path: str) -> None:
    """A one-row frame as an indented JSON document."""
    row = df.select(F.to_json(F.struct("*")).alias("j")).first()
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(json.loads(row["j"]), ensure_ascii=False, indent=2), encoding="utf-8")


def write_document(document: dict, path: str) -> None:
    """An indented JSON document of bounded size."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(document, ensure_ascii=False, indent=2, default=str), encoding="utf-8")


def write_tokens(df: DataFrame, path: str, rows_per_file: int = 500_000) -> None:
    """``input_ids`` as list<int32> Parquet with zstd, at most ``rows_per_file`` rows a file; empty lists
    are left out."""
    ids = df.select(F.col("input_ids").cast("array<int>").alias("input_ids")).where(F.size("input_ids") > 0)
    ids.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(path)


def write_corpus(df: DataFrame, path: str, text: str = "text", key: str | None = None, seed: int = 42) -> None:
    """One document per line, line feeds written as backslash and n; with ``key`` in a seeded order."""
    ordered = df if key is None else df.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary")), key)
    ordered.select(flatten_newlines(F.col(text)).alias("value")).write.mode("overwrite").text(path)


def derived_paths(output: str, **given: str | None) -> dict[str, str]:
    """Default places of the splits and the report beside an output; given ones win."""
    p = Path(output)
    suffix = p.suffix or ".jsonl"
    out = {k: str(p.with_name(f"{p.stem}_{k}{suffix}")) for k in ("val", "tool_val", "multi_turn_val")}
    out["report"] = str(p.with_name(f"{p.stem}_report"))
    return out | {k: v for k, v in given.items() if v}
