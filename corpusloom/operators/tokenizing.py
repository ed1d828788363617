"""Tokenizer seams: encoding through an existing vocabulary, token tables, training on a corpus file.

A tokenizer is anything with ``encode(list of texts) -> list of (ids, offsets)``; it is loaded once per
Python worker by the function given."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as t

Encode = Callable[[list[str]], list[tuple[list[int], list[tuple[int, int]]]]]


@cache
def _from_file(path: str):  # noqa: ANN202
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def file_tokenizer(path: str) -> Callable[[], Encode]:
    """A loader for a tokenizer file that is at the same path on every executor."""

    def load() -> Encode:
        tok = _from_file(path)
        return lambda texts: [(e.ids, e.offsets) for e in tok.encode_batch(texts, add_special_tokens=False)]

    return load


def encode(df: DataFrame, load: Callable[[], Encode], text: str = "text") -> DataFrame:
    """Adds input_ids, starts, ends (code points); null texts count as empty."""
    names = [f"c{i}" for i in range(len(df.columns))]
    at = df.columns.index(text)
    inner = df.toDF(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load()
        for b in batches:
            got = enc([x or "" for x in b.column(at).to_pylist()])
            cols = ([list(i) for i, _ in got], [[o[0] for o in off] for _, off in got], [[o[1] for o in off] for _, off in got])
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(c, pa.list_(pa.int32())) for c in cols]], [*names, "i", "s", "e"])

    schema = ", ".join([f"{n} {f.dataType.simpleString()}" for n, f in zip(names, inner.schema)] + ["i array<int>", "s array<int>", "e array<int>"])
    out = inner.mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, df.columns)], F.col("i").alias("input_ids"), F.col("s").alias("starts"), F.col("e").alias("ends"))


def corpus_to_tokens(df: DataFrame, load: Callable[[], Encode], text: str = "text") -> DataFrame:
    """Token rows of the non-blank texts, without empty ones."""
    return encode(df.where(t.strip(t.as_text(F.col(text))) != ""), load, text).where(F.size("input_ids") > 0)


class HashedWords(dict):
    """Ids 1..size of words by md5.  The words seen first are kept, in bounded number and length; others are hashed each time."""

    MOST, LONGEST = 1_000_000, 64

    def __init__(self, size: int):
        self.size = size

    def __missing__(self, word: str) -> int:
        # the first seven hexadecimal digits
        n = (int.from_bytes(hashlib.md5(word.encode()).digest()[:4], "big") >> 4) % self.size + 1
        if len(self) < self.MOST and len(word) <= self.LONGEST:
            self[word] = n
        return n


def hashed_words(c: Column, size: int = 1 << 15) -> Column:
    """White-space words as ids 1..size by hash: a stand-in vocabulary.  ``str.split`` parts at the same characters
    as ``text.words``; marked as not deterministic, so that filters on the ids don't have them worked out twice."""

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        get = HashedWords(size).__getitem__
        for b in batches:
            parts = []
            for x in b:
                w = x.as_py().split()
                parts.append(np.fromiter(map(get, w), np.int32, len(w)))
            ends = np.cumsum([0, *map(len, parts)])
            flat = np.concatenate([np.empty(0, np.int32), *parts])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    return run.asNondeterministic()(t.as_text(c))


def train(df: DataFrame, path: str, text: str = "text", size: int = 16_000, special: tuple[str, ...] = ("<pad>",)) -> None:
    """Trains a byte-level BPE on a corpus streamed through the driver and writes its file."""
    from tokenizers import Tokenizer, decoders, models, normalizers, pre_tokenizers, trainers

    tok = Tokenizer(models.BPE())
    tok.normalizer = normalizers.NFC()
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.decoder = decoders.ByteLevel()
    trainer = trainers.BpeTrainer(vocab_size=size, special_tokens=list(special), initial_alphabet=pre_tokenizers.ByteLevel.alphabet(), show_progress=False)
    rows = df.select(t.as_text(F.col(text)).alias("t")).toLocalIterator(prefetchPartitions=True)
    tok.train_from_iterator((r["t"] for r in rows), trainer)
    tok.save(path)


def tokens_of(path: str) -> Callable[[Column], Column]:
    """Ids of a column of texts by a tokenizer file (or the folder that holds tokenizer.json) at the same path on every executor; null counts as empty."""
    file = tokenizer_file(path)

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = file_tokenizer(file)()
        for s in batches:
            yield pd.Series([list(ids) for ids, _ in enc(s.fillna("").tolist())])

    return lambda c: run(c)


def token_counter(path: str) -> Callable[[Column], Column]:
    ids = tokens_of(path)
    return lambda c: F.size(ids(c))


def tokenizer_file(path: str) -> str:
    """The tokenizer's file; a path that isn't there is an error that names it."""
    import os

    file = os.path.join(path, "tokenizer.json") if os.path.isdir(path) else path
    if not os.path.isfile(file):
        raise FileNotFoundError(f"no tokenizer at {path}")
    return file


def pieces_of(path: str) -> dict[int, str]:
    """The piece of each id: of the vocabulary's size."""
    return {i: p for p, i in _from_file(tokenizer_file(path)).get_vocab().items()}
