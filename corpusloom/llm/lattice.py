"""Language-model scores: the probability of a text summed over all segmentations into known subwords.

The vocabulary is an existing one and is not trained.  The public file is of the BPE kind, whose piece
scores are merge ranks, not probabilities; so the pieces' unigram probabilities are learned from the
training documents (counts of their pieces, one added to each).  Pieces don't cross words, so a text's
lattice falls apart into its words' lattices: a word's log probability is the forward recursion
``f[j] = logsumexp(f[i] + log p(word[i:j]))`` over all pieces, bytes included for unknown characters, and
is computed once per distinct word.  A text's score is the sum over its words and one end.

Counting without a row per token: documents are encoded in blocks (the rows of up to 16 MB of text), each with
its own dictionary, and written to the shared folder.  What is shuffled is one row per block and distinct
word, which grows with the corpus's vocabulary in use, not with its tokens, and is no heavier for a word
that makes a third of all tokens.  Blocks then meet their dictionary again by block number.

Defined results: null and empty texts are one end token; repeated rows are separate documents and count
each; an empty training side has N = 0 and V = 0, so base_score is 0; an empty table gives an empty
result; a null doc_id is a training row; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import LOWER, UPPER, Scratch, arrow_batches

FOLDS, FOLD = 7, 2
#: Most rows and bytes of text in a block.
BLOCK_ROWS = 10_000
BLOCK_BYTES = 16_000_000
#: The end of a text, as a word: no word holds a space.
END = " "
_TABLE = bytes.maketrans(UPPER.encode(), LOWER.encode())


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == FOLD, F.lit(False))


def _encoded(df: DataFrame) -> DataFrame:
    """Rows of two kinds under one schema: documents (doc_id, held_out, ids of the block's dictionary) and,
    per block, its dictionary: words, counts in training rows."""
    slim = df.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").cast("binary").alias("text"))
    schema = T.StructType([
        # null in the dictionaries' rows, also where the table's ids can't be
        T.StructField("block", T.LongType()), T.StructField("doc_id", slim.schema["doc_id"].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("ids", T.BinaryType()),
        T.StructField("words", T.ArrayType(T.StringType())), T.StructField("counts", T.ArrayType(T.LongType())),
    ])

    def flush(block: int, ids: list, held: list, texts: list) -> Iterator[pa.RecordBatch]:
        words = [(t or b"").translate(_TABLE).split() for t in texts]
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__  # a new word gets the next number
        number[END.encode()]
        sizes = np.asarray([len(w) for w in words])
        flat = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.uint32, int(sizes.sum()))
        train = ~np.asarray(held, bool)
        counts = np.bincount(flat[np.repeat(train, sizes)], minlength=len(number))
        counts[0] = int(train.sum())
        n, ends = len(ids), np.cumsum(sizes)
        parts = [flat[e - s : e].tobytes() for s, e in zip(sizes, ends)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([block] * n, pa.int64()), pa.array(ids, kinds[1].type), pa.array(held, pa.bool_()), pa.array(parts, pa.binary()), pa.nulls(n, pa.list_(pa.string())), pa.nulls(n, pa.list_(pa.int64()))], schema.names)
        names = [w.decode("utf-8") for w in number]
        for lo in range(0, len(names), 10_000):
            # the dictionary in slices; word k of the slice that starts at lo has number lo + k
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.nulls(1, kinds[1].type), pa.nulls(1, pa.bool_()), pa.array([str(lo).encode()]), pa.array([names[lo : lo + 10_000]], pa.list_(pa.string())), pa.array([counts[lo : lo + 10_000].tolist()], pa.list_(pa.int64()))], schema.names)

    kinds: dict = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the part's number and a running one: a task that runs again gives the same numbers, and the commit
        # protocol keeps the rows of one of its runs
        block = TaskContext.get().partitionId() << 32
        ids, held, texts, size = [], [], [], 0
        for b in batches:
            kinds[1] = b.schema.field("doc_id")
            ids += b.column("doc_id").to_pylist()
            held += b.column("held_out").to_pylist()
            own = b.column("text").to_pylist()
            texts += own
            size += sum(len(t or b"") for t in own)
            if len(ids) >= BLOCK_ROWS or size >= BLOCK_BYTES:
                yield from flush(block, ids, held, texts)
                block, ids, held, texts, size = block + 1, [], [], [], 0
        if ids:
            yield from flush(block, ids, held, texts)

    return arrow_batches(slim).mapInArrow(run, schema)


class Lattice:
    """Log10 probabilities of words under unigram piece probabilities."""

    def __init__(self, pieces: dict[str, float], byte: list[float]):
        self.pieces, self.byte = pieces, byte
        self.longest = max(map(len, pieces)) if pieces else 1
        self.first: set[str] = {p[:2] for p in pieces}

    def word(self, word: str) -> float:
        """Forward recursion over the marked word, scaled at each step so that long words don't vanish."""
        s = "▁" + word
        n, get, longest = len(s), self.pieces.get, self.longest
        f = [0.0] * (n + 1)  # probabilities relative to exp(shift)
        f[0], shift = 1.0, [0.0] * (n + 1)
        # shift[j] is the log scale of f[j]; a step adds f[i] * p with the scales' difference
        for j in range(1, n + 1):
            lo = j - longest if j > longest else 0
            base, total = shift[j - 1], 0.0
            for i in range(lo, j):
                p = get(s[i:j])
                if p is not None:
                    d = shift[i] - base
                    total += f[i] * p * (1.0 if d == 0.0 else math.exp(d) if d < 700 else math.exp(700))
            c = s[j - 1]
            if get(c) is None:
                p = 1.0
                for b in c.encode("utf-8"):
                    p *= self.byte[b]
                total += f[j - 1] * p
            if total < 1e-150:
                if total <= 0.0:
                    return -math.inf
                f[j], shift[j] = 1.0, base + math.log(total)
            else:
                f[j], shift[j] = total, base
        return (math.log(f[n]) + shift[n]) / math.log(10)


def _piece_counts(words: DataFrame, path: str) -> tuple[dict[str, int], list[int], int]:
    """Counts of the vocabulary's pieces in the training words; at most one number per piece reaches the
    driver from each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        total = np.zeros(sp.get_piece_size(), np.int64)
        for b in batches:
            own, n = b.column("word").to_pylist(), b.column("c").to_pylist()
            for lo in range(0, len(own), 5000):
                for ids, k in zip(sp.encode(own[lo : lo + 5000], num_threads=1), n[lo : lo + 5000]):
                    for i in ids:
                        total[i] += k
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["piece", "n"])

    got = words.select("word", "c").mapInArrow(run, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return {r["piece"]: r["n"] for r in got.collect()}  # bounded by the vocabulary


def lattice_from_counts(counts: dict[int, int], ends: int, path: str) -> tuple[Lattice, float]:
    """The lattice over the vocabulary's pieces, and the log10 probability of the end."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    size = sp.get_piece_size()
    total = sum(counts.values()) + ends + size + 1
    pieces, byte = {}, [0.0] * 256
    for i in range(size):
        p = (counts.get(i, 0) + 1) / total
        if sp.is_byte(i):
            byte[int(sp.id_to_piece(i)[3:5], 16)] = p
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            pieces[sp.id_to_piece(i)] = p
    return Lattice(pieces, byte), math.log10((ends + 1) / total)


def score(df: DataFrame, path: str | None = None) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    path = path or default_path()
    spark = df.sparkSession
    scratch = Scratch(spark, "lattice")
    both = scratch.write(_encoded(df), "encoded")
    entries = both.where("words is not null").select(
        "block", F.posexplode(F.arrays_zip("words", "counts")).alias("k", "x"), F.col("ids").cast("string").cast("int").alias("lo")
    ).select("block", (F.col("lo") + F.col("k")).alias("k"), F.col("x.words").alias("word"), F.col("x.counts").alias("n"))
    entries = scratch.write(entries, "entries")
    # a block has counted its words already; the words' work is shared out by their number, not by their bytes
    least = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = min(8 * least, max(least, entries.count() // 100_000))
    vocabulary = scratch.write(entries.repartition(parts, "word").groupBy("word").agg(F.sum("n").alias("c")), "vocabulary")
    row = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.sum(F.when(F.col("c") > 0, 1).otherwise(0)).alias("v"), F.max(F.when(F.col("word") == END, F.col("c"))).alias("ends")).first()
    n_train, distinct, ends = int(row["n"]), int(row["v"] or 0), int(row["ends"] or 0)
    counts = _piece_counts(vocabulary.where((F.col("c") > 0) & (F.col("word") != END)), path)
    lat, end_score = lattice_from_counts(counts, ends, path)
    shared = spark.sparkContext.broadcast(lat)  # one number per piece of the vocabulary: of fixed size
    norm = (n_train + 1) * (distinct + 1)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = np.asarray(b.column("c").to_pylist(), np.float64)
            own = [end_score if w == END else shared.value.word(w) for w in b.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("word"), b.column("c"), pa.array(np.log10((c + 1) / norm)), pa.array(own, pa.float64())], ["word", "c", "base", "own"])

    scored = vocabulary.mapInArrow(words, "word string, c long, base double, own double")
    joined = entries.select("block", "k", "word").join(scored, "word").select("block", "k", (F.col("c") > 0).alias("known"), "base", "own")
    documents = both.where("words is null").select("block", "doc_id", "held_out", "ids")
    schema = T.StructType([
        df.schema["doc_id"], T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
    ])

    def run(docs: pa.Table, table: pa.Table) -> pa.Table:
        k = table.column("k").to_numpy()
        known, base, own = np.zeros(len(k), np.int64), np.zeros(len(k)), np.zeros(len(k))
        known[k], base[k], own[k] = table.column("known").to_numpy(), table.column("base").to_numpy(), table.column("own").to_numpy()
        cols: list[list] = [[], [], [], []]
        for raw in docs.column("ids").to_pylist():
            ids = np.frombuffer(raw, np.uint32)
            cols[0].append(len(ids) + 1)
            cols[1].append(int(known[ids].sum() + known[0]))
            # summed in the order of the text, so that reruns and other blocks give the same bits
            cols[2].append(float(base[ids].sum()) + base[0])
            cols[3].append(float(own[ids].sum()) + own[0])
        n = docs.num_rows
        types = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        a = [pa.array(c, t) for c, t in zip(cols, types)]
        return pa.Table.from_arrays([docs.column("doc_id"), docs.column("held_out"), a[0], a[1], pa.array([n_train] * n, pa.int64()), a[2], a[3]], schema.names)

    return documents.groupBy("block").cogroup(joined.groupBy("block")).applyInArrow(run, schema)
