"""Token-id output as a content-addressed store.

A document's id stream is cut where a rolling hash of the last 16 ids hits a pattern, so an insertion
moves only the cuts near it and shared passages give the same chunks.  Layout of a store:

``chunks``    one row per distinct chunk: sha256 of its payload, number of ids, how often it is
              referenced, payload (ids as little-endian unsigned integers of the width in ``manifest``)
``recipes``   one row per document in ascending doc_id order: part, place in it, doc_id, n_tokens, ids of the
              part before it, chunk hashes and lengths, Merkle root of the hashes; the last row of every
              ``RUN`` documents also has the Merkle root of their roots
``manifest``  one row per part: number of documents and ids, ids of all parts before it, Merkle root of
              its runs' roots, format fields

All three are Parquet tables written through Spark's commit protocol: a task that is lost and run again
leaves no half-written or doubled files.  Reading recomputes every hash from what was written, by documents,
runs and parts; what one step holds at a time is bounded by ``RUN``, not by the size of a part.

Defined results: null text is the empty document, whose stream is the end id alone; rows with the same
doc_id are separate documents next to each other; a null doc_id sorts first; an empty table gives an
empty store; other columns of the input are not stored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from corpusloom.llm.common import Scratch, arrow_batches
from corpusloom.llm.tokens import Pieces, default_path

END_ID = 2
#: Documents whose roots are hashed into one.
RUN = 4096
#: Chunk lengths in ids: least, most; a cut is sought with probability 2**-BITS at each id between.
LEAST, MOST, BITS, WINDOW = 64, 2048, 8, 16
ID_TYPE = "<u2"  # the vocabulary has fewer than 65,536 ids

_GEAR = np.random.default_rng(20240229).integers(0, 1 << 64, 1 << 16, dtype=np.uint64)
_ZEROS = memoryview(bytes(4 * MOST))
_MASK = np.uint64(((1 << BITS) - 1) << (64 - BITS))


def cuts(ids: np.ndarray) -> list[int]:
    """Ends of the chunks of one stream."""
    n = len(ids)
    if n <= LEAST:
        return [n] if n else []
    # the sum over the window of each id's number shifted by its distance, doubled from step to step
    h, j = _GEAR[ids], 1
    while j < WINDOW:
        low = h[:-j] << np.uint64(j)
        h[j:] += low
        j *= 2
    spots = np.flatnonzero((h & _MASK) == 0) + 1
    out, last = [], 0
    for s in spots.tolist():
        if s - last < LEAST:
            continue
        while s - last > MOST:
            last += MOST
            out.append(last)
        if s - last >= LEAST:
            out.append(s)
            last = s
    while n - last > MOST:
        last += MOST
        out.append(last)
    if n > last:
        out.append(n)
    return out


def merkle(leaves: list[bytes]) -> bytes:
    """Root over hashes; leaves and inner nodes are hashed with different first bytes."""
    level = [hashlib.sha256(b"\0" + x).digest() for x in leaves] or [hashlib.sha256(b"").digest()]
    while len(level) > 1:
        pairs = [hashlib.sha256(b"\1" + a + b).digest() for a, b in zip(level[::2], level[1::2])]
        level = pairs + level[len(pairs) * 2 :]
    return level[0]


def _flat(lists: pa.ListArray) -> tuple[pa.Array, list[int]]:
    """The values of a list column and where each row's begin and end among them."""
    at = lists.offsets.to_numpy()
    return lists.flatten(), (at - at[0]).tolist() if len(at) else [0]


def _list(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _staged(df: DataFrame, path: str) -> DataFrame:
    """Per document: hash, length and payload of its chunks; a payload that the same batch of documents has
    already given is left null."""
    slim = df.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chunk = T.StructType([T.StructField("hash", T.BinaryType()), T.StructField("n", T.IntegerType()), T.StructField("payload", T.BinaryType())])
    schema = T.StructType([
        T.StructField("doc_id", slim.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType()),
        T.StructField("chunks", T.ArrayType(chunk)), T.StructField("root", T.BinaryType()),
    ])
    end = np.asarray([END_ID], ID_TYPE).tobytes()
    width = np.dtype(ID_TYPE).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, sha = Pieces.get(path), hashlib.sha256
        for b in batches:
            seen: set[bytes] = set()
            n, at, hashes, lens, payloads, roots = [], [0], [], [], [], []
            for raw in pieces.id_bytes(b.column("text").to_pylist(), ID_TYPE):
                raw += end
                ends = cuts(np.frombuffer(raw, ID_TYPE))
                parts = [raw[i * width : j * width] for i, j in zip([0, *ends], ends)]
                own = [sha(p).digest() for p in parts]
                n.append(len(raw) // width)
                hashes += own
                lens += [len(p) // width for p in parts]
                payloads += [None if h in seen else seen.add(h) or p for h, p in zip(own, parts)]
                roots.append(merkle(own))
                at.append(len(hashes))
            chunks = pa.StructArray.from_arrays([pa.array(hashes, pa.binary()), pa.array(lens, pa.int32()), pa.array(payloads, pa.binary())], ["hash", "n", "payload"])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), _list(at, chunks), pa.array(roots, pa.binary())], schema.names)

    return arrow_batches(slim).mapInArrow(run, schema)


def _placed(ordered: DataFrame) -> DataFrame:
    """Adds to the sorted rows of each part: part, place, ids before, and a run's root on its last row."""
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType()), *ordered.schema.fields,
        T.StructField("before", T.LongType()), T.StructField("run_root", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, place, ids, leaves, held = TaskContext.get().partitionId(), 0, 0, [], None
        # one batch is held back, so that the last row of the part is known as such
        for b in chain((x for x in batches if x.num_rows), [None]):
            if held is not None:
                sizes = held.column("n_tokens").to_numpy()
                before = ids + np.concatenate([[0], np.cumsum(sizes)[:-1]])
                tops: list[bytes | None] = []
                for k, root in enumerate(held.column("root").to_pylist()):
                    leaves.append(root)
                    full = len(leaves) == RUN or (b is None and k == held.num_rows - 1)
                    tops.append(merkle(leaves) if full else None)
                    leaves = [] if full else leaves
                m = held.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, part), pa.int32()), pa.array(np.arange(place, place + m), pa.int64()), *held.columns, pa.array(before, pa.int64()), pa.array(tops, pa.binary())],
                    schema.names,
                )
                place, ids = place + m, ids + int(sizes.sum())
            held = b

    return ordered.mapInArrow(run, schema)


@F.udf(T.BinaryType())
def _root_of(leaves: list) -> bytes:
    """Of the roots of a part's runs: one row per part."""
    return merkle([bytes(x) for x in leaves])


def _parts(runs: DataFrame) -> DataFrame:
    """Per part, from (part, run, n_docs, n_ids, run_root): number of documents and ids, root."""
    tops = F.transform(F.array_sort(F.collect_list(F.struct("run", "run_root"))), lambda x: x["run_root"])
    return runs.groupBy("part").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_ids").alias("n_ids"), tops.alias("tops")).withColumn("root", _root_of("tops")).drop("tops")


def write(df: DataFrame, root: str, path: str | None = None) -> None:
    """Encodes the texts of ``df`` (doc_id, text) and writes a store to the folder ``root``."""
    spark = df.sparkSession
    scratch = Scratch(spark, "store-staging")
    staged = scratch.write(_staged(df, path or default_path()), "staged")
    # refs and payloads of a chunk meet in one small aggregate, combined on the map side first, so a chunk
    # that a third of all documents share is no heavier than any other
    flat = staged.select(F.inline("chunks"))
    flat.groupBy("hash").agg(
        F.first("n").alias("n_ids"), F.count("*").alias("refs"), F.first("payload", ignorenulls=True).alias("payload")
    ).write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/chunks")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    slim = staged.select("doc_id", "n_tokens", F.col("chunks.hash").alias("hashes"), F.col("chunks.n").alias("lens"), "root")
    ordered = slim.repartitionByRange(parts, "doc_id", "root").sortWithinPartitions("doc_id", "root")
    _placed(ordered).write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/recipes")
    scratch.drop()
    last = spark.read.parquet(f"{root}/recipes").where("run_root is not null")
    runs = last.select("part", F.expr(f"place div {RUN}").alias("run"), (F.col("place") + 1).alias("docs"), (F.col("before") + F.col("n_tokens")).alias("ids"), "run_root")
    # of a part's runs the last has the totals
    totals = _parts(runs.select("part", "run", F.lit(0).alias("n_docs"), F.lit(0).alias("n_ids"), "run_root")).select("part", "root")
    totals = runs.groupBy("part").agg(F.max("docs").alias("n_docs"), F.max("ids").alias("n_ids")).join(totals, "part")
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row per part
    totals.select("part", "n_docs", "n_ids", "root", before.alias("start"), F.lit(ID_TYPE).alias("id_type"), F.lit(END_ID).alias("end_id"), F.lit(2).alias("version")).write.mode("overwrite").parquet(f"{root}/manifest")


def recipes(spark: SparkSession, root: str) -> DataFrame:
    """Recipes with ``start``, the number of ids of all documents before.  The manifest has one row per part;
    Spark broadcasts it only while it is below the session's size limit."""
    m = spark.read.parquet(f"{root}/manifest").select("part", F.col("start").alias("base"))
    r = spark.read.parquet(f"{root}/recipes")
    return r.join(m, "part").withColumn("start", F.col("base") + F.col("before")).drop("base")


def _checked_chunks(spark: SparkSession, root: str) -> DataFrame:
    """Every stored chunk, read back: hash, n, crc32 of its ids as 32-bit little-endian integers.  A
    payload that doesn't match its hash or its length stops the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            crc, width, sha = [], np.dtype(ID_TYPE).itemsize, hashlib.sha256
            payloads, n = b.column("payload").to_pylist(), b.column("n_ids").to_pylist()
            # one widening for all payloads of the batch
            wide = memoryview(np.frombuffer(b"".join(payloads), ID_TYPE).astype("<u4").tobytes())
            at = 0
            for h, k, p in zip(b.column("hash").to_pylist(), n, payloads):
                if sha(p).digest() != h or len(p) != k * width:
                    raise ValueError(f"chunk {h.hex()} is damaged")
                crc.append(zlib.crc32(wide[at : at + 4 * k]))
                at += 4 * k
            yield pa.RecordBatch.from_arrays([b.column("hash"), b.column("n_ids"), pa.array(crc, pa.int64())], ["hash", "n", "crc"])

    return spark.read.parquet(f"{root}/chunks").select("hash", "n_ids", "payload").mapInArrow(run, "hash binary, n int, crc long")


@lru_cache(1 << 14)
def _zeros_crc(n: int) -> int:
    return zlib.crc32(bytes(n))


def joined_crc(parts: Iterable[tuple[int, int]]) -> int:
    """crc32 of a concatenation from the (crc32, length) of its parts.  The checksum is linear: against a
    run of zeros of the same length, a part changes it by what it changes on its own."""
    crc = 0
    for own, n in parts:
        crc = (zlib.crc32(_ZEROS[:n], crc) ^ _zeros_crc(n) if crc else 0) ^ own
    return crc


def _references(spark: SparkSession, root: str) -> DataFrame:
    """(part, start, k, hash) of every chunk of every document; start names the document, as no two start
    at the same id."""
    r = recipes(spark, root)
    return r.select("start", F.posexplode("hashes").alias("k", "hash"))


def digests(spark: SparkSession, root: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.  A recipe or a part that doesn't
    match its Merkle root stops the job.

    Each distinct chunk is read, verified and summed once; what travels to the documents is its checksum,
    not its payload, so a hot chunk costs eight bytes a reference.  AQE splits the references of a hot
    hash in the join."""
    documents, parts = _damaged_roots(spark, root)
    if documents or parts:
        raise ValueError(f"{documents} recipes and {parts} parts are damaged")
    r = recipes(spark, root)
    refs = r.select("doc_id", "start", "n_tokens", F.posexplode("hashes").alias("k", "hash"))
    joined = refs.join(_checked_chunks(spark, root), "hash", "left")
    docs = joined.groupBy("start").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_tokens").alias("n_tokens"), F.collect_list(F.struct("k", "crc", "n")).alias("parts")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts, at = _flat(b.column("parts"))
            if parts.field("crc").null_count:
                raise ValueError("a recipe names a chunk that the store lacks")
            k, crc, n = (parts.field(c).to_numpy(zero_copy_only=False) for c in ("k", "crc", "n"))
            doc = np.repeat(np.arange(b.num_rows), np.diff(at))
            order = np.lexsort((k, doc))
            crc, n = crc[order].tolist(), n[order]
            if b.num_rows and (np.bincount(doc, n, b.num_rows) != b.column("n_tokens").to_numpy()).any():
                raise ValueError("a recipe names a chunk that the store lacks")
            n = (4 * n).tolist()
            out = [joined_crc(zip(crc[i:j], n[i:j])) for i, j in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), b.column("n_tokens"), pa.array(out, pa.int64())], schema.names)

    schema = T.StructType([docs.schema["doc_id"], T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    return docs.select("doc_id", "start", "n_tokens", "parts").mapInArrow(run, schema)


def read_ids(spark: SparkSession, root: str) -> DataFrame:
    """The documents' ids, rebuilt: doc_id, start, ids."""
    chunks = spark.read.parquet(f"{root}/chunks").select("hash", "payload")
    parts = _references(spark, root).join(chunks, "hash").groupBy("start").agg(F.array_sort(F.collect_list(F.struct("k", "payload"))).alias("parts"))

    @F.udf("array<int>")
    def ids(parts: list) -> list[int]:
        return np.frombuffer(b"".join(bytes(p["payload"]) for p in parts), ID_TYPE).tolist()

    return recipes(spark, root).select("doc_id", "start").join(parts, "start").select("doc_id", "start", ids("parts").alias("ids"))


def verify(spark: SparkSession, root: str) -> dict[str, int]:
    """Recomputes every hash of a store and compares: chunks, documents' roots, parts' roots, totals."""
    n_chunks = _checked_chunks(spark, root).count()
    documents, parts = _damaged_roots(spark, root)
    return {"chunks": n_chunks, "damaged_documents": documents, "damaged_parts": parts}


def _damaged_roots(spark: SparkSession, root: str) -> tuple[int, int]:
    """Documents and parts whose Merkle roots, recomputed from recipes, aren't those written, or whose places
    and ids don't follow on each other; needs no payloads."""
    r = spark.read.parquet(f"{root}/recipes").select("part", "place", "n_tokens", "before", "hashes", "lens", "root", "run_root")

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes, at = _flat(b.column("hashes"))
            hashes = hashes.to_pylist()
            sizes = np.add.reduceat(np.append(b.column("lens").flatten().to_numpy(), 0), at[:-1]) if b.num_rows else np.zeros(0)
            good = [merkle(hashes[i:j]) == x for i, j, x in zip(at, at[1:], b.column("root").to_pylist())]
            good = np.asarray(good, bool) & (sizes == b.column("n_tokens").to_numpy())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("part", "place", "n_tokens", "before", "root", "run_root")), pa.array(good)], names)

    names = ["part", "place", "n_tokens", "before", "root", "run_root", "good"]
    told = r.mapInArrow(leaves, "part int, place long, n_tokens long, before long, root binary, run_root binary, good boolean")
    # a group holds the roots of RUN documents at most
    runs = told.groupBy("part", F.expr(f"place div {RUN}").alias("run")).agg(
        F.array_sort(F.collect_list(F.struct("place", "n_tokens", "before", "root"))).alias("docs"), F.max("run_root").alias("run_root"), F.count_if(~F.col("good")).alias("bad"))

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, at = _flat(b.column("docs"))
            place, n_ids, before = (docs.field(c).to_numpy() for c in ("place", "n_tokens", "before"))
            roots, first, ids, good = docs.field("root").to_pylist(), [], [], []
            for k, i, j, top in zip(b.column("run").to_pylist(), at, at[1:], b.column("run_root").to_pylist()):
                upto = before[i] + np.cumsum(n_ids[i:j])
                fine = (place[i:j] == np.arange(k * RUN, k * RUN + j - i)).all() and (before[i + 1 : j] == upto[:-1]).all()
                first.append(int(before[i]))
                ids.append(int(n_ids[i:j].sum()))
                good.append(bool(fine) and merkle(roots[i:j]) == top)
            n = pa.array(np.diff(at), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("part"), b.column("run"), n, pa.array(ids, pa.int64()), pa.array(first, pa.int64()), b.column("run_root"), pa.array(good, pa.bool_()), b.column("bad")], cols)

    cols = ["part", "run", "n_docs", "n_ids", "first", "run_root", "good", "bad"]
    found = Scratch(spark, "store-check")
    runs = found.write(runs.mapInArrow(tops, "part int, run long, n_docs long, n_ids long, first long, run_root binary, good boolean, bad long"), "runs")
    bad = runs.agg(F.coalesce(F.sum("bad"), F.lit(0))).first()[0]
    upto = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    torn = runs.withColumn("upto", upto).groupBy("part").agg(F.count_if(~F.col("good") | (F.col("upto") != F.col("first"))).alias("torn"))
    own = _parts(runs).join(torn, "part").select("part", F.col("root").alias("r"), F.col("n_docs").alias("d"), F.col("n_ids").alias("n"), "torn")
    m = spark.read.parquet(f"{root}/manifest")
    same = F.col("r").eqNullSafe(F.col("root")) & F.col("n").eqNullSafe(F.col("n_ids")) & F.col("d").eqNullSafe(F.col("n_docs")) & (F.col("torn") == 0)
    parts = m.join(own, "part", "full").where(~F.coalesce(same, F.lit(False))).count()
    found.drop()
    return int(bad), parts


def encode_and_digest(df: DataFrame, root: str | None = None) -> DataFrame:
    """Writes a store and returns its documents' digests, read back from it.  Without a ``root`` the store lies
    in the shared folder until the process ends."""
    spark = df.sparkSession
    root = root or Scratch(spark, "token-store").root
    write(df, root)
    return digests(spark, root)
