"""Scans: JSON lines under four error policies, token Parquet, text lines, manifests; the shared folder."""

from __future__ import annotations

import atexit
import json
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRETRAIN = T.StructType([T.StructField("text", T.StringType())])
MESSAGE = T.StructType([T.StructField(c, T.StringType()) for c in ("role", "content", "tool_calls", "tools", "reasoning_content")])
CONVERSATION = T.StructType([T.StructField("conversations", T.ArrayType(MESSAGE))])
#: Preference rows: the answers as conversations or as texts beside a prompt.
PREFERENCE = T.StructType([T.StructField(c, T.ArrayType(MESSAGE)) for c in ("chosen", "rejected")])
FLAT_PREFERENCE = T.StructType([T.StructField(c, T.StringType()) for c in ("prompt", "chosen", "rejected")])
CORRUPT = "_corrupt_record"


class Shared:
    """Intermediate tables in the folder that spark.checkpoint.dir names (set here only if unset)."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        sc = spark.sparkContext
        base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
        if not base:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
            sc.setCheckpointDir(base)
        self.root = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        atexit.register(self.drop)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self) -> None:
        try:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001 - at exit Spark may be gone
            pass


def json_lines(spark: SparkSession, path: str, schema: T.StructType = PRETRAIN, policy: str = "strict") -> DataFrame:
    """JSON lines; blank lines are skipped.  Policies: ``strict`` fails at the first bad line, ``skip``
    drops bad lines silently, ``log`` keeps them in ``_corrupt_record``, ``raise`` fails naming file and line."""
    if policy == "strict":
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if policy == "skip":
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    df = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)
    if policy == "log":
        return df
    if policy == "raise":
        where = F.concat(F.lit("bad JSON in "), F.input_file_name(), F.lit(": "), F.col(CORRUPT))
        checked = F.when(F.col(CORRUPT).isNotNull(), F.raise_error(where)).otherwise(F.lit(True))
        return df.where(checked.cast("boolean")).drop(CORRUPT)
    raise ValueError(f"unknown policy {policy!r}")


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and bad lines of a ``log`` scan."""
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT), df.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with white space stripped; blank ones stay as empty strings."""
    from corpusloom.functions.text import strip

    return spark.read.text(path).select(strip(F.col("value")).alias("text"))


def prompts(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines of one small prompt file with their 1-based line number."""
    whole = spark.read.option("wholetext", "true").text(path)
    lines = whole.select(F.posexplode(F.split("value", r"\r\n|\n|\r")).alias("i", "line"))
    return lines.select((F.col("i") + 1).cast("long").alias("sample_id"), F.trim("line").alias("prompt")).where("prompt <> ''")


def with_position(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """A contiguous position over a global order without one task seeing all rows: a range shuffle, the
    parts' counts (one number a part) and a running number inside each part."""
    from pyspark.sql.window import Window

    spark, shared = df.sparkSession, Shared(df.sparkSession, "positions")
    keys = order or ["__file", "__block", "__id"]
    if not order:
        df = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = shared.write(df.repartitionByRange(parts, *keys).withColumn("__part", F.spark_partition_id()), "ranged")
    sizes = sorted(at.groupBy("__part").count().collect())
    base, n = {}, 0
    for p, k in sizes:
        base[p], n = n, n + k
    offsets = spark.createDataFrame([(p, b) for p, b in base.items()], "__part int, __base long")
    rn = F.row_number().over(Window.partitionBy("__part").orderBy(*keys)) - 1
    out = at.withColumn("__rn", rn).join(F.broadcast(offsets), "__part")  # one row per partition
    return out.withColumn("pos", F.col("__base") + F.col("__rn")).drop("__base", "__rn", "__part", "__file", "__block", "__id")


def token_rows(spark: SparkSession, path: str) -> DataFrame:
    """``input_ids`` of a token Parquet file or folder; rows that are null or empty are skipped."""
    df = spark.read.parquet(path)
    if "input_ids" not in df.columns:
        raise KeyError("input_ids")
    return df.select("input_ids").where(F.size("input_ids") > 0)


def row_shard(df: DataFrame, pos: str, shard: int, shards: int) -> DataFrame:
    """Rows of one shard: position modulo the number of shards, empties counted before they are skipped."""
    return df.where(F.pmod(F.col(pos), F.lit(shards)) == shard).where(F.size("input_ids") > 0)


def file_sharded(spark: SparkSession, path: str, shards: int) -> DataFrame:
    """Token rows of a folder with ``shard``: the file's place among the sorted names modulo ``shards``."""
    files = sorted(r[0] for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path").collect())
    names = spark.createDataFrame([(f.rsplit("/", 1)[1], i % shards) for i, f in enumerate(files)], "file string, shard int")
    df = spark.read.parquet(path).select("input_ids", F.col("_metadata.file_name").alias("file"))
    # one row per file; Spark broadcasts it only while it is below the session's size limit
    return df.join(names, "file").where(F.size("input_ids") > 0)


def detect(path: str) -> str:
    """Kind of a local source: ``arrow``, ``parquet_dir``, ``parquet`` or ``jsonl``."""
    p = Path(path)
    if p.is_dir():
        if (p / "dataset_info.json").exists() and (p / "state.json").exists():
            return "arrow"
        if any(p.glob("*.parquet")):
            return "parquet_dir"
    return "parquet" if p.suffix == ".parquet" else "jsonl"


def load(spark: SparkSession, path: str) -> DataFrame:
    """Dispatches on ``detect``: token rows, or JSON lines that fail with their location."""
    kind = detect(path)
    if kind == "arrow":
        import pyarrow.ipc

        files = sorted(Path(path).glob("*.arrow"))

        def run(batches):  # noqa: ANN001, ANN202 - one file per row, read where the task runs
            for b in batches:
                for f in b.column(0).to_pylist():
                    with pyarrow.ipc.open_stream(f) as reader:
                        for x in reader:
                            yield x.select(["input_ids"]).cast(pyarrow.schema([("input_ids", pyarrow.list_(pyarrow.int32()))]))

        names = spark.createDataFrame([(str(f),) for f in files], "file string").repartition(max(1, len(files)))
        return names.mapInArrow(run, "input_ids array<int>").where(F.size("input_ids") > 0)
    if kind in ("parquet", "parquet_dir"):
        return token_rows(spark, path)
    return json_lines(spark, path, policy="raise")


def domains(spark: SparkSession, manifest: str, schema: T.StructType = PRETRAIN) -> DataFrame:
    """Rows of all files of a manifest (name to path), with ``domain``."""
    root = Path(manifest).parent
    out: DataFrame | None = None
    for name, path in json.loads(Path(manifest).read_text()).items():
        full = path if os.path.isabs(path) else str(root / path)
        one = json_lines(spark, full, schema, "raise").withColumn("domain", F.lit(name))
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("the manifest names no domains")
    return out


def nested(df: DataFrame, text: str = "text") -> DataFrame:
    """Long rows (conv_id, turn, role, text) as one row per conversation with its messages in order."""
    msg = F.struct("turn", F.col("role").cast("string").alias("role"), F.col(text).alias("content"))
    own = df.groupBy("conv_id").agg(F.array_sort(F.collect_list(msg)).alias("m"))
    null = F.lit(None).cast("string")
    return own.select("conv_id", F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"), null.alias("tool_calls"), null.alias("tools"), null.alias("reasoning_content"))).alias("conversations"))



def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """The frame itself; an error that names every column it lacks."""
    lacking = [n for n in names if n not in df.columns]
    if lacking:
        raise KeyError(f"columns {lacking} are missing; there are {df.columns}")
    return df


def preferences(spark: SparkSession, path: str, flat: bool = False) -> DataFrame:
    """JSON lines of preference rows; a line that isn't one fails with its file."""
    return json_lines(spark, path, FLAT_PREFERENCE if flat else PREFERENCE, "raise")
