"""Helpers shared by the operators of this subpackage: tables, the shared folder, input checks."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a maximal run of characters other than space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]"
#: Letters A-Z only; other letters keep their case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER_AZ = str.maketrans(UPPER, LOWER)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it in spark.checkpoint.dir.

    Where it is unset (tests, local mode) a temporary folder of this machine is set instead."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
        sc.setCheckpointDir(path)
    return path.rstrip("/")


class Scratch:
    """Tables of one operator run, written to the shared folder so that no lost executor takes them along."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(self.drop)

    def write(self, df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").option("compression", compression).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        """Deletes one table, or all of them; silent at exit, when Spark may be gone."""
        try:
            jvm = self.spark.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001 - a leftover folder is no failure
            pass


def arrow_batches(df: DataFrame) -> DataFrame:
    """Keeps Arrow batches small: at most 1000 rows, and few bytes where the session's Spark can bound them.

    Spark reads these settings when a query runs, so they are lowered for the session and can't be put back here;
    values that are lower already stay."""
    conf = df.sparkSession.conf
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 1000), ("spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20)):
        now = str(conf.get(name))
        if not now.isdigit() or not 0 < int(now) <= most:
            conf.set(name, str(most))
    return df
