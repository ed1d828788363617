"""Session settings and table loading shared by every query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def local_session(cores: int = 8, partitions: int = 8, app: str = "corpusloom", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data folder (a file or a folder of parts)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Tables below this many bytes are spread over all cores before work that is heavy for each row.
SMALL = 64 << 20


def spread(df: DataFrame, path: str) -> DataFrame:
    """A small table as one partition a core: such a file is often a single row group, which one task reads.  The
    shuffle is bounded by ``SMALL``; larger tables have their own splits and stay as they are."""
    sc = df.sparkSession.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    size = p.getFileSystem(sc._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    return df.repartition(sc.defaultParallelism) if size < SMALL else df
