"""The corpus pipeline: quality rules, near-duplicates, decontamination, mixing, token output.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage's result as
Parquet to the shared folder and reads it back as the next one's ``docs``, so a lost executor never
costs more than the stage at work.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import decontam, dedup, mixing, quality, store
from corpusloom.llm.common import Scratch, read, shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy keeps.

    Null and empty texts have no words and go; rows are judged one by one, so null or repeated ids and further
    columns of any name change nothing."""
    return quality.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates.

    A null id stays only where its group has no other; different texts under one id are different documents; of
    rows equal in id and words one stays; texts without words are in no group and all stay."""
    return dedup.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found.

    Null and empty texts hold none and stay; rows are judged one by one."""
    return decontam.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: each document as often as its source's target asks for.

    A null source is one of its own; rows of one id are taken alike; a source without words gives no rows."""
    return mixing.mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids written to a content-addressed store; per document its digest, read back from the files.

    The store is the product and stays: in the folder of the session's setting ``spark.corpusloom.tokens``, or in
    one of the shared folder.  Null texts are empty documents; repeated ids are documents side by side; other
    columns are not stored."""
    root = spark.conf.get("spark.corpusloom.tokens", "") or f"{shared_dir(spark)}/corpus-tokens-{uuid.uuid4().hex}"
    logging.getLogger(__name__).info("token store: %s", root)
    return store.encode_and_digest(docs, root)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing_to_weights),
    ("token output", token_output),
]

#: MinHash candidates, approximate matching and BPE are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"{k}-{name.replace(' ', '-')}")
        if k:
            scratch.drop(f"{k - 1}-{STAGES[k - 1][0].replace(' ', '-')}")
    return docs
