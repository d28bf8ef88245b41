"""A corpus pipeline: quality rules, toxicity, near duplicates, mixing of sources, byte-level encoding.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame; ``run`` writes it as
Parquet into the shared folder and reads it again as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctmart.llm.bpe import encode
from acctmart.llm.common import words
from acctmart.llm.mixing import mix
from acctmart.llm.neardup import near_duplicates
from acctmart.llm.quality import quality
from acctmart.llm.queries import vocabulary
from acctmart.llm.toxicity import toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the quality rules."""
    return quality(docs.select(COLUMNS)).filter("kept").select(COLUMNS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that aren't predicted to be toxic, by what the labelled ones among them teach."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity(docs.select(COLUMNS), labels).filter("predicted = 0").select(COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id.

    Rows that repeat an id are one document, of which the first by its columns stays. Rows without an id are told apart by
    their text: they take a large number made of it, so that they go before a row with an id does, and equal ones are
    one document. Rows without an id and without words all stay.
    """
    by_text = F.shiftrightunsigned(F.xxhash64("text"), 2) + F.lit(1 << 62)
    worded = F.size(words(F.col("text"))) > 0
    unnamed = F.col("doc_id").isNull()
    docs = docs.select(COLUMNS).withColumn("_unnamed", unnamed).withColumn(
        "doc_id", F.coalesce("doc_id", F.when(worded, by_text))
    )
    ids = near_duplicates(docs).filter("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("_rows"))
    met = docs.join(ids, "doc_id")
    rest = [c for c in [*COLUMNS, "_unnamed"] if c != "doc_id"]
    repeated = met.filter("_rows > 1").groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("_first"))
    one = met.filter("_rows = 1").drop("_rows").unionByName(repeated.select("doc_id", "_first.*"))
    kept = one.unionByName(docs.filter("doc_id IS NULL"))
    return kept.withColumn("doc_id", F.when(~F.col("_unnamed"), F.col("doc_id"))).select(COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, dealt to the output shards and in their order."""
    return mix(docs.select(COLUMNS)).select(COLUMNS)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, and whether they decode to its text."""
    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    coded = encode(docs.select(COLUMNS), path, decoded=True)
    return coded.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("exact"),
    )


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("near duplicates", near_dedup_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]
#: SQL can't express the learned scores, the sketches and the merges; tests hold the stages against brute force.
ORACLE_SQL = None


def _folder(spark: SparkSession) -> str:
    """A new folder in the shared one that the cluster names; a session on one machine may take a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return os.path.join(shared or tempfile.mkdtemp(prefix="corpus-"), f"corpus-{uuid.uuid4().hex}")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = _folder(spark)
    for number, (_, stage) in enumerate(STAGES):
        out = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
