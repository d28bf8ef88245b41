"""The operators' queries over the given tables, and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctmart.llm import chats
from acctmart.llm.alignment import align
from acctmart.llm.bpe import encode
from acctmart.llm.common import let, table, words
from acctmart.llm.htmltext import main_text
from acctmart.llm.licenses import NAMES, NOTICES, license_scan
from acctmart.llm.mixing import draws
from acctmart.llm.neardup import near_duplicates
from acctmart.llm.periods import periodic_runs
from acctmart.llm.quality import ORACLE as QUALITY_ORACLE
from acctmart.llm.quality import quality
from acctmart.llm.scoring import lm_scores
from acctmart.llm.token_counts import token_counts
from acctmart.llm.toxicity import held_out, toxicity
from acctmart.llm.vectorjoin import linked_vectors

BASE_COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.format_chats(table(spark, sf_dir, "conversations"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = draws(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return drawn.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"), "draws"
    )


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"), templates=NOTICES, names=NAMES, keep=["doc_id"])


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity(docs, table(spark, sf_dir, "labels"), keep=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality(docs).select(*BASE_COLUMNS, "base_failed", "kept")


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, vocabulary("byte_bpe_50k.json"), keep=["doc_id"])


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode(docs, vocabulary("byte_bpe_multi_50k.tiktoken"), decoded=True, keep=["doc_id"])
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_vectors(table(spark, sf_dir, "embeddings"))


def id_hash() -> Column:
    """crc32 of a document's id as text; null without an id."""
    return F.crc32(F.col("doc_id").cast("string"))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(id_hash() % 7 == 2, F.lit(False))
    return lm_scores(docs, ~held, keep=["doc_id"]).withColumn("held_out", held)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return align(
        docs,
        vocabulary("byte_bpe_50k.json"),
        vocabulary("piece_bpe_32k.model"),
        keep=["doc_id"],
        shape=lambda rows: rows.withColumn("groups", digest),
    ).withColumnRenamed("groups", "groups_sha256")


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """Documents, of which every tenth by its id's hash repeats a stretch of its words to its end."""
    h, g = id_hash(), F.floor(id_hash() / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        picked = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, place(i).cast("int")))
        return F.when(n > 0, F.array_join(picked, " ")).otherwise("")

    return docs.withColumn("text", F.when(h % 10 == 0, let(words(F.col("text")), repeated)).otherwise(F.col("text")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return periodic_runs(docs, keep=["doc_id"]).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_mix_sources": op2_mix_sources,
    "op3_html_extraction": op3_html_extraction,
    "op4_license_scan": op4_license_scan,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_quality_rules": op8_quality_rules,
    "op9_token_counts": op9_token_counts,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_lm_scoring": op11_lm_scoring,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLES: dict[str, str] = {
    "op1_chat_formatting": chats.ORACLE,
    "op8_quality_rules": QUALITY_ORACLE,
}
