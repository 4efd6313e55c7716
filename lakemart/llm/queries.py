"""The registered queries of this subpackage: thin digests of the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.alignment import aligned
from lakemart.llm.common import table
from lakemart.llm.exact_dedup import exact_duplicates
from lakemart.llm.html_text import labelled_weights, main_text
from lakemart.llm.line_dedup import line_duplicates
from lakemart.llm.mixing import mixed
from lakemart.llm.near_dedup import near_duplicates
from lakemart.llm.quality import fit_quality, held_out, quality_scores
from lakemart.llm.relative_lz import without_repeated_words
from lakemart.llm.repeats import without_repeats
from lakemart.llm.token_counts import token_counts
from lakemart.llm.trie_bpe import bpe_round_trip
from lakemart.llm.vector_topk import exact_top_k
from lakemart.llm.whitening import whitened

#: A text with more tokens than this is over the limit.
TOKEN_LIMIT = 1024
#: A document scoring at least this passes as good.
KEEP_SCORE = 0.3


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["hi"] - s["lo"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"))


def op4_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe_round_trip(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return coded.select("doc_id", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("token_ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return main_text(pages, labelled_weights(pages))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "row.doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = quality_scores(documents, fit_quality(documents, table(spark, sf_dir, "labels")))
    return scored.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score",
                         (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_duplicates(table(spark, sf_dir, "documents"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeated_words(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed",
                        F.sha2("kept", 256).alias("kept_sha256"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = aligned(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"),
                    tokenizer_file("piece_bpe_32k.model"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitened(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_token_counts, op2_repeats, op3_vector_topk, op4_trie_bpe, op5_html_text, op6_mixing, op7_near_dedup, op8_quality,
        op9_exact_dedup, op10_line_dedup, op11_substring_dedup, op12_alignment, op13_whitening)}
