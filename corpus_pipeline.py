"""The training-data pipeline over ``documents``: quality, lines, near-duplicates,
mixing and encoding, each stage on all that the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir), and
what it returns is written as Parquet and read again as the next one's docs.
All but the last return the columns of ``documents``. No SQL oracle: the stages
are tested against their brute-force versions in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import staged, table
from lakemart.llm.line_dedup import without_duplicate_lines
from lakemart.llm.mixing import mix
from lakemart.llm.near_dedup import without_near_duplicates
from lakemart.llm.quality import fit_quality, quality_scores
from lakemart.llm.queries import KEEP_SCORE, tokenizer_file
from lakemart.llm.trie_bpe import bpe_round_trip


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the
    labelled documents among ``docs``."""
    net = fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality_scores(docs, net).filter(F.col("score") >= KEEP_SCORE).select("row.*")


def first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat an earlier one exactly or nearly."""
    return without_duplicate_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return without_near_duplicates(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows (doc_id, n_tokens, token_ids): ids packed as little-endian unsigned
    32-bit integers."""
    return bpe_round_trip(docs, tokenizer_file("word_bpe_49k.json")).select(
        "doc_id", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"), "token_ids")


STAGES = [("quality classifier", good_quality), ("line dedup", first_lines),
          ("near-duplicates", one_of_near), ("source mixing", mixed_sources),
          ("BPE encoding", encoded)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
