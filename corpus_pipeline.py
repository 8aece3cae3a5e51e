"""A training-data pipeline over ``documents``: each stage takes what the one before kept.

Stages: documents that fail the quality rules go; of near-duplicates the document with the
smallest id stays; documents contaminated by the benchmark go; secrets in texts are replaced
by a mark; the rest is encoded, and decoded again as a check. All stages but the last return
the columns of ``documents`` they were given. Rows that repeat are near-duplicates.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm import bpe, decontaminate, quality, secrets, simhash
from visitlens.llm.common import documents, stored
from visitlens.llm.queries import RANKS


def _packed(docs: DataFrame) -> DataFrame:
    """The text and the whole row in one column, so that no name can clash with a result's."""
    return docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules."""
    return quality.judged(_packed(docs)).filter("kept").select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row, that of the smallest id and then text, also where an
    id has rows in other groups. Documents without an id come after all others."""
    own = "coalesce(cast(_row.doc_id as bigint), 4611686018427387904L + shiftrightunsigned(xxhash64(text), 2))"
    keyed = _packed(docs).withColumn("_id", F.expr(own))
    return simhash.firsts(keyed, shingle=3, bits=3, id_column="_id").select("_row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.judged(_packed(docs), items).filter("not contaminated").select("_row.*")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a mark in place of each secret; ``n_chars`` is counted anew where there is one."""
    found = secrets.scanned(_packed(docs), secrets.trained(docs)).withColumn("_found", F.size("secret_spans") > 0)
    n_chars = F.when(F.col("_found"), F.length("clean")).otherwise(F.col("_row.n_chars"))
    changed = {"text": F.col("clean"), "n_chars": n_chars.cast(docs.schema["n_chars"].dataType)}
    return found.select(*[changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, and a digest of the bytes they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    own = docs.select("doc_id", "text")
    found = bpe.encode(own, ranks, public_tokenizers.PATTERN, finish=bpe.RoundTrip(ranks), spaces_begin=True)
    return found.select("doc_id", "n_tokens", "token_ids", "decoded_sha256")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("byte_bpe", encoding),
]

#: SQL cannot express the fingerprints, the forest or the merges; tests check each stage instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; what a stage returns is stored for the next."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
