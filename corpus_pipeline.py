"""Corpus pipeline: the dealt operators as stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. ``run`` applies them to the whole table; between stages the rows are
written as Parquet in the shared folder and read again, so a stage starts from
stored rows and a lost executor costs only its own tasks.

A row without an id is kept by the deduplicating stages only if no row of its
group has one. Rows that share an id are kept or dropped together.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, maybe_broadcast
from tessera.llm.exact_dedup import exact_duplicates
from tessera.llm.mixing import sampled
from tessera.llm.near_dedup import near_duplicates
from tessera.llm.quality import kept_documents
from tessera.llm.queries import PIECE_MODEL
from tessera.llm.sentencepieces import encoded, read_model


def _without(spark: SparkSession, docs: DataFrame, verdicts: DataFrame, name: str) -> DataFrame:
    """``docs`` less the ids that no verdict keeps. Texts are shuffled only if
    those ids are too many to broadcast."""
    dropped = (verdicts.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("not kept")
               .select(F.coalesce("doc_id", F.lit(None).cast("long")).alias("__id")))
    dropped = Scratch(spark, name).save(dropped, "dropped")
    return docs.join(maybe_broadcast(dropped), docs["doc_id"].cast("long").eqNullSafe(dropped["__id"]), "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kept_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(spark, docs, exact_duplicates(docs), "exact-stage")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(spark, docs, near_duplicates(docs), "near-stage")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sampled(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_pieces and the piece ids of the whole text."""
    rows = docs.select("doc_id", "lang", "source", "text")
    out = encoded(rows, read_model(public_tokenizers.path(PIECE_MODEL)), keep_text=False, memo_size=MEMO_SIZE)
    return out.select("doc_id", "lang", "source", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids")


# Segments a worker process remembers in the last stage: the executors still
# hold what the stages before it took, so fewer than in the operator alone.
MEMO_SIZE = 100_000

STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("minhash near-dedup", near_dedup),
    ("mixing sources to target weights", source_mixing),
    ("sentencepiece encoding", sentencepiece),
]

# Near-dedup over whole tables, raking and piece encoding are not expressed in
# SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
