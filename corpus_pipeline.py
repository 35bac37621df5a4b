"""The pipeline over ``documents``: stages that each call one operator of ``tidemark.llm``.

Every stage works on all rows that its predecessor kept, and all but the last return the columns of ``documents``; each
result is written as Parquet to the shared folder and read again as the next stage's input.  Empty tables, NULLs,
repeated rows and extra columns are handled as the operators state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import line_crf, ngram_join, packing, secrets
from tidemark.llm.common import stored
from tidemark.llm.mixing import mix, shards_of


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lines' random field calls bad go.  The model is fitted on the labels of the documents at hand."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return line_crf.classify(docs, labels, F.lit(True)).filter("predicted = 1").select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id (five words, similarity 0.8)."""
    return ngram_join.representatives(docs, size=5, num=8, den=10)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; all documents stay."""
    return secrets.redact(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources drawn to their target weights: a row for each time the mix takes a document."""
    # other columns travel as one, so that their names cannot clash with those of the mix
    others = [c for c in docs.columns if c not in ("doc_id", "text", "source")]
    rows = docs.select("doc_id", "text", "source", F.struct(F.lit(1).alias("one"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]).alias("others"))
    drawn = shards_of(mix(rows))
    return drawn.select(*[F.col(f"others.c{others.index(c)}").alias(c) if c in others else F.col(c) for c in docs.columns])


def curve_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens along the curve, with the checksums of their ids."""
    import public_tokenizers

    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("secret_scans", secret_scans),
    ("mixing_sources", mixing_sources),
    ("curve_packing", curve_packing),
]

#: A fitted model, hashes and a tokenizer are no SQL; the tests compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
