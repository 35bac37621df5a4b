"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.cascade import FIGURES, judge
from tidemark.llm import cascade, chat, chunks, collocations, decontaminate, line_crf, ngram_join, part_codes, secrets, topk, toxicity
from tidemark.llm.mixing import mix
from tidemark.llm.packing import pack
from tidemark.llm.secrets import listed, scan, with_spans


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs).select("doc_id", *FIGURES, "base_failed", "kept")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each passage that an earlier document has: where it stands and who has it first."""
    spans = chunks.repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return spans.select("doc_id", "start", "length", "words", F.array_min("first_ids").alias("first_doc_id"), F.col("first_ids").alias("first_doc_ids"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.join(docs, size=3, num=9, den=10).select("doc_id", "n_shingles", "component_id")


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat.renderings(table(spark, sf_dir, "conversations"))
    return out.select(F.col("conv").alias("conv_id"), "part", "speaker", "n_turns", "n_spoken", "text", chat.listed(F.col("mask")).alias("mask"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.search(vectors, vectors.filter("vec_id % 50 = 0"), k=10)


def held_out(parts: int, rest: int):
    """Rows that are never learned from: crc32 of the id as text leaves ``rest``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(parts)) == rest


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_crf.classify(docs, table(spark, sf_dir, "labels"), ~held_out(3, 1))
    return out.select("doc_id", held_out(3, 1).alias("held_out"), "score", "predicted")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    rows = with_spans(docs, scan(docs))

    def kind(k: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")

    base, examples = F.filter("spans", lambda s: s["kind"] < 3), F.filter("spans", lambda s: s["verdict"] == "example")
    return rows.select("doc_id", kind(0).alias("n_assign"), kind(1).alias("n_access"), kind(2).alias("n_hex"),
                       F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
                       kind(3).alias("n_token"), F.size(F.filter("spans", lambda s: s["verdict"] == "live")).cast("long").alias("n_live"),
                       F.size(examples).cast("long").alias("n_example"), listed(examples).alias("examples"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.classify(docs, table(spark, sf_dir, "labels"), ~held_out(5, 0))
    return out.select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = part_codes.encode(table(spark, sf_dir, "embeddings"))
    rows = part_codes.with_label_errors(coded.rows)
    return rows.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(coded.books_sha256()).alias("codebooks_sha256"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    out = decontaminate.hits(docs, items)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    ids = F.filter(F.transform("items", lambda i: i["item"]), lambda i: i.isNotNull())
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents").select("text", "lang"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_quality_rules": op2_quality_rules,
    "op3_mixing": op3_mixing,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_ngram_join": op5_ngram_join,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_topk": op7_topk,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_secrets": op9_secrets,
    "op10_toxicity": op10_toxicity,
    "op11_vector_codes": op11_vector_codes,
    "op12_decontamination": op12_decontamination,
    "op13_collocations": op13_collocations,
}

ORACLES: dict[str, str] = {"op2_quality_rules": cascade.ORACLE, "op5_ngram_join": ngram_join.ORACLE, "op9_secrets": secrets.ORACLE, "op6_chat_formatting": chat.ORACLE, "op7_topk": topk.ORACLE,
                           "op11_vector_codes": part_codes.ORACLE, "op12_decontamination": decontaminate.ORACLE, "op13_collocations": collocations.ORACLE}
