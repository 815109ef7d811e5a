"""Registered queries of the training-data operators, with production parameters on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill.llm import (ann, codebooks, decontaminate, divergence, html, license, lines, mix,
                          pieces, quality, shard, simhash, suffix)
from lendmill.session import materialise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(table(spark, sf_dir, "documents"))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op3_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup(table(spark, sf_dir, "documents"), length=50)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), distance=4, shingle=4)
    return found.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.summary(table(spark, sf_dir, "documents"), distance=2)


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix.copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("times")).alias("taken"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"),
                                      table(spark, sf_dir, "benchmark"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = materialise(quality.with_statistics(table(spark, sf_dir, "documents")), "quality")
    model = quality.fit(quality.labelled(stats, table(spark, sf_dir, "labels")))
    return quality.score(stats, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op10_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.assign(table(spark, sf_dir, "documents"), shards=16)


def op11_codebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    books = codebooks.fit(vectors, positions=16, size=64, rounds=2, scale=256.0)
    coded = materialise(codebooks.encode(vectors, books), "codes")
    found = codebooks.with_group_total(coded, "label", "error", "label_error")
    return found.select("vec_id", codebooks.hex_code().alias("code"), "error", "label_error",
                        F.lit(books.sha256()).alias("codebooks_sha256"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), least_docs=3, top=200)


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model's path is a parameter of ``pieces.load``; executors get its table."""
    import public_tokenizers

    vocabulary = pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pieces.decode(pieces.encode(docs, vocabulary), vocabulary)
    numbers = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                        F.sha2(numbers, 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_license, op2_html, op3_suffix, op4_simhash, op5_ann, op6_lines, op7_mix,
    op8_decontaminate, op9_quality, op10_shard, op11_codebooks, op12_divergence, op13_pieces)}
ORACLES = {"op1_license": license.oracle(), "op11_codebooks": codebooks.oracle(),
           "op12_divergence": divergence.oracle()}
