"""The subpackage's queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake.llm import (
    alignment, bpe_reuse, lempel_ziv, licenses, minhash_dedup, packing, pii, projections, repetition, secrets, token_counts, token_files,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_minhash_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(documents(spark, sf_dir))


END = 2


@query("op2_best_fit_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), END)


@query("op3_token_files")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), END)
    return token_files.read_tokens(manifest, ids=False)


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), 50256)


@query("op7_secret_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_scan(documents(spark, sf_dir))

    def count(kind: str) -> Column:
        return F.expr(f"cast(size(filter(secrets, s -> s.kind = '{kind}')) as long)").alias(f"n_{kind}")

    def joined(chosen: str) -> Column:
        return F.expr(f"array_join(transform({chosen}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(joined("filter(secrets, s -> s.kind <> 'random')"), 256).alias("base_sha256"), joined("secrets").alias("spans"),
    )


@query("op8_quality_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality_rules(documents(spark, sf_dir), spans=False)


@query("op10_substring_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lempel_ziv.substring_dedup(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("left", 256).alias("kept_sha256"))


@query("op9_projected_neighbours")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return projections.nearest_neighbours(vectors, vectors.where("vec_id % 20 = 0"))


@query("op5_license_scan", licenses.ORACLE)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(documents(spark, sf_dir), licenses.templates(spark))


@query("op6_bpe_reuse")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_reuse.encode_decode(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), output=bpe_reuse.digests)


@query("op11_embedding_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op12_personal_data")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(documents(spark, sf_dir))

    def count(kind: str) -> Column:
        return F.expr(f"cast(size(filter(personal, s -> s.kind = '{kind}')) as long)").alias(f"n_{kind}")

    def joined(chosen: str) -> Column:
        return F.expr(f"array_join(transform({chosen}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")

    base = ", ".join(f"'{k}'" for k in pii.BASE_KINDS)
    return found.select(
        "doc_id", *map(count, pii.BASE_KINDS), F.sha2(joined(f"filter(personal, s -> s.kind in ({base}))"), 256).alias("base_sha256"),
        joined("personal").alias("spans"),
    )


@query("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path
    return alignment.aligned(documents(spark, sf_dir), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))[0]
