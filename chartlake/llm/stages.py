"""The corpus pipeline's stages: (spark, docs, sf_dir) to the documents that stay, the last one to packed pieces."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake.llm import lempel_ziv, minhash_dedup, packing, repetition, secrets

TOKENIZER = "byte_bpe_50k.json"
#: Documents that share so many percent of their five-word shingles are near-duplicates; with 13 + 13 hashes of 3 minhashes a
#: pair at exactly 0.80 is missed about once in 5,600.
NEAR_PERCENT, NEAR_SIDE = 80, 13
END = 2


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars after a change of the texts, where docs have that column."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go: null, empty and short texts and those of repeats.

    Rows are judged one by one, so repeated rows and null ids don't matter; columns stay as they are, whatever their names.
    """
    return repetition.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (similarity of 0.8 or more) stays, the one of the smallest id; of several rows with that id the smallest.

    Documents without an id stay, and so do null and empty texts. Rows are ordered by their columns in turn, those with maps by
    their JSON; other columns don't matter.
    """
    kept = minhash_dedup.near_duplicates(docs, percent=NEAR_PERCENT, side=NEAR_SIDE).where("kept and doc_id is not null").select("doc_id").distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    stay = docs.join(kept, "doc_id", "left_semi").select(columns)
    sortable = [F.to_json(F.struct(c)) if "map<" in f.dataType.simpleString() else c for c, f in zip(columns, docs.schema.fields)]
    one = stay.groupBy("doc_id").agg(F.min_by(F.struct(*columns), F.struct(*sortable)).alias("row")).select("row.*")
    return one.union(docs.where("doc_id is null"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in passages that stand earlier in the corpus go; documents of which nothing is left go too, and null and blank texts with them."""
    left = lempel_ziv.without_copies(docs)
    return _counted(left.where(F.length(F.trim("text")) > 0))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; no row goes, null texts stay null."""
    return _counted(secrets.redacted(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of packed sequences; null and empty texts are pieces of the end id alone."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), END)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("secret_scan", secret_scan),
    ("packing", packed),
]
