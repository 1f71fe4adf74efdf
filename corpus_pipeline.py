"""A corpus from raw documents to token ids, in stages.

Each stage takes the documents that the one before has kept, and all but the last return
them with the same columns. ``run`` writes every stage's result and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from likertlake.llm import bpe, decontam, langid, neardup, queries, secrets
from likertlake.session import Workspace


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from the labels; ``und`` ones go.

    Those are texts without a letter and texts that are noise to the network in more than
    half of their bytes. A low score is no reason to go: a clean text that quotes another
    language has one. The labels stay as they are, also where the prediction differs.
    """
    found = langid.predict(docs, langid.fit(docs, reject=True), to="_language")
    return found.where(F.col("_language.lang") != langid.UNKNOWN).drop("_language")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that of the least id."""
    return neardup.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontam.contamination(docs, items, to="_found")
    return found.where(~decontam.is_contaminated(F.col("_found"))).drop("_found")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in the text replaced by a placeholder, characters counted anew."""
    found = secrets.scan(docs, secrets.fit(docs), to="_secrets")
    text = secrets.redacted(found, secrets="_secrets")
    clean = found.withColumn("text", F.when(F.size("_secrets") > 0, text).otherwise(F.col("text")))
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.when(F.size("_secrets") > 0, length).otherwise(F.col("n_chars"))).select(*[f"`{c}`" for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document's whole text, and whether they decode to it."""
    model = queries.tokenizer(spark)
    coded = bpe.decode(bpe.encode(docs, model, to="_ids"), model, "_ids", "_bytes")
    same = F.col("_bytes") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", "n_chars", F.size("_ids").cast("bigint").alias("n_tokens"), F.col("_ids").alias("ids"), same.alias("decodes"))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("byte_bpe", encode),
]

#: Trained, sampled and hashed stages have no SQL; tests compare their kept ids or results with brute force, and language_id with planted rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    space = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = space.cut(stage(spark, docs, sf_dir), name)
    return docs
