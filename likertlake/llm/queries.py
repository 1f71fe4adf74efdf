"""The operators of this package as queries over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from likertlake.llm import bpe, decontam, fim, langid, manifest, neardup, pages, pii, quality, secrets, shards, substring, vectors
from likertlake.llm.oracles import all_oracles as all_oracles


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_identification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, learned from the labelled folds that are not held out.

    ``und`` and score 0 for a null text or one without a letter. A null id is never held out; rows of one id and equal rows
    are predicted one by one. Without any label all are ``und``; no documents, no rows.
    """
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.predict(docs.select("doc_id", "text"), langid.fit(docs))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's class of near duplicates, by its least id, and how many rows have its text.

    A null text is a class of its own, an empty one is equal to other empty ones only. Rows of one id are rows each, and
    ``kept`` where the id is that of the class, so two rows of that id and text are both kept (the pipeline keeps one).
    """
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found, _ = neardup.classes(docs)
    rows = docs.select("doc_id", neardup.node_of(F.col("text")).alias("node")).join(found, "node", "left")
    return rows.select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n", F.lit(1)).alias("n_copies"),
        F.coalesce("class_id", "doc_id").eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page and its length in code points; empty for null or empty html.

    Pages without a host lose no site blocks; repeated rows have the same text; no pages, no rows.
    """
    found = pages.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score, votes and posterior of every text by the weak-label model; ``kept`` from its threshold on.

    Null and empty texts are scored by the heuristics that apply to them; repeated rows have the same result; no documents, no rows.
    """
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.score(docs, *quality.fit(docs))
    q = F.col("quality")
    return found.select("doc_id", q["score"].alias("score"), q["votes"].alias("votes"), q["posterior"].alias("posterior"), q["keep"].alias("kept"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every text: counts and digest of the fixed patterns, and all spans.

    Spans of inferred formats are in ``spans`` as ``format``. A null or empty text has none; repeated rows have the same ones.
    """
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.fit(docs))
    number = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("secrets", lambda x: x["kind"].isin(*secrets.BASE))
    return found.select("doc_id", *map(number, secrets.BASE), F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("secrets")).alias("spans"))


def op6_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every text, those removed with repeated windows, and the digest of those kept.

    A null text, an empty one or one shorter than the window loses nothing; repeated rows are texts each, so that all their windows go.
    """
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    r = F.col("repeats")
    return substring.repeats(docs).select(
        "doc_id", r["n_words"].alias("n_words"), r["n_removed"].alias("n_removed"), F.sha2(r["kept"], 256).alias("kept_sha256")
    )


def tokenizer(spark: SparkSession) -> bpe.Tokenizer:
    import public_tokenizers

    return bpe.load(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of every text's token ids, and the digest of the bytes they decode to.

    A null or empty text has no ids; repeated rows have the same ones.
    """
    docs, model = _table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer(spark)
    coded = bpe.decode(bpe.encode(docs, model).select("doc_id", "ids"), model)
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every text, those inside benchmark windows, the items they are of, and whether they are too many.

    A null or empty text has no words and is clean. Items without words or id have no window; items with one id are one.
    """
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.contamination(docs, _table(spark, sf_dir, "benchmark"))
    f = F.col("found")
    return found.select(
        "doc_id", f["n_words"].alias("n_words"), f["n_hit"].alias("n_hit"), F.size(f["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(f["items"], ","), 256).alias("items_sha256"), decontam.is_contaminated(f).alias("contaminated"),
    )


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document by the law ``bytes``; equal texts are neighbours.

    A null text has no bytes and no checksum; null or repeated ids and equal rows are placed like others.
    """
    placed = shards.assign(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many vectors each is linked to directly, and the least id that links reach.

    A vector that is null, zero or not finite, or has no label, links with nothing; rows of one id are vectors each.
    """
    found = vectors.classes(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op11_dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a leaf of the manifest, folded to the root from its tampered text.

    Null fields count as ``-``; documents without a language have a tree of their own;
    equal rows are leaves each, a null id comes first and is never tampered with; no documents, no rows.
    """
    docs = _table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    changed = [F.translate("text", upper, upper.lower()) if c == "text" else F.col(c) for c in fields]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, manifest.digest(changed))
    return manifest.build(docs, fields, replacement=tampered).verified().withColumnRenamed("id", "doc_id")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text cut by lines and put in the order of its form, and restored from that.

    A null text counts as empty; an empty one is plain, with 0 lines. Rows of one id have the same
    draws; a null id has those of the seed alone.
    """
    docs = fim.transform(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    f = F.col("fim")
    back = fim.restored(f["output"], f["form"])
    return docs.select(
        "doc_id", f["n"].alias("n"), f["form"].alias("form"), f["prefix_chars"].alias("prefix_chars"), f["middle_chars"].alias("middle_chars"),
        F.sha2(f["output"], 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every text: counts and digest of the fixed patterns, and all spans.

    Disguised identifiers are in ``spans`` under their kind and counted in ``n_disguised``
    alone. A null or empty text has no spans; repeated rows have the same ones.
    """
    found = pii.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda x: ~x["disguised"])
    number = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(number, pii.KINDS), F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(F.col("pii")).alias("spans"),
        (F.size("pii") - F.size(base)).cast("bigint").alias("n_disguised"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it imports this package in turn

    return corpus_pipeline.run(spark, sf_dir)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_identification": op1_language_identification,
        "op2_near_duplicates": op2_near_duplicates,
        "op3_html_extraction": op3_html_extraction,
        "op4_quality": op4_quality,
        "op5_secret_scan": op5_secret_scan,
        "op6_repeated_substrings": op6_repeated_substrings,
        "op7_byte_bpe": op7_byte_bpe,
        "op8_decontamination": op8_decontamination,
        "op9_shards": op9_shards,
        "op10_vector_duplicates": op10_vector_duplicates,
        "op11_dataset_manifest": op11_dataset_manifest,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_personal_data": op13_personal_data,
        "pipeline": pipeline,
    }
