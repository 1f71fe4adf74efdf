import pytest


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, ids that are null or shared, clashing columns."""
    long = " ".join(f"word{i % 977} {i}" for i in range(12_000))
    rows = [
        (1, None, None), (2, "", "en"), (3, " \t\n ", None), (4, long, "en"), (4, long, "en"), (5, long + " end", "de"),
        (6, "one", "de"), (6, "two words", None), (None, "no id at all here", "en"), (None, None, None),
        (7, "Ünïcode — „text“ 𝒳   done", "de"), (8, "a b c d", "en"), (9, "a b c d", "en"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    extra = ["found", "repeats", "language", "quality", "secrets", "ids", "bytes", "node", "kept", "row", "n", "shard", "size", "chunk", "blob"]
    return df.selectExpr("*", "'src' AS source", "length(text) AS n_chars", *[f"'{c}' AS {c}" for c in extra])


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
