import numpy as np
import pytest

from likertlake.llm import langid, queries


@pytest.fixture(scope="module")
def net(docs):
    return langid.fit(docs)


def test_held_out_accuracy(spark, sf_dir, docs):
    rows = queries.op1_language_identification(spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and len(held) > 20
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(odd, net):
    rows = langid.predict(odd, net).collect()
    assert len(rows) == odd.count() and set(rows[0].asDict()) == set(odd.columns)
    for r in rows:
        if not r.text or not any(c.isalpha() for c in r.text):
            assert tuple(r["language"]) == ("und", 0.0)
        else:
            assert r["language"].lang in net.langs
    assert langid.predict(odd.limit(0), net).collect() == []


def test_without_labels(odd, none):
    assert langid.fit(none) is None
    assert {r["language"].lang for r in langid.predict(odd, None).collect()} == {"und"}


def test_only_training_folds_and_labels_are_read(docs):
    hidden = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 'xx' ELSE lang END AS lang")
    assert "xx" not in langid.fit(hidden).langs


def test_every_window_counts(net):
    data = np.frombuffer(b"the " * 200 + "der die das und nicht ".encode() * 200, np.uint8)
    x, doc, count = langid.windows(data, np.array([0, len(data)]))
    assert count.sum() == len(data) and len(x) == -(-len(data) // langid.LENGTH)


def test_the_sample_of_a_language_does_not_depend_on_its_size(spark):
    """The rows of the least hashes, as when all are ordered; of many languages the most frequent ones."""
    rows = [(i, f"{'das ist gut ' if i % 9 else 'this is fine '}{i}", "de" if i % 9 else "en") for i in range(4000)] + [(i, "x y", f"l{i}") for i in range(4000, 4030)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(7)
    net = langid.fit(df, sample_docs=40, sample_windows=1, langs=2)
    assert net.langs == ["de", "en"]
    assert len(langid.fit(df, sample_docs=40, sample_windows=1).langs) > 2
