import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from likertlake.llm import decontam, queries

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items, window=13):
    """Words, hit words and items of each text."""
    known = defaultdict(set)
    for item, text in items:
        w = words(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if w and item is not None else 0):
            known[tuple(w[i : i + k])].add(str(item))
    sizes = {len(k) for k in known}
    for text in texts:
        w, hit, found = words(text), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if own := known.get(tuple(w[i : i + k])):
                    hit.update(range(i, i + k))
                    found |= own
        yield len(w), len(hit), sorted(found)


def test_query_against_brute_force(spark, sf_dir, texts):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in queries.op8_decontamination(spark, sf_dir).collect()}
    for i, (n, hit, found) in zip(texts, brute(texts.values(), items)):
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert got[i] == (n, hit, len(found), digest, hit > 0 and 20 * hit >= n)
    assert any(r[1] for r in got.values())


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_odd_rows_and_blocks(spark, odd, block_bytes):
    """Short items, repeated and null ids, items that cross; one block or several."""
    items = [
        (1, "A b, C"), (1, "word1 1 word2 2"), (2, None), (3, ""), (None, "one"), (4, "two words"), (5, "--"), (6, "TWO"),
        (7, " ".join(f"word{i} {i}" for i in range(3, 12))), (8, " ".join(f"word{i} {i}" for i in range(9, 18))), (9, "Ünïcode text"),
    ]
    df = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontam.contamination(odd, df, block_bytes=block_bytes).collect()
    assert set(got[0].asDict()) == set(odd.columns) and len(got) == odd.count()
    found = sorted((r["found"].n_words, r["found"].n_hit, list(r["found"].items)) for r in got)
    assert found == sorted(brute([r.text for r in odd.collect()], items))


def test_blocks_are_bounded(spark, monkeypatch):
    """Equal pairs count once; only a single longer text makes a larger block."""
    rows = [("hot", "one text that makes up a third")] * 200 + [(f"i{i}", f"text {i} " + "x" * (i % 40)) for i in range(300)] + [("long", "y" * 900)] * 3
    seen = []
    monkeypatch.setattr(decontam, "Index", lambda items, texts, window, gram: seen.append(list(zip(items, texts))))
    for make in decontam._blocks(spark.createDataFrame(rows, "item_id string, text string"), "item_id", "text", 13, 5, 500):
        make()
    assert sorted(x for block in seen for x in block) == sorted(set(rows))
    assert all(sum(len(t) for _, t in block) <= 500 or len(block) == 1 for block in seen)
    assert len(seen) <= 2 * sum(len(t) for _, t in set(rows)) / 500


def test_nothing(odd, none):
    items = odd.selectExpr("doc_id AS item_id", "text")
    assert decontam.contamination(none, items).collect() == []
    clean = decontam.contamination(odd, items.limit(0))
    assert clean.where(F.col("found.n_hit") > 0).count() == 0 and clean.count() == odd.count()
