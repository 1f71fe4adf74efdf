import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from likertlake.llm import fim, queries
from likertlake.llm import words as W


def brute(doc_id, text):
    """The contract, step by step."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digits = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    if h[3] % 100 < 50:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


HARD = ["\n", "\n\n", "a", "a\n", "\na", "é𝒳\n" * 700, "x" * 5000, "x" * 511 + "\n" + "y" * 512 + "\n", "a <P> b\n", "<\nP>\n<S\n>", "<<\n>P\n>S>", "ü\r\n" * 3, " ", "\x00\n\x00"]


def test_rows_against_brute_force(spark, odd):
    rng = random.Random(3)
    texts = HARD + ["".join(rng.choice("aé𝒳\n\n <>PSM") for _ in range(rng.randrange(1500))) for _ in range(150)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(5, None), (None, "no\nid\n")], "doc_id bigint, text string")
    for rows in (df, odd):
        for block in (7, fim.BLOCK):
            got = fim.transform(rows, block=block)
            assert got.columns == [*rows.columns, "fim"]
            for r in got.select("doc_id", "text", "fim.*", fim.restored(F.col("fim.output"), F.col("fim.form")).alias("back")).collect():
                assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(r.doc_id, r.text)
                assert r.back == (r.text or "")


def test_trees_find_every_boundary():
    texts = ["", "one\ntwo\n\nthree", "é\n𝒳𝒳\n" * 40, "", "z" * 100]
    data, offsets = W.column(pa.array(texts))
    for block in (1, 2, 5, 64):
        laid = fim.layout(data.copy(), offsets, block)
        for k, t in enumerate(texts):
            units = re.findall(r"[^\n]*\n|[^\n]+", t)
            assert laid.lines[k] == len(units)
            lines = np.arange(len(units) + 1)
            want = [len("".join(units[:n])) for n in lines]
            assert fim.chars_before(laid, np.full(len(lines), k), lines, block).tolist() == want


def test_rate_and_order_are_parameters(spark, docs):
    forms = lambda **p: {r.form for r in fim.transform(docs.select("doc_id", "text"), **p).select("fim.form").distinct().collect()}
    assert forms(rate=0) == {"plain"} and forms(suffix_first=100) == {"spm"} and forms(suffix_first=0) == {"psm"} and forms(rate=50) == {"plain", "psm", "spm"}


def test_clashing_column_and_empty_table(spark, none):
    got = fim.transform(none.withColumn("fim", F.lit(1)), to="fim")
    assert got.collect() == [] and got.columns.count("fim") == 1


def test_query_restores_every_text(spark, sf_dir, texts):
    rows = queries.op12_fill_in_middle(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    assert all(r.restored_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in rows)
