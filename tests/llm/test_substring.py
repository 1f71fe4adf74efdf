import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest

from likertlake.llm import queries, substring
from likertlake.llm import words as W


def brute(texts, window):
    words = [t.encode().split() if t else [] for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        yield len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()


def test_query_against_brute_force(spark, sf_dir, texts):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op6_repeated_substrings(spark, sf_dir).collect()}
    want = {i: (n, r, hashlib.sha256(k.encode()).hexdigest()) for i, (n, r, k) in zip(texts, brute(texts.values(), 35))}
    assert got == want and any(r for _, r, _ in want.values())


@pytest.mark.parametrize("window,block", [(5, 3), (8, 2), (3, 1)])
def test_random_texts_over_many_small_chunks_and_parts(spark, window, block):
    rng = random.Random(window)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(40))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(5)
    got = {r.i: tuple(r.repeats) for r in substring.repeats(df, window=window, block=block, chunk_bytes=300, part_hashes=50).collect()}
    assert [got[i] for i in range(200)] == list(brute(texts, window))


def test_words_of_equal_hashes_are_no_repeat(spark):
    """Two words that the short hash takes for one: windows that begin with them stay, equal ones go."""
    one = "a"
    while len(one) < 1024:
        one += one.translate(str.maketrans("ab", "ba"))
    other = one.translate(str.maketrans("ab", "ba"))
    tables = W.powers()
    w = W.split(*W.column(pa.array([one, other])), W.NOT_BLANK)
    h = W.word_hashes(w, tables[0])
    assert h[0] == h[1]
    tail = " ".join(f"w{i}" for i in range(34))
    texts = [f"{one} {tail}", f"{other} {tail}", f"x {one}  {tail}\n", f"{other[:-1]}c {tail}"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: tuple(r.repeats) for r in substring.repeats(df).collect()}
    assert [got[i] for i in range(4)] == list(brute(texts, 35)) and [got[i][1] for i in range(4)] == [35, 0, 35, 0]


def test_odd_rows(odd, none):
    rows = odd.collect()
    got = substring.repeats(odd).collect()
    assert sorted(tuple(r["repeats"]) for r in got) == sorted(brute([r.text for r in rows], 35))
    assert set(got[0].asDict()) == set(odd.columns) and {r.found for r in got} == {"found"}
    assert substring.repeats(none).collect() == []


def test_a_block_must_fit(odd):
    with pytest.raises(ValueError):
        substring.repeats(odd, window=10, block=6)


def test_digests_do_not_stay_on_disk(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(substring.Workspace, "__init__", lambda self, spark, name="": setattr(self, "spark", spark) or setattr(self, "root", f"{tmp_path}/{name}"))
    rows = spark.createDataFrame([(i, " ".join(str(k + 3 * (i % 4)) for k in range(90))) for i in range(12)], "doc_id int, text string")
    found = substring.repeats(rows, window=8, block=2, chunk_bytes=500)
    kept = {p.name.rsplit("-", 1)[0] for p in (tmp_path / "substring").iterdir()}
    assert kept == {"chunks", "again", "near"}
    assert found.where("repeats.n_removed = 90").count() == 12
