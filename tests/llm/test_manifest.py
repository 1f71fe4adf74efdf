import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from likertlake.llm import manifest

H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()
FIELDS = ["doc_id", "lang", "text"]


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes):
    """Levels of a tree from the bottom."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def steps(levels, at, new):
    """The siblings on the way up, and the root with ``new`` in the place of a leaf."""
    proof = []
    for nodes in levels[:-1]:
        first = at // 8 * 8
        run = nodes[first : first + 8]
        proof += run[: at - first] + run[at - first + 1 :]
        run[at - first] = new
        new, at = H(*run), at // 8
    return proof, new


def brute(rows, tamper):
    """The contract over rows of id, lang and text."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    trees = {g: climb([x for *_, x in sorted((r[0] is not None, r[0] or 0, leaf(r)) for r in groups[g])]) for g in names}
    top = climb([trees[g][-1][0] for g in names])
    out = []
    for g in names:
        own = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        for k, r in enumerate(own):
            proof, new = steps(trees[g], k, leaf(tamper(r)))
            above, root = steps(top, names.index(g), new)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], H(*proof, *above), root, root == top[-1][0]))
    return out


def tampered(row):
    return row[0], row[1], row[2] if row[2] is None or row[0] is None or row[0] % 3 else row[2].lower()


def check(spark, rows, **settings):
    df = spark.createDataFrame(rows, "doc_id bigint, lang string, text string").withColumns({c: F.lit("x") for c in ("tree", "pos", "id", "digest", "name", "part")})
    new = F.when(F.col("doc_id") % 3 == 0, manifest.digest([F.col("doc_id"), F.col("lang"), F.lower("text")]))
    made = manifest.build(df.repartition(5), FIELDS, replacement=new, **settings)
    key = lambda x: tuple((v is not None, str(v)) for v in x)
    want = brute(rows, tampered)
    assert sorted(map(tuple, made.verified().collect()), key=key) == sorted(want, key=key)
    assert made.root() == want[0][3]


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 600])
def test_against_the_contract(spark, n):
    """Sizes at which trees gain a level; null ids, languages and texts; equal rows."""
    rows = [(i * 7 % n, ("en", "de", None, "é", "")[min(i % 9, 4)], f"Text {i % 5}" if i % 4 else None) for i in range(n)]
    check(spark, rows + [(None, None, "X"), (None, "en", None)] * 2)


def test_one_language_holds_nearly_all_and_blocks_are_many(spark, monkeypatch):
    """Stages of two levels each: several of them, and paths handed down through all."""
    monkeypatch.setattr(manifest, "LEVELS", 1)
    monkeypatch.setattr(manifest, "BLOCK", 8)
    rows = [(i, "en" if i % 50 else f"l{i}", f"Body {i}") for i in range(700)]
    check(spark, rows, range_rows=90)


def test_as_many_languages_as_rows(spark):
    check(spark, [(i, f"l{i * 37 % 101}", "T") for i in range(101)])


def test_a_state_taken_up_again_is_the_hash():
    digests = np.random.default_rng(1).integers(0, 1 << 32, (13, 8), dtype=np.uint32)
    text = [d.astype(">u4").tobytes().hex() for d in digests]
    (level,) = manifest.grow(digests, 1)
    assert [d.astype(">u4").tobytes().hex() for d in level.digests] == [H(*text[:8]), H(*text[8:])]
    new = digests[::-1].copy()
    got = manifest.fold(new, np.arange(13), digests, level)
    for k in range(13):
        run = text[:8] if k < 8 else text[8:]
        run = [*run]
        run[k % 8] = text[12 - k]
        assert got[k].astype(">u4").tobytes().hex() == H(*run)


def test_no_rows_have_no_root(spark, none):
    made = manifest.build(none, FIELDS)
    assert made.root() is None and made.verified().collect() == []


def test_extra_columns_do_not_matter(odd):
    made = manifest.build(odd, FIELDS)
    rows = made.verified().collect()
    assert len(rows) == odd.count() and all(r.verified for r in rows)
    assert made.root() == manifest.build(odd.select(*FIELDS), FIELDS).root()
