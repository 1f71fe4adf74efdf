import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from likertlake.llm import neardup, queries
from likertlake.llm import words as W
from likertlake.llm.graph import components
from likertlake.session import Workspace


def shingle_set(text, k=5):
    w = text.encode().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def edited(rng, words, changes):
    out = list(words)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"edit{rng.randrange(10**9)}"
    return " ".join(out)


def test_planted_copies(spark):
    """Groups of exact and near copies among clean texts that share a line."""
    rng = random.Random(3)
    line = "this line stands at the top of every page of the site"
    rows, group = [], {}
    for g in range(30):
        words = [f"w{rng.randrange(5000)}" for _ in range(300)]
        for _ in range(rng.choice([1, 1, 2, 5, 40])):
            rows.append((len(rows), f"{line} {edited(rng, words, rng.randrange(3))}"))
            group[rows[-1][0]] = g
    found, links = neardup.classes(spark.createDataFrame(rows, "doc_id int, text string"))
    node = {bytes(r.node): r for r in found.collect()}
    classes = {}
    for r in spark.createDataFrame(rows, "doc_id int, text string").select("doc_id", F.unhex(F.md5("text")).alias("n")).collect():
        classes[r.doc_id] = node[bytes(r.n)].class_id
    first = {}
    for i, g in sorted(group.items()):
        first.setdefault(g, i)
    assert classes == {i: first[g] for i, g in group.items()}
    assert links.where("similarity < 0.8").count() == 0
    kept = neardup.deduplicated(spark.createDataFrame(rows, "doc_id int, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(first.values())


def test_passage_that_many_texts_share(spark, monkeypatch):
    """Texts of one passage and words of their own meet in all buckets; few pairs are compared, and none that is similar is missed."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(400)]
    own = [rng.choice([5, 30, 90, 110, 130, 150]) for _ in range(150)]
    texts = [" ".join(passage + [f"own{i}x{j}" for j in range(n)]) for i, n in enumerate(own)]
    texts += [edited(rng, passage[:150], rng.randrange(9)) for _ in range(100)]
    compared, cut = [], Workspace.cut

    def counting(space, df, name):
        out = cut(space, df, name)
        if name == "pairs":
            compared.append(out)
        return out

    monkeypatch.setattr(Workspace, "cut", counting)
    found, links = neardup.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"))
    got = {r.id: r.class_id for r in found.collect()}
    linked = {(r.a, r.b) for r in links.collect()}
    first = {}
    for i, t in enumerate(texts):
        first.setdefault(t, i)
    sets = {i: shingle_set(texts[i]) for i in first.values()}
    clear = [(a, b) for a in sets for b in sets if a < b and jaccard(sets[a], sets[b]) >= 0.83]
    assert clear and linked and all(got[a] == got[b] for a, b in clear)
    assert len(set(got.values())) > 50
    assert sum(x.count() for x in compared) < 12 * len(sets)


def test_shared_weights_never_rule_out_a_similar_pair(texts):
    weights = neardup.Weights(np.zeros(8, np.int64), 0)
    rng = random.Random(4)
    rows = [edited(rng, t.split(), k) for t in list(texts.values())[:15] if t.split() for k in (1, 3, 9)]
    every = Counter(h for t in rows for h in set(neardup.shingles(W.split(*W.column(pa.array([t])), W.NOT_BLANK), 5, W.powers())[1].tolist()))
    lists = pa.array([[h - (h >> 63 << 64) for h, n in every.items() if n == 1]] + [None] * (len(rows) - 1), pa.list_(pa.int64()))
    marks = neardup.shared_weights(pa.array(rows), lists, weights, 5).to_pylist()
    pairs = [(a, b) for a in range(len(rows)) for b in range(a)]
    got = neardup.weighted_jaccard(pa.array([rows[a] for a, _ in pairs]), pa.array([rows[b] for _, b in pairs]), weights, 5)
    for (a, b), x in zip(pairs, got):
        common = x / (1 + x) * (marks[a]["weight"] + marks[b]["weight"])
        assert min(marks[a]["shared"], marks[b]["shared"]) * neardup.ROUNDING >= common
        assert sum(map(min, marks[a]["parts"], marks[b]["parts"])) * neardup.ROUNDING >= common
    assert any(m["shared"] < 0.9 * m["weight"] for m in marks)


def test_pairs_of_the_data(spark, sf_dir, texts):
    """Clear near copies share a class, and classes are joined by real similarity only."""
    got = {r.doc_id: r.class_id for r in queries.op2_near_duplicates(spark, sf_dir).collect()}
    sets = {i: shingle_set(t) for i, t in texts.items()}
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            j = jaccard(sets[a], sets[b])
            if j >= 0.83:
                assert got[a] == got[b]
            if got[a] == got[b]:
                assert j >= 0.5
    assert all(got[i] <= i for i in ids)


def test_weighted_jaccard(texts):
    weights = neardup.Weights(np.zeros(8, np.int64), 0)  # all weights equal
    pairs = [(a, b) for a, b in zip(list(texts.values())[:40], list(texts.values())[1:41])]
    pairs += [(t, t) for t in list(texts.values())[:5]] + [("", "a"), ("a b", "a b"), ("", "")]
    got = neardup.weighted_jaccard(pa.array([a for a, _ in pairs]), pa.array([b for _, b in pairs]), weights, 5)
    for (a, b), x in zip(pairs, got):
        ca, cb = (Counter(tuple(t.encode().split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))) if t.split() else Counter() for t in (a, b))
        total = sum((ca | cb).values())
        assert abs(x - (sum((ca & cb).values()) / total if total else 0)) < 1e-9


def test_samples_agree_as_often_as_texts_are_similar():
    rng = np.random.default_rng(1)
    h = W.mix(np.arange(400, dtype=np.uint64))
    wa, wb = rng.uniform(1, 3, 300), rng.uniform(1, 3, 300)
    a = dict(zip(range(300), wa))
    b = dict(zip(range(100, 400), wb))
    want = sum(min(a.get(k, 0), b.get(k, 0)) for k in range(400)) / sum(max(a.get(k, 0), b.get(k, 0)) for k in range(400))
    doc = np.repeat([0, 1], 300)
    _, s = neardup.samples(doc, np.concatenate([h[:300], h[100:]]), np.concatenate([wa, wb]), 4000)
    assert abs((s[0] == s[1]).mean() - want) < 0.03


def test_odd_rows(odd, none):
    found, _ = neardup.classes(odd)
    classes = {r.id: r for r in found.collect()}
    assert classes[4].n == 2 and classes[4].class_id == 4 and classes[5].class_id == 4
    assert classes[8].n == 2 and 9 not in classes
    kept = neardup.deduplicated(odd).collect()
    assert set(kept[0].asDict()) == set(odd.columns)
    assert sorted(str(r.doc_id) for r in kept) == sorted(map(str, [1, 2, 3, 4, 6, 6, None, None, 7, 8]))
    assert neardup.deduplicated(none).collect() == []


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(50)] + [(100 + rng.randrange(30), 100 + rng.randrange(30)) for _ in range(25)] + [(200, i) for i in range(201, 260)] + [(7, 7)]
    root = {x: x for e in links for x in e}
    for _ in range(len(root)):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(links, "a int, b int")
    got = {r.node: r.root for r in components(df, Workspace(spark, "test")).collect()}
    assert got == {k: v for k, v in root.items() if any(k in e and e[0] != e[1] for e in links)}
    assert components(df.limit(0), Workspace(spark, "test")).collect() == []
