import numpy as np

from likertlake.llm import quality, queries


def test_against_given_labels(spark, sf_dir):
    """The given labels are only looked at here."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rows = queries.op4_quality(spark, sf_dir).join(labels, "doc_id").collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) / len(good) > 0.97
    assert sum(not r.kept for r in bad) / len(bad) > 0.8


def test_em_finds_the_accuracies():
    rng = np.random.default_rng(4)
    n, k = 20_000, len(quality.HEURISTICS)
    truth = rng.random(n) < 0.8
    right = np.stack([rng.uniform(0.3, 0.7, k), rng.uniform(0.95, 0.99, k)])
    said = rng.random((n, k)) < 0.8
    hit = rng.random((n, k)) < right[truth.astype(int)]
    votes = np.where(said, np.where(hit, truth[:, None], ~truth[:, None]), quality.NONE).astype(int)
    patterns: dict[str, int] = {}
    for row in votes.tolist():
        key = "".join(map(str, row))
        patterns[key] = patterns.get(key, 0) + 1
    found = quality.Labels(patterns)
    assert abs(found.prior - 0.8) < 0.02
    assert np.abs(found.right - right).max() < 0.05
    own = np.array([found.posterior["".join(map(str, v))] for v in votes.tolist()])
    assert ((own > 0.5) == truth).mean() > 0.97


def test_odd_rows(odd, none):
    model = quality.fit(odd)
    rows = quality.score(odd, *model).collect()
    assert len(rows) == odd.count() and set(rows[0].asDict()) == set(odd.columns)
    assert all(r["quality"].score == 0 and not r["quality"].keep for r in rows if not r.text)
    assert all(0 <= r["quality"].score <= 1 for r in rows)
    empty = quality.fit(none)
    assert quality.score(none, *empty).collect() == []
    assert all(r["quality"].posterior is None for r in quality.score(odd, *empty).collect())
