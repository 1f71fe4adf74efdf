import numpy as np
import pytest

from likertlake.llm import queries, vectors


def brute(rows, cosine):
    """Links of each row, and the least id that it reaches."""
    def good(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n = len(rows)
    root, links = list(range(n)), [0] * n
    for a in range(n):
        for b in range(a):
            (_, u, la), (_, v, lb) = rows[a], rows[b]
            if la is None or la != lb or not good(u) or not good(v) or len(u) != len(v):
                continue
            x, y = np.array(u, float), np.array(v, float)
            x, y = x / np.abs(x).max(), y / np.abs(y).max()
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                links[a] += 1
                links[b] += 1
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    ids = {r: min((rows[k][0] for k in range(n) if root[k] == r and rows[k][0] is not None), default=None) for r in set(root)}
    return sorted(((rows[k][0], links[k], ids[root[k]]) for k in range(n)), key=str)


def near(rng, base, cosine):
    noise = rng.normal(size=len(base))
    base = base / np.linalg.norm(base)
    noise -= noise @ base * base
    return cosine * base + np.sqrt(1 - cosine**2) * noise / np.linalg.norm(noise)


@pytest.mark.parametrize("block", [1024, 16])
def test_recall_and_exactness(spark, block):
    """Neighbours at all cosines around the threshold; blocks small enough to matter."""
    rng = np.random.default_rng(block)
    rows = []
    for _ in range(120):
        base = rng.normal(size=16)
        label = int(rng.integers(3))
        rows.append((len(rows), base.tolist(), label))
        for c in rng.uniform(0.9, 1.0, rng.integers(4)):
            rows.append((len(rows), (3.5 * near(rng, base, c)).tolist(), label))
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>, label int")
    want, got = brute(rows, 0.93), sorted(map(tuple, vectors.classes(df, block=block).collect()), key=str)
    linked = sum(w[1] for w in want)
    assert sum(g[1] for g in got) >= 0.98 * linked
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    if block > len(rows):
        assert got == want


def test_the_traversal_is_in_order_of_distance():
    rng = np.random.default_rng(0)
    x = vectors.unit(rng.normal(size=(300, 10)))
    grid = vectors.Grid(x, 7, 0.93, 0.9)
    a, b = grid.distances(x)
    total = (a[:, :, None] + b[:, None, :]).reshape(len(x), -1)
    for n in (1, 5, 20, 49):
        cells = grid.visited(x, n)
        assert np.allclose(np.take_along_axis(total, cells, 1), np.sort(total, 1)[:, :n])
    assert (grid.visited(x, 1)[:, 0] == grid.cells(x)).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1),
        (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [None, 1.0], 1), (9, [], 1), (None, [1.0, 0.01], 1), (10, [1.0, 0.0], 2),
        (11, [1.0, 0.0, 0.0], 1), (12, [1e300, 0.0], 1), (13, [-1.0, 0.0], 1), (None, [0.0, 1.0], 3), (14, [5.0], 4), (15, [1e-300], 4),
        (16, [-0.0, 1.0], 5), (17, [0.0, 1.0], 5),
    ]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>, label int").selectExpr("*", "'x' AS node", "1 AS n", "'y' AS block")
    assert sorted(map(tuple, vectors.classes(df).collect()), key=str) == brute(rows, 0.93)
    assert vectors.classes(df.limit(0)).collect() == []


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in queries.op10_vector_duplicates(spark, sf_dir).collect()), key=str)
    assert got == brute(rows, 0.93)


def test_visits_are_counted_as_the_traversal_orders_cells():
    rng = np.random.default_rng(4)
    x = vectors.unit(rng.normal(size=(400, 8)))
    grid = vectors.Grid(x, 4, 0.93, 0.95)
    a, b = grid.distances(x)
    seen = grid.visited(x, a.shape[1] * b.shape[1])
    every = (a[:, :, None] + b[:, None, :]).reshape(len(x), -1)
    assert (np.diff(np.take_along_axis(every, seen, 1), axis=1) >= -1e-12).all()
    assert 1 <= grid.visits <= every.shape[1]
