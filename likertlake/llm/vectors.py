"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut in halves, each half has a codebook of its own, and the pair of
nearest codewords is a vector's cell in the product grid. The multi-sequence traversal
visits the cells of a vector in order of distance, as many as a vector at the threshold
needs for the target recall. Cells lie in blocks of bounded size; a block is compared
with those that hold visited cells, exactly and in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from likertlake.llm.graph import components
from likertlake.llm.share import column_udf, share
from likertlake.session import Workspace

COSINE, RECALL = 0.93, 0.995
#: Distinct vectors that the codebooks are fitted to, and vectors of a block.
SAMPLE, BLOCK = 8192, 1024
#: Codewords of a half: one for the square root of so many vectors, within these bounds.
PER_CELL, LEAST_WORDS, MOST_WORDS = 512, 2, 256
#: Sums of distances that the driver holds at once to see how many cells are to be visited.
RANKED = 1 << 22
STRIP = 256


def codebook(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """k-means; an empty codeword moves to the vector farthest from its own."""
    rng = np.random.default_rng(seed)
    words = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        d = distances(x, words)
        near = d.argmin(1)
        n = np.bincount(near, minlength=len(words))
        for w in range(len(words)):
            words[w] = x[near == w].mean(0) if n[w] else x[d.min(1).argmax()]
    return words


def distances(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ words.T + (words * words).sum(1), 0)


class Grid:
    """Two codebooks, and how many cells a vector visits."""

    def __init__(self, sample: np.ndarray, k: int, cosine: float, recall: float, seed: int = 3) -> None:
        self.half = max(1, sample.shape[1] // 2)
        halves = [h for h in (sample[:, : self.half], sample[:, self.half :]) if h.shape[1]]
        self.words = [codebook(h, k) for h in halves]
        self.shape = [len(w) for w in self.words] + [1] * (2 - len(self.words))
        self.visits = 1
        self.visits = self._needed(sample, cosine, recall, np.random.default_rng(seed))

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = distances(x[:, : self.half], self.words[0])
        second = distances(x[:, self.half :], self.words[1]) if len(self.words) > 1 else np.zeros((len(x), 1))
        return first, second

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.distances(x)
        return a.argmin(1) * self.shape[1] + b.argmin(1)

    def visited(self, x: np.ndarray, n: int | None = None) -> np.ndarray:
        """The ``n`` nearest cells of each vector, in order: the multi-sequence traversal.

        Codewords of each half are ranked by distance; the cell of ranks (i, j) comes after
        all those of lesser ranks in both, so only those with (i+1)(j+1) <= n can be among
        the first n. Their summed distances are sorted.
        """
        n = n or self.visits
        a, b = self.distances(x)
        ra, rb = a.argsort(1, kind="stable"), b.argsort(1, kind="stable")
        i, j = np.divmod(np.arange(self.shape[0] * self.shape[1]), self.shape[1])
        keep = (i + 1) * (j + 1) <= n
        i, j = i[keep], j[keep]
        total = np.take_along_axis(a, ra, 1)[:, i] + np.take_along_axis(b, rb, 1)[:, j]
        order = total.argsort(1, kind="stable")[:, :n]
        return np.take_along_axis(ra, i[order], 1) * self.shape[1] + np.take_along_axis(rb, j[order], 1)

    def _needed(self, x: np.ndarray, cosine: float, recall: float, rng: np.random.Generator) -> int:
        """Cells until those of that share of vectors at exactly the threshold are visited."""
        x = x[:2048]
        noise = rng.normal(size=x.shape)
        noise -= (noise * x).sum(1, keepdims=True) * x
        noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-12)
        other = self.cells(cosine * x + math.sqrt(max(0.0, 1 - cosine * cosine)) * noise)
        a, b = self.distances(x)
        own = np.take_along_axis(a, other[:, None] // self.shape[1], 1) + np.take_along_axis(b, other[:, None] % self.shape[1], 1)
        rank, strip = np.zeros(len(x), np.int64), max(1, RANKED // (self.shape[0] * self.shape[1]))
        for k in range(0, len(x), strip):  # the cells that come before the wanted one
            s = slice(k, k + strip)
            rank[s] = (a[s, :, None] + b[s, None, :] < own[s, :, None]).sum((1, 2))
        return int(np.sort(rank)[min(len(rank) - 1, int(recall * len(rank)))]) + 1


def usable(vector: Column) -> Column:
    """Neither null, empty nor zero, all components finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def _digest(label: Column, vector: Column) -> Column:
    part = lambda seed: F.lpad(F.hex(F.xxhash64(F.lit(seed), label, F.lit(seed), vector)), 16, "0")
    return F.unhex(F.concat(part(1), part(2)))


def matrix(array: pa.Array) -> np.ndarray:
    return array.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(array), -1)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow or underflow of the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def links_of(a: np.ndarray, b: np.ndarray | None, cosine: float) -> Iterator[tuple[int, np.ndarray]]:
    """Strips of the link matrix of unit vectors; of one block, without the diagonal."""
    for k in range(0, len(a), STRIP):
        hit = a[k : k + STRIP] @ (a if b is None else b).T >= cosine
        if b is None:
            hit[np.arange(len(hit)), k + np.arange(len(hit))] = False
        yield k, hit


def classes(
    rows: DataFrame, vector: str = "embedding", label: str = "label", id: str = "vec_id", cosine: float = COSINE,
    recall: float = RECALL, sample: int = SAMPLE, block: int = BLOCK,
) -> DataFrame:
    """``id``, ``n_links`` and ``component_id`` for every row.

    Links are between rows of one label and one dimension whose cosine reaches the
    threshold; rows with a null label or an unusable vector have none, and are their own
    component. Equal vectors are compared once and counted each. The component is the
    least id reachable; null ids do not count. The sample only places the grid: all
    vectors are indexed, and every link reported is exact.
    """
    spark = rows.sparkSession
    space = Workspace(spark, "vectors")
    base = rows.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    base = base.withColumn("node", F.when(F.col("label").isNotNull() & usable(F.col("v")), _digest(F.col("label"), F.col("v"))))
    nodes = base.where("node is not null").groupBy("node").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.count("*").alias("n"), F.min("id").alias("id"))
    nodes = space.cut(nodes, "nodes")
    count = nodes.count()
    k = min(MOST_WORDS, max(LEAST_WORDS, math.ceil(math.sqrt(count / PER_CELL))))
    fitted = nodes.orderBy("node").limit(sample).select("v").collect()  # digests are in random order
    by_size: dict[int, list] = {}
    for r in fitted:
        by_size.setdefault(len(r.v), []).append(r.v)
    grids = {d: Grid(unit(np.array(x)), k, cosine, recall) for d, x in by_size.items()}
    get = share(spark, grids)

    def cell(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        grids = get()
        for batch in batches:
            out = np.zeros(len(batch), np.int64)
            size = batch.value_lengths().to_numpy()
            for d in np.unique(size):
                own = np.flatnonzero(size == d)
                if int(d) in grids:  # a dimension that the sample has not met is one cell
                    out[own] = grids[int(d)].cells(unit(matrix(batch.take(pa.array(own)))))
            yield pa.array(out)

    placed = space.cut(nodes.select("node", "n", "label", "v", F.size("v").alias("d"), column_udf(cell, "bigint")("v").alias("cell")), "cells")
    # Small cells share a block, a large one has several.
    sizes = placed.groupBy("label", "d", "cell").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.partitionBy("label", "d").orderBy("cell")) - F.col("size")
    where = sizes.select("label", "d", "cell", "size", F.floor(before / block).alias("at"))
    split = F.when(F.col("size") > block, 1 + F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / block))).otherwise(F.lit(0))
    own = F.when(F.col("size") > block, F.col("cell")).otherwise(F.lit(-1))
    placed = placed.join(where, ["label", "d", "cell"]).withColumn("block", F.concat_ws("/", "label", "d", "at", own, split))
    each = placed.groupBy("block", "label", "d").agg(F.collect_list(F.struct("node", "n", "v")).alias("members"), F.collect_set("cell").alias("cells"))
    blocks = space.cut(each, "blocks")

    def visits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        grids = get()
        for batch in batches:
            out = []
            for members in batch:
                v = members.values.field("v")
                x = unit(matrix(v))
                out.append(np.unique(grids[x.shape[1]].visited(x)) if x.shape[1] in grids else np.zeros(1, np.int64))
            yield pa.array([x.tolist() for x in out], pa.list_(pa.int64()))

    holds = blocks.select("label", "d", F.explode("cells").alias("cell"), F.col("block").alias("b"))
    asks = blocks.select("label", "d", F.col("block").alias("a"), F.explode(column_udf(visits, "array<bigint>")("members")).alias("cell"))
    pairs = asks.join(holds, ["label", "d", "cell"]).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = pairs.union(blocks.select("block", "block")).distinct()
    of = lambda x: blocks.select(F.col("block").alias(x), F.col("members").alias(f"m{x}"))
    pairs = pairs.join(of("a"), "a").join(of("b"), "b").select(F.struct((F.col("a") == F.col("b")).alias("same"), "ma", "mb").alias("p"))

    def compare(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([_compared(p, cosine) for p in batch], _LINKS)

    # A row for each vector that has links in a pair of blocks: how many, and one that it reaches.
    found = pairs.select(F.inline(column_udf(compare, "array<struct<node binary, n bigint, root binary>>")("p")))
    found = space.cut(found, "links")
    degree = found.groupBy("node").agg(F.sum("n").alias("links"))
    root = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), space)
    full = nodes.select("node", "n", "id").join(degree, "node", "left").join(root, "node", "left")
    full = full.select("node", "id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
    full = space.cut(full, "classified")
    least = full.groupBy("root").agg(F.min("id").alias("component_id"))
    full = full.join(least, "root").select("node", "n_links", "component_id")
    out = base.select("id", "node").join(full, "node", "left")
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


_LINKS = pa.list_(pa.struct([("node", pa.binary()), ("n", pa.int64()), ("root", pa.binary())]))


def _compared(pair: pa.StructScalar, cosine: float) -> list[dict]:
    same = pair["same"].as_py()
    sides = [pair["ma"].values] if same else [pair["ma"].values, pair["mb"].values]
    node = [x for s in sides for x in s.field("node").to_pylist()]
    copies = [s.field("n").to_numpy() for s in sides]
    x = [unit(matrix(s.field("v"))) for s in sides]
    first = len(x[0])
    a, b = np.zeros(first, np.int64), np.zeros(len(x[-1]), np.int64)
    root = np.arange(len(node))
    for k, hit in links_of(x[0], None if same else x[1], cosine):
        if hit.any():
            a[k : k + len(hit)] = hit @ copies[-1]
            if not same:
                b += copies[0][k : k + len(hit)] @ hit
            i, j = np.nonzero(hit)
            root = _joined(root, i + k, j if same else j + first)
    n = a if same else np.concatenate([a, b])
    return [{"node": node[k], "n": int(n[k]), "root": node[root[k]]} for k in np.flatnonzero(n)]


def _joined(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Components, each by its least member, with more links; paths are halved as they grow."""
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        for at in (root[i], root[j], i, j):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new
