"""Merkle manifest of a dataset whose parents keep the hash states of their children.

A leaf is the hash of a row. Leaves of a group are a tree of runs of eight, and the roots
of the groups are the leaves of one more tree. Children go into their parent's hash as
64 hexadecimal digits, one whole block of SHA-256 each, so the state of the hash before
any child is eight words. Every parent keeps these states. To fold a changed leaf to the
root, the state before its place is taken up again and fed with the new digest and
with the siblings right of it; nothing to the left is hashed anew.

Nodes are numbered in Spark and worked on in blocks of consecutive nodes, four levels
high. A block leaves its root for the level above, and what its parents keep. On the way
down a block takes the path above its root, one row, to all its nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from likertlake.operators.ids import dense_id
from likertlake.session import Workspace

#: Children of a parent, and levels of a block.
ARITY, LEVELS = 8, 4
BLOCK = ARITY**LEVELS
#: Leaves of one range of the numbering, and ranges at least (as far as there are leaves).
RANGE_ROWS, RANGES = 4_000_000, 16


def _primes(n: int) -> list[int]:
    found: list[int] = []
    k = 2
    while len(found) < n:
        if all(k % p for p in found):
            found.append(k)
        k += 1
    return found


def _fraction(p: int, root: int) -> int:
    """The first 32 bits of the fraction of a root of ``p``."""
    n, x = p << (32 * root), 1 << 40
    while x**root > n:
        x = ((root - 1) * x + n // x ** (root - 1)) // root
    return x & 0xFFFFFFFF


ROUND = np.array([_fraction(p, 3) for p in _primes(64)], np.uint32)
START = np.array([_fraction(p, 2) for p in _primes(8)], np.uint32)
_DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)


def hex_words(digests: np.ndarray) -> np.ndarray:
    """Hexadecimal text of digests of eight words, as the sixteen words of a block."""
    raw = np.ascontiguousarray(digests.astype(">u4")).view(np.uint8)
    text = np.empty((len(raw), 64), np.uint8)
    text[:, 0::2], text[:, 1::2] = _DIGITS[raw >> 4], _DIGITS[raw & 15]
    return text.view(">u4").astype(np.uint32)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def resume(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """SHA-256 states (rows of eight words) after one more block each (rows of sixteen)."""
    w = [np.ascontiguousarray(block[:, i]) for i in range(16)]
    a, b, c, d, e, f, g, h = (np.ascontiguousarray(state[:, i]) for i in range(8))
    for i in range(64):
        if i >= 16:
            x, y = w[(i - 15) % 16], w[(i - 2) % 16]
            near = _turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))
            far = _turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))
            w[i % 16] = w[i % 16] + near + w[(i - 7) % 16] + far
        one = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + ROUND[i] + w[i % 16]
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h], 1)


def finish(state: np.ndarray, children: np.ndarray) -> np.ndarray:
    """Digests of states that have taken up so many children."""
    end = np.zeros((len(state), 16), np.uint32)
    end[:, 0] = 1 << 31
    end[:, 15] = children * 512
    return resume(state, end)


class Level(NamedTuple):
    digests: np.ndarray  # of the parents, eight words each
    states: np.ndarray  # of each parent, before each of its eight places


def grow(digests: np.ndarray, levels: int) -> list[Level]:
    """The parents of consecutive nodes, level by level; a run of fewer than eight has one, too."""
    out = []
    for _ in range(levels):
        n = len(digests)
        parents = -(-n // ARITY)
        children = np.minimum(ARITY, n - ARITY * np.arange(parents))
        state, states = np.tile(START, (parents, 1)), np.zeros((parents, ARITY, 8), np.uint32)
        text = hex_words(digests)
        for place in range(ARITY):
            states[:, place] = state
            has = np.flatnonzero(children > place)
            if len(has):
                state[has] = resume(state[has], text[has * ARITY + place])
        digests = finish(state, children)
        out.append(Level(digests, states))
    return out


def fold(digests: np.ndarray, at: np.ndarray, below: np.ndarray, level: Level) -> np.ndarray:
    """New digests of the parents of the nodes numbered ``at``, should these have ``digests``.

    ``below`` has the digests of all nodes of the level, as they are.
    """
    parent, place = at // ARITY, at % ARITY
    children = np.minimum(ARITY, len(below) - parent * ARITY)
    state, text, new = level.states[parent, place], hex_words(below), hex_words(digests)
    for k in range(ARITY):
        own, right = np.flatnonzero(place == k), np.flatnonzero((place < k) & (children > k))
        if len(own):
            state[own] = resume(state[own], new[own])
        if len(right):
            state[right] = resume(state[right], text[parent[right] * ARITY + k])
    return finish(state, children)


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    out = 0
    while n > 1:
        n, out = -(-n // ARITY), out + 1
    return out


# -- rows --------------------------------------------------------------------


def digest(fields: Sequence[Column]) -> Column:
    """Hash of a row: of each field its bytes' count, a colon and its text; ``-`` for null."""
    text = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def _to_words(column: pa.Array) -> np.ndarray:
    """Digests of 32 bytes as rows of eight words."""
    return np.frombuffer(b"".join(column.to_pylist()), ">u4").astype(np.uint32).reshape(-1, 8)


def _to_bytes(words: np.ndarray) -> list[bytes]:
    raw = words.astype(">u4").tobytes()
    return [raw[i : i + 32] for i in range(0, len(raw), 32)]


_NODES = pa.list_(pa.struct([("digests", pa.binary()), ("states", pa.binary())]))
_BLOCK = pa.schema([("tree", pa.int64()), ("size", pa.int64()), ("pos", pa.int64()), ("digest", pa.binary()), ("nodes", _NODES)])
_BLOCK_DDL = "tree bigint, size bigint, pos bigint, digest binary, nodes array<struct<digests: binary, states: binary>>"
#: A step up: the place of the node, its parent's state before it, and its siblings' digests from left to right.
_STEPS = pa.list_(pa.struct([("place", pa.int32()), ("state", pa.binary()), ("siblings", pa.binary())]))
_STEPS_DDL = "array<struct<place: int, state: binary, siblings: binary>>"
_PATH = pa.schema([("tree", pa.int64()), ("pos", pa.int64()), ("steps", _STEPS)])


def _sorted(table: pa.Table) -> pa.Table:
    return table.sort_by("pos").combine_chunks()


def _column(table: pa.Table, name: str) -> pa.Array:
    chunks = table.column(name).combine_chunks()
    return pa.concat_arrays(chunks.chunks) if isinstance(chunks, pa.ChunkedArray) else chunks


def _block_root(table: pa.Table) -> pa.Table:
    """One row: the root of a block of a tree and what its parents keep."""
    table = _sorted(table)
    tree, size, pos = (table.column(c)[0].as_py() for c in ("tree", "size", "pos"))
    own = _to_words(_column(table, "digest"))
    levels = grow(own, min(LEVELS, height(size)))
    nodes = [{"digests": x.digests.astype(">u4").tobytes(), "states": x.states.astype(">u4").tobytes()} for x in levels]
    root = (levels[-1].digests if levels else own)[0]
    return pa.Table.from_pylist([{"tree": tree, "size": -(-size // BLOCK), "pos": pos // BLOCK, "digest": _to_bytes(root[None])[0], "nodes": nodes}], _BLOCK)


def _levels(block: dict) -> list[Level]:
    words = lambda b, shape: np.frombuffer(b, ">u4").astype(np.uint32).reshape(shape)
    return [Level(words(x["digests"], (-1, 8)), words(x["states"], (-1, ARITY, 8))) for x in block["nodes"]]


def _paths(rows: pa.Table, above: pa.Table) -> pa.Table:
    """The steps from every node of a block to the root, given those of the block's root."""
    rows, block = _sorted(rows), above.to_pylist()[0]
    own, levels, out = _to_words(_column(rows, "digest")), _levels(block), []
    layers = [own, *[x.digests for x in levels]]
    for k, (tree, pos) in enumerate(zip(rows.column("tree").to_pylist(), rows.column("pos").to_pylist())):
        steps, at = [], k
        for below, level in zip(layers, levels):
            run = list(range(at // ARITY * ARITY, min(len(below), at // ARITY * ARITY + ARITY)))
            state = level.states[at // ARITY, at % ARITY].astype(">u4").tobytes()
            steps.append({"place": at % ARITY, "state": state, "siblings": below[[x for x in run if x != at]].astype(">u4").tobytes()})
            at //= ARITY
        out.append({"tree": tree, "pos": pos, "steps": steps + block["steps"]})
    return pa.Table.from_pylist(out, _PATH)


def _suffixes(layer: np.ndarray, above: list[bytes]) -> list[bytes]:
    """Siblings' digests as text of every node of a layer, followed by those of its parent."""
    text = hex_words(layer).astype(">u4").tobytes()
    out = []
    for k in range(len(layer)):
        first = k // ARITY * ARITY
        last = min(len(layer), first + ARITY)
        out.append(text[64 * first : 64 * k] + text[64 * (k + 1) : 64 * last] + above[k // ARITY])
    return out


def _verified(rows: pa.Table, above: pa.Table) -> pa.Table:
    """All leaves of a block folded to the root, with their proofs."""
    rows, block = _sorted(rows), above.to_pylist()[0]
    own, now, levels = _to_words(_column(rows, "digest")), _to_words(_column(rows, "replacement")), _levels(block)
    layers, at = [own, *[x.digests for x in levels]], np.arange(len(own))
    for below, level in zip(layers, levels):
        now, at = fold(now, at, below, level), at // ARITY
    proof = b""
    for step in block["steps"]:
        siblings = np.frombuffer(step["siblings"], ">u4").astype(np.uint32).reshape(-1, 8)
        text = hex_words(siblings)
        proof += text.astype(">u4").tobytes()
        state = np.tile(np.frombuffer(step["state"], ">u4").astype(np.uint32), (len(now), 1))
        state = resume(state, hex_words(now))
        for right in text[step["place"] :]:
            state = resume(state, np.tile(right, (len(now), 1)))
        now = finish(state, np.full(len(now), len(siblings) + 1))
    suffixes = [proof]
    for layer in reversed(layers[:-1]):
        suffixes = _suffixes(layer, suffixes)
    texts = lambda words: pa.array([x.hex() for x in _to_bytes(words)], pa.string())
    same = lambda c: pa.array([block[c].hex()] * len(own), pa.string())
    proofs = pa.array([hashlib.sha256(x).hexdigest() for x in suffixes], pa.string())
    return pa.Table.from_arrays(
        [_column(rows, "id"), texts(own), same("subroot"), same("root"), proofs, texts(now)], ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
    )


# -- the manifest ------------------------------------------------------------


class Manifest:
    """Written nodes of a dataset: leaves in place, and blocks of what parents keep."""

    def __init__(self, leaves: DataFrame, space: Workspace) -> None:
        self.space, self.leaves = space, leaves
        self.stages: list[DataFrame] = []  # the nodes that blocks are made of
        self.blocks: list[DataFrame] = []  # the blocks of each stage
        nodes = self._climb(leaves.select("tree", "size", "pos", "digest"), "group")
        self.groups = len(self.blocks)
        self.subroots = nodes.select("tree", "digest")
        trees = self.subroots.count()
        top = nodes.select(F.lit(0).cast("bigint").alias("tree"), F.lit(trees).cast("bigint").alias("size"), F.col("tree").alias("pos"), "digest")
        self.top = self._climb(top, "top")

    def _climb(self, nodes: DataFrame, name: str) -> DataFrame:
        """Blocks upon blocks until every tree has one node; at least one stage."""
        while True:
            blocks = nodes.groupBy("tree", F.floor(F.col("pos") / BLOCK).alias("block")).applyInArrow(_block_root, _BLOCK_DDL)
            blocks = self.space.cut(blocks, f"{name}-blocks")
            self.stages.append(nodes)
            self.blocks.append(blocks)
            nodes = blocks.select("tree", "size", "pos", "digest")
            if (nodes.agg(F.max("size")).first()[0] or 1) == 1:
                return nodes

    def root(self) -> str | None:
        """The digest of the whole dataset; None if it has no rows."""
        row = self.top.select(F.lower(F.hex("digest"))).first()
        return row[0] if row else None

    def _below(self, stage: int, paths: DataFrame) -> DataFrame:
        """Blocks of a stage with the path above their root."""
        return self.blocks[stage].drop("size", "digest").join(paths, ["tree", "pos"])

    def _cogroup(self, nodes: DataFrame, blocks: DataFrame, run, ddl: str) -> DataFrame:
        block = F.floor(F.col("pos") / BLOCK).alias("block")
        return nodes.groupBy("tree", block).cogroup(blocks.groupBy("tree", F.col("pos").alias("block"))).applyInArrow(run, ddl)

    def verified(self) -> DataFrame:
        """Every leaf with the roots above it, its proof, and the root that its replacement folds to.

        Columns are id, leaf, subroot, root, proof_sha256 (of all siblings' digests on the
        way to the root), folded_root, and verified: whether that is the root.
        """
        steps = F.array().cast(_STEPS_DDL).alias("steps")
        paths = self.top.select("tree", "pos", steps)
        for stage in reversed(range(self.groups, len(self.blocks))):
            paths = self._cogroup(self.stages[stage], self._below(stage, paths), _paths, f"tree bigint, pos bigint, steps {_STEPS_DDL}")
            paths = self.space.cut(paths, "paths")
        # A place in the top tree is a group; its path goes on in the group's own tree.
        root = self.top.select(F.col("digest").alias("root"))
        paths = paths.select(F.col("pos").alias("tree"), F.lit(0).cast("bigint").alias("pos"), "steps")
        ends = self.subroots.withColumnRenamed("digest", "subroot").crossJoin(F.broadcast(root))  # one row
        for stage in reversed(range(1, self.groups)):
            paths = self._cogroup(self.stages[stage], self._below(stage, paths), _paths, f"tree bigint, pos bigint, steps {_STEPS_DDL}")
            paths = self.space.cut(paths, "paths")
        schema = f"id {self.leaves.schema['id'].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
        found = self._cogroup(self.leaves, self._below(0, paths).join(ends, "tree"), _verified, schema)
        return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def build(
    docs: DataFrame, fields: Sequence[str], key: str = "doc_id", group: str = "lang", replacement: Column | None = None, range_rows: int = RANGE_ROWS
) -> Manifest:
    """The manifest of ``docs``: a leaf for each row, over its ``fields`` in that order.

    ``group`` names the column whose values have trees of their own, ordered by UTF-8
    bytes with null first; inside, rows ascend by ``key`` (null first), equal keys by
    their digest. ``replacement`` is a digest (hexadecimal) to fold in a leaf's place, its own by default.
    Null fields differ from empty ones. Equal rows are leaves each. A dataset without rows
    has no root. Other columns are not read.
    """
    spark, space = docs.sparkSession, Workspace(docs.sparkSession, "manifest")
    own = digest([F.col(f"`{c}`") for c in fields])
    name = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("id"), name.alias("name"), own.alias("_own"), (replacement if replacement is not None else F.lit(None)).alias("_new"))
    rows = space.cut(rows.select("id", "name", F.unhex("_own").alias("digest"), F.unhex(F.coalesce("_new", "_own")).alias("replacement")), "leaves")
    n = rows.count()
    parts = max(1, -(-n // range_rows), min(RANGES, n // BLOCK))
    order = ["name", "id", "digest", "replacement"]
    nth = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = space.cut(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("part"), nth.alias("nth")), "ranged")
    # One row for each group of each part: no group is a single task's rows.
    runs = ranged.groupBy("name", "part").agg(F.count("*").alias("n"), F.min("nth").alias("first"))
    whole = Window.partitionBy("name")
    before = F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = space.cut(runs.select("name", "part", "first", before.alias("before"), F.sum("n").over(whole).alias("size")), "runs")
    names = runs.select("name").distinct()
    number = dense_id(names, ["name"], space, max(1, -(-names.count() // range_rows)), "tree").select("name", (F.col("tree") - 1).alias("tree"))
    placed = ranged.join(runs.join(number, "name"), ["name", "part"])
    pos = F.col("before") + F.col("nth") - F.col("first")
    return Manifest(space.cut(placed.select("tree", "size", pos.alias("pos"), "id", "digest", "replacement"), "placed"), space)
