"""Benchmark decontamination by winnowing.

Every window of ``window`` words of a benchmark item has a fingerprint, the least hash
of its ``gram``-word grams. Texts that share a window share its fingerprint, so
matching fingerprints find every shared window; each match is then extended to the
window and compared word for word. An item shorter than the window is one window, and
is probed at every position. The benchmark is cut into blocks of bounded size, each
of which goes to the tasks as an index: the documents are never shuffled or broadcast.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from likertlake.llm import words as W
from likertlake.llm.share import column_udf, share
from likertlake.session import Workspace

WINDOW, GRAM = 13, 5
#: Bytes of benchmark text in one block, whose index is held by each task.
BLOCK_BYTES = 1 << 20


def _least(h: np.ndarray, n: int) -> np.ndarray:
    """Minimum of ``n`` neighbours at every start."""
    out, width = h, 1
    while width < n:
        step = min(width, n - width)
        out, width = np.minimum(out[: max(0, len(out) - step)], out[step:]), width + step
    return out


class Index:
    """Windows of benchmark texts by length, and the fingerprints of full windows."""

    def __init__(self, items: list[str], texts: list[str], window: int, gram: int) -> None:
        self.items, self.window, self.gram = items, window, gram
        tables = W.powers()
        data, offsets = W.column(pa.array(texts, pa.large_string()))
        w = W.split(W.LOWER[data], offsets, W.ALNUM)
        prefix = W.window_prefix(W.word_hashes(w, tables[0]), tables[1])
        counts = np.diff(w.first)
        self.text = [bytes(w.data[s:e]) for s, e in zip(w.starts, w.ends)]
        self.sizes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in sorted({min(window, int(n)) for n in counts if n}):
            fits = W.inside(w, size)
            own = counts[w.doc[: len(fits)]]
            at = np.flatnonzero(fits & (own >= window if size == window else own == size))
            h = W.window_hashes(prefix, size, tables[1], at)
            order = np.argsort(h, kind="stable")
            self.sizes[size] = (h[order], at[order], w.doc[at[order]])
        self.marks = np.zeros(0, np.uint64)
        if window in self.sizes:
            least = _least(W.window_hashes(prefix, gram, tables[1]), window - gram + 1)
            self.marks = np.unique(least[self.sizes[window][1]])

    def find(self, w: W.Words, tables: tuple[W.Powers, W.Powers]) -> Iterator[tuple[int, int, int]]:
        """Word position, length and item of every shared window."""
        prefix = W.window_prefix(W.word_hashes(w, tables[0]), tables[1])
        for size, (known, at, item) in self.sizes.items():
            fits = W.inside(w, size)
            if size == self.window:
                least = _least(W.window_hashes(prefix, self.gram, tables[1]), size - self.gram + 1)[: len(fits)]
                starts = np.flatnonzero(fits & W.listed(least, self.marks))
            else:
                starts = np.flatnonzero(fits)
            h = W.window_hashes(prefix, size, tables[1], starts)
            hit = W.listed(h, known)
            for p, x in zip(starts[hit].tolist(), h[hit]):
                own = [bytes(w.data[s:e]) for s, e in zip(w.starts[p : p + size], w.ends[p : p + size])]
                for k in range(int(np.searchsorted(known, x, "left")), int(np.searchsorted(known, x, "right"))):
                    if self.text[at[k] : at[k] + size] == own:
                        yield p, size, int(item[k])


_SPANS = "array<struct<s: bigint, e: bigint>>"
_RESULT = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))), ("items", pa.list_(pa.string()))])


def _scan(batches: Iterator[pa.Array], index: Index) -> Iterator[pa.Array]:
    tables = W.powers()
    for batch in batches:
        data, offsets = W.column(batch)
        out = []
        for _, part, at in W.slices(data, offsets):
            w = W.split(W.LOWER[part], at, W.ALNUM)
            found: dict[int, set] = defaultdict(set)
            starts, sizes = [], []
            for p, size, item in index.find(w, tables):
                starts.append(p)
                sizes.append(size)
                found[int(w.doc[p])].add(index.items[item])
            edges = np.zeros(0, np.int64)
            if starts:
                # A window never leaves its text, but those of neighbouring texts may touch.
                hit = W.spread(np.array(starts), np.array(sizes), len(w.doc))
                new = np.r_[True, w.doc[1:] != w.doc[:-1]]
                on = np.flatnonzero(hit & (new | ~np.r_[False, hit[:-1]]))
                off = np.flatnonzero(hit & (np.r_[new[1:], True] | ~np.r_[hit[1:], False])) + 1
                edges = np.stack([on, off], 1)
            spans: dict[int, list[dict]] = defaultdict(list)
            for s, e in edges.tolist() if len(edges) else ():
                d = int(w.doc[s])
                spans[d].append({"s": s - int(w.first[d]), "e": e - int(w.first[d])})
            for d in range(len(at) - 1):
                out.append({"n_words": int(w.first[d + 1] - w.first[d]), "spans": spans.get(d, []), "items": sorted(found.get(d, ()))})
        yield pa.array(out, _RESULT)


def _scanner(spark, index: Index):
    get = share(spark, index)
    return column_udf(lambda batches: _scan(batches, get()), f"struct<n_words bigint, spans {_SPANS}, items array<string>>")


def _covered() -> Column:
    """Positions inside the ``spans``, which may overlap after a merge of blocks."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("to"))
    return F.aggregate(
        F.array_sort("spans"),
        zero,
        lambda a, p: F.struct(
            (a["n"] + F.greatest(F.lit(0), p["e"] - F.greatest(a["to"], p["s"]))).alias("n"),
            F.greatest(a["to"], p["e"]).alias("to"),
        ),
    )["n"]


def contamination(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, gram: int = GRAM, block_bytes: int = BLOCK_BYTES, to: str = "found",
) -> DataFrame:
    """``docs`` with a struct column ``to``: words, hit words, spans of hit words, item ids.

    Words are lower-cased runs of ASCII letters, digits and characters beyond ASCII. A
    null or empty text has no words. Items without an id or without words match nothing,
    items of one id count once. A word is hit if any occurrence of a window covers it.
    The column ``to`` is replaced if ``docs`` has one; all other columns stay as they are.
    """
    spark = docs.sparkSession
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    blocks = _blocks(items, item_id, item_text, window, gram, block_bytes)
    if len(blocks) == 1:
        flat = rows.withColumn("_r", _scanner(spark, blocks[0]())("_text")).select("_row", F.col("_r.n_words").alias("n_words"), F.col("_r.spans").alias("spans"), F.col("_r.items").alias("items"))
    else:
        space = Workspace(spark, "decontam")
        key = F.sha2("_text", 256)
        words = Index([], [], window, gram)
        passes = []
        for make in blocks:
            part = rows.select("_text").withColumn("_r", _scanner(spark, make())("_text"))
            part = part.where(F.size("_r.spans") > 0).groupBy(key.alias("_k")).agg(F.first("_r.spans").alias("spans"), F.first("_r.items").alias("items"))
            passes.append(space.cut(part, "block"))
        hits = passes[0]
        for more in passes[1:]:
            hits = hits.unionByName(more)
        hits = hits.groupBy("_k").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        flat = rows.withColumn("_n", _scanner(spark, words)("_text")["n_words"]).withColumn("_k", key).join(hits, "_k", "left")
        empty = F.array().cast(_SPANS)
        flat = flat.select("_row", F.col("_n").alias("n_words"), F.coalesce("spans", empty).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    flat = flat.withColumn("n_hit", _covered()).select("_row", F.struct("n_words", "n_hit", "spans", "items").alias("_f"))
    return flat.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns if c != to], F.col("_f").alias(to))


def _blocks(items: DataFrame, item_id: str, text: str, window: int, gram: int, block_bytes: int) -> list:
    """One function for each block, which fetches it and builds its index.

    Blocks hold distinct pairs of item and text and at most ``block_bytes`` of text, or one
    longer text. They are cut from running totals in groups of about 16 blocks.
    """
    rows = items.where(F.col(f"`{item_id}`").isNotNull() & F.col(f"`{text}`").isNotNull()).select(F.col(f"`{item_id}`").cast("string").alias("item"), F.col(f"`{text}`").alias("text")).distinct()
    bytes_ = F.octet_length("text")
    size, longest = rows.agg(F.sum(bytes_), F.max(F.when(bytes_ <= block_bytes // 2, bytes_))).first()

    def make(block: DataFrame) -> Index:
        got = block.toArrow()
        return Index(got.column("item").to_pylist(), got.column("text").to_pylist(), window, gram)

    if (size or 0) <= block_bytes:
        return [lambda: make(rows.select("item", "text"))]
    # A block starts every ``step`` bytes and ends with the text that crosses the next start.
    step = max(1, block_bytes - (longest or 0))
    long = bytes_ > block_bytes // 2
    group = F.pmod(F.xxhash64("item", "text"), F.lit(max(1, size // (16 * block_bytes))))
    order = Window.partitionBy("long", "part").orderBy(F.xxhash64("text", "item"), "item", "text").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.when(F.col("long"), step).otherwise(bytes_)).over(order), F.lit(0))
    rows = rows.withColumn("long", long).withColumn("part", group).withColumn("block", F.floor(before / step))
    rows = Workspace(items.sparkSession, "decontam").cut(rows, "items")
    keys = rows.select("long", "part", "block").distinct().collect()  # one for each block
    return [lambda r=r: make(rows.where((F.col("long") == r.long) & (F.col("part") == r.part) & (F.col("block") == r.block)).select("item", "text")) for r in sorted(keys)]


def is_contaminated(found: Column) -> Column:
    """A document of which a twentieth or more is benchmark text."""
    return (found["n_hit"] > 0) & (20 * found["n_hit"] >= found["n_words"])
