"""Near-duplicate classes by consistent weighted sampling over TF-IDF word shingles.

A document is the weighted set of its ``size``-word shingles. Improved consistent
weighted sampling draws from it samples that two documents share with a probability
equal to their weighted Jaccard similarity; bands of samples make the buckets. In a
bucket all texts are compared with a few heads, and what is still in different classes
then is compared with more in further rounds. There a text counts only with the shingles that
others left have too, so that pairs which cannot be similar enough are told from a few sums.
The samples rule out most pairs of the rest, and the weighted Jaccard similarity of the whole
texts decides. Equal texts are one node.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from likertlake.llm import words as W
from likertlake.llm.graph import components
from likertlake.llm.share import column_udf, give_back, share, tidy
from likertlake.session import Workspace

SIZE, SIMILARITY = 5, 0.8
#: 0.8 ** 4 a band: a pair at the threshold is missed once in 4,500 times, one at 0.9 once in 26 million.
#: With fewer samples in a band, texts that share little more than a site's lines meet too often.
BANDS, ROWS = 16, 4
#: Cells of the table of document frequencies; shingles share them by hash.
CELLS, CELL_BLOCK = 1 << 20, 1 << 15
#: Tables of tasks that are added up at once, and how often before the last time: 64 ** 3 tasks make 64 at most.
ADDED, ADDED_TIMES = 64, 2
#: How much more a shingle of one text weighs than one of all texts. What copies share is
#: less rare than what tells them apart, so with more the threshold would ask for more.
STRENGTH = 0.25
#: Heads of a bucket in the first round, how many times more in the second, and in each one after it. By then
#: texts that link with many are in their class, and the shared weights rule out most pairs of the others.
LEADERS, MORE_LEADERS, MORE_THEN = 4, 8, 64
#: Classes of shingles, by hash, whose shared weights bound what two texts have in common.
PARTS = 64
#: Sums of the same weights in another order differ by less.
ROUNDING = 1 + 1e-9


def shingles(w: W.Words, size: int, tables: tuple[W.Powers, W.Powers]) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every shingle; a text of fewer words is one shingle."""
    prefix = W.window_prefix(W.word_hashes(w, tables[0]), tables[1])
    at = np.flatnonzero(W.inside(w, size))
    docs, hashes = [w.doc[at]], [W.window_hashes(prefix, size, tables[1], at)]
    counts = np.diff(w.first)
    for k in range(1, size):
        short = np.flatnonzero(counts == k)
        docs.append(short)
        hashes.append(W.window_hashes(prefix, k, tables[1], w.first[short]))
    return np.concatenate(docs), np.concatenate(hashes)


def counted(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text in order of text and hash, with their counts."""
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.zeros(0, np.int64)
    return doc[new], h[new], np.diff(np.r_[new, len(h)])


class Weights:
    """Term frequency times inverse document frequency, the latter from 1 to 1 + ``STRENGTH``."""

    def __init__(self, frequency: np.ndarray, docs: int) -> None:
        share = np.log((docs + 1) / (np.minimum(frequency, docs) + 1)) / max(1.0, math.log(docs + 1))
        self.idf = (1 + STRENGTH * share).astype(np.float32)

    def __call__(self, h: np.ndarray, n: np.ndarray) -> np.ndarray:
        return n * self.idf[(h >> np.uint64(40)).astype(np.int64) % len(self.idf)]


def samples(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts that have shingles, and ``n`` consistent samples of each as 32-bit hashes.

    For each shingle and sample, r and c are Gamma(2, 1) and beta uniform, drawn from
    the shingle's hash; t = floor(ln w / r + beta), and the shingle of the least
    c / exp(r (t - beta + 1)) is sampled together with its t.
    """
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    size = np.diff(np.r_[first, len(doc)])
    log_w = np.log(weight.astype(np.float32))
    out = np.empty((len(first), n), np.uint32)
    unit, low = np.float32(2.0**-21), np.uint64((1 << 21) - 1)
    for k, seed in enumerate(W.seeds(n, 1 << 32)):
        x = (h + seed) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x94D049BB133111EB)
        y = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
        u = lambda bits, shift: ((bits >> np.uint64(shift)) & low).astype(np.float32) * unit + unit / 2
        r = -np.log(u(x, 43) * u(x, 22))
        c = -np.log(u(y, 43) * u(y, 22))
        beta = u(x ^ y, 1)
        t = np.floor(log_w / r + beta)
        score = np.log(c) - r * (t - beta + np.float32(1))
        least = np.minimum.reduceat(score, first)
        at = np.flatnonzero(score == np.repeat(least, size))
        at = at[np.searchsorted(at, first)]
        out[:, k] = W.mix(h[at] + t[at].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    return doc[first], out


def band_keys(sample: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit bucket for each band."""
    rows = sample.reshape(len(sample), bands, -1).astype(np.uint64)
    key = np.broadcast_to(W.seeds(bands, 1 << 33), rows.shape[:2])
    for k in range(rows.shape[2]):
        key = W.mix(key + rows[:, :, k])
    return key


def weighted_jaccard(a: pa.Array, b: pa.Array, weights: Weights, size: int) -> np.ndarray:
    """Weighted Jaccard similarity of the texts of two columns, row by row."""
    out = np.zeros(len(a))
    tables = W.powers()
    sizes = [pc.binary_length(x).fill_null(0).to_numpy(zero_copy_only=False) for x in (a, b)]
    ends = np.r_[0, np.cumsum(sizes[0] + sizes[1], dtype=np.int64)]
    i = 0
    while i < len(a):  # a few whole pairs at a time, or one of long texts
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + W.SLICE, "right")) - 1)
        # Texts of the first column, then those of the second.
        data, offsets = W.column(pa.concat_arrays([a.slice(i, j - i), b.slice(i, j - i)]))
        doc, h, n = counted(*shingles(W.split(data, offsets, W.NOT_BLANK), size, tables))
        weight, row = weights(h, n).astype(np.float64), doc % (j - i)
        key = W.mix(h + W.seeds(j - i, 1 << 34)[row])
        order = np.argsort(key, kind="stable")
        same = np.flatnonzero(key[order][1:] == key[order][:-1])
        both = np.minimum(weight[order][same], weight[order][same + 1])
        shared, total = np.bincount(row[order][same], both, j - i), np.bincount(row, weight, j - i)
        out[i:j] = np.divide(shared, total - shared, out=np.zeros(j - i), where=total > shared)
        i = j
    return out


def shared_weights(texts: pa.Array, alone: pa.Array, weights: Weights, size: int) -> pa.Array:
    """Weight of each text, that of its shingles not listed in ``alone``, and the latter by class.

    ``alone`` holds shingles of one text each, so all lists of a batch are one. Weights of
    classes are rounded up: the sum of the lesser ones of two texts is no less than what they share.
    """
    tables, whole, parts = W.powers(), np.zeros(len(texts)), np.zeros((len(texts), PARTS))
    none = np.sort(alone.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
    data, offsets = W.column(texts)
    for i, part, at in W.slices(data, offsets):
        doc, h, n = counted(*shingles(W.split(part, at, W.NOT_BLANK), size, tables))
        weight, row = weights(h, n).astype(np.float64), doc + i
        whole += np.bincount(row, weight, len(texts))
        met = ~W.listed(h, none)
        cell = row[met] * PARTS + ((h[met] >> np.uint64(20)) % np.uint64(PARTS)).astype(np.int64)
        parts += np.bincount(cell, weight[met], parts.size).reshape(parts.shape)
    up = parts.astype(np.float32)
    up = np.where(up < parts, np.nextafter(up, np.float32(np.inf)), up)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * PARTS, pa.int32()), pa.array(up.ravel()))
    return pa.StructArray.from_arrays([pa.array(whole), pa.array(parts.sum(1)), lists], ["weight", "shared", "parts"])


def frequencies(docs: DataFrame, text: str, size: int, cells: int) -> tuple[np.ndarray, int]:
    """In how many texts some shingle of each cell occurs, and the number of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, total, n = W.powers(), np.zeros(cells, np.int64), 0
        for batch in batches:
            data, offsets = W.column(batch.column(0))
            n += batch.num_rows
            for _, part, at in W.slices(data, offsets):
                doc, h = shingles(W.split(part, at, W.NOT_BLANK), size, tables)
                pair = np.unique(doc.astype(np.int64) * cells + (h >> np.uint64(40)).astype(np.int64) % cells)
                np.add.at(total, pair % cells, 1)
        part = pa.array([TaskContext.get().partitionId()], pa.int64())
        for k in range(-1, -(-cells // CELL_BLOCK)):  # a block at a time, so that the table is not there twice
            x = total[k * CELL_BLOCK : (k + 1) * CELL_BLOCK] if k >= 0 else np.array([n])
            if k < 0 or x.any():
                yield pa.record_batch({"k": pa.array([k], pa.int32()), "part": part, "n": pa.array([x.astype("<i8").tobytes()], pa.binary())})

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), "<i8") for x in group.column("n"))
        part = pa.array([group.column("part")[0].as_py() // ADDED], pa.int64())
        give_back(cycles=False)  # what the groups before held
        return pa.table({"k": group.column("k").slice(0, 1), "part": part, "n": pa.array([total.astype("<i8").tobytes()], pa.binary())})

    kind = "k int, part bigint, n binary"
    sums = docs.select(f"`{text}`").mapInArrow(tidy(count), kind)
    for _ in range(ADDED_TIMES):  # sums of a few tasks, of a few of those, then of what is left
        sums = sums.groupBy("k", F.floor(F.col("part") / ADDED).alias("next")).applyInArrow(add, kind)
    rows = sums.groupBy("k").applyInArrow(add, kind).select("k", "n").collect()  # bounded by the cells
    out, n = np.zeros(cells, np.int64), 0
    for k, x in rows:
        if k < 0:
            n = int(np.frombuffer(x, "<i8")[0])
        else:
            out[k * CELL_BLOCK : k * CELL_BLOCK + len(x) // 8] = np.frombuffer(x, "<i8")
    return out, n


def node_of(text: Column) -> Column:
    """Digest that equal texts share."""
    return F.unhex(F.md5(text))


def classes(
    docs: DataFrame, text: str = "text", id: str = "doc_id", size: int = SIZE, similarity: float = SIMILARITY,
    bands: int = BANDS, rows: int = ROWS, cells: int = CELLS, leaders: int = LEADERS,
) -> tuple[DataFrame, DataFrame]:
    """Nodes with their classes, and links between different texts.

    Nodes: ``node`` (a digest of the text), ``n`` rows of that text, ``id`` (the least),
    ``class_node`` and ``class_id`` (of the class's least id). Links: ``a``, ``b``,
    ``similarity``; enough to connect the classes, not all pairs inside them. Texts without
    words link with nothing, but equal ones are one node; rows with a null text are in none.
    """
    spark = docs.sparkSession
    space = Workspace(spark, "neardup")
    base = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")).where("text is not null")
    node = node_of(F.col("text")).alias("node")
    frequency, n_docs = frequencies(base, "text", size, cells)
    weights = share(spark, Weights(frequency, n_docs))

    def sample(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables, weight = W.powers(), weights()
        for batch in batches:
            data, offsets = W.column(batch)
            found: list[bytes | None] = [None] * len(batch)
            for i, part, at in W.slices(data, offsets):
                doc, h, n = counted(*shingles(W.split(part, at, W.NOT_BLANK), size, tables))
                if len(doc):
                    for d, s in zip(*samples(doc, h, weight(h, n), bands * rows)):
                        found[i + d] = s.tobytes()
            yield pa.array(found, pa.binary())

    def keys(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            s = np.frombuffer(b"".join(batch.to_pylist()), np.uint32).reshape(len(batch), -1)
            k = band_keys(s, bands).view(np.int64)
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * bands, pa.int32()), pa.array(k.ravel()))

    def agree(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            s = np.frombuffer(b"".join(batch.to_pylist()), np.uint32).reshape(len(batch), 2, -1)
            yield pa.array((s[:, 0] == s[:, 1]).mean(1))

    def similar(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weight = weights()
        for batch in batches:
            yield pa.array(weighted_jaccard(batch.field(0), batch.field(1), weight, size))

    def with_ends(pairs: DataFrame, texts: DataFrame, *columns: str) -> DataFrame:
        for end in ("a", "b"):
            pairs = pairs.join(texts.select(F.col("node").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns]), end)
        return pairs

    def agreeing(pairs: DataFrame) -> DataFrame:
        return pairs.where(column_udf(agree, "double")(F.concat("s_a", "s_b")) >= sure)

    def hashes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = W.powers()
        for batch in batches:
            data, offsets = W.column(batch)
            found, sizes = [], []
            for _, part, at in W.slices(data, offsets):
                doc, h, _ = counted(*shingles(W.split(part, at, W.NOT_BLANK), size, tables))
                found.append(h.view(np.int64))
                sizes.append(np.bincount(doc, minlength=len(at) - 1))
            ends = np.r_[0, np.cumsum(np.concatenate(sizes))] if sizes else np.zeros(1)
            flat = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))

    def shared(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weight = weights()
        for batch in batches:
            yield shared_weights(batch.field(0), batch.field(1), weight, size)

    def marked(entries: DataFrame, texts: DataFrame) -> DataFrame:
        """Entries that may be similar to another of ``texts``, with what their text shares with the others."""
        each = texts.select("node", F.explode(column_udf(hashes, "array<bigint>")("text")).alias("h"))
        alone = each.groupBy("h").agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1")
        alone = alone.groupBy("node").agg(F.collect_list("h").alias("alone"))
        kind = "struct<weight:double,shared:double,parts:array<float>>"
        marks = texts.join(alone, "node", "left").select("node", column_udf(shared, kind)(F.struct("text", "alone")).alias("m"))
        marks = marks.select("node", "m.weight", "m.shared", "m.parts")
        return entries.join(marks, "node").where(F.col("shared") * ROUNDING >= similarity * F.col("weight"))

    texts = base.select("id", node, column_udf(sample, "binary")("text").alias("s"))
    nodes = space.cut(texts.groupBy("node").agg(F.count("*").alias("n"), F.min("id").alias("id"), F.first("s").alias("s")), "nodes")
    live = nodes.where("s is not null").select("node", F.explode(column_udf(keys, "array<bigint>")("s")).alias("bucket"))
    crowd = live.groupBy("bucket").count().where("count > 1").select("bucket")
    live = space.cut(live.join(crowd, "bucket"), "live")
    active = live.select("node").distinct()
    kept = base.select(node, "text").join(active, "node", "left_semi").dropDuplicates(["node"])
    kept = space.cut(kept.join(nodes.select("node", "s"), "node"), "texts")

    # The samples of a pair at the threshold agree less often than this once in 10**5 times or less.
    sure = similarity - 4.5 * math.sqrt(similarity * (1 - similarity) / (bands * rows))
    seen, root = None, None
    while True:
        entries = space.cut(_unfinished(live, root), "entries")
        if entries.isEmpty():
            break
        # Digests are in random order, so heads come from all classes of a bucket. Once it is known
        # what texts share, those with the least of their own come first, as they link with most.
        first, may, known = [F.col("node")], F.col("root") != F.col("head_root"), []
        if root is not None:
            kept = space.cut(kept.join(entries.select("node").distinct(), "node", "left_semi"), "texts")
            entries = space.cut(marked(entries, kept), "marked")
            first, known = [F.col("weight") - F.col("shared"), *first], ["weight", "shared", "parts"]
            # Similarity s asks for s / (1 + s) of both weights in common.
            most = similarity / (1 + similarity) * (F.col("weight") + F.col("head_weight"))
            in_parts = F.aggregate(F.zip_with("parts", "head_parts", lambda x, y: F.least(x, y)), F.lit(0.0), lambda x, y: x + y)
            may = may & (F.least("shared", "head_shared") * ROUNDING >= most) & (in_parts * ROUNDING >= most)
        order = Window.partitionBy("bucket").orderBy(*first)
        heads = entries.withColumn("r", F.row_number().over(order)).where(F.col("r") <= leaders)
        heads = heads.select(F.col("bucket").alias("own"), F.col("node").alias("head"), *[F.col(c).alias(f"head_{c}") for c in ["root", *known]])
        each = entries.join(heads, (F.col("bucket") == F.col("own")) & may)
        pairs = each.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()
        if seen is not None:
            pairs = pairs.join(seen.select("a", "b"), ["a", "b"], "left_anti")
        if root is None:
            pairs = agreeing(with_ends(pairs, kept, "s")).select("a", "b")
            pairs = with_ends(pairs, kept, "text")
        else:  # few are left, and are joined once
            pairs = agreeing(with_ends(pairs, kept, "s", "text"))
        pairs = space.cut(pairs.select("a", "b", column_udf(similar, "double")(F.struct("text_a", "text_b")).alias("similarity")), "pairs")
        seen = pairs if seen is None else seen.unionByName(pairs)
        links = pairs.where(F.col("similarity") >= similarity).select("a", "b")
        if root is None:
            root = components(links, space)
        elif not links.isEmpty():  # the stars of the rounds before stand for their links
            root = components(links.union(root.select("node", "root")), space)
        live = entries.join(heads.select(F.col("own").alias("bucket"), F.col("head").alias("node")), ["bucket", "node"], "left_anti").select("bucket", "node")
        leaders *= MORE_THEN if known else MORE_LEADERS
    if seen is None:
        seen = spark.createDataFrame([], "a binary, b binary, similarity double")
        root = spark.createDataFrame([], "node binary, root binary")
    return _classified(nodes, root, space), seen.where(F.col("similarity") >= similarity)


def _unfinished(live: DataFrame, root: DataFrame | None) -> DataFrame:
    """Entries of the buckets that still hold texts of different classes.

    ``root`` is an entry's class so far. Heads are compared with all entries of other
    classes and leave; a bucket is done when the rest is of one class. So no pair of
    different classes is left out but those whose shared weights rule it out, and pairs
    inside a class need no comparison.
    """
    own = live.withColumn("root", F.col("node")) if root is None else live.join(root, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    open_ = own.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    return own.join(open_.select("bucket"), "bucket")


def _classified(nodes: DataFrame, root: DataFrame, space: Workspace) -> DataFrame:
    full = nodes.select("node", "n", "id").join(root, "node", "left").select("node", "n", "id", F.coalesce("root", "node").alias("root"))
    full = space.cut(full, "classified")
    best = full.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("m"))
    return full.join(best, "root").select("node", "n", "id", F.col("m.node").alias("class_node"), F.col("m.id").alias("class_id"))


def deduplicated(docs: DataFrame, text: str = "text", id: str = "doc_id", **how) -> DataFrame:
    """One row of ``docs`` for each class: the one of the least id, all columns as given.

    Rows with a null text are in no class and all stay. Of equal rows one stays. Of rows
    with a null id one stays if no row of the class has an id.
    """
    found, _ = classes(docs, text, id, **how)
    best = found.where(F.col("node") == F.col("class_node")).select(F.col("node").alias("_node"), F.col("class_id").alias("_id"))
    rows = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row"), F.col(f"`{id}`").alias("_own"), node_of(F.col(f"`{text}`")).alias("_node"))
    first = rows.join(best, "_node").where(F.col("_own").eqNullSafe(F.col("_id"))).dropDuplicates(["_node"])
    kept = first.select("_row").unionByName(rows.where("_node is null").select("_row"))
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
