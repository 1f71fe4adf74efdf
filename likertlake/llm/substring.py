"""Exact removal of repeated word windows, found by fixed-block anchors.

A window of ``window`` words occurs twice only if a block of ``block`` words on the
grid of one occurrence (every ``block`` words from the start of its text) occurs
somewhere else too. So the non-overlapping blocks of all texts are the index, and the
rolling block at every position probes it. Windows around a hit are the candidates
(a repeat of any length is a run of them). Of those alone a 96-bit digest is taken over
their words as they are written, and equal digests decide: the short hashes of the
probes only choose what is looked at. What the decision covers is a maximal exact repeat.

Volume is what matters here, for there is a probe for every word. Texts travel in
compressed chunks, and the hashes of a chunk as sorted distinct values, cut to the
bits that the corpus needs and dealt to parts by value: a few bytes for each probe, one
for each chunk however often it repeats there. Parts answer with a bit for each value.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from likertlake.llm import words as W
from likertlake.session import Workspace

WINDOW, BLOCK = 35, 18
CHUNK_BYTES = 1 << 20
#: Of zstd. Chunks are written once and shuffled twice, so bytes matter more than time.
LEVEL = 6
#: Hashes that one part compares.
PART_HASHES = 2_000_000
#: Bytes of a digest beyond the first eight.
REST = 4
#: Bits beyond those of the index's size; a probe hits by chance once in 2**14 times.
SPARE_BITS = 14


def pack(batches: Iterator[pa.RecordBatch], text: str, chunk_bytes: int, letters: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of many texts as few rows: chunk id, number of words, compressed rows."""
    base, n = TaskContext.get().partitionId() << 32, 0
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", LEVEL))
    for batch in batches:
        data, offsets = W.column(batch.column(text))
        for i, part, at in W.slices(data, offsets, chunk_bytes):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
                out.write_batch(batch.slice(i, len(at) - 1))
            size = len(W.split(part, at, letters).starts)
            yield pa.record_batch({"chunk": [base + n], "size": [size], "blob": pa.array([sink.getvalue().to_pybytes()], pa.binary())})
            n += 1


class Chunk:
    """The words of a chunk and the distinct hashes of its windows."""

    def __init__(self, blob: bytes, text: str, tables: tuple[W.Powers, W.Powers], letters: np.ndarray) -> None:
        self.rows = pa.ipc.open_stream(blob).read_all().combine_chunks()
        data, offsets = W.column(self.rows.column(text))
        self.words, self.tables, self.letters = W.split(data, offsets, letters), tables, letters
        self.prefix = W.window_prefix(W.word_hashes(self.words, tables[0]), tables[1])

    def hashes(self, k: int, drop: int, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Starts of windows, of ``k`` words each, and their hashes without low bits."""
        at = np.flatnonzero(W.inside(self.words, k)) if at is None else at
        return at, W.window_hashes(self.prefix, k, self.tables[1], at) >> np.uint64(drop)


    def digests(self, k: int, at: np.ndarray) -> np.ndarray:
        """BLAKE2b of the words of the windows that start at ``at``, a blank between two: numbers of 8 and 4 bytes.

        Words hold no blank, so windows have equal texts if and only if they have equal words.
        """
        if not len(at):
            return np.zeros((0, 2), np.uint64)
        w = self.words
        first = np.r_[0, np.cumsum(w.ends - w.starts + 1)]
        plain, inside = np.full(first[-1], 32, np.uint8), np.ones(first[-1], bool)
        inside[first[1:] - 1] = False
        plain[inside] = w.data[self.letters[w.data]]
        text = memoryview(plain.tobytes())
        found = b"".join([blake2b(text[a:b], digest_size=8 + REST).digest() for a, b in zip(first[at].tolist(), (first[at + k] - 1).tolist())])
        parts = np.frombuffer(found, np.dtype([("first", "<u8"), ("rest", f"<u{REST}")]))
        return np.stack([parts["first"], parts["rest"].astype(np.uint64)], 1)


def distinct(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct digests in order of the first number, then the second; where each one given is among them; how often they occur."""
    order = np.lexsort((digests[:, 1], digests[:, 0]))
    own = digests[order]
    new = np.r_[True, (own[1:] != own[:-1]).any(1)][: len(own)]
    back = np.empty(len(own), np.int64)
    back[order] = np.cumsum(new) - 1
    return own[new], back, np.bincount(back, minlength=int(new.sum()))


def planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of sorted values, byte by byte: slow ones compress."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplanes(data: bytes, width: int) -> np.ndarray:
    cols = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((cols.shape[1], 8), np.uint8)
    out[:, :width] = cols.T
    return out.reshape(-1).view("<u8")


def bounds(values: np.ndarray, parts: int, width: int) -> np.ndarray:
    """Where the values of each part begin in sorted values of ``width`` bytes."""
    edges = np.array([(p << (8 * width)) // parts for p in range(parts)], np.uint64)
    return np.r_[np.searchsorted(values, edges), len(values)]


PROBES = "part int, chunk bigint, hashes binary, flags binary"
REPLIES = "part int, chunk bigint, bits binary"


def probes(chunk: int, values: np.ndarray, flags: tuple[np.ndarray, ...], parts: int, width: int, rest: np.ndarray | None = None) -> pa.RecordBatch:
    """Sorted distinct values with their flags, a row for each part that gets any; ``rest`` is the second number of digests."""
    at = bounds(values, parts, width)
    own = np.flatnonzero(np.diff(at))
    tail = lambda p: b"" if rest is None else planes(rest[at[p] : at[p + 1]], REST)
    return pa.record_batch(
        {
            "part": pa.array(own, pa.int32()),
            "chunk": pa.array([chunk] * len(own), pa.int64()),
            "hashes": pa.array([planes(values[at[p] : at[p + 1]], width) + tail(p) for p in own], pa.binary()),
            "flags": pa.array([b"".join(np.packbits(f[at[p] : at[p + 1]]).tobytes() for f in flags) for p in own], pa.binary()),
        }
    )


def compare(rows: pa.Table, width: int, indexed: bool) -> pa.Table:
    """For each chunk's values of a part, whether they occur twice (and are indexed).

    Without an index the values are digests of two numbers, both of which count.
    """
    packed = [b.as_py() for b in rows.column("hashes")]
    rest = None
    if not indexed:
        cut = [len(b) // (width + REST) * width for b in packed]
        rest = np.concatenate([unplanes(b[c:], REST) for b, c in zip(packed, cut)])
        packed = [b[:c] for b, c in zip(packed, cut)]
    values = [unplanes(b, width) for b in packed]
    flags = []
    for v, f in zip(values, rows.column("flags")):
        bits = np.frombuffer(f.as_py(), np.uint8).reshape(1 + indexed, -1)
        flags.append(np.unpackbits(bits, axis=1, count=len(v)).astype(bool))
    every, flag = np.concatenate(values), np.concatenate(flags, axis=1)
    order = np.argsort(every, kind="stable") if rest is None else np.lexsort((rest, every))
    new = every[order][1:] != every[order][:-1]
    if rest is not None:
        new |= rest[order][1:] != rest[order][:-1]
    first = np.flatnonzero(np.r_[True, new])
    many = (np.diff(np.r_[first, len(every)]) > 1) | np.logical_or.reduceat(flag[0][order], first)
    if indexed:
        many &= np.logical_or.reduceat(flag[1][order], first)
    hot = np.zeros(len(every), bool)
    hot[order] = np.repeat(many, np.diff(np.r_[first, len(every)]))
    cuts = np.split(hot, np.cumsum([len(v) for v in values])[:-1])
    keep = [k for k, c in enumerate(cuts) if c.any()]
    own = rows.select(["part", "chunk"]).take(pa.array(keep, pa.int64()))
    return own.append_column("bits", pa.array([np.packbits(cuts[k]).tobytes() for k in keep], pa.binary()))


def answered(values: np.ndarray, replies: list[dict] | None, parts: int, width: int) -> np.ndarray:
    """The replies put back over the sorted distinct values of a chunk."""
    hot = np.zeros(len(values), bool)
    if replies:
        at = bounds(values, parts, width)
        for r in replies:
            a, b = at[r["part"]], at[r["part"] + 1]
            hot[a:b] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=b - a).astype(bool)
    return hot


def repeats(
    docs: DataFrame, text: str = "text", window: int = WINDOW, block: int = BLOCK, to: str = "repeats",
    chunk_bytes: int = CHUNK_BYTES, part_hashes: int = PART_HASHES,
) -> DataFrame:
    """``docs`` with a struct column ``to``: words, removed words, text of the words kept.

    Words are runs of other than ASCII white space. A word goes if it lies in a window
    of ``window`` words whose sequence also starts at any other place, in any text or
    the same one. All occurrences go, and windows are judged on the texts as given. Kept
    words are joined by one blank. A null or empty text, or one shorter than the window,
    has nothing to remove. Equal rows are separate texts. A column ``to`` of ``docs`` is
    replaced; ids and other columns are carried along and may be null or repeated.
    ``block`` may be at most half of ``window`` and a half.
    """
    if 2 * block - 1 > window:
        raise ValueError("a window must hold a whole block at any offset")
    spark, letters = docs.sparkSession, W.NOT_BLANK
    docs = docs.select(*[f"`{c}`" for c in docs.columns if c != to])
    space = Workspace(spark, "substring")
    chunks = space.cut(docs.mapInArrow(lambda it: pack(it, text, chunk_bytes, letters), "chunk bigint, size bigint, blob binary"), "chunks")
    total = chunks.agg(F.sum("size")).first()[0] or 0
    parts = max(1, -(-total // part_hashes))
    width = min(8, math.ceil((math.log2(total / block + 2) + SPARE_BITS) / 8))
    drop = 64 - 8 * width

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = W.powers()
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("blob")):
                c = Chunk(blob.as_py(), text, tables, letters)
                at, h = c.hashes(block, drop)
                values, n = np.unique(h, return_counts=True)
                grid = (at - c.words.first[c.words.doc[at]]) % block == 0
                yield probes(chunk, values, (n > 1, W.listed(values, np.unique(h[grid]))), parts, width)

    hits = chunks.select("chunk", "blob").mapInArrow(probe, PROBES).groupBy("part").applyInArrow(lambda t: compare(t, width, True), REPLIES)
    mine = lambda replies: replies.groupBy("chunk").agg(F.collect_list(F.struct("part", "bits")).alias("replies"))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = W.powers()
        for batch in batches:
            for chunk, blob, replies in zip(batch.column("chunk").to_pylist(), batch.column("blob"), batch.column("replies")):
                c = Chunk(blob.as_py(), text, tables, letters)
                at, h = c.hashes(block, drop)
                values, back = np.unique(h, return_inverse=True)
                hit = at[answered(values, replies.as_py(), parts, width)[back]]
                fits = W.inside(c.words, window)
                reach = window - block
                near = W.spread(np.maximum(hit - reach, 0), np.minimum(hit, reach) + 1, len(c.words.doc))[: len(fits)] & fits
                values, _, n = distinct(c.digests(window, np.flatnonzero(near)))
                yield probes(chunk, values[:, 0], (n > 1,), parts, 8, values[:, 1])
                yield pa.record_batch({"part": pa.array([-1], pa.int32()), "chunk": pa.array([chunk], pa.int64()), "hashes": pa.array([np.packbits(near).tobytes()], pa.binary()), "flags": pa.array([b""], pa.binary())})

    # Only chunks with a hit have candidates. Their digests have gone once they are compared, for
    # the chunks then travel again: what is kept are the bits of the answers and of the places.
    held = space.inner("held")
    found = held.cut(chunks.select("chunk", "blob").join(mine(hits), "chunk").mapInArrow(candidates, PROBES), "candidates")
    again = space.cut(found.where("part >= 0").groupBy("part").applyInArrow(lambda t: compare(t, 8, False), REPLIES), "again")
    near = space.cut(found.where("part < 0").select("chunk", F.col("hashes").alias("near")), "near")
    held.drop()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = W.powers()
        for batch in batches:
            for blob, near, replies in zip(batch.column("blob"), batch.column("near"), batch.column("replies")):
                c = Chunk(blob.as_py(), text, tables, letters)
                w, gone = c.words, np.zeros(len(c.words.doc), bool)
                if replies.is_valid:
                    n = max(0, len(w.doc) - window + 1)
                    at = np.flatnonzero(np.unpackbits(np.frombuffer(near.as_py(), np.uint8), count=n))
                    values, back, _ = distinct(c.digests(window, at))
                    gone = W.spread(at[answered(values[:, 0], replies.as_py(), parts, 8)[back]], window, len(w.doc))
                yield from _kept(c.rows, text, w, gone, to)

    out = T.StructType([*docs.schema.fields, T.StructField(to, T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]))])
    return chunks.select("chunk", "blob").join(near, "chunk", "left").join(mine(again), "chunk", "left").select("blob", "near", "replies").mapInArrow(remove, out)


def _kept(rows: pa.Table, text: str, w: W.Words, gone: np.ndarray, to: str) -> Iterator[pa.RecordBatch]:
    sums = np.r_[0, np.cumsum(gone)]
    removed = sums[w.first[1:]] - sums[w.first[:-1]]
    kept = []
    for value, a, b, n in zip(rows.column(text), w.first[:-1], w.first[1:], removed):
        own = value.as_buffer().to_pybytes().split() if value.is_valid else []
        if n:
            own = [x for x, g in zip(own, gone[a:b].tolist()) if not g]
        kept.append(b" ".join(own))
    result = pa.StructArray.from_arrays([pa.array(np.diff(w.first), pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["n_words", "n_removed", "kept"])
    yield from rows.append_column(to, result).to_batches()
