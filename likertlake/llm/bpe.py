"""Byte-level BPE encoding of whole texts, and decoding.

A long text is cut into chunks that overlap. Chunks are split into pre-tokens in
parallel; a chunk may begin inside a pre-token, so its first boundaries can be wrong,
but from the first boundary that it shares with the chunk before, both agree. There the
chunks are stitched, and the pieces between the stitches are encoded in parallel.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from likertlake.llm import words as W
from likertlake.llm.share import column_udf, portions, share
from likertlake.session import Workspace

#: Characters of a chunk and of its overlap with the next. Shorter texts are one piece.
CHUNK, OVERLAP = 1 << 15, 1 << 11
#: Pre-tokens whose ids a worker keeps, the longest that it keeps, and characters encoded at once.
CACHE, CACHED_LENGTH, AT_ONCE = 200_000, 64, 1 << 19
#: A pre-token that ends this close to a cut could go on, or begin otherwise, beyond it.
MARGIN = 3
#: Pre-tokens beyond this many bytes are merged with a heap.
HEAP_FROM = 48


class Tokenizer:
    """Ranks, and the pattern that splits text before merges."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern = ranks, pattern
        self.pairs, self.joined = _pairs(ranks)
        self._prepare()

    def _prepare(self) -> None:
        self.cache: dict[str, bytes] = {}
        self.split, self.split_ascii = regex.compile(self.pattern).findall, _ascii_split(self.pattern)

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("ranks", "pattern", "pairs", "joined")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._prepare()

    def cuts(self, text: str) -> Iterator[tuple[int, int]]:
        return (m.span() for m in regex.finditer(self.pattern, text))

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens in turn."""
        plain = self.split_ascii and text.isascii() and not _SEPARATORS.search(text)
        return self.split_ascii(text) if plain else self.split(text)

    def packed(self, texts: list[str]) -> list[bytes]:
        """Token ids of the pre-tokens of each text in turn, four bytes each."""
        out, k = [], 0
        while k < len(texts):
            some, size = [], 0
            while k < len(texts) and (not some or size + len(texts[k]) <= AT_ONCE):
                some.append(self.pieces(texts[k]))
                size += len(texts[k])
                k += 1
            ids = self._known(set().union(*some)).__getitem__
            out += [b"".join(map(ids, x)) for x in some]
        return out

    def _known(self, wanted: set[str]) -> dict[str, bytes]:
        """A table with the ids of the wanted pre-tokens at least."""
        if len(self.cache) + len(wanted) > CACHE:  # the older half goes
            for p in list(islice(self.cache, len(self.cache) // 2)):
                del self.cache[p]
        new = sorted(wanted - self.cache.keys())
        if not new:
            return self.cache
        found = dict(zip(new, self._merged([p.encode() for p in new])))
        self.cache.update((p, x) for p, x in found.items() if len(p) <= CACHED_LENGTH)
        long = {p: x for p, x in found.items() if len(p) > CACHED_LENGTH}
        return {**self.cache, **long} if long else self.cache

    def _merged(self, pieces: list[bytes]) -> list[bytes]:
        whole = [self.ranks.get(p) for p in pieces]
        few = [k for k, p in enumerate(pieces) if whole[k] is None and len(p) <= HEAP_FROM]
        out = [b"" if r is None else _pack([r]) for r in whole]
        for k, ids in zip(few, merge_all([pieces[k] for k in few], self.ranks, self.pairs, self.joined)):
            out[k] = ids
        for k, p in enumerate(pieces):
            if whole[k] is None and len(p) > HEAP_FROM:
                out[k] = _pack(merge(p, self.ranks))
        return out

    def encode(self, text: str) -> list[int]:
        """Token ids of each pre-token in turn."""
        return np.frombuffer(self.packed([text])[0], np.int32).tolist()

    def vocabulary(self) -> tuple[np.ndarray, np.ndarray]:
        """All tokens' bytes in a row by id, and where each begins."""
        words = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            words[rank] = token
        return np.frombuffer(b"".join(words), np.uint8), np.r_[0, np.cumsum([len(x) for x in words])].astype(np.int64)


def load(spark: SparkSession, path: str, pattern: str) -> Tokenizer:
    """A rank file: one token in base 64 and its rank on each line. Its size is fixed."""
    lines = spark.read.text(path).where("value <> ''").collect() if "://" in path else open(path, encoding="ascii")
    pairs = (str(x[0] if "://" in path else x).split() for x in lines)
    return Tokenizer({base64.b64decode(p[0]): int(p[1]) for p in pairs if p}, pattern)


def _pack(ids: list[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


#: Control characters that one library takes for white space and the other does not.
_SEPARATORS = re.compile("[\x1c-\x1f]")


def _ascii_split(pattern: str):
    """The same split for ASCII texts by the standard library, which is faster; None if it cannot have the pattern."""
    plain = {r"\p{L}": "A-Za-z", r"\p{N}": "0-9"}
    out, inside, k = "", False, 0
    while k < len(pattern):
        if pattern[k : k + 5] in plain:
            own = plain[pattern[k : k + 5]]
            out, k = out + (own if inside else f"[{own}]"), k + 5
            continue
        step = 2 if pattern[k] == "\\" else 1
        if step == 1:
            inside = pattern[k] == "[" or (inside and pattern[k] != "]")
        out, k = out + pattern[k : k + step], k + step
    try:
        return re.compile(out).findall
    except re.error:
        return None


def _pairs(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of tokens whose bytes make up a token, as one number each, sorted, and the rank of that token."""
    found = {}
    for token, rank in ranks.items():
        for k in range(1, len(token)):
            a, b = ranks.get(token[:k]), ranks.get(token[k:])
            if a is not None and b is not None:
                found[a << 32 | b] = rank
    keys = np.fromiter(found.keys(), np.int64, len(found))
    order = np.argsort(keys)
    return keys[order], np.fromiter(found.values(), np.int64, len(found))[order]


def merge_all(pieces: list[bytes], ranks: dict[bytes, int], pairs: np.ndarray, joined: np.ndarray) -> list[bytes]:
    """``merge`` for many pieces at once, none of which is a token; ids as four bytes each.

    In every round each piece joins its pair of the lowest rank, leftmost first, until it has none.
    """
    if not pieces:
        return []
    single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
    part = single[np.frombuffer(b"".join(pieces), np.uint8)]
    if (part < 0).any():
        raise KeyError("a byte is no token")
    of = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])

    def rank(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(pairs):
            return np.full(len(left), NONE)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
        return np.where(pairs[at] == key, joined[at], NONE)

    def following(at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at ``at``."""
        ends = (at + 1 >= len(of)) | (of[np.minimum(at + 1, len(of) - 1)] != of[at])
        return np.where(ends, NONE, rank(part[at], part[np.minimum(at + 1, len(of) - 1)]))

    pair = following(np.arange(len(of)))
    done_part, done_of = [], []
    while len(of):
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        least = np.minimum.reduceat(pair, first)
        size = np.diff(np.r_[first, len(of)])
        open_ = np.repeat(least != NONE, size)
        if not open_.all():  # these have no pair left
            done_part.append(part[~open_])
            done_of.append(of[~open_])
            part, of, pair = part[open_], of[open_], pair[open_]
            least, size = least[least != NONE], size[least != NONE]
            if not len(of):
                break
        hits = np.flatnonzero(pair == np.repeat(least, size))
        at = hits[np.r_[True, of[hits][1:] != of[hits][:-1]]]
        part[at] = least
        stay = np.ones(len(of), bool)
        stay[at + 1] = False
        part, of, pair = part[stay], of[stay], pair[stay]
        at -= np.arange(len(at))  # one part fewer in every piece before
        pair[at] = following(at)
        before = at[(at > 0) & (of[np.maximum(at - 1, 0)] == of[at])] - 1
        pair[before] = following(before)
    of, part = np.concatenate(done_of), np.concatenate(done_part)
    flat = part[np.argsort(of, kind="stable")].astype(np.int32).tobytes()
    ends = np.cumsum(np.bincount(of, minlength=len(pieces))).tolist()
    return [flat[4 * a : 4 * b] for a, b in zip([0, *ends], ends)]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Join the neighbours of the lowest rank, leftmost first, until none is a token."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > HEAP_FROM:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [ranks.get(a + b, NONE) for a, b in zip(parts, parts[1:])]
    while pairs:
        least = min(pairs)
        if least == NONE:
            break
        i = pairs.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], NONE)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], NONE)
    return [ranks[p] for p in parts]


NONE = 1 << 62


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of pairs and linked neighbours."""
    n = len(piece)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that begins here; -1 is gone
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, to = heapq.heappop(heap)
        if end[i] < 0 or end[i] >= n or end[i] >= to or end[end[i]] != to:
            continue  # one of the two has changed
        end[end[i]], end[i] = -1, to
        if to < n:
            before[to] = i
            if (r := ranks.get(piece[i : end[to]])) is not None:
                heapq.heappush(heap, (r, i, end[to]))
        if (b := before[i]) >= 0 and (r := ranks.get(piece[b:to])) is not None:
            heapq.heappush(heap, (r, b, to))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


def _id_lists(lists: list[bytes]) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(x) // 4 for x in lists])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(lists), np.int32) if offsets[-1] else np.zeros(0, np.int32)))


def encode(docs: DataFrame, tokenizer: Tokenizer, text: str = "text", to: str = "ids", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``docs`` with the token ids of the whole text as ``array<int>`` in column ``to``.

    A null or empty text has no ids. Special tokens are not known: their strings are
    text. Texts longer than a chunk are stitched, once for equal ones; should two
    chunks share no boundary (a pre-token longer than the overlap), the rest of that text
    is one piece. A column ``to`` of ``docs`` is replaced, others stay as they are.
    """
    get = share(docs.sparkSession, tokenizer)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        t = get()
        for batch in portions(batches):
            yield _id_lists(t.packed([x or "" for x in batch.to_pylist()]))

    ids = column_udf(run, "array<int>")
    rows = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    is_long = F.coalesce(F.length("_text") > chunk, F.lit(False))
    short = rows.where(~is_long).select("_row", ids("_text").alias("_ids"))
    long = rows.where(is_long).withColumn("_node", F.sha2("_text", 256))
    stitched = _pieces(long.select(F.col("_node").alias("node"), F.col("_text").alias("text")), get, chunk, overlap)
    pieces = stitched.select("node", "seg", ids("piece").alias("ids"))
    whole = pieces.groupBy("node").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("seg", "ids"))), lambda x: x["ids"])).alias("_ids"))
    long = long.select("_row", "_node").join(whole.withColumnRenamed("node", "_node"), "_node").select("_row", "_ids")
    out = short.unionByName(long)
    return out.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns if c != to], F.col("_ids").alias(to))


def _pieces(texts: DataFrame, get, chunk: int, overlap: int) -> DataFrame:
    """Pieces of long texts that begin and end at true pre-token boundaries: node, seg, piece."""
    space = Workspace(texts.sparkSession, "bpe")
    def chunked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("k", pa.int32()), ("body", pa.string()), ("tail", pa.string()), ("last", pa.bool_())]))
        for batch in batches:
            for x in batch:
                text = x.as_py()
                starts = range(0, len(text), chunk)
                own = [{"k": k, "body": text[a : a + chunk], "tail": text[a + chunk : a + chunk + overlap], "last": k == len(starts) - 1} for k, a in enumerate(starts)]
                yield pa.array([own], kind)

    cut = texts.dropDuplicates(["node"])
    each = column_udf(chunked, "array<struct<k: int, body: string, tail: string, last: boolean>>")("text")
    chunks = space.cut(cut.select("node", F.inline(each)), "chunks")

    def boundaries(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        t = get()
        for batch in portions(batches):
            heads, tails = [], []
            for row in batch:
                body, tail, last = row["body"].as_py(), row["tail"].as_py(), row["last"].as_py()
                size, end = len(body), len(body) + len(tail)
                sure = [a for a, b in t.cuts(body + tail) if last or b <= end - MARGIN]
                heads.append([a for a in sure if a < min(overlap, size)])
                tails.append([a - size for a in sure if a >= size])
            yield pa.StructArray.from_arrays([pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))], ["heads", "tails"])

    marks = chunks.select("node", "k", column_udf(boundaries, "struct<heads array<int>, tails array<int>>")(F.struct("body", "tail", "last")).alias("m"))
    by = Window.partitionBy("node").orderBy("k")
    meet = F.array_min(F.array_intersect("m.heads", F.lag("m.tails").over(by)))
    marks = marks.select("node", "k", F.when(F.col("k") == 0, F.lit(0)).otherwise(meet).alias("entry"))
    # Boundaries of a chunk are known to be true as long as all before it have met.
    met = F.min(F.col("entry").isNotNull()).over(by.rowsBetween(Window.unboundedPreceding, 0))
    marks = marks.select("node", "k", F.when(met, F.col("entry")).alias("entry"))
    marks = marks.select("node", "k", "entry", F.lead("entry").over(by).alias("next"), F.last(F.when(F.col("entry").isNotNull(), F.col("k")), True).over(by).alias("seg"))
    begin, size = F.coalesce("entry", F.lit(0)), F.length("body") + F.coalesce("next", F.lit(0))
    part = F.substring(F.concat("body", "tail"), begin + 1, size - begin)
    parts = chunks.join(marks, ["node", "k"]).select("node", "seg", "k", part.alias("part"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "part"))), lambda x: x["part"]), "")
    return parts.groupBy("node", "seg").agg(joined.alias("piece"))


def decode(docs: DataFrame, tokenizer: Tokenizer, ids: str = "ids", to: str = "bytes") -> DataFrame:
    """``docs`` with the bytes of the tokens in column ``to``; null for null ids.

    The bytes of any ids concatenate; those of a part of a text need not be valid UTF-8.
    An id that is no rank has no bytes.
    """
    get = share(docs.sparkSession, tokenizer.vocabulary())

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        data, at = get()
        size = np.diff(at)
        for batch in portions(batches):
            flat = batch.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            bounds = np.r_[0, np.cumsum(batch.value_lengths().fill_null(0).to_numpy())]
            out = []
            for a, b in zip(bounds[:-1], bounds[1:]):
                own = flat[a:b]
                own = own[(own >= 0) & (own < len(size))]
                n = size[own]
                out.append(data[np.repeat(at[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())].tobytes())
            yield pa.array(out, pa.binary(), mask=batch.is_null().to_numpy(zero_copy_only=False))

    keep = [f"`{c}`" for c in docs.columns if c != to]
    return docs.select(*keep, column_udf(run, "binary")(f"`{ids}`").alias(to))
