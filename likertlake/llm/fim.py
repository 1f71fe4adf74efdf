"""Fill-in-middle transformation: lines of a text cut at two drawn places and put in another order.

A text is laid out in fixed blocks of bytes. Two Fenwick trees over its blocks hold how
many lines end and how many code points begin in each node's span. A descent by powers of
two finds the block that holds a wanted line end, and that block alone is then searched
for the place. All trees of a batch of texts are built and descended at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from likertlake.llm import words as W
from likertlake.llm.share import column_udf

#: Bytes of a block, and blocks searched locally at a time.
BLOCK, AT_ONCE = 512, 4096
#: What stands before each part of the output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Seed of the draws; texts in a hundred that are transformed, and of those the ones with the suffix first.
SEED, RATE, SUFFIX_FIRST = 7, 100, 50


class Layout(NamedTuple):
    """Blocks of a slice of texts and the trees over them; node ``i`` of a text is at ``first + i - 1``."""

    ends: np.ndarray  # by byte: whether a line ends here
    begins: np.ndarray  # by byte: whether a code point begins here
    offsets: np.ndarray  # of the texts
    first: np.ndarray  # the first block of each text
    blocks: np.ndarray  # how many blocks a text has
    lines: np.ndarray  # how many lines a text has
    line_tree: np.ndarray
    char_tree: np.ndarray


def layout(data: np.ndarray, offsets: np.ndarray, block: int = BLOCK) -> Layout:
    size = np.diff(offsets)
    blocks = -(-size // block)
    first = np.cumsum(blocks) - blocks
    text = np.repeat(np.arange(len(size)), blocks)
    node = np.arange(len(text)) - first[text] + 1
    ends = data == 10
    ends[offsets[1:][size > 0] - 1] = True  # the last line may lack its line feed
    begins = (data & 0xC0) != 0x80
    starts = offsets[text] + (node - 1) * block

    def tree(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        upto = np.r_[0, np.cumsum(np.add.reduceat(mask, starts, dtype=np.int64) if len(starts) else [])].astype(np.int64)
        last = first[text] + node
        return upto[last] - upto[last - (node & -node)], upto

    line_tree, upto = tree(ends)
    return Layout(ends, begins, offsets, first, blocks, upto[first + blocks] - upto[first], line_tree, tree(begins)[0])


def chars_before(at: Layout, text: np.ndarray, line: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Code points of the first ``line`` lines of each ``text``."""
    out = np.zeros(len(text), np.int64)
    wanted = np.flatnonzero(line > 0)
    text, left = text[wanted], line[wanted].astype(np.int64)
    first, blocks = at.first[text], at.blocks[text]
    node, chars = np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
    step = 1 << int(blocks.max(initial=0)).bit_length()
    while step := step >> 1:
        to = node + step
        k = np.minimum(first + to, len(at.line_tree)) - 1
        down = (to <= blocks) & (at.line_tree[k] < left)
        node, left, chars = np.where(down, to, node), np.where(down, left - at.line_tree[k], left), np.where(down, chars + at.char_tree[k], chars)
    # The wanted end is the one numbered ``left`` in block ``node``, counted from 0.
    start, stop = at.offsets[text] + node * block, at.offsets[text + 1]
    for k in range(0, len(text), AT_ONCE):
        own = slice(k, k + AT_ONCE)
        byte = start[own, None] + np.arange(block)
        inside = byte < stop[own, None]
        byte = np.minimum(byte, len(at.ends) - 1)
        found = (np.cumsum(at.ends[byte] & inside, axis=1, dtype=np.int32) >= left[own, None]).argmax(1)
        chars[own] += (at.begins[byte] & (np.arange(block) <= found[:, None])).sum(1)
    out[wanted] = chars
    return out


_CUT = "struct<n: bigint, prefix_chars: bigint, middle_chars: bigint>"


def _cuts(block: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            data, offsets = W.column(batch.field("text"))
            draws = [batch.field(c).to_numpy(zero_copy_only=False) for c in ("a", "b")]
            n, low, high = (np.zeros(len(batch), np.int64) for _ in range(3))
            for i, part, at in W.slices(data, offsets):
                laid = layout(part, at, block)
                own, text = slice(i, i + len(at) - 1), np.arange(len(at) - 1)
                n[own] = laid.lines
                a, b = (d[own] % (laid.lines + 1) for d in draws)
                low[own], high[own] = (chars_before(laid, text, f(a, b), block) for f in (np.minimum, np.maximum))
            yield pa.StructArray.from_arrays([pa.array(n), pa.array(low), pa.array(high - low)], ["n", "prefix_chars", "middle_chars"])

    return run


def draws(id: Column, seed: int = SEED) -> list[Column]:
    """Four whole numbers below 2**32, from the digits of a hash of the seed and the id."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digits, 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(4)]


def transform(
    docs: DataFrame, text: str = "text", id: str = "doc_id", to: str = "fim",
    seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, block: int = BLOCK,
) -> DataFrame:
    """``docs`` with a struct column ``to``: n, form, prefix_chars, middle_chars and output.

    A line ends after its line feed or at the end of the text; ``n`` counts them. The cuts
    are two draws of 0 to ``n`` lines, so any part may be empty. Forms are ``psm``, ``spm``
    and, for texts that are null, empty, not drawn or hold one of the three marks,
    ``plain``: the text itself, without lengths. A null text counts as empty. Draws depend on the id and
    the seed alone: rows of one id are cut by the same draws, a null id has those of the seed.
    A column ``to`` of ``docs`` is replaced, others stay as they are.
    """
    source = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row"), source.alias("_text"), F.array(*draws(F.col(f"`{id}`"), seed)).alias("_h"))
    cut = column_udf(_cuts(block), _CUT)
    rows = rows.withColumn("_cut", cut(F.struct(F.col("_text").alias("text"), F.get("_h", F.lit(0)).alias("a"), F.get("_h", F.lit(1)).alias("b"))))
    whole, p, m = F.col("_text"), F.col("_cut.prefix_chars").cast("int"), F.col("_cut.middle_chars").cast("int")
    marked = F.contains(whole, F.lit(PREFIX)) | F.contains(whole, F.lit(SUFFIX)) | F.contains(whole, F.lit(MIDDLE))
    plain = (whole == "") | marked | (F.get("_h", F.lit(2)) % 100 >= rate)
    form = F.when(plain, "plain").when(F.get("_h", F.lit(3)) % 100 < suffix_first, "spm").otherwise("psm")
    parts = {
        "prefix": F.concat(F.lit(PREFIX), F.substring(whole, F.lit(1), p)),
        "suffix": F.concat(F.lit(SUFFIX), F.substring(whole, p + m + 1, F.length(whole))),
        "middle": F.concat(F.lit(MIDDLE), F.substring(whole, p + 1, m)),
    }
    order = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
    joined = {f: F.concat(*[parts[x] for x in names]) for f, names in order.items()}
    rows = rows.withColumn("_form", form)
    output = F.when(F.col("_form") == "psm", joined["psm"]).when(F.col("_form") == "spm", joined["spm"]).otherwise(whole)
    size = lambda c: F.when(F.col("_form") != "plain", F.col(f"_cut.{c}"))
    made = F.struct(F.col("_cut.n").alias("n"), F.col("_form").alias("form"), size("prefix_chars").alias("prefix_chars"), size("middle_chars").alias("middle_chars"), output.alias("output"))
    return rows.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns if c != to], made.alias(to))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of.

    A transformed text holds no mark and no mark overlaps another, so the marks part the
    output into the three pieces without doubt.
    """
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    piece = lambda k: F.get(parts, F.lit(k))
    return (
        F.when(form == "psm", F.concat(piece(1), piece(3), piece(2)))
        .when(form == "spm", F.concat(piece(2), piece(3), piece(1)))
        .otherwise(output)
    )
