"""Words of UTF-8 text and hashes of word windows, for whole Arrow columns at once.

Texts are handled as bytes in slices of bounded size. A window hash is a polynomial
of its word hashes modulo 2**64, read off prefix sums, so every window of a slice
costs a few vector operations whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a longer text makes a slice of its own.
SLICE = 1 << 19

_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93

#: Word bytes where words end at ASCII white space only.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[9, 10, 11, 12, 13, 32]] = False

#: Word bytes where words are ASCII letters, digits and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, seed: int) -> np.ndarray:
    return mix((np.arange(n, dtype=np.uint64) + np.uint64(seed)) * np.uint64(_BASE))


_LETTERS = seeds(256, 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of an odd base and of its inverse, grown when needed."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.zeros(0, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(self.base, 2 * n), _powers(self.inverse, 2 * n)
        return self.up, self.down


def powers() -> tuple[Powers, Powers]:
    """Tables for ``word_hashes`` and ``window_prefix``; make them once a task."""
    return Powers(_BASE), Powers(_WORD_BASE)


class Words(NamedTuple):
    """Words of a slice of texts, in order."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray  # the text of each word
    first: np.ndarray  # the first word of each text, and the number of words


def column(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a string column; null reads as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_string()).fill_null("")
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1] if offsets else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def slices(data: np.ndarray, offsets: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``size`` bytes: first text, bytes, offsets."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def split(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray) -> Words:
    mask = letters[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = mask[:-1], mask[1:]
    starts = np.flatnonzero(mask & (~before | edge[:-1]))
    ends = np.flatnonzero(mask & (~after | edge[1:])) + 1
    doc = np.searchsorted(offsets, starts, "right") - 1
    return Words(data, starts, ends, doc, np.searchsorted(starts, offsets))


def word_hashes(w: Words, table: Powers) -> np.ndarray:
    up, down = table(len(w.data) + 1)
    sums = np.zeros(len(w.data) + 1, np.uint64)
    np.cumsum(_LETTERS[w.data] * up[: len(w.data)], out=sums[1:])
    h = (sums[w.ends] - sums[w.starts]) * down[w.starts]
    return mix(h + (w.ends - w.starts).astype(np.uint64))


def window_prefix(hashes: np.ndarray, table: Powers) -> np.ndarray:
    up, _ = table(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return sums


def window_hashes(prefix: np.ndarray, k: int, table: Powers, at: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the windows of ``k`` words that start at ``at`` (everywhere)."""
    _, down = table(len(prefix))
    if at is None:
        n = max(0, len(prefix) - k)
        return mix((prefix[k : k + n] - prefix[:n]) * down[:n])
    return mix((prefix[at + k] - prefix[at]) * down[at])


def inside(w: Words, k: int) -> np.ndarray:
    """Whether the window of ``k`` words at each start lies in one text."""
    n = max(0, len(w.doc) - k + 1)
    return w.doc[:n] == w.doc[k - 1 : k - 1 + n]


def spread(starts: np.ndarray, k: int | np.ndarray, n: int) -> np.ndarray:
    """Mask of the ``n`` positions covered by runs of length ``k`` at ``starts``."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + k, -1)
    return np.cumsum(step[:-1]) > 0


def listed(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether each value is in a sorted table."""
    if not len(table):
        return np.zeros(len(values), bool)
    at = np.searchsorted(table, values)
    return table[np.minimum(at, len(table) - 1)] == values
