"""Row-local building blocks, all plain Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c: str | Column) -> Column:
    """Text to int; anything that is not a number becomes null, never an error."""
    return _col(c).try_cast("int")


def is_blank_text(c: str | Column) -> Column:
    return _col(c).isNull() | (F.trim(_col(c)) == "")


def null_count(cols: Sequence[str]) -> Column:
    return reduce(add, (_col(c).isNull().cast("int") for c in cols))


def blank_count(cols: Sequence[str], missing: int = 0) -> Column:
    """How many columns hold the missing code; null as soon as one column is null."""
    return reduce(add, ((_col(c) == missing).cast("int") for c in cols))


def distinct_count(cols: Sequence[str]) -> Column:
    """Distinct values across columns; null counts as a value of its own."""
    return F.size(F.array_distinct(F.array(*cols)))


def is_uniform(cols: Sequence[str]) -> Column:
    """All columns equal, with null equal to null: ``distinct_count(cols) == 1``."""
    nulls = null_count(cols)
    same = F.greatest(*cols) == F.least(*cols)
    return (nulls == len(cols)) | ((nulls == 0) & same)


def outside(cols: Sequence[str], lo: int, hi: int) -> Column:
    """Some non-null value lies outside ``lo..hi``."""
    return reduce(or_, (F.coalesce((_col(c) > hi) | (_col(c) < lo), F.lit(False)) for c in cols))


def ratio(total: str | Column, n: str | Column | int, digits: int) -> Column:
    """``total / n`` rounded to ``digits``, halves away from zero, for whole numbers and positive ``n``.

    The numerator is doubled and shifted by ``n`` before the division, so the floor
    falls on the exact side. ``round`` on a double goes through a decimal object per
    row and costs many times as much on a full table.
    """
    count = F.lit(n) if isinstance(n, int) else _col(n)
    scale = float(10**digits)
    size = F.floor((F.abs(_col(total)) * F.lit(2 * scale) + count) / (count * 2)) / F.lit(scale)
    return F.when(_col(total) < 0, -size).otherwise(size)


def sum_of_valid(cols: Sequence[str], missing: int = 0) -> Column:
    """Sum of the values above the missing code."""
    return reduce(add, (F.when(_col(c) > missing, _col(c)).otherwise(0).cast("bigint") for c in cols))


def count_of_valid(cols: Sequence[str], missing: int = 0) -> Column:
    return reduce(add, (F.when(_col(c) > missing, 1).otherwise(0) for c in cols))


def reverse(c: str | Column, lo: int, hi: int) -> Column:
    return F.lit(lo + hi) - _col(c)


def mean_score(corrected: Sequence[Column], digits: int = 4) -> Column:
    return ratio(reduce(add, corrected), len(corrected), digits)


def bit_code(flags: Sequence[str]) -> Column:
    """Flags as one integer, the first flag in the highest bit."""
    top = len(flags) - 1
    return reduce(add, (_col(f).cast("int") * (1 << (top - i)) for i, f in enumerate(flags)))


def band(c: str | Column, per_unit: int = 2) -> Column:
    """Lower edge of the band that holds the value, ``per_unit`` bands per unit."""
    return F.floor(_col(c) * per_unit) / per_unit


def percent(part: str | Column, total: str | Column, digits: int = 2) -> Column:
    return F.round(100 * _col(part) / _col(total), digits)


def code_label(c: str | Column, labels: Mapping[int, str], default: str) -> Column:
    code = _col(c)
    out = None
    for value, label in labels.items():
        out = F.when(code == value, label) if out is None else out.when(code == value, label)
    return F.lit(default) if out is None else out.otherwise(default)


def item_label(item: str | Column, is_reversed: str | Column) -> Column:
    return F.concat(_col(item), F.when(_col(is_reversed), F.lit("*")).otherwise(F.lit("")))


def group_label(name: str | Column, n: str | Column) -> Column:
    return F.format_string("%s (n=%d)", _col(name), _col(n))


class PackedVector:
    """A row of small integers as a few bigints, for grouping on whole rows.

    Every value in ``lo..hi`` becomes one digit; the digit above the range marks
    anything else (nulls, wild codes), and such rows also carry their exact text
    in ``rest``. Two rows are equal if and only if words and rest are equal, while
    the shuffled key is a fraction of the original columns.
    """

    def __init__(self, cols: Sequence[str], lo: int, hi: int) -> None:
        self.cols, self.lo, self.hi = list(cols), lo, hi
        self.base = hi - lo + 2
        self.per_word = 1
        while self.base ** (self.per_word + 1) < 2**63:
            self.per_word += 1
        self.chunks = [
            self.cols[i : i + self.per_word] for i in range(0, len(self.cols), self.per_word)
        ]
        self.names = [f"_w{i}" for i in range(len(self.chunks))] + ["_rest"]

    def pack(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Words and rest next to the ``keep`` columns, in place of the vector.

        Digits become columns first: never null, so the words need no null checks,
        and the largest digit tells whether the row is irregular.
        """
        escape = self.base - 1
        digits = {
            c: F.when(F.col(c).between(self.lo, self.hi), F.col(c) - self.lo).otherwise(escape)
            for c in self.cols
        }
        staged = df.select(*keep, *self.cols, *[d.alias(f"_d_{c}") for c, d in digits.items()])
        words = []
        for i, chunk in enumerate(self.chunks):
            word = F.lit(0).cast("bigint")
            for c in chunk:
                word = word * self.base + F.col(f"_d_{c}")
            words.append(word.alias(f"_w{i}"))
        exact = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in self.cols])
        irregular = F.greatest(*[F.col(f"_d_{c}") for c in self.cols]) == escape
        return staged.select(*keep, *words, F.when(irregular, exact).alias("_rest"))

    def unpack(self) -> list[Column]:
        out = []
        for i, chunk in enumerate(self.chunks):
            for k, c in enumerate(chunk):
                scale = self.base ** (len(chunk) - 1 - k)
                digit = F.expr(f"cast((_w{i} div {scale}) % {self.base} as int)") + self.lo
                at = self.cols.index(c)
                out.append(
                    F.when(F.col("_rest").isNull(), digit)
                    .otherwise(F.split("_rest", ",").getItem(at).try_cast("int"))
                    .alias(c)
                )
        return out
