"""Statistics that stay distributed at any row count.

Two shapes cover everything the analyses need:

* :func:`profile_columns` aggregates many columns side by side in one pass and
  turns the single result row into one row per column, so rows are never
  multiplied by the number of columns.
* :func:`value_counts` reduces columns whose values sit on a small lattice
  (scores, codes, money in cents) to ``(group, value, n)``. Means, deviations,
  exact quantiles and histograms then read that small table instead of the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Bands of the quantile search: 64 per doubling, linear below one hundredth.
BAND_UNIT, BANDS_PER_DOUBLING = 0.01, 64


def profile_columns(
    df: DataFrame,
    cols: Sequence[str],
    metrics: Mapping[str, Callable[[str], Column]],
    name: str = "campo",
    total: str | None = None,
) -> DataFrame:
    """One row per column with the given aggregates; ``total`` adds the row count.

    A metric maps a column name to an aggregate. Up to about 100 aggregation
    buffers in all, Spark keeps the pass inside generated code.
    """
    aggs = [m(c).alias(f"{k}__{c}") for k, m in metrics.items() for c in cols]
    extra = [] if total is None else [total]
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *aggs)
    cells = [x for c in cols for x in (F.lit(c), *[F.col(f"{k}__{c}") for k in metrics])]
    rows = wide.select("__rows", F.stack(F.lit(len(cols)), *cells).alias(name, *metrics))
    if total is not None:
        rows = rows.withColumnRenamed("__rows", total)
    return rows.select(name, *metrics, *extra)


def value_counts(
    df: DataFrame,
    cols: Mapping[str, str],
    group: str = "traco",
    value: str = "valor",
    keep_null: bool = False,
) -> DataFrame:
    """``(group, value, n)`` for several columns in one scan.

    ``cols`` maps the group label to the column. The map-side combine brings each
    task down to the distinct values before anything is shuffled.
    """
    cells = [x for label, c in cols.items() for x in (F.lit(label), F.col(c))]
    long = df.select(F.stack(F.lit(len(cols)), *cells).alias(group, value))
    if not keep_null:
        long = long.where(F.col(value).isNotNull())
    return long.groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))


def grouped_value_counts(df: DataFrame, group: str, col: str, value: str = "valor") -> DataFrame:
    rows = df.select(group, F.col(col).alias(value)).where(F.col(value).isNotNull())
    return rows.groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))


# Copies of a small row that meet the rows of one key, so that no key is one task's work.
COPIES = 16
# Parts into which the quantile search cuts a band, and how often it cuts again. A band of 1 % holds
# 7e13 doubles, so what is ordered in the end are 65,536 values at most, however they are clustered.
PARTS, CUTS = 1024, 3


def _attach(rows: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join ``small`` onto a few rows per group; both sides are aggregates.

    Keys compare null-safe: a null group finds itself.
    """
    renamed = small.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys))
    return rows.join(renamed, same).drop(*[f"_key_{k}" for k in keys])


def _copy_of(value: str) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(COPIES)).cast("int")


def _meet(rows: DataFrame, few: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Join the value-level ``rows`` with a ``few`` rows per key, copied ``COPIES`` times.

    The value picks the copy, so a key that holds most of the rows is shared out.
    """
    copied = few.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    return _attach(rows.withColumn("_copy", _copy_of(value)), copied, [*keys, "_copy"]).drop("_copy")


def _band(value: str) -> Column:
    """Order-preserving band number: even steps near zero, then about 1 % per band.

    Doubles of any size fall into some 130,000 bands, so a table of band totals is
    small for any data, stray codes included.
    """
    size = F.log2(F.lit(1.0) + F.abs(F.col(value)) / F.lit(BAND_UNIT))
    return F.floor(F.signum(F.col(value)) * size * F.lit(BANDS_PER_DOUBLING))


def _part(value: str) -> Column:
    """Which of ``PARTS`` even steps between ``_lo`` and ``_hi`` the value falls into."""
    step = F.try_divide(F.col(value) - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    return F.least(F.coalesce(F.floor(step * PARTS), F.lit(0)), F.lit(PARTS - 1))


Rank = Callable[[Column], Column]


def share(p: float) -> Rank:
    """Rank of the smallest value that at least the share ``p`` does not exceed."""
    return lambda total: F.greatest(F.ceil(F.lit(p) * total), F.lit(1))


def _sizes(rows: DataFrame, keys: Sequence[str], value: str, carry: Sequence[str] = ()) -> DataFrame:
    """Rows and range of each cell, and what all of its rows ``carry``."""
    carried = [F.first(c).alias(c) for c in carry]
    return rows.groupBy(*keys).agg(F.sum("n").alias("_size"), F.min(value).alias("_lo"), F.max(value).alias("_hi"), *carried)


def _holding(
    sizes: DataFrame, within: Sequence[str], key: str, ranks: Mapping[str, Rank], carry: Sequence[str] = ()
) -> DataFrame:
    """The cells that hold a wanted rank, with the rows before each. ``_start`` is where ``within`` begins."""
    running = Window.partitionBy(*within).orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    before = F.col("_start") + F.sum("_size").over(running) - F.col("_size")
    placed = sizes.withColumn("_before", before)
    total, end = F.col("_total"), F.col("_before") + F.col("_size")
    holds = [(F.col("_before") < rank(total)) & (rank(total) <= end) for rank in ranks.values()]
    return placed.where(reduce(or_, holds)).select(*within, key, "_before", "_total", *carry)


def values_at(
    counts: DataFrame, ranks: Mapping[str, Rank], group: str = "traco", value: str = "valor", lattice: bool = False
) -> DataFrame:
    """Exact values at the given ranks of each group.

    With ``lattice`` the caller knows that a group has few values, as scores of an instrument do:
    one window orders them. Otherwise totals per band place every band in the cumulative order. The few bands that hold
    a wanted rank are cut into even parts between their least and greatest value, those that hold it are cut again
    (``CUTS`` times in all), and only the last are ordered value by value. Windows run over the bands of
    a group, the parts of a part, or the values of a last part; none gathers those of a band.
    """
    if lattice:
        total = F.col("_total")
        return _ordered(counts, group, value).groupBy(group).agg(
            *[F.min(F.when(F.col("_upto") >= rank(total), F.col(value))).alias(name) for name, rank in ranks.items()]
        )
    rows = counts.select(group, value, "n").withColumn("_band", _band(value))
    sizes = _sizes(rows, [group, "_band"], value).withColumns(
        {"_total": F.sum("_size").over(Window.partitionBy(group)), "_start": F.lit(0)}
    )
    wanted, keys = _holding(sizes, [group], "_band", ranks, ["_lo", "_hi"]), [group, "_band"]
    parted = rows
    for cut in range(CUTS):
        part = f"_part{cut}"
        parted = _meet(parted.select(*keys, value, "n"), wanted, keys, value).withColumn(part, _part(value))
        inside = _sizes(parted, [*keys, part], value, ["_before", "_total"]).withColumnRenamed("_before", "_start")
        wanted, keys = _holding(inside, keys, part, ranks, ["_lo", "_hi"]), [*keys, part]
    inner = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = _meet(parted.select(*keys, value, "n"), wanted, keys, value).withColumn(
        "_upto", F.col("_before") + F.sum("n").over(inner)
    )
    total = F.col("_total")
    return ranked.groupBy(group).agg(
        *[
            F.min(F.when(F.col("_upto") >= rank(total), F.col(value))).alias(name)
            for name, rank in ranks.items()
        ]
    )


def _ordered(counts: DataFrame, group: str, value: str) -> DataFrame:
    """The values of each group in order, with the rows up to each and in all. For few values."""
    whole = Window.partitionBy(group)
    upto = F.sum("n").over(whole.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    return counts.select(group, value, "n", upto.alias("_upto"), F.sum("n").over(whole).alias("_total"))


def quantiles(
    counts: DataFrame, probs: Mapping[str, float], group: str = "traco", value: str = "valor", lattice: bool = False
) -> DataFrame:
    """Exact discrete quantiles per group: smallest value with share >= p."""
    return values_at(counts, {name: share(p) for name, p in probs.items()}, group, value, lattice)


def moments(counts: DataFrame, group: str = "traco", value: str = "valor", lattice: bool = False) -> DataFrame:
    """Count, mean, sample deviation and range.

    Deviations are taken from the mean, which a first sum gives, and corrected by their own sum: no digits
    cancel, whatever the size of the values. Both sums are combined in each task; no window is needed.
    ``lattice`` as in :func:`values_at`: few values are read once.
    """
    if lattice:
        return _few_summary(counts, group, value).drop(*_SUMMARY_RANKS)
    n, x = F.col("n"), F.col(value)
    rows = counts.select(group, value, "n")
    whole = rows.groupBy(group).agg((F.sum(n * x) / F.sum(n)).alias("_mean"))
    off = x - F.col("_mean")
    total = F.sum(n)
    spread = F.sum(n * off * off) - F.sum(n * off) * F.sum(n * off) / total
    return _meet(rows, whole, [group], value).groupBy(group).agg(
        total.alias("n"),
        (F.max("_mean") + F.sum(n * off) / total).alias("media"),
        F.when(total > 1, F.sqrt(F.try_divide(F.greatest(spread, F.lit(0.0)), total - 1))).alias("desvio_padrao"),
        F.min(x).alias("minimo"),
        F.max(x).alias("maximo"),
    )


_SUMMARY_RANKS: dict[str, Rank] = {
    "q25": share(0.25),
    "q50": share(0.5),
    "q75": share(0.75),
    "_lower": lambda total: F.floor((total + 1) / 2),
    "_upper": lambda total: F.floor(total / 2) + 1,
}


def _few_summary(counts: DataFrame, group: str, value: str) -> DataFrame:
    """Moments and ranks of few values from one ordering of them."""
    n, x, total = F.col("n"), F.col(value), F.col("_total")
    mean = F.sum(n * x).over(Window.partitionBy(group)) / total
    placed = _ordered(counts, group, value).withColumn("_mean", mean)
    off = x - F.col("_mean")
    size = F.sum(n)
    return placed.groupBy(group).agg(
        size.alias("n"),
        F.max("_mean").alias("media"),
        F.when(size > 1, F.sqrt(F.try_divide(F.sum(n * off * off), size - 1))).alias("desvio_padrao"),
        F.min(x).alias("minimo"),
        F.max(x).alias("maximo"),
        *[F.min(F.when(F.col("_upto") >= rank(total), x)).alias(name) for name, rank in _SUMMARY_RANKS.items()],
    )


def summary(counts: DataFrame, group: str = "traco", value: str = "valor", lattice: bool = False) -> DataFrame:
    """:func:`moments` with discrete quartiles and the interpolated median.

    ``lattice`` as in :func:`values_at`; then one window serves all of it.
    """
    if lattice:
        both = _few_summary(counts, group, value)
    else:
        both = _attach(values_at(counts, _SUMMARY_RANKS, group, value), moments(counts, group, value), [group])
    return both.select(
        group,
        "n",
        "media",
        "desvio_padrao",
        "minimo",
        "q25",
        "q50",
        "q75",
        "maximo",
        ((F.col("_lower") + F.col("_upper")) / 2).alias("mediana"),
    )


def _with_fences(quart: DataFrame, factor: float, digits: int) -> DataFrame:
    spread = F.lit(factor) * (F.col("q3") - F.col("q1"))
    return quart.withColumns(
        {
            "limite_inf": F.round(F.col("q1") - spread, digits),
            "limite_sup": F.round(F.col("q3") + spread, digits),
        }
    )


def iqr_outliers(
    counts: DataFrame,
    group: str = "traco",
    value: str = "valor",
    factor: float = 1.5,
    digits: int = 9,
    lattice: bool = False,
) -> DataFrame:
    """Interquartile fences and the rows beyond them, low and high side apart.

    Fences are rounded before they are compared, because a fence can fall on an
    attainable value and then differ from it in the last bit only. ``lattice`` as in :func:`values_at`.
    """
    names = [group, "q1", "q3", "limite_inf", "limite_sup"]
    low, high = F.col("limite_inf"), F.col("limite_sup")
    x = F.round(F.col(value), digits)
    quarts = {"q1": 0.25, "q3": 0.75}
    if lattice:
        whole = Window.partitionBy(group)
        at = {q: F.min(F.when(F.col("_upto") >= share(p)(F.col("_total")), F.col(value))).over(whole) for q, p in quarts.items()}
        rows = _with_fences(_ordered(counts, group, value).withColumns(at), factor, digits)
        return rows.groupBy(group).agg(
            *[F.max(c).alias(c) for c in names[1:]],
            F.sum(F.when(x < low, F.col("n")).otherwise(0)).alias("n_low"),
            F.sum(F.when(x > high, F.col("n")).otherwise(0)).alias("n_high"),
            F.sum(F.when((x < low) | (x > high), F.col("n")).otherwise(0)).alias("n_total"),
        )
    fences = _with_fences(quantiles(counts, quarts, group, value), factor, digits)
    rows = counts.select(group, value, "n").withColumn("_band", _band(value))
    bands = _attach(_sizes(rows, [group, "_band"], value), fences, [group])
    least, most = F.round("_lo", digits), F.round("_hi", digits)
    # A band beyond a fence counts whole; only those that a fence runs through are opened.
    cut = ((least < low) & (most >= low)) | ((least <= high) & (most > high))
    whole = bands.select(
        *names,
        F.when(~cut & (most < low), F.col("_size")).otherwise(0).alias("_low"),
        F.when(~cut & (least > high), F.col("_size")).otherwise(0).alias("_high"),
    )
    opened = _meet(rows, bands.where(cut).select(*names, "_band"), [group, "_band"], value).select(
        *names,
        F.when(x < low, F.col("n")).otherwise(0).alias("_low"),
        F.when(x > high, F.col("n")).otherwise(0).alias("_high"),
    )
    return (
        whole.unionByName(opened)
        .groupBy(*names)
        .agg(F.sum("_low").alias("n_low"), F.sum("_high").alias("n_high"), F.sum(F.col("_low") + F.col("_high")).alias("n_total"))
    )


def pearson(a: str, b: str) -> Column:
    """Pearson correlation over rows where both are present; null for a constant column.

    The built-in ``corr`` divides by zero there, which is an error in ANSI mode.
    """
    x = F.when(F.col(b).isNotNull(), F.col(a))
    y = F.when(F.col(a).isNotNull(), F.col(b))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def correlations(
    df: DataFrame, pairs: Mapping[str, tuple[str, str]], digits: int = 4, name: str = "par_de_tracos"
) -> DataFrame:
    """Pearson correlation of several pairs in one scan; pairs with a null are skipped."""
    wide = df.agg(*[pearson(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs.values())])
    cells = [x for i, label in enumerate(pairs) for x in (F.lit(label), F.round(f"c{i}", digits))]
    return wide.select(F.stack(F.lit(len(pairs)), *cells).alias(name, "correlacao"))


def correlation_matrix(df: DataFrame, cols: Mapping[str, str], digits: int = 4) -> DataFrame:
    """Square matrix, one row per label. Each unordered pair is computed once."""
    labels = list(cols)
    index = [(i, j) for i in range(len(labels)) for j in range(i, len(labels))]
    wide = df.agg(
        *[pearson(cols[labels[i]], cols[labels[j]]).alias(f"c{i}_{j}") for i, j in index]
    )
    cells = []
    for i, label in enumerate(labels):
        cells.append(F.lit(label))
        cells += [F.round(f"c{min(i, j)}_{max(i, j)}", digits) for j in range(len(labels))]
    return wide.select(F.stack(F.lit(len(labels)), *cells).alias("traco", *labels))


def share_of_total(df: DataFrame, n: str, name: str = "percentual", digits: int = 2) -> DataFrame:
    """Percent of the total, over an already aggregated handful of rows."""
    total = F.sum(n).over(Window.partitionBy())
    return df.withColumn(name, F.round(100 * F.col(n) / total, digits))
