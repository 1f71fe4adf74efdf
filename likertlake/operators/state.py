"""Statistics that are refreshed by a new load without reading the old rows.

A load leaves two small tables: moments and co-moments of its columns, and quantile
sketches. Both merge: moments by the formula for parts, sketches by Spark's own merge. A
refresh reads one row for each load and column, however many rows the loads had.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Size of a sketch. The error of a rank falls nearly with its inverse: for this one it is
#: 0.0007 with 99 % confidence, below the 0.001 that approximate cuts are asked for.
SKETCH_SIZE = 8192
RANK_ERROR = 0.001

PAIR = ("a", "b")
_STATE = ("n", "media_a", "media_b", "m2_a", "m2_b", "c", "minimo", "maximo")


def _pairs(cols: Mapping[str, str]) -> list[tuple[str, str]]:
    labels = list(cols)
    return [(x, y) for i, x in enumerate(labels) for y in labels[i:]]


def moments(rows: DataFrame, cols: Mapping[str, str], group: Sequence[str] = ()) -> DataFrame:
    """State of all columns and pairs of columns of one load, in one pass.

    ``cols`` maps a label to a column. One row for each pair of labels, a label with itself
    included: rows where both are present (NaN counts as absent), means, sums of squared deviations, sum of products of deviations,
    and the range of the first.
    """
    present = {label: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for label, c in cols.items()}
    plain = rows.select(*group, *[v.alias(f"_{i}") for i, v in enumerate(present.values())])
    at = {label: f"_{i}" for i, label in enumerate(cols)}
    aggs: list[Column] = []
    for i, (x, y) in enumerate(_pairs(cols)):
        a, b = (F.when(F.col(at[y]).isNotNull(), F.col(at[x])), F.when(F.col(at[x]).isNotNull(), F.col(at[y])))
        n = F.count(a)
        cells = [n, F.avg(a), F.avg(b), F.var_pop(a) * n, F.var_pop(b) * n, F.covar_pop(a, b) * n, F.min(a), F.max(a)]
        aggs += [v.alias(f"{name}__{i}") for name, v in zip(_STATE, cells)]
    wide = plain.groupBy(*group).agg(*aggs)
    cells = [v for i, (x, y) in enumerate(_pairs(cols)) for v in (F.lit(x), F.lit(y), *[F.col(f"{name}__{i}") for name in _STATE])]
    return wide.select(*group, F.stack(F.lit(len(_pairs(cols))), *cells).alias(*PAIR, *_STATE))


def merged(states: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """One state of the states of several loads, exact but for rounding.

    Deviations of a load are moved from its own mean to the common one, so no digits cancel. There is a row of each load and pair,
    so the window over a pair has as many rows as there were loads.
    """
    keys = [*group, *PAIR]
    some = states.where(F.col("n") > 0)
    whole = Window.partitionBy(*keys)
    mean = {x: F.sum(F.col("n") * F.col(f"media_{x}")).over(whole) / F.sum("n").over(whole) for x in PAIR}
    moved = some.withColumns({f"_media_{x}": m for x, m in mean.items()})
    off = {x: F.col(f"media_{x}") - F.col(f"_media_{x}") for x in PAIR}
    return moved.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.max("_media_a").alias("media_a"),
        F.max("_media_b").alias("media_b"),
        F.sum(F.col("m2_a") + F.col("n") * off["a"] * off["a"]).alias("m2_a"),
        F.sum(F.col("m2_b") + F.col("n") * off["b"] * off["b"]).alias("m2_b"),
        F.sum(F.col("c") + F.col("n") * off["a"] * off["b"]).alias("c"),
        F.min("minimo").alias("minimo"),
        F.max("maximo").alias("maximo"),
    )


def descriptives(state: DataFrame, group: Sequence[str] = (), name: str = "traco") -> DataFrame:
    """Count, mean, sample deviation and range of each label; no deviation for a single row."""
    deviation = F.sqrt(F.try_divide(F.col("m2_a"), F.col("n") - 1))
    own = state.where(F.col("a") == F.col("b"))
    return own.select(*group, F.col("a").alias(name), "n", F.col("media_a").alias("media"), deviation.alias("desvio_padrao"), "minimo", "maximo")


def correlations(state: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of each pair of labels; null where one is constant."""
    value = F.try_divide(F.col("c"), F.sqrt(F.col("m2_a")) * F.sqrt(F.col("m2_b")))
    return state.where(F.col("a") != F.col("b")).select(*group, *PAIR, "n", value.alias("correlacao"))


# -- quantiles with a stated error -------------------------------------------


def sketches(rows: DataFrame, cols: Mapping[str, str], group: Sequence[str] = (), size: int = SKETCH_SIZE, name: str = "traco") -> DataFrame:
    """A quantile sketch of each column (and group) of one load, in one pass; nulls and NaN are left out."""
    wide = rows.groupBy(*group).agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), size).alias(f"_{i}") for i, c in enumerate(cols.values())])
    cells = [v for i, label in enumerate(cols) for v in (F.lit(label), F.col(f"_{i}"))]
    return wide.select(*group, F.stack(F.lit(len(cols)), *cells).alias(name, "esboco"))


def merged_sketches(stored: DataFrame, group: Sequence[str] = (), name: str = "traco") -> DataFrame:
    """One sketch of each label (and group) for all loads."""
    return stored.groupBy(*group, name).agg(F.kll_merge_agg_double("esboco").alias("esboco"))


def quantiles(sketch: DataFrame, probs: Mapping[str, float], group: Sequence[str] = (), name: str = "traco") -> DataFrame:
    """Values whose rank is off by ``RANK_ERROR`` of the rows at most; null for an empty sketch."""
    n = F.kll_sketch_get_n_double("esboco")
    at = {k: F.when(n > 0, F.kll_sketch_get_quantile_double("esboco", F.lit(float(p)))) for k, p in probs.items()}
    return sketch.select(*group, name, n.alias("n"), *[v.alias(k) for k, v in at.items()])


def rank_errors(rows: DataFrame, cols: Mapping[str, str], found: DataFrame, probs: Mapping[str, float], group: str) -> DataFrame:
    """How far the rank of each value of ``found`` is from the one asked for, as a share of the rows of its group.

    Exact, by one more pass over ``rows``. A value that many rows have takes up a stretch of ranks; it is right anywhere in it.
    """
    out = None
    for label, c in cols.items():
        own = found.where(F.col("traco") == label).select(F.col(group).alias("_group"), *probs)
        held = rows.select(F.col(group), F.col(c).alias("_x")).where("_x IS NOT NULL")
        met = held.join(own, F.col(group).eqNullSafe(F.col("_group")))
        sides = [x for k in probs for x in (F.avg((F.col("_x") < F.col(k)).cast("int")).alias(f"_below_{k}"), F.avg((F.col("_x") <= F.col(k)).cast("int")).alias(f"_upto_{k}"))]
        shares = met.groupBy(group).agg(F.count(F.lit(1)).alias("n"), *sides)
        off = [F.greatest(F.col(f"_below_{k}") - F.lit(p), F.lit(p) - F.col(f"_upto_{k}"), F.lit(0.0)).alias(k) for k, p in probs.items()]
        part = shares.select(group, F.lit(label).alias("traco"), "n", *off)
        out = part if out is None else out.unionByName(part)
    return out
