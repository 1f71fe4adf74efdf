"""Data-quality diagnosis. Every operator reads, none changes the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from likertlake.functions import columns as C
from likertlake.instrument import Instrument
from likertlake.operators import statistics as S

# Nine decimals tell any two means of up to a few dozen items apart.
PROVISIONAL_DIGITS = 9


# -- completeness -----------------------------------------------------------


def missing_profile(df: DataFrame, cols: Sequence[str], missing: int = 0) -> DataFrame:
    rows = S.profile_columns(
        df,
        cols,
        {
            "nulos": lambda c: F.count_if(F.col(c).isNull()),
            "zeros": lambda c: F.count_if(F.col(c) == missing),
        },
        total="_total",
    )
    share = F.round(100 * (F.col("nulos") + F.col("zeros")) / F.col("_total"), 2)
    return (
        rows.select("campo", "nulos", "zeros", share.alias("pct_ausente"))
        .orderBy(F.desc("pct_ausente"), "campo")
    )


def blank_count_histogram(df: DataFrame, cols: Sequence[str], missing: int = 0) -> DataFrame:
    return (
        df.groupBy(C.blank_count(cols, missing).alias("qtd_zeros"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("qtd_zeros")
    )


def context_missing(bronze: DataFrame, spec: Instrument) -> DataFrame:
    """Rows without each context column; the route code counts as missing when null only."""
    missing = {c: F.col(c).isNull() if c == spec.origin else C.is_blank_text(c) for c in spec.context}
    return bronze.agg(*[F.count_if(m).alias(f"{c}_ausente") for c, m in missing.items()])


# -- consistency ------------------------------------------------------------


def domain_violations(df: DataFrame, cols: Sequence[str], lo: int, hi: int) -> DataFrame:
    """The rows that hold a value outside ``lo..hi``."""
    return df.where(C.outside(cols, lo, hi))


def domain_violation_count(df: DataFrame, cols: Sequence[str], lo: int, hi: int) -> DataFrame:
    return df.agg(F.count_if(C.outside(cols, lo, hi)).alias("fora_do_dominio"))


def domain_profile(df: DataFrame, cols: Sequence[str], missing: int = 0) -> DataFrame:
    """Observed range of each column and the mean of its valid values, side by side."""
    rows = S.profile_columns(
        df,
        cols,
        {
            "minimo": F.min,
            "maximo": F.max,
            "_sum": lambda c: F.sum(F.when(F.col(c) > missing, F.col(c))),
            "_n": lambda c: F.count_if(F.col(c) > missing),
        },
    )
    mean = F.round(F.try_divide(F.col("_sum"), F.col("_n")), 2)
    return rows.select("campo", "minimo", "maximo", mean.alias("media_validos"))


# -- uniqueness -------------------------------------------------------------


def packed(spec: Instrument) -> C.PackedVector:
    """The answers of a row as words; two rows have the same ones if and only if they answered the same."""
    return C.PackedVector(spec.item_ids, min(spec.lo, spec.missing), spec.hi)


def _packed_groups(df: DataFrame, spec: Instrument) -> tuple[C.PackedVector, DataFrame]:
    words = packed(spec)
    rows = df if set(words.names) <= set(df.columns) else words.pack(df)
    return words, rows.groupBy(*words.names).agg(F.count(F.lit(1)).alias("count"))


def duplicate_summary(df: DataFrame, spec: Instrument) -> DataFrame:
    """Rows, distinct response vectors and rows that repeat one; exact. ``df`` has the items, or their ``packed`` words."""
    _, groups = _packed_groups(df, spec)
    counted = groups.agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("distintas"))
    return counted.select(
        F.coalesce("total", F.lit(0)).alias("total"),
        "distintas",
        (F.coalesce("total", F.lit(0)) - F.col("distintas")).alias("repetidas"),
    )


def duplicate_groups(df: DataFrame, spec: Instrument, top: int = 10) -> DataFrame:
    """The most repeated response vectors, ties settled by the answers. ``df`` has the items, or their ``packed`` words."""
    words, groups = _packed_groups(df, spec)
    repeated = groups.where(F.col("count") > 1).select(*words.unpack(), "count")
    order = [F.desc("count"), *[F.col(c).asc_nulls_first() for c in spec.item_ids]]
    return repeated.orderBy(*order).limit(top)


# -- accuracy ---------------------------------------------------------------


def straight_line_histogram(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Respondents who gave one answer throughout, by that answer."""
    return (
        df.where(C.is_uniform(cols))
        .groupBy(F.col(cols[0]).alias("valor_repetido"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("valor_repetido")
    )


def distinct_value_histogram(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return (
        df.groupBy(C.distinct_count(cols).alias("valores_distintos"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("valores_distintos")
    )


def answer_variability(df: DataFrame, cols: Sequence[str], missing: int = 0, keep: Sequence[str] = ()) -> DataFrame:
    """How much each respondent's answers vary: a row-local deviation and the longest run of one answer.

    ``validas`` counts answers above the missing code; ``desvio_linha`` is their sample deviation, from whole-number sums
    (null for fewer than two). ``maior_sequencia`` is the most neighbouring items, in the order of ``cols``, with the same
    valid answer (0 without any); a blank or null between two equal answers ends a run.
    """
    valid = [F.when(F.col(c) > missing, F.col(c)) for c in cols]
    n, total, squares = "validas", "_total", "_quadrados"
    sums = df.select(
        *keep,
        F.array(*valid).alias("_valid"),
        C.count_of_valid(cols, missing).alias(n),
        C.sum_of_valid(cols, missing).alias(total),
        reduce(add, (F.when(F.col(c) > missing, F.col(c).cast("bigint") * F.col(c)).otherwise(F.lit(0)) for c in cols)).alias(squares),
    )
    spread = F.col(n) * F.col(squares) - F.col(total) * F.col(total)
    start = F.struct(F.lit(None).cast("int").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(state: Column, x: Column) -> Column:
        run = F.when(x.isNull(), 0).when(x == state["last"], state["run"] + 1).otherwise(1)
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(state["best"], run).alias("best"))

    return sums.select(
        *keep,
        F.col(n).cast("int").alias(n),
        F.when(F.col(n) > 1, F.sqrt(spread / (F.col(n) * (F.col(n) - 1)))).alias("desvio_linha"),
        F.aggregate("_valid", start, step, lambda state: state["best"]).alias("maior_sequencia"),
    )


def low_variability(df: DataFrame, cols: Sequence[str], missing: int = 0, keep: Sequence[str] = (), below: float = 0.5, run: int | None = None) -> DataFrame:
    """Respondents whose answers hardly vary: a deviation under ``below``, or ``run`` equal answers in a row (a third of the items).

    Those with fewer than two valid answers have no deviation and are judged by their run alone.
    """
    longest = run if run is not None else max(2, -(-len(cols) // 3))
    found = answer_variability(df, cols, missing, keep)
    flat = F.coalesce(F.col("desvio_linha") < below, F.lit(False))
    reason = F.when(flat & (F.col("maior_sequencia") >= longest), "desvio e sequencia").when(flat, "desvio").otherwise("sequencia")
    return found.where(flat | (F.col("maior_sequencia") >= longest)).withColumn("motivo", reason)


# -- outliers ---------------------------------------------------------------


def _valid_sums(df: DataFrame, spec: Instrument, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(
        *keep,
        *[
            x
            for t in spec.traits
            for x in (
                C.sum_of_valid(t.item_ids, spec.missing).alias(f"_sum_{t.slug}"),
                C.count_of_valid(t.item_ids, spec.missing).alias(f"_n_{t.slug}"),
            )
        ],
    )


def _valid_mean(total: str, n: str) -> Column:
    return F.when(F.col(n) > 0, C.ratio(total, n, PROVISIONAL_DIGITS))


def provisional_scores(df: DataFrame, spec: Instrument, keep: Sequence[str] = ()) -> DataFrame:
    """Trait means over answered items, before any reverse coding; null without answers."""
    sums = _valid_sums(df, spec, keep)
    return sums.select(
        *keep, *[_valid_mean(f"_sum_{t.slug}", f"_n_{t.slug}").alias(t.slug) for t in spec.traits]
    )


def provisional_counts(df: DataFrame, spec: Instrument) -> DataFrame:
    """Value counts of the provisional scores, counted as whole-number pairs first."""
    cells = [
        x
        for t in spec.traits
        for x in (F.lit(t.slug), F.col(f"_sum_{t.slug}"), F.col(f"_n_{t.slug}"))
    ]
    pairs = _valid_sums(df, spec).select(
        F.stack(F.lit(len(spec.traits)), *cells).alias("traco", "_sum", "_answered")
    )
    counted = (
        pairs.where(F.col("_answered") > 0)
        .groupBy("traco", "_sum", "_answered")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.groupBy("traco", _valid_mean("_sum", "_answered").alias("valor")).agg(
        F.sum("n").alias("n")
    )


# -- context ----------------------------------------------------------------


def frequency(df: DataFrame, col: str, top: int | None = None, trim: bool = False) -> DataFrame:
    """How often each value occurs, most frequent first; null is a value."""
    value = F.trim(col) if trim else F.col(col)
    counted = df.groupBy(value.alias(col)).agg(F.count(F.lit(1)).alias("count"))
    ordered = counted.orderBy(F.desc("count"), F.col(col).asc_nulls_first())
    return ordered if top is None else ordered.limit(top)
