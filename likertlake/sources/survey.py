"""Survey rows derived from the supplied ``orders`` table.

One respondent per order, in the raw shape of the questionnaire (every column as
text), with blanks, nulls, non-numeric text, out-of-domain codes and
straight-liners mixed in by a deterministic integer hash of the order key. The
derivation is a narrow projection: it reads two columns and never shuffles.

The projection is staged on purpose. Row-level draws become columns first, so
each of the 27 item expressions only compares against them instead of repeating
the hash arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from likertlake.instrument import SHORT_FORM_27, Instrument

PRIME = 1000003
STEP = 7919
STRIDE = 104729
SHIFT = 12345
BIAS_DRAW = 600

KEY = "src_row"
#: The columns of ``orders`` that the survey is derived from.
SOURCE = ("o_orderkey", "o_custkey")


def _draw(j: int) -> Column:
    u = (F.col(KEY) * STEP + F.lit(j * STRIDE + SHIFT)) % PRIME
    return (u * u) % PRIME


def _bump(col: Column) -> Column:
    m = col % 8
    return F.when(m == 0, -1).when(m == 7, 1).otherwise(0)


def _at(gate: int, every: int, pick: int, n_items: int) -> Column:
    """Index of the one item that a fault hits in this row, null when none."""
    return F.when(_draw(gate) % every == 0, _draw(pick) % n_items)


def derive_survey(
    orders: DataFrame, spec: Instrument = SHORT_FORM_27, keep: Sequence[str] = ()
) -> DataFrame:
    n_items = len(spec.item_ids)
    rows = orders.select(F.col("o_orderkey").alias(KEY), F.col("o_custkey").alias("_cust"), *keep)
    drawn = rows.select(
        "*",
        (_draw(300) % 500 == 0).alias("_flat"),
        (F.col(KEY) % 6).cast("string").alias("_flat_value"),
        _at(200, 40, 201, n_items).alias("_blank"),
        _at(202, 400, 203, n_items).alias("_null"),
        _at(204, 800, 205, n_items).alias("_text"),
        _at(206, 900, 207, n_items).alias("_wild"),
        *[
            (F.lit(3) + _bump(_draw(100)) + _bump(_draw(101 + t))).alias(f"_level{t}")
            for t in range(len(spec.traits))
        ],
        (_draw(500) % 200).alias("_place"),
        (_draw(501) % 4 + 1).cast("string").alias("source"),
    )

    items, j = [], 0
    for t, trait in enumerate(spec.traits):
        for item in trait.items:
            level = F.col(f"_level{t}") + (_draw(j) % 3 - 1)
            if t == 0:
                level = level + _draw(BIAS_DRAW + j) % 2
            value = F.least(F.lit(spec.hi), F.greatest(F.lit(spec.lo), level))
            if item.reversed:
                value = F.lit(spec.lo + spec.hi) - value
            items.append(
                F.when(F.col("_flat"), F.col("_flat_value"))
                .when(F.col("_blank") == j, F.lit("0"))
                .when(F.col("_null") == j, F.lit(None).cast("string"))
                .when(F.col("_text") == j, F.lit("x"))
                .when(F.col("_wild") == j, F.lit("7"))
                .otherwise(value.cast("int").cast("string"))
                .alias(item.id)
            )
            j += 1

    place = F.least(F.col("_cust") % 25, F.col("_cust") % 7)
    country = (
        F.when(F.col("_place") == 0, F.lit(""))
        .when(F.col("_place") == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" N"), place.cast("string"), F.lit(" ")))
    )
    return drawn.select(KEY, *items, country.alias("country"), "source", *keep)


def read_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet")
