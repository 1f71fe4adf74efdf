"""Star schema: three dimensions, the answer fact and the score fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from likertlake.functions import columns as C
from likertlake.instrument import Instrument
from likertlake.operators import statistics as S

ID = "id_respondente"


# -- dimensions -------------------------------------------------------------


def dim_item(spark: SparkSession, spec: Instrument) -> DataFrame:
    rows = [(i.id, t.label, i.text, i.reversed) for t in spec.traits for i in t.items]
    return spark.createDataFrame(
        rows, "id_item string, traco string, texto_item string, invertido boolean"
    )


def dim_profile(spark: SparkSession, spec: Instrument) -> DataFrame:
    rows = [(code, label, bin(code).count("1")) for code, label in enumerate(spec.profile_labels)]
    return spark.createDataFrame(
        rows, "id_perfil int, descricao_perfil string, qtd_tracos_elevados int"
    )


def dim_respondent(silver: DataFrame, spec: Instrument) -> DataFrame:
    """Where each respondent came from; context columns without a role keep their names."""
    shown = []
    for c in spec.context:
        if c == spec.place:
            shown.append(F.col(c).alias("pais_acesso"))
        elif c == spec.origin:
            label = C.code_label(c, spec.origin_labels, spec.origin_default)
            shown += [F.col(c).alias("id_origem"), label.alias("origem_acesso")]
        else:
            shown.append(F.col(c))
    return silver.select(ID, *shown, F.col("_data_ingestao").alias("data_ingestao"))


# -- answers ----------------------------------------------------------------


def corrected(item_id: str, spec: Instrument) -> Column:
    """The answer pointing in the direction of its trait."""
    if item_id in spec.reversed_ids:
        return C.reverse(item_id, spec.lo, spec.hi)
    return F.col(item_id)


def response_facts(silver: DataFrame, spec: Instrument) -> DataFrame:
    """One row per respondent and item, original and reverse-coded answer.

    The instrument already says which trait an item belongs to and whether it is
    reversed, so both travel as literals of the row generator. That saves a join
    on the table with 27 times the respondents.
    """
    cells = [
        x
        for t in spec.traits
        for i in t.item_ids
        for x in (F.lit(i), F.lit(t.label), F.col(i), corrected(i, spec))
    ]
    out = F.stack(F.lit(len(spec.item_ids)), *cells)
    return silver.select(
        ID, out.alias("id_item", "traco", "resposta_original", "resposta_corrigida")
    )


def long_answers(wide: DataFrame, items: Sequence[str], keys: Sequence[str] = (ID,)) -> DataFrame:
    """Wide to long for any set of columns; null answers stay as rows."""
    cells = [x for i in items for x in (F.lit(i), F.col(i))]
    out = F.stack(F.lit(len(items)), *cells)
    return wide.select(*keys, out.alias("id_item", "resposta_original"))


def reverse_by_dimension(long: DataFrame, items: DataFrame, lo: int, hi: int) -> DataFrame:
    """Attach trait and corrected answer from an item dimension.

    For dimensions kept as a table. Such a dimension has one row per questionnaire
    column, so it is far below any broadcast limit.
    """
    attributes = F.broadcast(items.select("id_item", "traco", "invertido"))
    value = F.col("resposta_original")
    fixed = F.when(F.col("invertido"), C.reverse(value, lo, hi)).otherwise(value)
    return (
        long.join(attributes, "id_item")
        .withColumn("resposta_corrigida", fixed)
        .select(*[c for c in long.columns if c not in ("id_item", "resposta_original")],
                "id_item", "traco", "resposta_original", "resposta_corrigida")
    )


def reverse_audit(silver: DataFrame, spec: Instrument) -> DataFrame:
    """How many answers the reverse coding changed, for the items it touched.

    Only the reversed items are read, side by side; the middle of the scale stays as it is.
    """
    items = [i for i in spec.item_ids if i in spec.reversed_ids]
    moved = {"respostas_alteradas": lambda i: F.count_if(corrected(i, spec) != F.col(i))}
    return S.profile_columns(silver, items, moved, name="id_item").where("respostas_alteradas > 0")


# -- scores -----------------------------------------------------------------


def trait_scores(silver: DataFrame, spec: Instrument, keep: Sequence[str] = (ID,)) -> DataFrame:
    """Mean of the corrected items per trait, computed inside the wide row: no shuffle."""
    return silver.select(
        *keep,
        *[
            C.mean_score([corrected(i, spec) for i in t.item_ids]).alias(t.score_column)
            for t in spec.traits
        ],
    )


def trait_scores_from_facts(responses: DataFrame, spec: Instrument) -> DataFrame:
    """The same scores from the long fact, pivoted to one column per trait.

    The fact table of a lake is bucketed on the respondent: grouping it has no exchange.
    """
    value = F.col("resposta_corrigida")
    return responses.groupBy(ID).agg(
        *[
            F.round(F.avg(F.when(F.col("traco") == t.label, value)), 4).alias(t.score_column)
            for t in spec.traits
        ]
    )


def score_counts(scores: DataFrame, spec: Instrument, keep_null: bool = False) -> DataFrame:
    cols = {t.label: t.score_column for t in spec.traits}
    return S.value_counts(scores, cols, keep_null=keep_null)


def cutoffs(scores: DataFrame, spec: Instrument, prob: float = 0.75) -> DataFrame:
    """The sample quantile of each trait that an elevated score must exceed."""
    return S.quantiles(score_counts(scores, spec), {"corte": prob}, lattice=True)


def score_profiles(scores: DataFrame, cuts: DataFrame, spec: Instrument) -> DataFrame:
    """Flags strictly above the cut and the profile code.

    The cuts enter as scalar subqueries, so they become constants of the scan
    stage: no join and no value typed in by hand.
    """
    flagged = scores.select(
        "*",
        *[
            (
                F.col(t.score_column)
                > cuts.where(F.col("traco") == t.label).agg(F.max("corte")).scalar()
            ).alias(t.flag_column)
            for t in spec.traits
        ],
    )
    return flagged.withColumn("id_perfil", C.bit_code(spec.flag_columns))
