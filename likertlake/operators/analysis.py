"""The questions asked of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from likertlake.functions import columns as C
from likertlake.instrument import Instrument
from likertlake.operators import star
from likertlake.operators import statistics as S
from likertlake.operators.star import ID


# -- distribution -----------------------------------------------------------


def trait_descriptives(scores: DataFrame, spec: Instrument) -> DataFrame:
    stats = S.summary(star.score_counts(scores, spec), lattice=True)
    names = ("media", "desvio_padrao", "mediana", "minimo", "maximo")
    return stats.select("traco", *[F.round(c, 2).alias(c) for c in names]).orderBy(
        F.desc("media"), "traco"
    )


def score_bands(scores: DataFrame, spec: Instrument, per_unit: int = 2) -> DataFrame:
    """Respondents per band of score and their share; a missing score is a band of its own."""
    counts = star.score_counts(scores, spec, keep_null=True)
    bands = counts.groupBy("traco", C.band("valor", per_unit).alias("faixa")).agg(
        F.sum("n").alias("qtd")
    )
    total = F.sum("qtd").over(Window.partitionBy("traco"))  # a row of each trait per respondent
    return bands.withColumn("percentual", F.round(100 * F.col("qtd") / total, 2)).orderBy(
        "traco", "faixa"
    )


def lattice_histogram(scores: DataFrame, cuts: DataFrame, spec: Instrument) -> DataFrame:
    """Histogram on the attainable scores, with mean and cut of the trait alongside.

    A mean of k items moves in steps of 1/k, so bins centred on those steps leave
    no artificial gaps. Attainable bins nobody reached appear with zero.
    """
    steps = F.create_map(
        *[x for t in spec.traits for x in (F.lit(t.label), F.lit(len(t.items)))]
    )
    step = steps[F.col("traco")]
    counts = star.score_counts(scores, spec)
    seen = counts.select(
        "traco", F.round((F.col("valor") - spec.lo) * step).cast("int").alias("bin"), "n"
    )
    attainable = cuts.select(
        "traco",
        F.explode(F.sequence(F.lit(0), (spec.hi - spec.lo) * step)).alias("bin"),
        F.lit(0).cast("bigint").alias("n"),
    )
    binned = seen.unionByName(attainable).groupBy("traco", "bin").agg(F.sum("n").alias("qtd"))
    means = S.moments(counts, lattice=True).select("traco", F.round("media", 4).alias("media"))
    beside = cuts.select("traco", "corte").join(means, "traco", "left")
    return (
        binned.join(F.broadcast(beside), "traco")
        .select(
            "traco",
            "bin",
            F.round(F.col("bin") / step + spec.lo, 4).alias("centro"),
            "qtd",
            "media",
            "corte",
        )
        .orderBy("traco", "bin")
    )


# -- elevated scores --------------------------------------------------------


def prevalence(scores: DataFrame, spec: Instrument) -> DataFrame:
    return (
        S.profile_columns(
            scores,
            spec.flag_columns,
            {"qtd_elevados": F.count_if, "_share": lambda c: F.avg(F.col(c).cast("int"))},
            name="_flag",
        )
        .withColumn(
            "traco",
            F.create_map(*[x for t in spec.traits for x in (F.lit(t.flag_column), F.lit(t.label))])[
                F.col("_flag")
            ],
        )
        .select("traco", "qtd_elevados", F.round(100 * F.col("_share"), 2).alias("pct_elevados"))
    )


def co_occurrence(scores: DataFrame, spec: Instrument) -> DataFrame:
    """Among those elevated in one trait, the share elevated in a later one.

    All pairs come from one scan: a filtered average needs no WHERE of its own.
    """
    pairs = [
        (a, b) for i, a in enumerate(spec.traits) for b in spec.traits[i + 1 :]
    ]
    wide = scores.agg(
        *[
            F.avg(F.when(F.col(a.flag_column), F.col(b.flag_column).cast("int"))).alias(f"p{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    cells = [
        x
        for i, (a, b) in enumerate(pairs)
        for x in (
            F.lit(f"Elevado em {a.slug} → também em {b.slug}"),  # fixed value, as published
            F.round(100 * F.col(f"p{i}"), 2),
        )
    ]
    return wide.select(F.stack(F.lit(len(pairs)), *cells).alias("relacao", "pct"))


def trait_correlation(scores: DataFrame, spec: Instrument, digits: int = 4) -> DataFrame:
    pairs = {
        f"{a.label} × {b.label}": (a.score_column, b.score_column)
        for i, a in enumerate(spec.traits)
        for b in spec.traits[i + 1 :]
    }
    return S.correlations(scores, pairs, digits).orderBy(F.desc("correlacao"), "par_de_tracos")


def trait_correlation_matrix(scores: DataFrame, spec: Instrument, digits: int = 4) -> DataFrame:
    return S.correlation_matrix(scores, {t.label: t.score_column for t in spec.traits}, digits)


# -- profiles ---------------------------------------------------------------


def _profile_counts(scores: DataFrame, profiles: DataFrame) -> DataFrame:
    """Count codes first, so that only one row per code meets the dimension.

    A code without a label stays, with a null label: percentages are of all respondents.
    """
    counted = scores.groupBy("id_perfil").agg(F.count(F.lit(1)).alias("qtd_respondentes"))
    return counted.join(profiles, "id_perfil", "left")


def profile_distribution(scores: DataFrame, profiles: DataFrame) -> DataFrame:
    rows = _profile_counts(scores, profiles).select(
        "descricao_perfil", "qtd_tracos_elevados", "qtd_respondentes"
    )
    return S.share_of_total(rows, "qtd_respondentes").orderBy(
        F.desc("qtd_respondentes"), "descricao_perfil"
    )


def profile_chart(scores: DataFrame, profiles: DataFrame) -> DataFrame:
    rows = _profile_counts(scores, profiles).select(
        "descricao_perfil", "qtd_tracos_elevados", F.col("qtd_respondentes").alias("count")
    )
    return S.share_of_total(rows, "count", digits=1).orderBy("count", "descricao_perfil")


def elevated_count_distribution(scores: DataFrame, profiles: DataFrame) -> DataFrame:
    rows = (
        _profile_counts(scores, profiles)
        .groupBy("qtd_tracos_elevados")
        .agg(F.sum("qtd_respondentes").alias("qtd_respondentes"))
    )
    return S.share_of_total(rows, "qtd_respondentes").orderBy("qtd_tracos_elevados")


def profile_dictionary(profiles: DataFrame, scores: DataFrame) -> DataFrame:
    """Every profile of the dimension with its respondents, also those nobody has."""
    counted = scores.groupBy("id_perfil").agg(F.count(F.lit(1)).alias("_n"))
    return profiles.join(counted, "id_perfil", "left").select(
        *profiles.columns, F.coalesce("_n", F.lit(0)).alias("qtd_respondentes")
    )


# -- items ------------------------------------------------------------------


def item_dictionary(items: DataFrame, silver: DataFrame, spec: Instrument) -> DataFrame:
    """The item dimension with the observed range of the original answers."""
    seen = S.profile_columns(
        silver,
        spec.item_ids,
        {"respostas": F.count, "minimo": F.min, "maximo": F.max},
        name="id_item",
    )
    return F.broadcast(items).join(seen, "id_item").select(*items.columns, "respostas", "minimo", "maximo")


def item_endorsement(
    silver: DataFrame, items: DataFrame, spec: Instrument, agree_from: int = 4
) -> DataFrame:
    """Mean corrected answer and share of agreement per item, from the wide rows.

    The 27 items are aggregated side by side; the item dimension joins the 27
    results, not the answers.
    """
    rows = S.profile_columns(
        silver,
        spec.item_ids,
        {
            "_sum": lambda c: F.sum(star.corrected(c, spec)),
            "_agree": lambda c: F.count_if(star.corrected(c, spec) >= agree_from),
            "_n": F.count,
        },
        name="id_item",
    )
    return (
        rows.join(F.broadcast(items), "id_item")
        .select(
            "traco",
            "id_item",
            "texto_item",
            "invertido",
            F.round(F.col("_sum") / F.col("_n"), 2).alias("media_corrigida"),
            F.round(100 * F.col("_agree") / F.col("_n"), 2).alias("pct_concordancia"),
        )
        .orderBy("traco", F.desc("media_corrigida"), "id_item")
    )


def item_chart(responses: DataFrame, items: DataFrame, trait: str | None = None) -> DataFrame:
    """Item means with a display label, from the answer fact.

    ``trait`` keeps one panel; a fact partitioned by trait is read for that trait only.
    """
    rows = responses if trait is None else responses.where(F.col("traco") == trait)
    means = rows.groupBy("traco", "id_item").agg(F.avg("resposta_corrigida").alias("_mean"))
    attributes = F.broadcast(items.select("id_item", "texto_item", "invertido"))
    return (
        means.join(attributes, "id_item")
        .select(
            "traco",
            "id_item",
            "texto_item",
            "invertido",
            C.item_label("id_item", "invertido").alias("rotulo"),
            F.round("_mean", 2).alias("media"),
        )
        .orderBy("traco", "media", "id_item")
    )


# -- groups -----------------------------------------------------------------


def group_means(
    scores: DataFrame,
    respondents: DataFrame,
    by: str,
    spec: Instrument,
    min_size: int = 0,
    label: bool = False,
) -> DataFrame:
    """Mean scores per respondent group, groups below ``min_size`` left out.

    Both tables hold a row per respondent. Bucketed on the id they join without an
    exchange; otherwise Spark sorts and merges them. Neither side is broadcast.
    """
    joined = scores.select(ID, *spec.score_columns).join(respondents.select(ID, by), ID)
    means = joined.groupBy(by).agg(
        F.count(F.lit(1)).alias("respondentes"),
        *[F.round(F.avg(t.score_column), 2).alias(t.slug) for t in spec.traits],
    )
    if min_size:
        means = means.where(F.col("respondentes") >= min_size)
    if label:
        means = means.withColumn("rotulo", C.group_label(by, "respondentes"))
    return means.orderBy(F.desc("respondentes"), by)
