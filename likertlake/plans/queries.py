"""Every operator as a query over the supplied tables.

Most read the survey derived from ``orders`` through its lake; a few apply the same
operators to other supplied tables. All results are lazy DataFrames.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from likertlake.functions import columns as C
from likertlake.functions import sql as sql_functions
from likertlake.instrument import SHORT_FORM_27 as SPEC
from likertlake.operators import analysis, cleaning, quality, star, state
from likertlake.operators import statistics as S
from likertlake.plans import lake as L
from likertlake.operators.ids import IdMap
from likertlake.plans.growing import GrowingLake
from likertlake.plans.lake import Lake, derived_lake, range_parts
from likertlake.session import Workspace
from likertlake.sources import files
from likertlake.sources.loads import LoadFolder
from likertlake.sources.survey import KEY
from likertlake.sources.tables import LAYERS, Layers
from likertlake.streaming.landing import Landing

Query = Callable[[SparkSession, str], DataFrame]
ITEMS = SPEC.item_ids

_registry: dict[str, Query] = {}


def _on_lake(fn: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(derived_lake(spark, sf_dir))

    query.__doc__ = fn.__doc__
    _registry[fn.__name__] = query
    return fn


def _on_tables(fn: Query) -> Query:
    _registry[fn.__name__] = fn
    return fn


# -- bronze and its diagnosis -----------------------------------------------


@_on_lake
def lineage_columns(lake: Lake) -> DataFrame:
    """Rows and load times per source file."""
    name = F.regexp_extract(files.ORIGIN, "[^/]+$", 0)
    return lake.bronze().groupBy(name.alias("arquivo")).agg(
        F.count(F.lit(1)).alias("registros"), F.count(files.INGESTED).alias("com_data")
    )


@_on_lake
def typed_survey(lake: Lake) -> DataFrame:
    return lake.typed().select(KEY, *ITEMS, "country", "source")


@_on_lake
def typed_view(lake: Lake) -> DataFrame:
    """SQL over the typed rows through a session view; nothing is written."""
    lake.layers.view(lake.typed(), "sessao_tipada")
    return lake.spark.sql("""
        SELECT source, count(*) AS registros, count(country) AS com_pais, max(M1) AS maior_m1
        FROM sessao_tipada GROUP BY source
    """)


@_on_lake
def missing_profile(lake: Lake) -> DataFrame:
    return quality.missing_profile(lake.typed(), ITEMS, SPEC.missing)


@_on_lake
def blank_count_histogram(lake: Lake) -> DataFrame:
    return quality.blank_count_histogram(lake.typed(), ITEMS, SPEC.missing)


@_on_lake
def context_missing(lake: Lake) -> DataFrame:
    return quality.context_missing(lake.bronze(), SPEC)


@_on_lake
def domain_violations(lake: Lake) -> DataFrame:
    rows = quality.domain_violations(lake.typed(), ITEMS, SPEC.missing, SPEC.hi)
    return rows.select(KEY, *ITEMS)


@_on_lake
def domain_violation_count(lake: Lake) -> DataFrame:
    return quality.domain_violation_count(lake.typed(), ITEMS, SPEC.missing, SPEC.hi)


@_on_lake
def domain_profile(lake: Lake) -> DataFrame:
    return quality.domain_profile(lake.typed(), ITEMS, SPEC.missing)


@_on_lake
def duplicate_summary(lake: Lake) -> DataFrame:
    return quality.duplicate_summary(lake.vectors(), SPEC)


@_on_lake
def duplicate_groups(lake: Lake) -> DataFrame:
    return quality.duplicate_groups(lake.vectors(), SPEC)


@_on_lake
def straight_line_histogram(lake: Lake) -> DataFrame:
    return quality.straight_line_histogram(lake.typed(), ITEMS)


@_on_lake
def distinct_value_histogram(lake: Lake) -> DataFrame:
    return quality.distinct_value_histogram(lake.typed(), ITEMS)


@_on_lake
def provisional_scores(lake: Lake) -> DataFrame:
    return quality.provisional_scores(lake.typed(), SPEC, keep=[KEY])


def _six_digits(summary: DataFrame) -> DataFrame:
    return summary.withColumns({c: F.round(c, 6) for c in ("media", "desvio_padrao")}).drop("mediana")


@_on_lake
def score_summary(lake: Lake) -> DataFrame:
    return _six_digits(S.summary(quality.provisional_counts(lake.typed(), SPEC), lattice=True))


@_on_lake
def iqr_outliers(lake: Lake) -> DataFrame:
    return S.iqr_outliers(quality.provisional_counts(lake.typed(), SPEC), lattice=True)


@_on_lake
def country_top(lake: Lake) -> DataFrame:
    return quality.frequency(lake.bronze(), "country", top=20)


@_on_lake
def source_frequency(lake: Lake) -> DataFrame:
    return quality.frequency(lake.bronze(), "source")


# -- silver -----------------------------------------------------------------


@_on_lake
def exclusion_funnel(lake: Lake) -> DataFrame:
    return cleaning.exclusion_funnel(lake.typed(), SPEC)


@_on_lake
def retention(lake: Lake) -> DataFrame:
    return cleaning.retention(lake.bronze(), lake.silver())


@_on_lake
def silver_range(lake: Lake) -> DataFrame:
    return cleaning.value_range(lake.silver(), SPEC)


@_on_lake
def surrogate_id(lake: Lake) -> DataFrame:
    return lake.silver().select(KEY, star.ID)


@_on_lake
def silver_table(lake: Lake) -> DataFrame:
    return lake.silver().select(star.ID, *ITEMS, "country", "source")


@_on_lake
def preview(lake: Lake) -> DataFrame:
    return lake.preview()


# -- gold -------------------------------------------------------------------


@_on_lake
def dim_item(lake: Lake) -> DataFrame:
    return analysis.item_dictionary(lake.items(), lake.silver(), SPEC)


@_on_lake
def dim_profile(lake: Lake) -> DataFrame:
    return analysis.profile_dictionary(lake.profiles(), lake.scores())


@_on_lake
def dim_respondent(lake: Lake) -> DataFrame:
    return lake.respondents().drop("data_ingestao")


@_on_lake
def responses_long(lake: Lake) -> DataFrame:
    return lake.responses()


@_on_lake
def responses_by_dimension(lake: Lake) -> DataFrame:
    """The same facts with trait and direction joined from the item dimension table."""
    long = star.long_answers(lake.silver(), ITEMS)
    return star.reverse_by_dimension(long, lake.items(), SPEC.lo, SPEC.hi)


@_on_lake
def reverse_audit(lake: Lake) -> DataFrame:
    return star.reverse_audit(lake.silver(), SPEC)


@_on_lake
def trait_scores(lake: Lake) -> DataFrame:
    return star.trait_scores(lake.silver(), SPEC)


@_on_lake
def trait_scores_pivot(lake: Lake) -> DataFrame:
    return star.trait_scores_from_facts(lake.responses(), SPEC)


@_on_lake
def gold_score_summary(lake: Lake) -> DataFrame:
    return _six_digits(S.summary(star.score_counts(lake.scores(), SPEC), lattice=True))


@_on_lake
def cutoffs(lake: Lake) -> DataFrame:
    return lake.cuts()


@_on_lake
def score_profiles(lake: Lake) -> DataFrame:
    return lake.scores()


# -- analysis ---------------------------------------------------------------


@_on_lake
def trait_descriptives(lake: Lake) -> DataFrame:
    return analysis.trait_descriptives(lake.scores(), SPEC)


@_on_lake
def score_bands(lake: Lake) -> DataFrame:
    return analysis.score_bands(lake.scores(), SPEC)


@_on_lake
def lattice_histogram(lake: Lake) -> DataFrame:
    return analysis.lattice_histogram(lake.scores(), lake.cuts(), SPEC)


@_on_lake
def prevalence(lake: Lake) -> DataFrame:
    return analysis.prevalence(lake.scores(), SPEC)


@_on_lake
def co_occurrence(lake: Lake) -> DataFrame:
    return analysis.co_occurrence(lake.scores(), SPEC)


@_on_lake
def trait_correlation(lake: Lake) -> DataFrame:
    return analysis.trait_correlation(lake.scores(), SPEC)


@_on_lake
def correlation_matrix(lake: Lake) -> DataFrame:
    return analysis.trait_correlation_matrix(lake.scores(), SPEC)


@_on_lake
def profile_distribution(lake: Lake) -> DataFrame:
    return analysis.profile_distribution(lake.scores(), lake.profiles())


@_on_lake
def profile_chart(lake: Lake) -> DataFrame:
    return analysis.profile_chart(lake.scores(), lake.profiles())


@_on_lake
def elevated_count_distribution(lake: Lake) -> DataFrame:
    return analysis.elevated_count_distribution(lake.scores(), lake.profiles())


@_on_lake
def elevated_count_sql(lake: Lake) -> DataFrame:
    """The same question as SQL text over the gold tables."""
    lake.scores(), lake.profiles()
    facts, names = (lake.layers.name("gold", t) for t in (L.SCORES, L.PROFILES))
    return lake.spark.sql(f"""
        WITH per_profile AS (SELECT id_perfil, count(*) AS n FROM {facts} GROUP BY id_perfil),
             per_size AS (
               SELECT qtd_tracos_elevados, sum(n) AS qtd_respondentes
               FROM per_profile JOIN {names} USING (id_perfil) GROUP BY ALL)
        SELECT *, round(100 * qtd_respondentes / sum(qtd_respondentes) OVER (), 2) AS percentual
        FROM per_size ORDER BY qtd_tracos_elevados
    """)


@_on_lake
def item_endorsement(lake: Lake) -> DataFrame:
    return analysis.item_endorsement(lake.silver(), lake.items(), SPEC)


@_on_lake
def item_chart(lake: Lake) -> DataFrame:
    return analysis.item_chart(lake.responses(), lake.items())


@_on_lake
def item_chart_panel(lake: Lake) -> DataFrame:
    return analysis.item_chart(lake.responses(), lake.items(), trait=SPEC.traits[1].label)


@_on_lake
def group_means_country(lake: Lake) -> DataFrame:
    return analysis.group_means(lake.scores(), lake.respondents(), "pais_acesso", SPEC, min_size=200)


@_on_lake
def group_means_origin(lake: Lake) -> DataFrame:
    return analysis.group_means(lake.scores(), lake.respondents(), "origem_acesso", SPEC, label=True)


# -- files and catalogue ----------------------------------------------------


@_on_lake
def tsv_roundtrip(lake: Lake) -> DataFrame:
    """The raw answers written as tab-separated files and read back as text."""
    return files.read_delimited(lake.spark, lake.landed(), [KEY, *SPEC.raw_columns])


@_on_lake
def text_head(lake: Lake) -> DataFrame:
    """The first lines of the codebook, which is one file."""
    return files.text_head(lake.spark, lake.codebook())


@_on_lake
def whole_text(lake: Lake) -> DataFrame:
    return files.whole_text(lake.spark, lake.codebook()).select("texto")


@_on_tables
def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.file_manifest(spark, sf_dir).drop("modificado_em")


@_on_lake
def catalog_listing(lake: Lake) -> DataFrame:
    """Every table of every layer, as the catalogue lists them."""
    lake.gold()
    bronze, silver, gold = map(lake.layers.profile, LAYERS)
    return bronze.unionByName(silver).unionByName(gold)


@_on_lake
def table_description(lake: Lake) -> DataFrame:
    lake.scores()
    return lake.layers.column_catalogue("gold", L.SCORES)


# -- loads that come one after the other -------------------------------------

#: Answers of the first two routes are there first, those of the others (or of none) come later.
RAW = [KEY, *SPEC.raw_columns]


def _early(raw: bool = False) -> Column:
    return F.coalesce(F.col("source").isin(*(("1", "2") if raw else (1, 2))), F.lit(False))


@_on_lake
def table_versions(lake: Lake) -> DataFrame:
    """A table replaced by another version of itself, and what changed between the two.

    First the answers as given, then reverse-coded and without codes beyond the scale.
    """
    space = lake.work.inner("versions")
    layers = Layers(lake.spark, f"{lake.layers.prefix}v_", space.root)
    given = lake.silver().select(star.ID, *ITEMS)
    coded = given.where(~C.outside(ITEMS, SPEC.lo, SPEC.hi)).select(star.ID, *[star.corrected(i, SPEC).alias(i) for i in ITEMS])
    for rows in (given, coded):
        layers.save(rows, "silver", "respostas", checks={"ids are distinct": F.count(star.ID) == F.count_distinct(star.ID)})
    old, new = [v.number for v in layers.versions("silver", "respostas").all()][-2:]
    sizes = layers.history("silver", "respostas").select(F.when(F.col("em_uso"), "versao atual").otherwise("versao anterior").alias("situacao"), "registros")
    return layers.changes("silver", "respostas", old, new, star.ID).unionByName(sizes)


@_on_lake
def incremental_landing(lake: Lake) -> DataFrame:
    """The raw answers landed as two drops, each by a run of its own over one checkpoint."""
    space = lake.work.inner("landing")
    rows = lake.bronze().select(*RAW)
    landing = Landing(lake.spark, f"{space.root}/drops/*", f"{space.root}/bronze", RAW)
    for name, part in (("a", _early(raw=True)), ("b", ~_early(raw=True))):
        files.write_delimited(rows.where(part), f"{space.root}/drops/{name}")
        landing.run()
    return landing.rows().select(*RAW)


@_on_lake
def stable_ids(lake: Lake) -> DataFrame:
    """Ids of the respondents after a first load, and after a second one that has all of them."""
    rows, space = lake.silver().select(KEY, "source"), lake.work.inner("ids")
    known = IdMap(lake.spark, space.path("map"), [KEY])
    parts = range_parts(rows.count(), int(lake.spark.conf.get("spark.sql.shuffle.partitions")))
    first = known.add(rows.where(_early()), 1, space, parts)
    known.add(rows, 2, space, parts)
    return known.assign(rows.select(KEY)).join(first.withColumnRenamed(star.ID, "id_primeira_carga"), KEY, "left").select(KEY, "id_primeira_carga", star.ID)


@_on_lake
def growing_profiles(lake: Lake) -> DataFrame:
    """Profiles after two refreshes of a lake that reads new files only."""
    space, rows = lake.work.inner("growing"), lake.bronze().select(*RAW)
    landing = Landing(lake.spark, f"{space.root}/drops/*", f"{space.root}/bronze", RAW)
    grown = GrowingLake(landing, f"{space.root}/lake", SPEC, keys=[KEY])
    for name, part in (("a", _early(raw=True)), ("b", ~_early(raw=True))):
        files.write_delimited(rows.where(part), f"{space.root}/drops/{name}")
        grown.refresh()
    return analysis.profile_distribution(grown.scores(), lake.profiles())


PRICE_PROBS = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}


@_on_tables
def sketched_price_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price cuts per return flag from the sketches of two loads, held against the exact ranks."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    flag, cols = "l_returnflag", {"preco": "l_extendedprice"}
    stored = LoadFolder(spark, Workspace(spark, "sketches").path("prices"))
    for load, status in enumerate(("F", "O"), 1):
        stored.write(load, state.sketches(lines.where(F.col("l_linestatus") == status), cols, [flag]))
    kept = stored.read()
    cuts = state.quantiles(state.merged_sketches(kept, [flag]), PRICE_PROBS, [flag])
    off = state.rank_errors(lines, cols, cuts, PRICE_PROBS, flag)
    sizes = kept.groupBy(flag).agg(F.count(F.lit(1)).alias("cargas"))
    return off.join(sizes, flag).select(flag, "n", "cargas", (F.greatest(*PRICE_PROBS) <= state.RANK_ERROR).alias("dentro_do_erro"))


def _score_loads(lake: Lake) -> DataFrame:
    """Moments of the scores of two loads."""
    scores = star.trait_scores(lake.silver(), SPEC, keep=[star.ID, "source"])
    stored = LoadFolder(lake.spark, lake.work.path("moments"))
    cols = {t.label: t.score_column for t in SPEC.traits}
    for load, part in enumerate((_early(), ~_early()), 1):
        stored.write(load, state.moments(scores.where(part), cols))
    return state.merged(stored.read())


@_on_lake
def refreshed_descriptives(lake: Lake) -> DataFrame:
    """Mean, deviation and range of the scores from the stored moments of two loads."""
    return state.descriptives(_score_loads(lake)).withColumns({c: F.round(c, 6) for c in ("media", "desvio_padrao")})


@_on_lake
def refreshed_correlation(lake: Lake) -> DataFrame:
    """Correlation of the scores from the same moments."""
    return state.correlations(_score_loads(lake)).withColumn("correlacao", F.round("correlacao", 6))


@_on_lake
def observed_funnel(lake: Lake) -> DataFrame:
    """The exclusion funnel as the write of silver counted it; nothing is scanned for it."""
    return lake.funnel().drop("removidos_dominio")


@_on_lake
def ragged_lines(lake: Lake) -> DataFrame:
    """Whole lines and rejected ones with the reason, from files with lines too short and too long.

    Lines of route 4 lack their last field, those with an empty place have one too many.
    """
    space = lake.work.inner("ragged")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in RAW]
    short, long = F.col("source") == "4", F.coalesce(F.col("country") == "", F.lit(False))
    line = F.when(short, F.concat_ws("\t", *fields[:-1])).when(long, F.concat_ws("\t", *fields, F.lit("mais"))).otherwise(F.concat_ws("\t", *fields))
    # One column whose name is the header line, and neither quotes nor separators of its own.
    text = lake.bronze().select(line.alias("\t".join(RAW)))
    text.write.option("header", True).option("sep", "\u0001").option("quote", "").csv(f"{space.root}/lines")
    rows, rejects = files.split_ragged(lake.spark, f"{space.root}/lines", f"{space.root}/split", RAW)
    parts = rows.select(F.lit("linha inteira").alias(files.REASON)).unionAll(rejects.select(files.REASON))
    return parts.groupBy(files.REASON).agg(F.count(F.lit(1)).alias("linhas"))


@_on_lake
def schema_versions(lake: Lake) -> DataFrame:
    """Files of two headers in one bronze: the first lack the route, the second have it in front."""
    space, rows = lake.work.inner("headers"), lake.bronze().select(*RAW)
    files.write_delimited(rows.where(_early(raw=True)).drop("source"), f"{space.root}/drops/a")
    files.write_delimited(rows.where(~_early(raw=True)).select("source", *[c for c in RAW if c != "source"]), f"{space.root}/drops/b")
    found = files.read_versions(lake.spark, f"{space.root}/drops")
    return found.select(*RAW, F.col(files.SCHEMA_VERSION).alias("versao_esquema"))


@_on_lake
def low_variability(lake: Lake) -> DataFrame:
    """Respondents whose answers hardly vary, by their deviation or by a run of equal answers."""
    found = quality.low_variability(lake.typed(), ITEMS, SPEC.missing, keep=[KEY])
    return found.withColumn("desvio_linha", F.round("desvio_linha", 6))


@_on_lake
def score_bands_sql(lake: Lake) -> DataFrame:
    """Score bands asked in SQL, with the band as a function of the session."""
    lake.scores()
    sql_functions.register(lake.spark, SPEC)
    scores = ", ".join(f"'{t.label}', {t.score_column}" for t in SPEC.traits)
    return lake.spark.sql(f"""
        SELECT traco, faixa_escore(valor, 2) AS faixa, count(*) AS qtd,
               round(100 * count(*) / sum(count(*)) OVER (PARTITION BY traco), 2) AS percentual
        FROM (SELECT stack({len(SPEC.traits)}, {scores}) AS (traco, valor) FROM {lake.layers.name("gold", L.SCORES)})
        GROUP BY ALL
    """)


@_on_lake
def item_endorsement_sql(lake: Lake) -> DataFrame:
    """Item ranking asked in SQL over the answers as given, reverse-coded by a function of the session."""
    lake.responses(), lake.items()
    sql_functions.register(lake.spark, SPEC)
    facts, names = (lake.layers.name("gold", t) for t in (L.RESPONSES, L.ITEMS))
    return lake.spark.sql(f"""
        WITH given AS (SELECT id_item, resposta_corrigida(id_item, resposta_original) AS valor FROM {facts}),
             per_item AS (
               SELECT id_item, avg(valor) AS media, avg(CAST(valor >= 4 AS INT)) AS parte FROM given GROUP BY id_item)
        SELECT traco, id_item, texto_item, item_invertido(id_item) AS invertido,
               round(media, 2) AS media_corrigida, round(100 * parte, 2) AS pct_concordancia
        FROM per_item JOIN {names} USING (id_item) ORDER BY traco, media_corrigida DESC
    """)


# -- the same operators on other supplied tables ----------------------------


@_on_tables
def iqr_outliers_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price outliers per return flag; prices are whole cents, so they repeat."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    counts = S.grouped_value_counts(lines, "l_returnflag", "l_extendedprice")
    return S.iqr_outliers(counts, "l_returnflag", digits=6)


@_on_tables
def price_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    counts = S.grouped_value_counts(lines, "l_returnflag", "l_extendedprice")
    return S.summary(counts, "l_returnflag").withColumns({c: F.round(c, 4) for c in ("media", "desvio_padrao", "mediana")})


@_on_tables
def correlation_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    pairs = {
        "l_quantity × l_extendedprice": ("l_quantity", "l_extendedprice"),
        "l_quantity × l_discount": ("l_quantity", "l_discount"),
        "l_discount × l_tax": ("l_discount", "l_tax"),
    }
    return S.correlations(lines, pairs, name="par")


@_on_tables
def missing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    nulls = {"nulos": lambda c: F.count_if(F.col(c).isNull())}
    return S.profile_columns(events, events.columns, nulls, total="total")


def all_queries() -> dict[str, Query]:
    return dict(_registry)
