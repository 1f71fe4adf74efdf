"""The layered pipeline: raw text, clean respondents, star schema.

Every table is written once, on first use, and read by everything downstream. The
written tables are also the lineage cuts: a lost executor costs a re-read.
"""

from __future__ import annotations

import hashlib
import json
import math
import threading
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from likertlake.functions.columns import PackedVector
from likertlake.instrument import SHORT_FORM_27, Instrument
from likertlake.operators import cleaning, ids, quality, star
from likertlake.session import Workspace, application_id, tuned
from likertlake.sources import files, survey
from likertlake.sources.tables import Layers
from likertlake.streaming.landing import Landing

BRONZE, TYPED, SILVER = "respostas_brutas", "respostas_tipadas", "respostas"
ITEMS, RESPONDENTS, PROFILES = "dim_item", "dim_respondente", "dim_perfil"
RESPONSES, SCORES, CUTS = "fato_resposta_item", "fato_escore_respondente", "corte_traco"

COMMENTS = {
    BRONZE: "Raw answers exactly as read, all text, with load time and source file.",
    TYPED: "All answers as numbers, text that is none as null; nobody left out.",
    SILVER: "Valid respondents, one row each, answers as numbers in their original direction.",
    ITEMS: "What each question asks, which trait it counts for and in which direction.",
    RESPONDENTS: "Who answered: place and route of access, with the route spelled out.",
    PROFILES: "Names of the possible sets of elevated traits.",
    RESPONSES: "One row per respondent and question, before and after reverse coding.",
    SCORES: "Trait scores of each respondent, which of them are elevated, and the profile.",
    CUTS: "Score of each trait that three quarters of the respondents do not exceed.",
}

COLUMN_NOTES = {
    "id_respondente": "dense number, 1 to the row count",
    "id_item": "column of the raw file",
    "traco": "trait label",
    "texto_item": "question as shown",
    "invertido": "agreement lowers the trait",
    "pais_acesso": "place the answer came from, trimmed",
    "id_origem": "route code of the raw file",
    "origem_acesso": "route label",
    "data_ingestao": "load time of the raw row",
    "resposta_original": "answer as given",
    "resposta_corrigida": "answer in the direction of the trait",
    "escore_maquiavelismo": "mean corrected answer, four decimals",
    "escore_narcisismo": "mean corrected answer, four decimals",
    "escore_psicopatia": "mean corrected answer, four decimals",
    "elevado_maquiavelismo": "score strictly above the cut",
    "elevado_narcisismo": "score strictly above the cut",
    "elevado_psicopatia": "score strictly above the cut",
    "id_perfil": "elevated traits as bits, first trait highest",
    "descricao_perfil": "profile label",
    "qtd_tracos_elevados": "bits set in the profile",
    "corte": "75 % sample quantile, discrete",
}

# Property of the silver table with the counts of its write.
FUNNEL = "likertlake.funil"

# Rows per range of the dense id: small ranges to use every core on small data, else
# ranges that a task sorts in memory. Their number has no limit.
SMALL_PART, LARGE_PART = 20_000, 8_000_000
# Respondents in a bucket: a task sorts their answers, 27 rows each. Spark takes no more buckets than the second number.
BUCKET_ROWS, MOST_BUCKETS = 150_000, 100_000


def range_parts(rows: int, wanted: int) -> int:
    small = max(1, math.ceil(rows / SMALL_PART))
    return max(math.ceil(rows / LARGE_PART), min(wanted, small))


def bucket_count(rows: int, least: int) -> int:
    return max(least, min(MOST_BUCKETS, math.ceil(rows / BUCKET_ROWS)))


class Lake:
    def __init__(
        self,
        spark: SparkSession,
        raw: Callable[[], DataFrame],
        order_by: Sequence[str],
        layers: Layers,
        work: Workspace,
        spec: Instrument = SHORT_FORM_27,
        keep: Sequence[str] = (),
        names: Mapping[str, str] | None = None,
        drop_out_of_domain: bool = False,
        attach: bool = False,
        known: ids.IdMap | None = None,
    ) -> None:
        """``raw`` yields the text rows with lineage columns; ``order_by`` identifies a row.

        ``keep`` names order columns that stay in the silver table; ``names`` gives
        tables other names than the defaults above. ``drop_out_of_domain`` also leaves
        answers beyond the scale out of silver. With ``attach``, tables that exist are
        taken as they are, also where only their files do, and only missing ones are built: a build
        that was killed goes on after its last whole table. With ``known``, respondents keep the ids of
        earlier loads, and those who are new are numbered after them. The session's settings are
        left alone but for the time of a write, which has those of ``session.tuned``.
        """
        self.spark, self.raw, self.spec = spark, raw, spec
        self.drop_out_of_domain, self.attach, self.known = drop_out_of_domain, attach, known
        self.order_by, self.layers, self.work = list(order_by), layers, work
        self.keep, self.names = list(keep), dict(names or {})
        self._lock = threading.RLock()
        self._built: set[str] = set()
        self._rows: int | None = None
        self._landed: str | None = None
        self._codebook: str | None = None
        self._vectors: DataFrame | None = None

    def _table(
        self,
        layer: str,
        name: str,
        build: Callable[[], DataFrame],
        bucketed: bool = False,
        partition_by: str | None = None,
        checks: Mapping[str, Column] | None = None,
    ) -> DataFrame:
        with self._lock:
            target = self.names.get(name, name)
            if name in self._built and self.layers.exists(layer, target):
                return self.layers.read(layer, target)
            if self.attach and (self.layers.exists(layer, target) or self.layers.recover(layer, target)):
                self._built.add(name)
                return self.layers.read(layer, target)
            with tuned(self.spark):
                df = build()
                notes = {c: COLUMN_NOTES[c] for c in df.columns if layer == "gold" and c in COLUMN_NOTES}
                saved = self.layers.save(
                    df, layer, target, COMMENTS[name], notes, star.ID if bucketed else None, partition_by, checks,
                    self._buckets() if bucketed else None,
                )
            self._built.add(name)
            return saved

    def _raw_rows(self) -> int:
        """The raw rows, counted once, from file footers."""
        bronze = self.bronze()
        if self._rows is None:
            self._rows = bronze.count()
        return self._rows

    def _parts(self) -> int:
        """Ranges for the id."""
        return range_parts(self._raw_rows(), int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    def _buckets(self) -> int:
        """Files of a table of respondents: those of silver, so that all of them join without a shuffle."""
        if SILVER in self._built:
            return self.layers.buckets_of("silver", self.names.get(SILVER, SILVER))
        return bucket_count(self._raw_rows(), self.layers.buckets)

    # -- layers -------------------------------------------------------------

    def bronze(self) -> DataFrame:
        return self._table("bronze", BRONZE, self.raw)

    def typed(self) -> DataFrame:
        """Bronze with numbers as numbers, written once: diagnosis reads it many times."""
        keep = [*self.order_by, files.INGESTED]
        return self._table("bronze", TYPED, lambda: cleaning.typed(self.bronze(), self.spec, keep))

    def vectors(self) -> DataFrame:
        """The typed answers of each row as packed words, written once: checks of uniqueness group them.

        Packing 27 columns and grouping fuse into a method that the JVM never compiles, unless the session
        is tuned; written, the packing is a stage of its own with the settings of a write.
        """
        with self._lock:
            typed = self.typed()
            if self._vectors is None:
                with tuned(self.spark):
                    self._vectors = self.work.cut(quality.packed(self.spec).pack(typed), "vectors")
            return self._vectors

    def silver(self) -> DataFrame:
        """Valid respondents with a dense id, bucketed on it.

        Answers travel through both shuffles and the staging write as packed
        vectors, a quarter of the bytes of 27 columns.
        """

        built = []

        def build() -> DataFrame:
            built.append(True)
            context = [*self.spec.context, files.INGESTED]
            valid = cleaning.clean_observed(self.typed(), self.spec, counts, self.drop_out_of_domain)
            answers = PackedVector(self.spec.item_ids, min(self.spec.lo, self.spec.missing), self.spec.hi)
            # Range partitioning samples its input in a pass of its own; written down,
            # that pass reads a few compact columns instead of cleaning twice.
            slim = staging.cut(answers.pack(valid, [*self.order_by, *context]), "valid")
            if self.known is None:
                numbered = ids.dense_id(slim, self.order_by, staging, self._parts(), star.ID)
            else:
                self.known.add(slim, max(self.known.stored.loads(), default=0) + 1, staging, self._parts())
                numbered = self.known.assign(slim)
            placed = numbered.select(star.ID, *answers.names, *context, *self.keep)
            return placed.repartition(self._buckets(), star.ID).select(
                star.ID, *answers.unpack(), *context, *self.keep
            )

        # Ids of respondents who are gone by now leave gaps among those that are kept.
        one_each = F.count(F.lit(1)) == (F.max(star.ID) if self.known is None else F.count_distinct(star.ID))
        counts = Observation()
        staging = self.work.inner("staging")
        try:
            saved = self._table("silver", SILVER, build, bucketed=True, checks={"every respondent has an id of their own": one_each})
            if built:
                name = self.layers.name("silver", self.names.get(SILVER, SILVER))
                self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{FUNNEL}' = '{json.dumps(counts.get)}')")
            return saved
        finally:
            staging.drop()

    def funnel(self) -> DataFrame:
        """Rows lost at each exclusion, as counted by the write of silver and kept with the table.

        No row is read. Tables that have no such counts are diagnosed from the typed rows.
        """
        self.silver()
        name = self.layers.name("silver", self.names.get(SILVER, SILVER))
        kept = {r.key: r.value for r in self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        if FUNNEL not in kept:
            return cleaning.exclusion_funnel(self.typed(), self.spec)
        counts = json.loads(kept[FUNNEL])
        return self.spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} bigint" for c in counts))

    def items(self) -> DataFrame:
        return self._table("gold", ITEMS, lambda: star.dim_item(self.spark, self.spec).coalesce(1))

    def profiles(self) -> DataFrame:
        return self._table("gold", PROFILES, lambda: star.dim_profile(self.spark, self.spec).coalesce(1))

    def respondents(self) -> DataFrame:
        return self._table(
            "gold", RESPONDENTS, lambda: star.dim_respondent(self.silver(), self.spec), bucketed=True
        )

    def responses(self) -> DataFrame:
        """The long facts, a folder for each trait and bucketed inside: a panel reads its
        trait only, and grouping by respondent does not shuffle."""
        facts = self._table(
            "gold", RESPONSES, lambda: star.response_facts(self.silver(), self.spec), True, partition_by="traco"
        )
        return facts.select(star.ID, "id_item", "traco", "resposta_original", "resposta_corrigida")

    def cuts(self) -> DataFrame:
        def build() -> DataFrame:
            return star.cutoffs(star.trait_scores(self.silver(), self.spec), self.spec).coalesce(1)

        return self._table("gold", CUTS, build)

    def scores(self) -> DataFrame:
        def build() -> DataFrame:
            plain = star.trait_scores(self.silver(), self.spec)
            return star.score_profiles(plain, self.cuts(), self.spec)

        return self._table("gold", SCORES, build, bucketed=True)

    def gold(self) -> None:
        for table in (self.items, self.profiles, self.respondents, self.responses, self.scores):
            table()

    def preview(self, rows: int = 10) -> DataFrame:
        """The first respondents. Ids are dense, so a filter finds them without a full sort."""
        first = self.silver().where(F.col(star.ID) <= rows)
        return first.select(star.ID, *self.spec.item_ids).orderBy(star.ID)

    # -- files --------------------------------------------------------------

    def landed(self) -> str:
        """Folder with the raw answers as tab-separated files."""
        with self._lock:
            if self._landed is None:
                path = self.work.path("landed")
                rows = self.bronze().select(*self.keep, *self.spec.raw_columns)
                files.write_delimited(rows, path)
                self._landed = path
            return self._landed

    def codebook(self) -> str:
        """Folder with one text file: a line per item with its observed answers.

        The file has as many lines as the questionnaire has items, at any number
        of respondents, so one task writes it.
        """
        with self._lock:
            if self._codebook is None:
                path = self.work.path("codebook")
                seen = self.value_domain()
                line = F.concat_ws("\t", "campo", "minimo", "maximo", "media_validos")
                ordered = seen.orderBy("campo").select(line.alias("value")).coalesce(1)
                ordered.write.text(path)
                self._codebook = path
            return self._codebook

    def value_domain(self) -> DataFrame:
        return quality.domain_profile(self.typed(), self.spec.item_ids, self.spec.missing)


# -- constructors -----------------------------------------------------------

_lakes: dict[tuple[str, str], Lake] = {}
_lakes_lock = threading.Lock()


def derived_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The lake over the survey derived from ``orders``; one per session and folder."""
    key = (application_id(spark), sf_dir)
    with _lakes_lock:
        if key not in _lakes:
            tag = hashlib.sha256(repr(key).encode()).hexdigest()[:10]
            work = Workspace(spark, f"lake-{tag}")
            layers = Layers(spark, prefix=f"lake_{tag}_", location=work.root)

            def raw() -> DataFrame:
                # Two numbers become 29 texts, and later tables inherit the parts. Those of the scan are what the files
                # allow: a row group is never split, so a compact file is one part.
                orders = survey.read_orders(spark, sf_dir)
                rows = orders.count()
                even = files.with_lineage(orders).select(*survey.SOURCE, files.INGESTED, files.ORIGIN)
                even = even.repartition(range_parts(rows, bucket_count(rows, layers.buckets)), *survey.SOURCE)
                return survey.derive_survey(even, keep=[files.INGESTED, files.ORIGIN])

            _lakes[key] = Lake(spark, raw, [survey.KEY], layers, work, keep=[survey.KEY])
        return _lakes[key]


def file_lake(
    spark: SparkSession,
    path: str,
    layers: Layers,
    spec: Instrument = SHORT_FORM_27,
    names: Mapping[str, str] | None = None,
    corrupt_column: str | None = None,
    drop_out_of_domain: bool = False,
    resume: bool = False,
) -> Lake:
    """The lake over landed tab-separated files, numbered in file and line order.

    Bronze has the columns that the header names, also those beyond the instrument.
    With ``corrupt_column`` lines of the wrong width keep their raw text there. With ``resume`` a build that
    was killed goes on: tables it has finished are not built again.
    """

    def raw() -> DataFrame:
        scan = files.read_delimited(spark, path, corrupt_column=corrupt_column)
        if absent := set(spec.raw_columns) - set(scan.columns):
            raise ValueError(f"the header lacks {sorted(absent)}")
        return files.with_file_order(files.with_lineage(scan))

    work = Workspace(spark, "files")
    return Lake(spark, raw, files.FILE_ORDER, layers, work, spec, names=names, drop_out_of_domain=drop_out_of_domain, attach=resume)


def landing_lake(
    landing: Landing,
    layers: Layers,
    known: ids.IdMap,
    spec: Instrument = SHORT_FORM_27,
    names: Mapping[str, str] | None = None,
    drop_out_of_domain: bool = False,
) -> Lake:
    """The lake over all rows landed so far, in which respondents keep the ids of earlier lakes.

    Land new files and make the lake anew: its tables replace those of the one before, each in one step.
    ``known`` must be keyed by ``files.FILE_ORDER``.
    """
    if absent := set(spec.raw_columns) - set(landing.columns):
        raise ValueError(f"the header lacks {sorted(absent)}")
    if known.keys != list(files.FILE_ORDER):
        raise ValueError(f"ids are to be keyed by {files.FILE_ORDER}")
    work = Workspace(landing.spark, "landing")
    return Lake(landing.spark, landing.rows, files.FILE_ORDER, layers, work, spec, names=names, drop_out_of_domain=drop_out_of_domain, known=known)


def open_lake(
    spark: SparkSession,
    layers: Layers,
    spec: Instrument = SHORT_FORM_27,
    names: Mapping[str, str] | None = None,
) -> Lake:
    """The lake of tables that an earlier run has written; nothing is ingested."""

    def raw() -> DataFrame:
        raise LookupError("these layers hold no raw answers")

    return Lake(spark, raw, files.FILE_ORDER, layers, Workspace(spark, "open"), spec, names=names, attach=True)
