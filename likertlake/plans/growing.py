"""A lake that only ever reads new rows.

Each refresh lands what has arrived and makes one load of it: its valid respondents with their ids, and small
mergeable results (value counts, moments, sketches, the funnel). Earlier loads are not read, nor is anything
rewritten. Scores and facts are row-local, so they are made from the stored respondents when asked for; cuts and
statistics come from the merged small results, and so are those of all respondents.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from likertlake.instrument import SHORT_FORM_27, Instrument
from likertlake.operators import cleaning, star, state
from likertlake.operators import statistics as S
from likertlake.operators.ids import IdMap
from likertlake.plans.lake import range_parts
from likertlake.session import Workspace, tuned
from likertlake.sources import files
from likertlake.sources.loads import LOAD, LoadFolder
from likertlake.streaming.landing import Landing

PARTS, SILVER, COUNTS, MOMENTS, SKETCHES, FUNNEL = "arquivos", "respostas", "contagens", "momentos", "esbocos", "funil"


class GrowingLake:
    """Loads of one landing, kept below ``root`` in shared storage.

    ``keys`` identify a respondent: the place in the landed files, or columns of the header. One whose
    key an earlier load has is not taken again. A load counts once its last result, the funnel, is whole; one that was
    killed before is made again from the same files, and until then no reader sees any of it.
    """

    def __init__(
        self, landing: Landing, root: str, spec: Instrument = SHORT_FORM_27, keys: Sequence[str] = files.FILE_ORDER, drop_out_of_domain: bool = False
    ) -> None:
        if absent := set(spec.raw_columns) - set(landing.columns):
            raise ValueError(f"the header lacks {sorted(absent)}")
        self.spark, self.landing, self.spec, self.keys = landing.spark, landing, spec, list(keys)
        self.drop_out_of_domain, self.root = drop_out_of_domain, root.rstrip("/")
        self.stored = {name: LoadFolder(self.spark, f"{self.root}/{name}") for name in (PARTS, SILVER, COUNTS, MOMENTS, SKETCHES, FUNNEL)}
        self.known = IdMap(self.spark, f"{self.root}/ids", self.keys, star.ID)
        self.scores_by_label = {t.label: t.score_column for t in spec.traits}

    # -- a load -------------------------------------------------------------

    def loads(self) -> list[int]:
        return self.stored[FUNNEL].loads()

    def refresh(self) -> int | None:
        """Take what has arrived since the last refresh; the number of its load, or None if there was nothing."""
        with tuned(self.spark):
            return self._refresh()

    def _refresh(self) -> int | None:
        self.landing.run()
        load = max(self.loads(), default=0) + 1
        if load not in self.stored[PARTS].loads():
            taken = self.stored[PARTS].read(load)
            before = {r.arquivo for r in taken.collect()} if taken is not None else set()  # names, as in a listing
            new = [(p,) for p in self.landing.parts() if p not in before]
            if not new:
                return None
            self.stored[PARTS].write(load, self.spark.createDataFrame(new, "arquivo string").coalesce(1))
        self._add(load, [r.arquivo for r in self.stored[PARTS].read(load + 1).where(F.col(LOAD) == load).collect()])
        return load

    def _add(self, load: int, parts: list[str]) -> None:
        space, counted = Workspace(self.spark, "load"), Observation()
        try:
            typed = cleaning.typed(self.landing.rows(parts), self.spec, [*self.keys, files.INGESTED])
            valid = space.cut(cleaning.clean_observed(typed, self.spec, counted, self.drop_out_of_domain), "valid")
            wanted = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            ids = self.known.add(valid, load, space, range_parts(valid.count(), wanted))
            same = [F.col(f"v.`{k}`").eqNullSafe(F.col(f"i.`{k}`")) for k in self.keys]
            numbered = valid.alias("v").join(ids.alias("i"), same).select(F.col(f"i.`{star.ID}`"), "v.*")
            silver = self.stored[SILVER].write(load, numbered)
            scores = star.trait_scores(silver, self.spec)
            self.stored[COUNTS].write(load, star.score_counts(scores, self.spec))
            self.stored[MOMENTS].write(load, state.moments(scores, self.scores_by_label))
            self.stored[SKETCHES].write(load, state.sketches(scores, self.scores_by_label))
            found = counted.get
            self.stored[FUNNEL].write(load, self.spark.createDataFrame([tuple(found.values())], ", ".join(f"{c} bigint" for c in found)))
        finally:
            space.drop()

    # -- what all loads say ---------------------------------------------------

    def _read(self, name: str) -> DataFrame:
        done = max(self.loads(), default=0)
        found = self.stored[name].read(done + 1) if done else None
        if found is None:
            raise LookupError("no load yet")
        return found

    def silver(self) -> DataFrame:
        """Valid respondents of all loads, with the number of their load."""
        return self._read(SILVER)

    def respondents(self) -> DataFrame:
        return star.dim_respondent(self.silver(), self.spec)

    def responses(self) -> DataFrame:
        return star.response_facts(self.silver(), self.spec)

    def value_counts(self) -> DataFrame:
        return self._read(COUNTS).groupBy("traco", "valor").agg(F.sum("n").alias("n"))

    def cuts(self, prob: float = 0.75) -> DataFrame:
        """Exact sample quantiles, from the merged value counts."""
        return S.quantiles(self.value_counts(), {"corte": prob}, lattice=True)

    def sketched_cuts(self, probs: Mapping[str, float]) -> DataFrame:
        """The same with an error of rank, from sketches of a fixed size."""
        return state.quantiles(state.merged_sketches(self._read(SKETCHES)), probs)

    def scores(self) -> DataFrame:
        """Scores, flags and profiles of all respondents against the cuts of all loads."""
        return star.score_profiles(star.trait_scores(self.silver(), self.spec), self.cuts(), self.spec)

    def moments(self) -> DataFrame:
        return state.merged(self._read(MOMENTS))

    def descriptives(self) -> DataFrame:
        return state.descriptives(self.moments())

    def correlations(self) -> DataFrame:
        return state.correlations(self.moments())

    def funnel(self) -> DataFrame:
        """Rows lost at each exclusion, over all loads."""
        rows = self._read(FUNNEL)
        return rows.agg(*[_total(c) for c in rows.columns if c != LOAD])


def _total(c: str) -> Column:
    return F.sum(c).alias(c)
