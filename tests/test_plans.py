"""Plans that must keep their shape to survive large data."""

import re
import time

import pytest

from likertlake.instrument import SHORT_FORM_27 as SPEC
from likertlake.operators import analysis, cleaning, quality, star
from likertlake.operators import statistics as S


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def scans(df):
    """Scans of rows in the plan as it ran, reuse included."""
    df.collect()
    ran = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return len([x for x in ran.splitlines() if "FileScan" in x and "corte_traco" not in x and "dim_item" not in x])


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_scan_per_multi_trait_question(lake, no_broadcast):
    scores, typed = lake.scores(), lake.typed()
    for df in (
        analysis.trait_descriptives(scores, SPEC),
        analysis.prevalence(scores, SPEC),
        analysis.co_occurrence(scores, SPEC),
        analysis.trait_correlation(scores, SPEC),
        analysis.trait_correlation_matrix(scores, SPEC),
        S.summary(quality.provisional_counts(typed, SPEC)),
        S.iqr_outliers(quality.provisional_counts(typed, SPEC)),
        analysis.lattice_histogram(scores, lake.cuts(), SPEC),
        star.cutoffs(star.trait_scores(lake.silver(), SPEC), SPEC),
        quality.missing_profile(typed, SPEC.item_ids),
        quality.domain_profile(typed, SPEC.item_ids),
        cleaning.exclusion_funnel(typed, SPEC),
        analysis.score_bands(scores, SPEC),
        analysis.item_chart(lake.responses(), lake.items()),
        star.trait_scores_from_facts(lake.responses(), SPEC),
    ):
        assert scans(df) == 1


def test_row_local_steps_do_not_shuffle(lake):
    typed = lake.typed()
    for df in (
        cleaning.clean(typed, SPEC),
        quality.provisional_scores(typed, SPEC),
        quality.domain_violations(typed, SPEC.item_ids, 0, 5),
        star.trait_scores(lake.silver(), SPEC),
        star.response_facts(lake.silver(), SPEC),
        star.score_profiles(star.trait_scores(lake.silver(), SPEC), lake.cuts(), SPEC),
        star.dim_respondent(lake.silver(), SPEC),
    ):
        assert "Exchange" not in plan(df).split("Subquery")[0]


def test_respondent_join_is_colocated(lake, no_broadcast):
    df = analysis.group_means(lake.scores(), lake.respondents(), "pais_acesso", SPEC)
    text = plan(df)
    assert "SortMergeJoin" in text
    below = text[text.index("SortMergeJoin") :]
    assert "Exchange" not in below


def test_respondent_facts_are_never_broadcast_by_hint(lake, no_broadcast):
    for df in (
        analysis.group_means(lake.scores(), lake.respondents(), "origem_acesso", SPEC),
        analysis.lattice_histogram(lake.scores(), lake.cuts(), SPEC),
    ):
        for line in plan(df).splitlines():
            assert not ("BroadcastExchange" in line and "escore_" in line)


def test_only_needed_columns_are_read(lake):
    text = plan(analysis.group_means(lake.scores(), lake.respondents(), "pais_acesso", SPEC))
    assert "id_perfil" not in text and "elevado_" not in text and "data_ingestao" not in text


def test_a_panel_reads_its_partition_only(lake):
    text = plan(analysis.item_chart(lake.responses(), lake.items(), trait="Narcisismo"))
    assert re.search(r"PartitionFilters: \[[^\]]*traco#\d+ = Narcisismo", text)


def test_scores_from_facts_do_not_shuffle(lake):
    assert "Exchange" not in plan(star.trait_scores_from_facts(lake.responses(), SPEC))


def test_diagnosis_reads_numbers(lake):
    for df in (quality.missing_profile(lake.typed(), SPEC.item_ids), quality.domain_profile(lake.typed(), SPEC.item_ids)):
        text = plan(df)
        assert "M1:int" in text and "cast(M1" not in text


def test_no_value_is_joined_or_ordered_by_its_group_alone(spark, sf_dir, no_broadcast):
    """Above the value counts every join or window has a key besides the group."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    counts = S.grouped_value_counts(lines, "l_returnflag", "l_extendedprice")
    for df in (S.iqr_outliers(counts, "l_returnflag"), S.summary(counts, "l_returnflag")):
        tree = df._jdf.queryExecution().optimizedPlan()
        stack = [tree]
        while stack:
            node = stack.pop()
            children = [node.children().apply(i) for i in range(node.children().size())]
            stack += children
            if node.nodeName() in ("Join", "Window"):
                # a side of single values would show its value column next to n
                sides = [c for c in children if {"valor", "n"} <= {a.name() for a in _output(c)}]
                if sides:
                    text = node.simpleString(10_000)
                    assert "_copy" in text or "_cell" in text or "_part" in text, text


def _output(node):
    out = node.output()
    return [out.apply(i) for i in range(out.size())]


def test_preview_does_not_sort_the_table(lake):
    assert re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(id_respondente,10\)", plan(lake.preview()))


def test_no_window_over_rows_runs_in_one_task(lake):
    """Every window sits on an aggregate, none on the rows of a table."""
    for df in (
        analysis.profile_distribution(lake.scores(), lake.profiles()),
        S.summary(quality.provisional_counts(lake.typed(), SPEC)),
    ):
        steps = re.findall(r"\b(Window|HashAggregate|FileScan)\b", plan(df))
        assert "Window" in steps
        for i, step in enumerate(steps):
            if step == "Window":
                below = steps[i:]
                assert below.index("HashAggregate") < below.index("FileScan")


def test_no_python_and_no_cross_join_anywhere(spark, sf_dir):
    from likertlake.plans.queries import all_queries

    for name, query in all_queries().items():
        text = plan(query(spark, sf_dir))
        for word in ("Python", "Pandas", "CartesianProduct", "NestedLoop"):
            assert word not in text, (name, word)


def test_grouped_outliers_count_the_rows_once(spark, sf_dir, no_broadcast):
    """Three uses of one aggregate share its exchange at run time."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    counts = S.grouped_value_counts(lines, "l_returnflag", "l_extendedprice")
    assert scans(S.iqr_outliers(counts, "l_returnflag", digits=6)) == 1


def test_lazy_chain_from_text_to_long_facts_plans_quickly(lake, spark):
    start = time.time()
    silver = cleaning.clean(cleaning.typed(lake.bronze(), SPEC, ["src_row"]), SPEC)
    silver = silver.withColumnRenamed("src_row", "id_respondente")
    long = star.reverse_by_dimension(
        star.long_answers(silver, SPEC.item_ids), star.dim_item(spark, SPEC), SPEC.lo, SPEC.hi
    )
    text = plan(long)
    assert time.time() - start < 20
    # each item is cast once: the filter stays above the casts
    assert text.count("try_cast(M1#") == 1
