"""Every query against the independent SQL engine, on whole tables."""

import pytest
from __spark_entry__ import entry
from parity import connect, difference

from likertlake.plans.oracle import all_oracles
from likertlake.plans.queries import all_queries

ORACLES, QUERIES = all_oracles(), all_queries()
WITHOUT_SQL = {"file_manifest"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql_or_a_known_reason():
    assert set(ORACLES) | WITHOUT_SQL == set(QUERIES)
    assert not set(ORACLES) & WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_the_oracle_is_independent():
    import likertlake.plans.oracle as oracle

    assert "likertlake" not in "".join(x for x in open(oracle.__file__, encoding="utf-8") if "import" in x)


def test_entry_is_the_profile_distribution(spark):
    rows = entry(spark).collect()
    assert rows and sum(r.qtd_respondentes for r in rows) > 1000


def test_text_head_starts_with_the_first_item(spark, sf_dir):
    rows = [r.linha for r in QUERIES["text_head"](spark, sf_dir).collect()]
    assert len(rows) == 3 and rows[0].startswith("M1\t")


def test_file_manifest_lists_every_table(spark, sf_dir):
    rows = {r.arquivo: r for r in QUERIES["file_manifest"](spark, sf_dir).collect()}
    assert "orders.parquet" in rows and rows["orders.parquet"].bytes > 0
