"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import difference, oracle_frame

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_matches_sql(spark, name):
    ours = queries()[name](spark, SF).toPandas()
    assert difference(ours, oracle_frame(oracle_sql()[name], SF)) is None


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", ["split", "split_temporal", "cpd_breakpoints", "inference_sample", "drift_report_recent"])
def test_query_without_sql_runs(spark, name):
    assert queries()[name](spark, SF).count() > 0
