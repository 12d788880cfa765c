"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry
from wattline import oracles
from wattline import queries as registry

QUERIES = registry.queries()
ORACLES = oracles.oracle_sql()
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in ORACLES:
        assert compare.differences(df, con, ORACLES[name]) == []
    else:
        assert df.count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert {"bucket_start", "machine_id", "availability", "performance", "quality", "oee"} <= set(df.columns)
    assert df.count() > 0


@pytest.mark.parametrize("name", ["regression_summary_by_machine", "scan_summary_json_by_machine"])
def test_summaries_by_machine_have_every_section_of_each_machine(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).select("target", "machine_id", "section").distinct().collect()
    fitted = QUERIES["model_status"](spark, sf_dir).filter("model_type = 'gamma_glm' AND status = 'ok'")
    groups = {(r.target, r.machine_id) for r in fitted.collect()}
    sections = ["metrics", "significant_coefficients", "sensitivity", "univariate_gamma_glm", "vif"]
    assert {tuple(r) for r in rows} == {(*group, section) for group in groups for section in sections}
    assert len({machine for _, machine in groups}) > 1
