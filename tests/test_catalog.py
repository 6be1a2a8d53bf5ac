"""Differential layer: every catalog query against its DuckDB oracle at
sf0.001 (the driver repeats this at sf0.01)."""

import os
import sys

import pytest

from sf_paths import SF001

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from compare import duck, rows_of  # noqa: E402

from ridgeline.plans import catalog  # noqa: E402

NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    missing = set(NAMES) - set(E.oracle_sql())
    assert set(NAMES) <= set(E.queries())
    assert not missing, f"queries without oracle SQL: {sorted(missing)}"


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF001)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["weekend", "parent_id", "rank", "area_id", "area_name", "avg_score", "min_score",
                          "max_score", "n_hours"]
    assert df.count() > 0


def test_no_query_plans_a_nested_loop_or_cartesian_join(spark):
    bad = []
    for name in NAMES:
        fn = E.queries()[name]
        plan = fn(spark, SF001)._jdf.queryExecution().executedPlan().toString()
        if "NestedLoop" in plan or "Cartesian" in plan:
            bad.append(name)
    assert not bad, f"pair-emitting joins in: {bad}"
