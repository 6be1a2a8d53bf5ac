import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from compare import duck, rows_of  # noqa: E402
from ridgeline.llm import queries  # noqa: E402

SF001 = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    df = E.queries()[name](spark, SF001)
    cur = duck(SF001).execute(E.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cur.fetchall())


def test_jaccard_query_matches_all_pairs(spark):
    from helpers import components
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in E.queries()["op8_jaccard_join"](spark, SF001).collect())
    assert got == sorted(components([tuple(r) for r in docs]))
