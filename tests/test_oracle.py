"""Every registered query against its DuckDB oracle at sf0.001."""

import contextlib
import io
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_check import canon, duck  # noqa: E402

from __spark_entry__ import entry  # noqa: E402

from starweave.plans.catalog import ORACLES, QUERIES  # noqa: E402

SMALL = "/root/testdata/sf0.001"
Q = dict(QUERIES)
O = dict(ORACLES)


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_an_oracle():
    assert set(Q) == set(O)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["event_id", "competition_nm", "program_nm", "element_nm", "entries_ct"]
    assert df.count() > 0


def physical_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def check_plan(plan: str) -> None:
    assert "EvalPython" not in plan  # no Python UDF in any query
    # nothing funnels all rows through one task; a frame dealt by a number of its own size may come to one
    assert "SinglePartition" not in plan.replace("SinglePartition, REPARTITION_BY_NUM", "")
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan


@pytest.fixture()
def written(monkeypatch):
    """The plans of all frames that are written on the way."""
    from pyspark.sql.readwriter import DataFrameWriter

    plans = []

    def watched(f):
        def write(self, *args, **kw):
            plans.append(physical_plan(self._df))
            return f(self, *args, **kw)

        return write

    for name in ("parquet", "text", "csv", "insertInto", "save"):
        monkeypatch.setattr(DataFrameWriter, name, watched(getattr(DataFrameWriter, name)))
    return plans


@pytest.mark.parametrize("name", sorted(Q))
def test_query_matches_oracle(spark, con, written, name):
    sdf = Q[name](spark, SMALL)
    check_plan(physical_plan(sdf))
    for plan in written:
        check_plan(plan)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(O[name])
    dcols = [d[0] for d in res.description]
    sc, sr = canon(srows, sdf.columns)
    dc, dr = canon(res.fetchall(), dcols)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
