"""Every registered query against its SQL oracle (order-insensitive)."""

import pytest

from compare import digest, duck
from conftest import SF_SMALL

import __spark_entry__ as entry
from tidemart.plans.registry import QUERIES

NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(srows, sdf.columns)[0] == digest(drows, dcols)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["stt", "edt", "cur_date", "home_uv_ct", "good_detail_uv_ct"]
    assert df.count() > 0
