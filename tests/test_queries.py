"""Every query outside the llm subpackage against its oracle on the smallest data."""

import math
import os

import duckdb
import pytest
from conftest import DATA

from sporeframe.plans import articles, data_problems, documents, specimens

MODULES = (specimens, articles, documents, data_problems)
NAMES = [(m, n) for m in MODULES for n in m.QUERIES]


def value(x):
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    return x


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{DATA}/{f}')")
    return c


@pytest.mark.parametrize("module, name", NAMES, ids=[n for _, n in NAMES])
def test_query(spark, con, module, name):
    df = module.QUERIES[name](spark, DATA)
    order = sorted(df.columns)
    got = sorted((tuple(value(r[c]) for c in order) for r in df.collect()), key=repr)
    if name in module.SQL:
        cur = con.execute(module.SQL[name])
        names = [d[0] for d in cur.description]
        at = [names.index(c) for c in order]
        assert sorted(names) == order
        assert got == sorted((tuple(value(r[i]) for i in at) for r in cur.fetchall()), key=repr)
