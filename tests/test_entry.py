import duckdb
import pytest

import __spark_entry__ as entry
import voltframe.plans.report_queries  # noqa: F401
from voltframe.plans.queries import ORACLES, QUERIES

D = "/root/testdata/sf0.001"


def cell(v):
    if v is None or v != v:
        return "~"
    if isinstance(v, bool):
        return str(v)
    return repr(round(float(v), 6) + 0.0) if isinstance(v, (int, float)) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_against_sql(spark, name):
    db = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    df = QUERIES[name](spark, D)
    cols = sorted(df.columns)
    got = sorted(tuple(map(cell, r)) for r in df.select(*cols).collect())
    want = sorted(tuple(map(cell, r)) for r in db.execute(f"SELECT {', '.join(f'"{c}"' for c in cols)} FROM ({ORACLES[name]})").fetchall())
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
