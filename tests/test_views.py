"""The applications / scored views equal their SQL definitions (DuckDB) at sf0.001."""

import duckdb

from riskframe.plans.views_sql import APPS, SCORED
from riskframe.sources.tables import TABLE_NAMES, applications, scored
from tests.conftest import SF_SMALL


def _duck(sql):
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    rel = con.sql(sql)
    return rel.columns, rel.fetchall()


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(r[i] for i in order) for r in rows)


def test_applications_view_matches_sql(spark):
    df = applications(spark, SF_SMALL)
    dcols, drows = _duck(APPS)
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, drows)


def test_scored_view_matches_sql(spark):
    df = scored(spark, SF_SMALL)
    dcols, drows = _duck(f"WITH apps AS ({APPS}) {SCORED}")
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, drows)
