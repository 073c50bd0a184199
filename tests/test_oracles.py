"""Every core query that has SQL gives the SQL's rows."""

import math

import pytest

from linkloom.plans import catalog

SQL = catalog.oracle_sql()


def rows(df):
    df = df[sorted(df.columns)]

    def value(x):
        if x is None or isinstance(x, float) and math.isnan(x):
            return ""
        return repr(round(float(x), 6)) if isinstance(x, float) else str(x)

    return sorted(tuple(map(value, r)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, spark, data, duck):
    got, want = catalog.queries()[name](spark, data).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_has_rows(spark, data):
    assert catalog.flagship(spark, data).count() > 0
