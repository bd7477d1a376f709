"""Rounded doubles are those that SQL rounds."""

from __future__ import annotations

import math

import duckdb

from tideshift.plans.views import rounded, sql_round

# Ends in a 5 behind the sixth digit, and what scaling makes of it: below a half, a half, above it.
HALVES = [79.25 / 160 - 1, 76.75 / 160 - 1, 0.0015625, 2.0000005, 1.0000025, 0.0078125, -0.0078125]
OTHERS = [0.0, -0.0, -1e-9, 1e-7, 4.465517241, 123456789.1234565, 1e300, 1.7e308, -1.7e308, 2.0**53, float("inf"), float("-inf")]


def test_rounds_as_sql(spark):
    values = HALVES + OTHERS + [k / 640 for k in range(-2000, 2000)] + [k / 3200 - 1 for k in range(5000)]
    con = duckdb.connect()
    for digits in (6, 9):
        found = rounded(spark.createDataFrame(list(enumerate(values)), "i int, x double"), digits).orderBy("i").collect()
        sql = f"SELECT i, {sql_round('x', 'x', digits)} FROM (SELECT unnest(range(len($v))) AS i, unnest($v::DOUBLE[]) AS x) ORDER BY i"
        assert [r["x"] for r in found] == [x for _, x in con.execute(sql, {"v": values}).fetchall()]
        assert all(math.copysign(1.0, r["x"]) > 0 for r in found if r["x"] == 0)


def test_missing_stays_missing(spark):
    found = rounded(spark.createDataFrame([(float("nan"),), (None,)], "x double")).collect()
    assert [r["x"] for r in found] == [None, None]
