"""Conversion at the edges of its widths, and queries on keys of larger tables."""

from decimal import Decimal

import duckdb
from pyspark.sql import functions as F

from millrace.functions import convert as cv
from millrace.queries import ORACLE, QUERIES


def test_integers_are_cut_as_the_sql_says(spark, tmp_path):
    keys = [(k, k) for k in (0, 499, 500, 33267, 33268, 66035, 66036, 90000, (1 << 31) - 1, 1 << 31, (1 << 31) + 1, (1 << 32) + 5)]
    spark.createDataFrame(keys, "o_orderkey long, o_custkey long").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    got = sorted(map(tuple, QUERIES["cnv02_unpack_int"](spark, str(tmp_path)).select("o_orderkey", "two", "four", "eight").collect()))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    assert got == sorted(db.sql(f"SELECT o_orderkey, two, four, eight FROM ({ORACLE['cnv02_unpack_int']})").fetchall())
    of = {r[0]: r[1:3] for r in got}
    assert of[33268] == (-32768, -33268) and of[1 << 31] == ((((1 << 31) - 500 + 32768) % 65536) - 32768, -(1 << 31)) and of[(1 << 31) + 1][1] == (1 << 31) - 1


def test_only_integer_digits_overflow_a_decimal(spark, tmp_path):
    lines = [(k, p, "F") for k, p in enumerate((1.0, 49999.74, 49999.75, 49999.99, 50000.0, 104999.91))]
    spark.createDataFrame(lines, "l_orderkey long, l_extendedprice double, l_linestatus string").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = sorted(map(tuple, QUERIES["cnv06_fit"](spark, str(tmp_path)).select("d", "s", "n").collect()), key=str)
    db = duckdb.connect()
    db.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    assert got == sorted(db.sql(f"SELECT d, s, n FROM ({ORACLE['cnv06_fit']})").fetchall(), key=str) == [("DECIMAL_OVERFLOW", None, 2), (None, None, 4)]
    wide = [(Decimal("9" * 27 + ".9999999999"),), (Decimal("9" * 28 + ".9999999999"),), (-Decimal(10**27),), (None,)]
    fits = spark.createDataFrame(wide, "v decimal(38,10)").select(*[cv.fit_decimal(F.col("v"), n + 10, 10).alias(f"n{n}") for n in (27, 28, 38)]).collect()
    assert [[x is None for x in r] for r in fits] == [[True, True, True], [False, True, True], [False, True, True], [True, True, True]]
