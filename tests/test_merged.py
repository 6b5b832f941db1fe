import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.aggregates import daily_usage_rollup
from millrace.streaming.merged import KEPT, MergedTable, added, latest
from millrace.streaming.usage import UsageRollup


def test_upsert_versions(spark, tmp_path):
    at, schema = str(tmp_path / "t"), spark.createDataFrame([], "k int, v string, o int").schema
    table = MergedTable(at, latest(["k"], "o"))
    write = table.write
    read = lambda: sorted((r.k, r.v) for r in table.read(spark, schema).collect())
    assert read() == []
    write(spark.createDataFrame([(1, "a", 1), (2, "b", 1), (2, "b2", 2)], schema), 0)
    assert read() == [(1, "a"), (2, "b2")]  # one row of a key within a batch
    write(spark.createDataFrame([(2, "c", 3)], schema), 2)  # a batch is skipped
    write(spark.createDataFrame([(2, "old", 1), (3, "d", 1)], schema), 3)
    assert read() == [(1, "a"), (2, "c"), (3, "d")]
    write(spark.createDataFrame([(2, "old", 1), (3, "e", 1)], schema), 3)  # a batch runs again
    assert read() == [(1, "a"), (2, "c"), (3, "e")]
    write(spark.createDataFrame([], schema), 4)
    assert read() == [(1, "a"), (2, "c"), (3, "e")]


def test_runs_stay_few_and_dead_ones_go(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, n long").schema
    table, want, rng = MergedTable(str(tmp_path / "t"), added(["k"]), fan=3), {}, random.Random(1)
    written = set()
    for b in range(20):
        rows = [(rng.randrange(6), rng.randrange(10)) for _ in range(5)]
        for k, n in rows:
            want[k] = want.get(k, 0) + n
        table.write(spark.createDataFrame(rows, schema).coalesce(1), b)
        written |= {p.name for p in (tmp_path / "t/runs").iterdir()}
        assert len(list((tmp_path / "t/manifests").glob("[0-9]*"))) <= KEPT
    assert dict(map(tuple, table.read(spark, schema).collect())) == want
    live = {p.name for p in (tmp_path / "t/runs").iterdir()}
    assert len(live) < 15 < 20 <= len(written)
    # A batch that was cut off before its manifest leaves the table as it was, and runs again.
    before = sorted(map(tuple, table.read(spark, schema).collect()))
    (tmp_path / "t/manifests/000000000019").unlink()
    table.write(spark.createDataFrame(rows, schema).coalesce(1), 19)
    assert sorted(map(tuple, table.read(spark, schema).collect())) == before


@pytest.mark.parametrize("batches", [1, 4, 11])
def test_usage_is_exact_after_any_split(spark, tmp_path, batches):
    rng = random.Random(batches)
    names = {"document.created": "a", "document.viewed": "b", "storage.allocated": "c", "storage.released": "d"}
    rows = [(f"2024-01-0{rng.randrange(1, 5)}", rng.choice([*map(str, range(40)), "70000", "-3", None]), rng.choice("abcde"), rng.choice([5, None])) for _ in range(400)]
    df = spark.createDataFrame(rows, "ts string, user_id string, event_type string, bytes long").withColumn("ts", F.col("ts").cast("timestamp"))
    rollup = UsageRollup(str(tmp_path / "u"), names, F.col("user_id").cast("long"))
    cut = [df.where(F.pmod(F.xxhash64(*df.columns, F.lit(1)), F.lit(batches)) == k) for k in range(batches)]
    for k, part in enumerate(cut):
        rollup.write(part, k)
    rollup.write(cut[-1], batches - 1)  # the last batch runs again
    assert sorted(map(tuple, rollup.read(spark, df).collect())) == sorted(map(tuple, daily_usage_rollup(df, names).collect()))
