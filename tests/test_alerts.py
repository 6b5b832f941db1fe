import datetime
import random

import pytest
from pyspark.sql import functions as F

from millrace.streaming.alerts import condition_windows, held_alerts, held_alerts_batch, state_in_rocksdb

START = datetime.datetime(2024, 1, 1)
SCHEMA = "job string, ts timestamp, ok boolean"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Each partition of a stream's state is a store of its own."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def at(minutes):
    return START + datetime.timedelta(minutes=minutes)


def streamed(spark, folder, batches, hold=120, floor=2):
    """Each batch is a run of its own that goes on from the last one's checkpoint."""
    (folder / "in").mkdir(parents=True)
    got = []
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(folder / f"in/{k}"))
        events = spark.readStream.schema(SCHEMA).parquet(str(folder / "in/*"))
        out = held_alerts(condition_windows(events, ["job"], 60, ~F.col("ok"), 0.05, floor, late="3 minutes"), ["job"], 60, hold)
        with state_in_rocksdb(spark):
            q = out.writeStream.outputMode("append").option("checkpointLocation", str(folder / "state")).trigger(availableNow=True)
            q.foreachBatch(lambda df, n: got.extend(df.collect())).start().awaitTermination()
    return sorted((r.job, r.ts, r.state, r.since) for r in got if r.job != "~")


def batch(spark, rows, hold=120, floor=2):
    windows = condition_windows(spark.createDataFrame(rows, SCHEMA), ["job"], 60, ~F.col("ok"), 0.05, floor)
    return sorted((r.job, r.ts, r.state, r.since) for r in held_alerts_batch(windows, ["job"], 60, hold).collect())


def minute(job, m, bad, n=3):
    return [(job, at(m + 0.1 * k), k >= bad) for k in range(n)]


def test_states_late_rows_and_silence(spark, tmp_path):
    rows = []
    for m in range(0, 5):  # holds over five windows, then recovers
        rows += minute("a", m, 1)
    rows += minute("a", 5, 0)
    rows += minute("b", 0, 1) + minute("b", 1, 1)  # never long enough
    rows += minute("c", 2, 3) + minute("c", 3, 3) + minute("c", 4, 3)  # falls silent while it fires
    rows += [("d", at(1), False)]  # too few events
    rows += minute("e", 0, 1) + minute("e", 1, 0) + minute("e", 2, 1)  # interrupted
    end = [("~", at(60), True), ("~", at(61), True)]
    want = batch(spark, rows)
    assert [(j, s) for j, _, s, _ in want if j == "a"] == [("a", "pending"), ("a", "firing"), ("a", "resolved")]
    assert [(t, s) for j, t, s, _ in want if j == "c"] == [(at(3), "pending"), (at(5), "firing"), (at(6), "resolved")]
    assert {j for j, *_ in want} == {"a", "b", "c", "e"} and [s for j, _, s, _ in want if j == "e"] == ["pending", "inactive"] * 2
    # Rows in three runs, some of them late but within the watermark.
    rows.sort(key=lambda r: r[1])
    first, late, rest = rows[:12], rows[12:18:2], rows[13:18:2] + rows[18:]
    assert streamed(spark, tmp_path, [first + rest[:2], late + rest[2:], end, [("~", at(120), True)]]) == want


def test_any_split_into_batches(spark, tmp_path):
    rng = random.Random(4)
    rows = [r for job in ("a", "b") for m in range(40) if rng.random() < 0.85 for r in minute(job, m, rng.choice([0, 1, 1, 1]), rng.choice([1, 3, 4]))]
    rows.sort(key=lambda r: r[1])
    want = batch(spark, rows, hold=150)
    assert {s for _, _, s, _ in want} == {"pending", "firing", "resolved", "inactive"}
    cut = len(rows) // 3
    splits = [rows[:cut], rows[cut : 2 * cut], rows[2 * cut :] + [("~", at(90), True)], [("~", at(180), True)]]
    assert streamed(spark, tmp_path, splits, hold=150) == want
