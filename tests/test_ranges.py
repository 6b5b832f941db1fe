import datetime
import random
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.operators import ranges as rg
from millrace.queries import ORACLE, QUERIES

EPOCH = datetime.datetime(2024, 1, 1)


def by_hand(samples, span, step):
    """Rates by a scan of each window."""
    series = defaultdict(list)
    for job, t, v in samples:
        if t is not None and v is not None:
            series[job].append((t, float(v)))
    out = {}
    for job, xs in series.items():
        xs.sort()
        t = -(-xs[0][0] // step) * step
        while t < xs[-1][0] + span:
            inside = [x for x in xs if t - span < x[0] <= t]
            if len(inside) > 1 and inside[-1][0] > inside[0][0]:
                inc = inside[-1][1] - inside[0][1] + sum(a[1] for a, b in zip(inside, inside[1:]) if b[1] < a[1])  # noqa: B905
                d = inside[-1][0] - inside[0][0]
                m = d / (len(inside) - 1)
                x, y = inside[0][0] - (t - span), t - inside[-1][0]
                x, y = (m / 2 if x >= 1.1 * m else x), (m / 2 if y >= 1.1 * m else y)
                if inc > 0 and inside[0][1] >= 0:
                    x = min(x, d * inside[0][1] / inc)
                out[job, t] = inc * (d + x + y) / d / span
            t += step
    return out


def frame(spark, samples):
    return spark.createDataFrame([(j, None if t is None else EPOCH + datetime.timedelta(seconds=t), v) for j, t, v in samples], "job string, ts timestamp, value double")


@pytest.mark.parametrize("span, step, block", [(300, 15, 86_400), (300, 15, 100), (100, 40, 1000), (15, 60, 7)])
def test_rates_with_resets_gaps_and_blocks(spark, span, step, block):
    rng, base = random.Random(span + block), int((EPOCH - datetime.datetime(1970, 1, 1)).total_seconds())
    samples = []
    for job in ("a", "b", None):
        t, v = rng.randrange(50), 0.0
        for _ in range(150):
            t += rng.choice([0, 5, 15, 15, 16, 40]) if rng.random() > 0.05 else rng.choice([250, 900, 3000])
            v = rng.choice([0.0, 1.0]) if rng.random() < 0.06 else v + rng.randrange(4)
            samples.append((job, t, v))
    samples += [("lone", 77, 3.0), ("twice", 60, 1.0), ("twice", 60, 2.0), ("a", None, 1.0), ("a", 5, None)]
    want = by_hand([(j, None if t is None else base + t, v) for j, t, v in samples], span, step)
    got_rows = rg.range_rate(frame(spark, samples), ["job"], span, step, block_seconds=block).collect()
    got = {(r.job, int((r.ts - datetime.datetime(1970, 1, 1)).total_seconds())): r.rate for r in got_rows}
    assert got.keys() == want.keys() and len(got) >= 12
    assert all(got[k] == pytest.approx(want[k], rel=1e-9, abs=1e-12) for k in got)


def test_samples_are_not_copied_into_windows(spark):
    """As many rows as windows and edges, whatever the number of samples in a window."""
    samples = [("a", t, float(t)) for t in range(0, 3600)]
    edges = rg.window_edges(frame(spark, samples), ["job"], 300, 60)
    assert edges.count() == 64
    rates = {r.ts: r.rate for r in rg.range_rate(frame(spark, samples), ["job"], 300, 60).collect()}
    assert rates[EPOCH + datetime.timedelta(minutes=30)] == pytest.approx(1.0, rel=0.01)


def test_ratio_and_empty(spark):
    df = spark.createDataFrame([("a", "5xx", EPOCH, 1.0), ("a", "2xx", EPOCH, 3.0), ("b", "2xx", EPOCH, 3.0), ("c", "5xx", EPOCH, 0.0)], "job string, status string, ts timestamp, rate double")
    got = {r.job: r.ratio for r in rg.rate_ratio(df, ["job"], F.col("status") == "5xx").collect()}
    assert got == {"a": 0.25, "c": None}
    assert rg.range_rate(frame(spark, []), ["job"]).count() == 0


def test_quantiles_agree_with_sql_to_the_last_digit(spark):
    """Where a bucket holds just the rank, the next one that holds more may lie far off, so the last digit of a rate counts."""
    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.sql("SET timezone = 'UTC'")
    db.sql(f"CREATE VIEW events AS SELECT * FROM '{sf}/events.parquet'")
    want = db.sql(f"SELECT event_type, ts, quantile FROM ({ORACLE['ts03_range_quantile']})").fetchall()
    got = QUERIES["ts03_range_quantile"](spark, sf).select("event_type", "ts", "quantile").collect()
    assert sorted(want) == sorted(map(tuple, got))


def test_samples_inside_windows_are_not_carried_on(spark):
    """Of 20,000 samples of one day, those about its 24 steps and the windows' starts, and the block's first and last, are kept, with the counts of all."""
    rows = spark.range(20_000).select(F.lit("a").alias("job"), F.timestamp_micros(F.col("id") * 4_300_000).alias("ts"), (F.col("id") % 7_000).cast("double").alias("value"))
    hour, span = 3_600 * 1_000_000, 6 * 3_600 * 1_000_000
    edge = lambda us, after: rg._any_step(us, F.least(after, us + span), hour) | rg._any_step(F.greatest(us + span, after), after + span, hour)
    every = {r.us: r for r in rg.running_counter(rows, ["job"]).collect()}
    some = rg.running_counter(rows, ["job"], needed=edge).collect()
    assert len(every) == 20_000 and 24 <= len(some) <= 60 and all(every[r.us] == r for r in some)
    rates = rg.range_rate(rows, ["job"], 21_600, 3_600)
    assert rates.count() == 23 + 6
