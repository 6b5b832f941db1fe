import datetime
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from millrace.operators.metrics import sample_traces
from millrace.streaming.alerts import state_in_rocksdb
from millrace.streaming.traces import TailSampler, sample_trace_stream

SCHEMA = "span long, trace string, start timestamp, end timestamp, status string"
START = datetime.datetime(2024, 1, 1)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Each partition of a stream's state is a store of its own."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def at(seconds):
    return START + datetime.timedelta(seconds=seconds)


def streamed(spark, folder, batches, **more):
    (folder / "in").mkdir(parents=True)
    got = []
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(folder / f"in/{k}"))
        spans = spark.readStream.schema(SCHEMA).parquet(str(folder / "in/*"))
        out = sample_trace_stream(spans, "trace", "start", "end", F.col("status") == "ERROR", late="30 seconds", **more)
        with state_in_rocksdb(spark):
            q = out.writeStream.outputMode("append").option("checkpointLocation", str(folder / "state")).trigger(availableNow=True)
            q.foreachBatch(lambda df, n: got.extend(df.collect())).start().awaitTermination()
    return sorted(tuple(r) for r in got if r.trace != "~")


def spans_of(rng, traces):
    rows = []
    for k in range(traces):
        t, n = rng.randrange(20), rng.randrange(1, 6)
        for _ in range(n):
            rows.append((len(rows), f"t{k}", at(t), at(t + rng.choice([0.1, 0.5])), rng.choice(["OK"] * 9 + ["ERROR", None])))
            t += rng.choice([0.05, 0.2, 0.9])
    return rows


@pytest.mark.parametrize("order", [0, 1])
def test_same_as_batch_in_any_order(spark, tmp_path, order):
    rows = spans_of(random.Random(2), 120)
    want = sorted(tuple(r) for r in sample_traces(spark.createDataFrame(rows, SCHEMA), "trace", "start", "end", F.col("status") == "ERROR", slow_ms=2000, percent=10).select("span", "trace", "start", "end", "status").collect())
    lucky = [r for r in want if not any(x[4] == "ERROR" for x in rows if x[1] == r[1])]
    assert 0 < len(lucky) < len(want) < len(rows)
    random.Random(order).shuffle(rows)
    end = [(-1, "~", at(100), at(100), "OK"), (-2, "~", at(200), at(200), "OK")]
    assert streamed(spark, tmp_path, [rows[:100], rows[100:], end[:1], end[1:]], slow_ms=2000, percent=10) == want


def test_way_out_of_large_traces_and_end_of_state(spark, tmp_path):
    big = [(k, "big", at(k * 0.01), at(k * 0.01), "OK") for k in range(50)]
    small = [(100, "small", at(1), at(1), "OK"), (101, None, at(1), at(1), "ERROR")]
    late = [(200, "small", at(500), at(500), "ERROR")]  # its trace was left out and forgotten: a new one
    got = streamed(spark, tmp_path, [big[:30], big[30:] + small, [(-1, "~", at(300), at(300), "OK")], late, [(-2, "~", at(900), at(900), "OK")]], percent=0, most=20)
    assert [r[0] for r in got] == [*range(50), 200]


class Held:
    """A state variable or the timers of one key, in memory; counts what it is asked."""

    def __init__(self, asked):
        self.value, self.asked = None, asked

    def __getattr__(self, name):
        self.asked.append(name)
        return {
            "exists": lambda: self.value is not None, "get": lambda: iter(self.value) if isinstance(self.value, list) else self.value,
            "update": lambda v: setattr(self, "value", v), "put": lambda v: setattr(self, "value", v), "clear": lambda: setattr(self, "value", None),
            "appendValue": lambda v: setattr(self, "value", [*(self.value or []), v]), "appendList": lambda v: setattr(self, "value", [*(self.value or []), *v]),
            "registerTimer": lambda ms: setattr(self, "value", ms), "deleteTimer": lambda ms: setattr(self, "value", None),
        }[name]


def test_traces_of_a_bucket_share_accesses_to_state():
    asked = []
    handle = Held(asked)
    handle.getListState = handle.getValueState = lambda *a: Held(asked)
    s = TailSampler(["span", "trace"], "trace", 1_000_000, 2_000_000, 100)
    s.init(handle)
    span = lambda k, t, us, bad=False: {"span": k, "trace": t, "_from": us, "_to": us, "_bad": bad}
    at = lambda ms: (SimpleNamespace(getCurrentWatermarkInMs=lambda: ms), SimpleNamespace(getExpiryTimeInMs=lambda: handle.value))
    assert not list(s.handleInputRows((0,), iter([span(k, f"t{k % 500}", k) for k in range(1000)]), None))
    # An error lets out what waits of its trace alone; those that end are forgotten, the others go on.
    assert sorted(r.span for r in s.handleInputRows((0,), iter([span(1000, "t7", 9, True), span(1001, "t8", 900_000)]), None)) == [7, 507, 1000]
    assert handle.value == 1001 and not list(s.handleExpiredTimer((0,), *at(1100)))
    assert handle.value == 1900
    assert sorted(r.span for r in s.handleInputRows((0,), iter([span(1002, "t8", 901_000, True), span(1003, "t7", 901_000)]), None)) == [8, 508, 1001, 1002]
    assert not list(s.handleExpiredTimer((0,), *at(3000))) and s.traces.value is s.waiting.value is None
    assert len(asked) < 60
