import datetime

import pytest
from pyspark.sql import functions as F

from millrace import scratch
from millrace.operators import windows as wn
from millrace.plans import content as ct
from millrace.sources import readers, sinks
from millrace.streaming import streams as sm


def test_events_ndjson(spark, tmp_path):
    (tmp_path / "e.ndjson").write_text('# head\n\n {"eventId":"a","timestamp":"2024-01-01T00:00:00Z","metadata":{"bytes":"5"}} \n{"eventId":"b","timestamp":1704067200000}\n')
    rows = readers.read_events_ndjson(spark, str(tmp_path / "e.ndjson")).orderBy("eventId").collect()
    assert [r.eventId for r in rows] == ["a", "b"]
    assert rows[0].timestamp == rows[1].timestamp and rows[0].metadata == {"bytes": "5"}


def test_lake_round_trip_and_overwrite_of_a_day(spark, tmp_path):
    root = str(tmp_path / "lake")
    for day, n in (("2024-01-01", 1), ("2024-01-03", 2), ("2024-01-03", 5)):
        sinks.write_lake_partition(spark.createDataFrame([("u", n)], "user_id string, total long"), root, day)
    got = readers.read_daily_users(spark, root, "2024-01-04", 2, "user_id STRING, total LONG").collect()
    assert [(r.total, r.day) for r in got] == [(5, 3)]


def test_fixed_width_and_inventory(spark, tmp_path):
    (tmp_path / "r.bin").write_bytes(b"AAA\x00\x01BBB\xff\xfe")
    out = readers.read_fixed_width(spark, str(tmp_path / "r.bin"), 5, [("code", 0, 3), ("n", 3, 2)])
    assert [(bytes(r.code), bytes(r.n)) for r in out.collect()] == [(b"AAA", b"\x00\x01"), (b"BBB", b"\xff\xfe")]
    with pytest.raises(ValueError, match="whole records"):
        readers.read_fixed_width(spark, str(tmp_path / "r.bin"), 4, [])
    with pytest.raises(ValueError, match="2 records where 3"):
        readers.read_fixed_width(spark, str(tmp_path / "r.bin"), 5, [], expected=3)
    inv = readers.read_object_inventory(spark, str(tmp_path), "*.bin").collect()
    assert [(r.key.rsplit("/", 1)[1], r.size) for r in inv] == [("r.bin", 10)]


def test_csv_json_reports(spark, tmp_path):
    df = spark.createDataFrame([("a,b", None), ('say "x"', 2)], "s string, n long")
    assert [r.value for r in sinks.csv_lines(df, ["s", "n"]).collect()] == ['"a,b",', '"say ""x""",2']
    assert [r.value for r in sinks.csv_lines(df, ["s", "n"], quote_all=True).collect()][0] == '"a,b",""'
    sinks.export_csv(df, str(tmp_path / "c"), ["s", "n"])
    back = readers.read_market_csv(spark, str(tmp_path / "c"), "s STRING, n LONG")
    assert spark.read.csv(str(tmp_path / "c"), header=True, escape='"').count() == 2 and back.columns == ["s", "n"]
    sinks.export_csv(df.limit(0), str(tmp_path / "none"), ["s", "n"])
    sinks.export_json(df, str(tmp_path / "j"), "week", "now")
    assert spark.read.json(str(tmp_path / "j/header")).first().record_count == 2
    sinks.write_report_rows(df, str(tmp_path / "r"), "report", "2024")
    assert spark.read.json(str(tmp_path / "r/meta")).first().row_count == 2
    sinks.publish_latest(df, str(tmp_path / "p"), "2024-01-01")
    assert spark.read.json(str(tmp_path / "p/latest")).count() == 2
    sinks.archive_jsonl(df.withColumn("ts", F.lit(datetime.datetime(2024, 1, 9))), str(tmp_path / "a"), "ts")
    assert (tmp_path / "a/year=2024/week=2").exists()


def test_range_predicates():
    assert readers.range_predicates("k", [("a", "o'b")], "x > 1") == ["(x > 1) AND k BETWEEN 'a' AND 'o''b'"]
    assert readers.range_predicates("k", [(1, 20)]) == ["(1 = 1) AND k BETWEEN 1 AND 20"]


def test_jdbc_ranges(spark):
    url, options = "jdbc:derby:memory:ranges;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    spark.range(100).select(F.col("id").alias("K"), F.concat(F.lit("n"), "id").alias("V")).write.jdbc(url, "ROWS_OF", properties=options)
    df = readers.read_jdbc_range(spark, url, "ROWS_OF", "K", [(0, 9), (10, 49), (50, 99)], "K <> 7", options)
    assert df.rdd.getNumPartitions() == 3
    assert [r.K for r in df.collect()] == [k for k in range(100) if k != 7]


def test_key_ranges_refuse_repeated_keys(spark):
    with pytest.raises(Exception, match="duplicate keys"):
        wn.key_ranges(spark.createDataFrame([(1,), (1,), (2,)], "k long"), "k", 2).collect()
    got = wn.key_ranges(spark.range(25).withColumnRenamed("id", "k"), "k", 10).orderBy("seq").collect()
    assert [(r.seq, r.from_key, r.to_key, r.rows) for r in got] == [(1, 0, 9, 10), (2, 10, 19, 10), (3, 20, 24, 5)]


@pytest.mark.parametrize("partitions", [None, 64])
def test_key_ranges_over_many_partitions(spark, partitions):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(3_000_000).select(F.xxhash64("id").alias("k"))
        got = wn.key_ranges(df, "k", 1000, partitions).orderBy("seq").collect()
        by_rank = sorted(r.k for r in df.collect())
        assert [tuple(r) for r in got] == [(k // 1000 + 1, by_rank[k], by_rank[k + 999], 1000) for k in range(0, 3_000_000, 1000)]
        with pytest.raises(Exception, match="duplicate keys"):  # equal keys on both sides of a range's end
            wn.key_ranges(spark.range(2000).select(F.when(F.col("id") == 1000, 999).otherwise(F.col("id")).alias("k")), "k", 1000, partitions).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_scratch(spark, tmp_path):
    df = scratch.staged(spark.range(5))
    assert df.count() == 5
    scratch.clear_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|FILE_NOT_EXIST|does not exist"):
        df.sparkSession.read.parquet(df.inputFiles()[0]).count()


def test_reindex_refuses_lost_rows(spark):
    df = spark.range(5)
    assert ct.checked_reindex(df, df).count() == 5
    with pytest.raises(Exception, match="do not match"):
        ct.checked_reindex(df, df.limit(4)).collect()


def test_streams_from_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.txt").write_text('{"Message":"{\\"eventId\\":\\"a\\"}","TopicArn":"t"}\nbroken\n{"eventId":"b"}\n')
    good, dead = sm.parse_stream(sm.stream_text(spark, str(tmp_path / "in")), "eventId STRING", "eventId")
    out = {}
    for name, df in (("good", good), ("dead", dead)):
        df.writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-state")).trigger(availableNow=True).start().awaitTermination()
        out[name] = sorted(r[0] for r in spark.read.schema(df.schema).parquet(str(tmp_path / name)).collect())
    assert out == {"good": ["a", "b"], "dead": ["broken"]}


def test_late_alerts_take_their_place(spark, tmp_path):
    schema = "service string, status string, ts timestamp, event_id long"
    at = lambda m: datetime.datetime(2024, 1, 1, 12) + datetime.timedelta(minutes=m)
    batches = [
        [("a", "firing", at(0), 1), ("a", "resolved", at(8), 3), ("b", "firing", at(5), 4)],
        [("a", "firing", at(4), 2), ("a", "firing", at(9), 5)],  # the first comes late, and opens nothing
        [("z", "firing", at(60), 9)],
        [("a", "resolved", at(3), 6), ("z", "resolved", at(200), 10)],  # too late
    ]
    got = []
    (tmp_path / "in").mkdir()
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
        out = sm.incident_state(spark.readStream.schema(schema).parquet(str(tmp_path / "in/*")))
        q = out.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
        q.foreachBatch(lambda df, n: got.extend(df.collect())).start().awaitTermination()
    assert sorted((r.service, r.incident_no, r.action, r.ts) for r in got if r.service != "z") == [
        ("a", 1, "closed", at(8)), ("a", 1, "opened", at(0)), ("a", 2, "opened", at(9)), ("b", 1, "opened", at(5)),
    ]
