import json

import pytest

from millrace.sources.queue import FolderQueue, QueueReader, queue_stream
from millrace.streaming.streams import parse_stream


@pytest.fixture
def queue(tmp_path):
    (tmp_path / "q").mkdir()
    for k in range(10):
        (tmp_path / f"q/{k:02d}.json").write_text("".join(json.dumps({"eventId": f"{k}-{j}"}) + "\n" for j in range(3)) + ("broken\n" if k % 4 == 0 else ""))
    (tmp_path / "q/_being_written").write_text("no message yet\n")
    return tmp_path


def names(at):
    return sorted(p.name for p in (at / "q").glob("[!_]*"))


def drain(spark, at, write):
    """One run of the stream until nothing is left, or until ``write`` fails."""
    good, dead = parse_stream(queue_stream(spark, str(at / "q"), str(at / "log"), most=4, together=2), "eventId STRING", "eventId")
    both = good.selectExpr("eventId AS value", "false AS dead").unionByName(dead.selectExpr("_line AS value", "true AS dead"))
    q = both.writeStream.option("checkpointLocation", str(at / "state")).foreachBatch(write).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def rows_of(spark, at):
    return sorted(tuple(r) for r in spark.read.parquet(str(at / "out/*")).collect())


WANT = sorted([(f"{k}-{j}", False) for k in range(10) for j in range(3)] + [("broken", True)] * 3)


@pytest.mark.parametrize("fail", ["before", "after"])
def test_restart_loses_and_doubles_nothing(spark, queue, fail):
    """A batch that fails before or after its rows are written runs again with the same messages."""
    seen = []

    def write(df, n):
        if n == 1 and fail == "before" and n not in seen:
            seen.append(n)
            raise RuntimeError("lost")
        df.write.mode("overwrite").parquet(str(queue / f"out/{n}"))
        if n == 1 and fail == "after" and n not in seen:
            seen.append(n)
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        drain(spark, queue, write)
    assert {"04.json", "05.json", "06.json", "07.json"} <= set(names(queue))  # not acknowledged
    drain(spark, queue, write)
    assert rows_of(spark, queue) == WANT
    # What came in the meantime is taken by the next run, and nothing else.
    (queue / "q/10.json").write_text('{"eventId": "new"}\n')
    drain(spark, queue, write)
    assert rows_of(spark, queue) == sorted([*WANT, ("new", False)])
    assert names(queue) in ([], ["10.json"])  # the last batch is acknowledged when the next one begins


def test_offsets_and_acknowledgement(queue):
    options = {"path": str(queue / "q"), "log": str(queue / "log"), "most": "4", "together": "3"}
    r = QueueReader(options)
    assert r.latestOffset() == {"poll": 1} and r.latestOffset() == {"poll": 2}
    parts = r.partitions({"poll": 0}, {"poll": 2})
    assert [len(p.names) for p in parts] == [3, 3, 2] and len(list(r.read(parts[0]))) == 10
    again = QueueReader(options)  # a restart: the same offsets have the same messages
    assert [p.names for p in again.partitions({"poll": 0}, {"poll": 2})] == [p.names for p in parts]
    again.commit({"poll": 1})
    assert names(queue) == [f"{k:02d}.json" for k in range(4, 10)]
    again.commit({"poll": 1})
    assert again.latestOffset() == {"poll": 3} and again.partitions({"poll": 1}, {"poll": 1}) == []
    again.commit({"poll": 3})
    last = QueueReader(options)
    assert names(queue) == [] and last.latestOffset() == {"poll": 3} and last.initialOffset() == {"poll": 0}
    FolderQueue(options).acknowledge(["00.json"])  # long gone
