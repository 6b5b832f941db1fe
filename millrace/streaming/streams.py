"""Event streams: parsing with dead letters, dedup, windows, upserts and keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.normalize import audit_from_message, unwrap_envelope
from ..operators.sets import upsert_by_key


def stream_text(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Lines of a growing folder; a Kafka source's ``value`` as text goes through the same operators."""
    return spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger).load(path)


def parse_stream(lines: DataFrame, schema: str, required: str, line: str = "value") -> tuple[DataFrame, DataFrame]:
    """Events, and dead letters: lines that are no JSON or lack the required field. Offsets advance for both."""
    body = unwrap_envelope(F.col(line))
    rows = lines.select(F.col(line).alias("_line"), F.from_json(F.coalesce(body, F.col(line)), schema).alias("e"))
    ok = F.coalesce(F.col(f"e.{required}").isNotNull(), F.lit(False))
    return rows.where(ok).select("e.*"), rows.where(~ok).select("_line")


def dedup_events(events: DataFrame, id_col: str, ts: str, late: str = "10 minutes") -> DataFrame:
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark([id_col])


def tumbling_totals(events: DataFrame, interval: str, ts: str, late: str = "10 minutes") -> DataFrame:
    """Counts by windows that begin at multiples of the interval since 1970, and type."""
    out = events.withWatermark(ts, late).groupBy(F.window(ts, interval).alias("w"), "event_type").agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("start"), "event_type", "n")


def daily_rollup(events: DataFrame, ts: str, late: str = "1 day") -> DataFrame:
    return tumbling_totals(events, "1 day", ts, late)


def index_changes(changes: DataFrame, id_col: str, order: str) -> DataFrame:
    """Of one batch's changes the last of each id."""
    rest = [c for c in changes.columns if c != id_col]
    return changes.groupBy(id_col).agg(F.max_by(F.struct(*rest), order).alias("r")).select(id_col, "r.*")


def apply_changes(index: DataFrame, last: DataFrame, id_col: str) -> DataFrame:
    """The index after the changes: deleted ids go, others are replaced."""
    return upsert_by_key(index, last, [id_col]).join(last.where("action = 'delete'").select(id_col), id_col, "left_anti")


def audit_ingest(lines: DataFrame, line: str = "value") -> DataFrame:
    """Audit rows of messages, stamped on arrival where they have no time."""
    return audit_from_message(lines.select(unwrap_envelope(F.col(line)).alias("body")), F.current_timestamp())


def incident_state(alerts: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Open and resolve of each service in order of time: ``service, incident_no, action, ts``. ``alerts``: service, status, ts (TIMESTAMP), event_id.

    Alerts wait in the state until the watermark passes them, so those that
    come out of order by less than ``late`` take their place; later ones are
    dropped. What a service has waiting is held in memory: the alerts of
    ``late`` and of one trigger, which ``maxFilesPerTrigger`` bounds.
    """

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        is_open, number, *held = state.get if state.exists else (False, 0, [], [], [])
        mark = state.getCurrentWatermarkMs() * 1000
        waiting = list(zip(*held, strict=True))
        for rows in parts:
            waiting += [x for x in zip(rows.us.tolist(), rows.event_id.tolist(), rows.status.tolist(), strict=True) if x[0] > mark]
        waiting.sort()
        out, rest = [], []
        for us, event_id, status in waiting:
            if us > mark:
                rest.append((us, event_id, status))
            elif status == "firing" and not is_open:
                is_open, number = True, number + 1
                out.append((key[0], number, "opened", us))
            elif status == "resolved" and is_open:
                is_open = False
                out.append((key[0], number, "closed", us))
        state.update((is_open, number, *(list(x) for x in zip(*rest, strict=True))) if rest else (is_open, number, [], [], []))
        if rest:
            state.setTimeoutTimestamp(rest[0][0] // 1000 + 1)
        yield pd.DataFrame(out, columns=["service", "incident_no", "action", "us"])

    live = alerts.where((F.trim("service") != "") & F.col("status").isin("firing", "resolved")).withWatermark("ts", late)
    live = live.select("service", "status", "ts", "event_id", F.unix_micros("ts").alias("us"))
    held = "is_open boolean, number int, ts array<long>, event_id array<long>, status array<string>"
    out = live.groupBy("service").applyInPandasWithState(
        step, "service string, incident_no int, action string, us long", held, "append", GroupStateTimeout.EventTimeTimeout
    )
    return out.select("service", "incident_no", "action", F.timestamp_micros("us").alias("ts"))


def presence(events: DataFrame, idle: str, ts: str, late: str = "10 minutes") -> DataFrame:
    """Sessions of a user in a document that end after an idle time."""
    out = events.withWatermark(ts, late).groupBy(F.session_window(ts, idle).alias("w"), "document_id", "user_id").agg(F.count("*").alias("n"))
    return out.select("document_id", "user_id", F.col("w.start").alias("joined_at"), F.col("w.end").alias("left_at"), "n")


def live_alerts(events: DataFrame, window: str, threshold: float, ts: str, late: str = "10 minutes") -> DataFrame:
    """Error shares of windows over the threshold, as windows close (append mode). ``alerts.held_alerts`` waits until a condition has held."""
    out = events.withWatermark(ts, late).groupBy(F.window(ts, window).alias("w")).agg((F.count_if(F.col("event_type") == "error") / F.count("*")).alias("ratio"))
    return out.where(F.col("ratio") > threshold).select(F.col("w.start").alias("start"), "ratio")
