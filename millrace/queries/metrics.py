"""Time-series metrics over the events, and streams run to their end over the table's files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import metrics as mt
from ..operators import ranges as rg
from ..scratch import scratch_path
from ..sources.queue import queue_stream
from ..streaming import alerts as al
from ..streaming import merged as mg
from ..streaming import streams as sm
from ..streaming import traces as tr
from ..streaming.usage import UsageRollup
from .content import alerts
from .events import USAGE, _rollup_sql
from .registry import E, Tables, query

#: A counter for each event type, its running count by time, which falls to zero every 500 events.
_COUNTER = "c AS (SELECT event_type, event_id, ts, (row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id)) % 500 AS value FROM events)"


def counter(t: Tables) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("event_type").orderBy("ts", "event_id"))
    return t.events.select("event_type", "event_id", "ts", (n % 500).cast("long").alias("value"))


_INC = f"""{_COUNTER}, s AS (SELECT *, lag(value) OVER (PARTITION BY event_type ORDER BY ts) AS p FROM c),
i AS (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS start, sum(CASE WHEN p IS NULL THEN 0 WHEN value < p THEN value ELSE value - p END)::BIGINT AS increase FROM s GROUP BY 1, 2)"""


@query("ts01_increase", f"WITH {_INC} SELECT * FROM i")
def _(t: Tables) -> DataFrame:
    return mt.increase(counter(t), ["event_type"], "1 hour")


@query("ts01_rate", f"WITH {_INC} SELECT event_type, start, increase / 3600.0 AS rate FROM i")
def _(t):
    return mt.rate(counter(t), ["event_type"], "1 hour", 3600).select("event_type", "start", "rate")


@query("ts02_error_ratio", f"WITH {_INC} SELECT start, sum(increase) FILTER (WHERE event_type = 'error') / nullif(sum(increase), 0)::DOUBLE AS ratio FROM (SELECT start, event_type, increase FROM i UNION ALL SELECT start, 'error', 0 FROM i) GROUP BY 1")
def _(t):
    return mt.error_ratio(mt.increase(counter(t), ["event_type"], "1 hour"), ["start"], F.col("event_type") == "error", "increase")


@query("ts03_histogram_quantile", """WITH b(le) AS (VALUES (10.0), (25.0), (50.0), (100.0), (200.0), ('inf'::DOUBLE)), h AS (SELECT event_type, le, count(*) FILTER (WHERE value <= le) AS n FROM events, b GROUP BY 1, 2),
w AS (SELECT *, coalesce(lag(le) OVER p, 0) AS low, coalesce(lag(n) OVER p, 0) AS under, max(n) OVER (PARTITION BY event_type) * 0.95 AS t FROM h WINDOW p AS (PARTITION BY event_type ORDER BY le))
SELECT event_type, CASE WHEN isinf(le) THEN low ELSE low + (le - low) * (t - under) / (n - under) END AS quantile FROM w WHERE n >= t AND under < t""")
def _(t):
    bounds = F.array(*[F.lit(x) for x in (10.0, 25.0, 50.0, 100.0, 200.0, float("inf"))])
    rows = t.events.select("event_type", "value", F.explode(bounds).alias("le"))
    return mt.histogram_quantile(0.95, rows.groupBy("event_type", "le").agg(F.count_if(F.col("value") <= F.col("le")).alias("n")), ["event_type"])


#: Counters of the events of a type and instance, which begin again each day, and their rates over six hours at each full hour.
_RANGE = """c AS (SELECT event_type, user_id % 3 AS instance, epoch_us(ts) AS us, row_number() OVER (PARTITION BY event_type, user_id % 3, ts::DATE ORDER BY ts, event_id)::DOUBLE AS value FROM events)"""


def _rates_sql(series: str) -> str:
    """Rates of ``c`` by a scan of each window."""
    return f"""g AS (SELECT {series}, unnest(ts) AS t FROM (SELECT {series}, range(ceil(min(us) / 3600000000.0)::BIGINT * 3600000000, max(us) + 21600000000, 3600000000) AS ts FROM c GROUP BY ALL)),
s AS (SELECT *, lag(value) OVER (PARTITION BY {series}, t ORDER BY us, value) AS p FROM g JOIN c USING ({series}) WHERE us > t - 21600000000 AND us <= t),
a AS (SELECT {series}, t, count(*) AS n, min(us) AS f, max(us) AS l, first(value ORDER BY us, value) AS fv, last(value ORDER BY us, value) - first(value ORDER BY us, value) + sum(CASE WHEN value < p THEN p ELSE 0 END) AS inc FROM s GROUP BY ALL HAVING max(us) > min(us)),
b AS (SELECT *, (l - f) / 1e6 AS d, (l - f) / 1e6 / (n - 1) AS m, (f - t + 21600000000) / 1e6 AS x, (t - l) / 1e6 AS y FROM a),
e AS (SELECT * REPLACE (CASE WHEN x >= 1.1 * m THEN m / 2 ELSE x END AS x, CASE WHEN y >= 1.1 * m THEN m / 2 ELSE y END AS y) FROM b),
r AS (SELECT {series}, make_timestamp(t) AS ts, inc * (d + CASE WHEN inc > 0 AND fv >= 0 AND d * fv / inc < x THEN d * fv / inc ELSE x END + y) / d / 21600 AS rate FROM e)"""


def _counters(t: Tables) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("event_type", "instance", F.to_date("ts")).orderBy("ts", "event_id"))
    return t.events.select("event_type", (F.col("user_id") % 3).alias("instance"), "ts", "event_id").select("event_type", "instance", "ts", n.alias("value"))


def _hourly(rates: DataFrame) -> DataFrame:
    return rates.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("ts01_range_rate", f"WITH {_RANGE}, {_rates_sql('event_type, instance')} SELECT event_type, ts, sum(rate) AS rate FROM r GROUP BY 1, 2")
def _(t):
    return _hourly(rg.summed_rate(rg.range_rate(_counters(t), ["event_type", "instance"], 21_600, 3_600), ["event_type"]))


@query("ts02_range_ratio", f"WITH {_RANGE}, {_rates_sql('event_type, instance')} SELECT instance, ts, sum(rate) FILTER (WHERE event_type = 'error') / nullif(sum(rate), 0) AS ratio FROM r GROUP BY 1, 2 HAVING sum(rate) FILTER (WHERE event_type = 'error') IS NOT NULL")
def _(t):
    rates = rg.range_rate(_counters(t), ["event_type", "instance"], 21_600, 3_600)
    return _hourly(rg.rate_ratio(rates, ["instance"], F.col("event_type") == "error"))


@query("ts03_range_quantile", f"""WITH bounds(le) AS (VALUES (10.0), (25.0), (50.0), (100.0), (200.0), ('inf'::DOUBLE)),
c AS (SELECT event_type, le, epoch_us(ts) AS us, (count(*) FILTER (WHERE events.value <= le) OVER (PARTITION BY event_type, le, ts::DATE ORDER BY ts, event_id))::DOUBLE AS value FROM events, bounds), {_rates_sql('event_type, le')},
w AS (SELECT *, coalesce(lag(le) OVER p, 0) AS low, coalesce(lag(rate) OVER p, 0) AS under, max(rate) OVER (PARTITION BY event_type, ts) * 0.95 AS q FROM r WINDOW p AS (PARTITION BY event_type, ts ORDER BY le)),
h AS (SELECT event_type, ts, CASE WHEN isinf(le) THEN low ELSE low + (le - low) * (q - under) / (rate - under) END AS quantile, row_number() OVER (PARTITION BY event_type, ts ORDER BY le) AS k FROM w WHERE rate >= q AND under < q)
SELECT event_type, ts, quantile FROM h WHERE k = 1""")
def _(t):
    """Bucket counters are cumulative over bounds, so each event is a sample of each bound; rates come before the quantile."""
    bounds = (10.0, 25.0, 50.0, 100.0, 200.0, float("inf"))
    w = Window.partitionBy("event_type", F.to_date("ts")).orderBy("ts", "event_id")
    counts = [F.struct(F.lit(x).alias("le"), F.count_if(F.col("value") <= x).over(w).alias("n")) for x in bounds]
    rows = t.events.select("event_type", "ts", F.array(*counts).alias("b")).withColumn("b", F.explode("b")).select("event_type", "b.le", "ts", "b.n")
    rates = rg.range_rate(rows, ["event_type", "le"], 21_600, 3_600, value="n")
    return _hourly(mt.histogram_quantile(0.95, rg.summed_rate(rates, ["event_type", "le"]), ["event_type", "ts"], count="rate"))


@query("ts04_gauge_ratio", "SELECT c_nationkey::BIGINT AS nation, ratio, coalesce(ratio > 2, false) AS over FROM (SELECT c_nationkey, c / nullif(s, 0)::DOUBLE AS ratio FROM (SELECT c_nationkey, count(*) AS c FROM customer GROUP BY 1) JOIN (SELECT s_nationkey, count(*) FILTER (WHERE s_acctbal > 5000) AS s FROM supplier GROUP BY 1) ON c_nationkey = s_nationkey)")
def _(t):
    a = t.customer.groupBy(F.col("c_nationkey").cast("long").alias("nation")).agg(F.count("*").alias("value"))
    b = t.supplier.groupBy(F.col("s_nationkey").cast("long").alias("nation")).agg(F.count_if(F.col("s_acctbal") > 5000).alias("value"))
    return mt.gauge_ratio(a, b, ["nation"], 2.0)


@query("ts05_availability", "SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS start, avg(CASE WHEN value > 20 THEN 1 ELSE 0 END) AS availability FROM events GROUP BY 1, 2")
def _(t):
    return mt.availability(t.events.withColumn("up", (F.col("value") > 20).cast("int")), "event_type", "1 hour")


@query("ts05_up_down", "SELECT count(*) FILTER (WHERE v > 0) AS n_up, count(*) FILTER (WHERE v <= 0) AS n_down FROM (SELECT user_id, arg_max(CASE WHEN value > 20 THEN 1 ELSE 0 END, ts) AS v FROM events GROUP BY 1)")
def _(t):
    return mt.up_down(t.events.withColumn("up", (F.col("value") > 20).cast("int")), "user_id")


@query("ts06_changes", "SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS start, sum(CASE WHEN event_type <> p THEN 1 ELSE 0 END)::BIGINT AS changes FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events) GROUP BY 1, 2")
def _(t):
    return mt.changes(t.events, "user_id", "1 day", value="event_type").withColumn("changes", F.col("changes").cast("long"))


@query("ts07_alert_for", """WITH s AS (SELECT *, sum(CASE WHEN value > 40 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts) AS g FROM events)
SELECT user_id, min(ts) AS since, max(ts) AS until, floor(epoch_us(max(ts)) / 1000000) - floor(epoch_us(min(ts)) / 1000000) >= 36000 AS firing FROM s WHERE value > 40 GROUP BY user_id, g""")
def _(t):
    return mt.alert_for(t.events, ["user_id"], F.col("value") > 40, 36000)


@query("ts08_avg_per_request", f"WITH {E} SELECT user_id, sum(bytes)::DOUBLE / nullif(count(*), 0) AS mean FROM e GROUP BY 1")
def _(t):
    return mt.avg_per_request(t.e.select("user_id", "bytes", F.lit(1).alias("one")), ["user_id"], "bytes", "one")


@query("ts09_latency", """WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT user_id, count(*) AS n, max(CASE WHEN i = n // 2 THEN value END) AS p50, max(CASE WHEN i = least(n - 1, n * 95 // 100) THEN value END) AS p95, count(*) FILTER (WHERE event_type = 'error') / count(*)::DOUBLE AS error_share FROM r GROUP BY 1""")
def _(t):
    return mt.latency_summary(t.events, ["user_id"], "value", F.col("event_type") == "error")


@query("ts10_sample_traces", """WITH g AS (SELECT user_id, ts::DATE AS d, bool_or(event_type = 'error') OR epoch_us(max(ts)) - epoch_us(min(ts)) > 36000000000 AS keep FROM events GROUP BY 1, 2)
SELECT event_id FROM events JOIN g ON g.user_id = events.user_id AND g.d = ts::DATE WHERE keep""")
def _(t):
    rows = t.events.withColumn("trace", F.concat_ws(":", "user_id", F.to_date("ts")))
    return mt.sample_traces(rows, "trace", "ts", "ts", F.col("event_type") == "error", slow_ms=36_000_000, percent=0).select("event_id")


#: Traces are a user's events of a day; slow are those of over ten hours, and of the rest a tenth is kept by a hash that SQL has too.
_SAMPLED = """SELECT event_id FROM events JOIN (SELECT user_id, ts::DATE AS d, bool_or(event_type = 'error') OR epoch_us(max(ts)) - epoch_us(min(ts)) > 36000000000
  OR ('0x' || substr(md5(user_id || ':' || ts::DATE), 1, 8))::BIGINT % 100 < 10 AS keep FROM events GROUP BY 1, 2) g ON g.user_id = events.user_id AND g.d = ts::DATE WHERE keep"""


def _spans(events: DataFrame) -> DataFrame:
    return events.select("event_id", "event_type", "ts", F.concat_ws(":", "user_id", F.to_date("ts")).alias("trace"))


def _bucket() -> Column:
    return F.conv(F.substring(F.md5("trace"), 1, 8), 16, 10).cast("long") % 100


@query("ts10_sample_share", _SAMPLED)
def _(t):
    return mt.sample_traces(_spans(t.events), "trace", "ts", "ts", F.col("event_type") == "error", slow_ms=36_000_000, percent=10, bucket=_bucket()).select("event_id")


# Streams: the table's file as the source, run until all of it is read.


def _stream(t: Tables, files: int = 100) -> DataFrame:
    """The events' file or folder as a stream of so many files a batch, with times as TIMESTAMP."""
    rows = t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", files).parquet(f"{t.sf_dir}/events*.parquet")
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def _finished(t: Tables, out: DataFrame, mode: str) -> DataFrame:
    """Run a stream over what is there and read what it wrote, from the shared scratch folder."""
    at = scratch_path(t.spark, "stream")
    q = out.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/state").trigger(availableNow=True)
    if mode == "append":
        q.format("parquet").option("path", f"{at}/rows").start().awaitTermination()
    else:
        q.foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{at}/rows")).start().awaitTermination()
    return t.spark.read.schema(out.schema).parquet(f"{at}/rows")


@query("str02_dedup", "SELECT count(*) AS n, count(DISTINCT event_id) AS ids FROM events")
def _(t):
    return _finished(t, sm.dedup_events(_stream(t), "event_id", "ts").select("event_id"), "append").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"))


@query("str02_dedup_repeats", "SELECT count(*) AS n, count(DISTINCT event_id) AS ids, sum(event_id)::BIGINT AS total FROM events")
def _(t):
    """Every event comes twice, in batches in no order of time, so that most repeats are in another batch."""
    at = scratch_path(t.spark, "twice")
    rows = t.events.select("event_id", "ts")
    rows.unionByName(rows).repartition(5).write.parquet(f"{at}/in")
    stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/in").withColumn("ts", F.col("ts").cast("timestamp"))
    out = _finished(t, sm.dedup_events(stream, "event_id", "ts", "60 days").select("event_id"), "append")
    return out.agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"), F.sum("event_id").alias("total"))


@query("str03_tumbling", "SELECT time_bucket(INTERVAL 6 HOURS, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(t):
    """Windows come out, and their state ends, as the watermark passes them; a last event closes the rest."""
    rows = t.events.select("ts", "event_type")
    end = rows.agg((F.max("ts") + F.expr("INTERVAL 7 DAYS")).alias("ts")).select("ts", F.lit("~").alias("event_type"))
    out = _finished(t, sm.tumbling_totals(_restreamed(t, rows, end), "6 hours", "ts"), "append").where("event_type <> '~'")
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


def _upserted(t: Tables, out: DataFrame, mode: str, keys: list[str], order: str) -> DataFrame:
    """Run a stream whose batches are merged by key, and read the merged table."""
    at = scratch_path(t.spark, "stream")
    q = out.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/state").trigger(availableNow=True)
    table = mg.MergedTable(f"{at}/rows", mg.latest(keys, order))
    q.foreachBatch(table.write).start().awaitTermination()
    return table.read(t.spark, out.schema)


@query("str04_daily_rollup", "SELECT ts::DATE AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(t):
    """Batches bring the counts that changed; counts only grow, so the greatest is the last."""
    out = _upserted(t, sm.daily_rollup(_stream(t, 1), "ts"), "update", ["start", "event_type"], "n")
    return out.select(F.to_date("start").alias("day"), "event_type", "n")


@query("str04_usage_rollup", f"WITH {E} {_rollup_sql()}")
def _(t):
    """The events in batches of a file each, in no order of time; each batch is merged into the tables of counts and users."""
    at = scratch_path(t.spark, "usage")
    t.e.repartition(10).write.parquet(f"{at}/in")
    events = t.spark.readStream.schema(t.e.schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/in")
    rollup = UsageRollup(f"{at}/out", USAGE, F.col("user_id").cast("long"))
    q = events.writeStream.option("checkpointLocation", f"{at}/state").trigger(availableNow=True)
    q.foreachBatch(rollup.write).start().awaitTermination()
    return rollup.read(t.spark, t.e)


@query("str07_incident_state", """WITH a AS (SELECT event_id, CASE WHEN user_id % 11 = 0 THEN ' ' ELSE 's' || (user_id % 20) END AS service, CASE event_type WHEN 'error' THEN 'firing' WHEN 'signup' THEN 'resolved' ELSE 'other' END AS status, ts FROM events),
r AS (SELECT *, lag(status) OVER (PARTITION BY service ORDER BY ts, event_id) AS before FROM a WHERE trim(service) <> '' AND status <> 'other')
SELECT service, CASE status WHEN 'firing' THEN 'opened' ELSE 'closed' END AS action, ts FROM r WHERE status <> coalesce(before, 'resolved')""")
def _(t):
    """Alerts are taken in once the watermark passes them, so a last one of a service of its own, long after all others, ends the wait."""
    rows = alerts(t.events).select("service", "status", "ts", "event_id")
    end = t.events.agg((F.max("ts") + F.expr("INTERVAL 7 DAYS")).alias("ts")).select(F.lit("~").alias("service"), F.lit("firing").alias("status"), "ts", F.lit(-1).cast("long").alias("event_id"))
    out = _finished(t, sm.incident_state(_restreamed(t, rows, end)), "append").where("service <> '~'")
    return out.select("service", "action", F.col("ts").cast("timestamp_ntz").alias("ts"))


def _restreamed(t: Tables, rows: DataFrame, end: DataFrame) -> DataFrame:
    """Rows and a last one, written and read as a stream with ``ts`` as TIMESTAMP."""
    at = scratch_path(t.spark, "events")
    rows.write.parquet(f"{at}/0")
    end.write.parquet(f"{at}/1")
    stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1000).parquet(f"{at}/*")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query("str01_parse_stream", "SELECT event_type, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1")
def _(t):
    body = F.when(F.col("event_type") == "error", "not json").otherwise(F.to_json(F.struct(F.col("event_id").cast("string").alias("eventId"), F.col("event_type").alias("eventType"))))
    good, _dead = sm.parse_stream(_stream(t).select(body.alias("value")), "eventId STRING, eventType STRING", "eventId")
    return _finished(t, good, "append").groupBy(F.col("eventType").alias("event_type")).agg(F.count("*").alias("n"))


@query("str01_dead_letters", "SELECT count(*) AS n FROM events WHERE event_type = 'error'")
def _(t):
    body = F.when(F.col("event_type") == "error", "not json").otherwise(F.to_json(F.struct(F.col("event_id").cast("string").alias("eventId"))))
    _good, dead = sm.parse_stream(_stream(t).select(body.alias("value")), "eventId STRING, eventType STRING", "eventId")
    return _finished(t, dead, "append").agg(F.count("*").alias("n"))


@query("str01_queue_source", "SELECT CASE event_type WHEN 'error' THEN 'dead letter' ELSE event_type END AS kind, count(*) AS n FROM events GROUP BY 1")
def _(t):
    """The events as messages of a queue, a few bundles a batch; lines that are no JSON are kept as dead letters."""
    at = scratch_path(t.spark, "queue")
    body = F.when(F.col("event_type") == "error", "not json").otherwise(F.to_json(F.struct(F.col("event_id").cast("string").alias("eventId"), F.col("event_type").alias("eventType"))))
    t.events.select(body.alias("value")).repartition(12).write.text(f"{at}/q")
    good, dead = sm.parse_stream(queue_stream(t.spark, f"{at}/q", f"{at}/log", most=5, together=2), "eventId STRING, eventType STRING", "eventId")
    out = good.select(F.col("eventType").alias("kind")).unionByName(dead.select(F.lit("dead letter").alias("kind")))
    q = out.writeStream.format("parquet").option("path", f"{at}/rows").option("checkpointLocation", f"{at}/state").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return t.spark.read.schema(out.schema).parquet(f"{at}/rows").groupBy("kind").agg(F.count("*").alias("n"))


@query("str05_index_changes", "SELECT user_id, arg_max(event_type, event_id) AS title FROM events GROUP BY 1 HAVING arg_max(event_type, event_id) <> 'error'")
def _(t):
    """Each batch's last change of an id is merged into the table; deletions stay as rows, so that later batches cannot bring back older ones."""
    action = F.when(F.col("event_type") == "error", "delete").otherwise("index")
    changes = _stream(t, 1).select("user_id", "event_id", F.col("event_type").alias("title"), action.alias("action"))
    return _upserted(t, changes, "append", ["user_id"], "event_id").where("action <> 'delete'").select("user_id", "title")


@query("str06_audit_ingest", "SELECT user_id::VARCHAR AS user_id, event_type AS action, count(*) AS n FROM events GROUP BY ALL")
def _(t):
    body = F.to_json(F.struct(F.col("user_id").cast("string").alias("userId"), F.col("event_type").alias("eventType"), F.col("ts").cast("string").alias("timestamp")))
    rows = _finished(t, sm.audit_ingest(_stream(t).select(body.alias("value"))).drop("details"), "append")
    return rows.groupBy("user_id", "action").agg(F.count("*").alias("n"))


@query("str08_presence", """WITH r AS (SELECT ts, user_id, json_extract_string(props, '$.k') AS document_id, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS opens FROM events WINDOW w AS (PARTITION BY user_id, json_extract_string(props, '$.k') ORDER BY ts)),
s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id, document_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM r)
SELECT document_id, user_id, min(ts) AS joined_at, max(ts) + INTERVAL 30 MINUTES AS left_at, count(*) AS n FROM s GROUP BY document_id, user_id, no""")
def _(t):
    """Sessions close when the watermark passes them, so a last event long after all others, which is left out again, closes the rest."""
    rows = t.events.select("ts", "user_id", F.get_json_object("props", "$.k").alias("document_id"))
    end = rows.agg((F.max("ts") + F.expr("INTERVAL 7 DAYS")).alias("ts")).select("ts", F.lit(-1).cast("long").alias("user_id"), F.lit(None).cast("string").alias("document_id"))
    out = _finished(t, sm.presence(_restreamed(t, rows, end), "30 minutes", "ts"), "append").where("user_id >= 0")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("joined_at", "left_at")})


@query("str09_live_alerts", "SELECT start, ratio FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) FILTER (WHERE event_type = 'error') / count(*)::DOUBLE AS ratio FROM events GROUP BY 1) WHERE ratio > 0.3")
def _(t):
    rows = t.events.select("ts", "event_type")
    end = rows.agg((F.max("ts") + F.expr("INTERVAL 7 DAYS")).alias("ts")).select("ts", F.lit("view").alias("event_type"))
    out = _finished(t, sm.live_alerts(_restreamed(t, rows, end), "1 hour", 0.3, "ts"), "append")
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("str09_alerts_for", """WITH w AS (SELECT user_id % 5 AS service, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS t, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS bad FROM events GROUP BY 1, 2),
o AS (SELECT service, t, t - INTERVAL 1 HOUR * row_number() OVER (PARTITION BY service ORDER BY t) AS run FROM w WHERE n >= 2 AND bad / n::DOUBLE > 0.15),
r AS (SELECT service, min(t) AS since, max(t) AS last FROM o GROUP BY service, run)
SELECT service, 'pending' AS state, since, since AS ts FROM r UNION ALL
SELECT service, 'firing', since, since + INTERVAL 1 HOUR FROM r WHERE last > since UNION ALL
SELECT service, CASE WHEN last > since THEN 'resolved' ELSE 'inactive' END, since, last + INTERVAL 1 HOUR FROM r""")
def _(t):
    """Each hour's share of errors, of two events or more; it fires after another hour. A last event ends the wait for the watermark."""
    rows = t.events.select("ts", "event_type", (F.col("user_id") % 5).alias("service"))
    end = rows.agg((F.max("ts") + F.expr("INTERVAL 7 DAYS")).alias("ts")).select("ts", F.lit("view").alias("event_type"), F.lit(-1).cast("long").alias("service"))
    windows = al.condition_windows(_restreamed(t, rows, end), ["service"], 3600, F.col("event_type") == "error", 0.15, 2)
    with al.state_in_rocksdb(t.spark):
        out = _finished(t, al.held_alerts(windows, ["service"], 3600, 3600), "append")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("since", "ts")})


@query("ts10_stream", _SAMPLED)
def _(t):
    """Traces are decided a day after their last span; a last span ends the wait for the watermark."""
    rows = _spans(t.events)
    end = t.events.agg((F.max("ts") + F.expr("INTERVAL 7 DAYS")).alias("ts")).select(F.lit(-1).cast("long").alias("event_id"), F.lit("view").alias("event_type"), "ts", F.lit("~").alias("trace"))
    kept = tr.sample_trace_stream(_restreamed(t, rows, end), "trace", "ts", "ts", F.col("event_type") == "error", wait_seconds=86_400, slow_ms=36_000_000, percent=10, late="10 minutes", bucket=_bucket())
    with al.state_in_rocksdb(t.spark):
        return _finished(t, kept, "append").where("event_id >= 0").select("event_id")
