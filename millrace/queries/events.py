"""Event analytics, audit, admin, windows and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import normalize as nz
from ..operators import aggregates as ag
from ..operators import digests as dg
from ..operators import joins as jn
from ..operators import sets as st
from ..operators import windows as wn
from ..sources import readers, sinks
from .registry import E, Tables, query

#: Which of the table's types stand for the platform's.
DAILY = {"document_created": "signup", "document_edited": "click", "comment_added": "view", "file_uploaded": "purchase", "file_shared": "error", "file_deleted": "-"}
USAGE = {"document.created": "signup", "document.viewed": "view", "document.edited": "click", "file.uploaded": "purchase", "file.downloaded": "view", "collab.session_started": "signup", "storage.allocated": "purchase", "storage.released": "error"}
NOW, NOW_SQL = "2024-01-25 00:00:00", "TIMESTAMP '2024-01-25 00:00:00'"


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def day(text: str):
    return F.lit(text).cast("date")


def listed(c: str):
    """A map as text: key=value in the order of keys."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string"))), ",")


@query("src01_events_ndjson", "SELECT event_id::VARCHAR AS event_id, event_type, epoch_us(ts) // 1000 AS ms FROM events")
def _(t: Tables) -> DataFrame:
    lines = t.events.select(F.to_json(F.struct(F.col("event_id").cast("string").alias("eventId"), F.col("event_type").alias("eventType"), F.unix_millis(F.col("ts").cast("timestamp")).cast("string").alias("timestamp"))).alias("value"))
    rows = readers.parse_events(lines)
    return rows.select(F.col("eventId").alias("event_id"), F.col("eventType").alias("event_type"), F.unix_millis("timestamp").alias("ms"))


@query("src02_event_store", "SELECT event_id, event_type FROM events WHERE CAST(ts::DATE AS VARCHAR) LIKE '2024-01-1%'")
def _(t):
    rows = t.events.withColumn("event_date", F.date_format("ts", "yyyy-MM-dd"))
    return readers.read_event_store(rows, "2024-01-1").select("event_id", "event_type")


@query("src08_paged_extract", "SELECT doc_id::VARCHAR AS id, coalesce(source, '') AS title, coalesce(n_chars, 0)::BIGINT AS size FROM documents")
def _(t):
    docs = t.documents.withColumn("doc_id", F.col("doc_id").cast("string"))
    return readers.paged_extract(docs, {"id": (["document_id", "doc_id"], ""), "title": (["file_name", "source"], ""), "size": (["size_bytes", "n_chars"], 0)}).withColumn("size", F.col("size").cast("long"))


@query("src09_structured_logs", "SELECT event_type AS service, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1")
def _(t):
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    lines = t.events.select(F.to_json(F.struct(F.col("ts").cast("string").alias("timestamp"), level.alias("level"), F.col("event_type").alias("service"), F.col("props").alias("message"))).alias("value"))
    good, _bad = readers.parse_logs(lines)
    return good.groupBy("service").agg(F.count("*").alias("n"), F.count_if(F.col("level") == "ERROR").alias("errors"))


@query("prj01_resolve_user", f"WITH {E} SELECT event_id, CASE WHEN event_type = 'click' THEN user_id WHEN event_type = 'view' THEN 'e' || user_id ELSE 'unknown' END AS user_id FROM e")
def _(t):
    rows = t.e.select("event_id", F.when(F.col("event_type") == "click", F.col("user_id")).otherwise("").alias("ownerId"), F.when(F.col("event_type") == "view", F.concat(F.lit("e"), "user_id")).alias("editedBy"))
    return nz.resolve_user_id(rows).select("event_id", "user_id")


@query("prj02_event_type", "SELECT event_id, coalesce(nullif(event_type, 'click'), 'unknown') AS kind FROM events")
def _(t):
    rows = t.events.select("event_id", F.nullif("event_type", F.lit("click")).alias("event_type"))
    return nz.normalise_event_type(rows).select("event_id", F.col("eventType").alias("kind"))


@query("prj03_hour_bucket", "SELECT hour, count(*) AS n FROM (SELECT CASE WHEN event_type = 'error' THEN '00' ELSE strftime(ts, '%H') END AS hour FROM events) GROUP BY 1")
def _(t):
    text = F.when(F.col("event_type") == "error", "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return t.events.select(nz.hour_bucket(text).alias("hour")).groupBy("hour").agg(F.count("*").alias("n"))


@query("prj04_unwrap_envelope", "SELECT event_id, CASE WHEN event_type = 'view' THEN 'view' ELSE event_type END AS kind FROM events")
def _(t):
    inner = F.to_json(F.struct(F.col("event_type").alias("kind")))
    body = F.when(F.col("event_type") == "view", F.to_json(F.struct(inner.alias("Message"), F.lit("t").alias("TopicArn")))).otherwise(inner)
    return t.events.select("event_id", F.get_json_object(nz.unwrap_envelope(body), "$.kind").alias("kind"))


@query("prj05_index_event", """SELECT event_id, CASE event_type WHEN 'click' THEN 'index' WHEN 'view' THEN 'delete' WHEN 'error' THEN NULL ELSE 'index' END AS action,
  user_id::VARCHAR AS id, event_type AS title FROM events""")
def _(t):
    u, k = F.col("user_id").cast("string"), F.col("event_type")
    flat = lambda kind: F.to_json(F.struct(F.lit(kind).alias("eventType"), u.alias("documentId"), k.alias("title")))
    snake = F.to_json(F.struct(F.lit("document_updated").alias("event_type"), F.struct(u.alias("document_id"), k.alias("title")).alias("payload")))
    plain = F.to_json(F.struct(F.lit("index").alias("action"), F.struct(u.alias("id"), k.alias("title")).alias("data")))
    body = F.when(k == "click", snake).when(k == "view", flat("document_deleted")).when(k == "error", flat("file_shared")).otherwise(plain)
    return nz.normalise_index_event(t.events.select("event_id", body.alias("body"))).select("event_id", "action", "id", "title")


@query("prj06_audit_from_message", """SELECT CASE WHEN event_type = 'error' THEN 'system' ELSE user_id::VARCHAR END AS user_id, CASE WHEN event_type = 'view' THEN 'share' ELSE event_type END AS action,
  CASE WHEN event_type = 'view' THEN 'file' ELSE 'unknown' END AS resource_type, count(*) AS n FROM events GROUP BY ALL""")
def _(t):
    u, k = F.col("user_id").cast("string"), F.col("event_type")
    body = F.when(k == "view", F.to_json(F.struct(F.lit("file_shared").alias("eventType"), u.alias("ownerId")))).otherwise(F.to_json(F.struct(k.alias("eventType"), F.when(k != "error", u).alias("userId"))))
    rows = nz.audit_from_message(t.events.select(body.alias("body")), F.lit(NOW).cast("timestamp"))
    return rows.groupBy("user_id", "action", "resource_type").agg(F.count("*").alias("n"))


@query("prj07_period_filter", f"SELECT event_id FROM events WHERE ts BETWEEN {NOW_SQL} - INTERVAL 7 DAYS AND {NOW_SQL}")
def _(t):
    return nz.period_filter(t.events, "ts", "WEEK", ntz(NOW)).select("event_id")


@query("prj08_filter_page", f"SELECT event_id, ts FROM events WHERE event_type = 'click' AND ts <= {NOW_SQL} ORDER BY ts DESC, event_id LIMIT 50 OFFSET 50")
def _(t):
    return nz.filter_page(t.events, {"event_type": "click", "user_id": None}, "ts", None, ntz(NOW), "event_id", 2, 50).select("event_id", "ts")


@query("prj08_filter_total", f"SELECT count(*) AS total, ceil(count(*) / 50.0)::BIGINT AS pages FROM events WHERE event_type = 'click' AND ts <= {NOW_SQL}")
def _(t):
    return nz.filter_total(t.events, {"event_type": "click", "user_id": None}, "ts", None, ntz(NOW), 50)


DOCS = "d AS (SELECT doc_id AS id, split_part(text, chr(10), 1) AS title, source AS owner_id, lang AS content_type, n_chars FROM documents)"


def documents(t: Tables) -> DataFrame:
    return t.documents.select(
        F.col("doc_id").alias("id"), F.split("text", "\n")[0].alias("title"), F.col("source").alias("owner_id"), F.col("lang").alias("content_type"), F.col("lang").alias("folder_id"),
        F.lit(False).alias("is_deleted"), (F.col("lang") == "es").alias("is_template"), F.col("n_chars").alias("word_count"), F.col("doc_id").alias("updated_at"),
    )


@query("prj09_document_filter", f"WITH {DOCS} SELECT id, n_chars AS word_count FROM d WHERE content_type = 'en' AND contains(lower(title), 'the') AND content_type <> 'es'")
def _(t):
    return nz.document_metadata_filter(documents(t), content_type="en", title="The", sort="word_count").select("id", "word_count")


@query("prj10_ilike", "SELECT c_custkey FROM customer WHERE contains(lower(c_name), '00_1') OR contains(lower(c_mktsegment), 'mach')")
def _(t):
    rows = nz.ilike_search(t.customer, "MACH", ["c_name", "c_mktsegment"]).select("c_custkey")
    return rows.union(nz.ilike_search(t.customer, "00_1", ["c_name"]).select("c_custkey")).distinct()


@query("prj11_active_window", """SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderdate <= TIMESTAMP '1998-01-01' AND (o_totalprice < 100000 OR o_orderdate + INTERVAL 90 DAYS >= TIMESTAMP '1998-01-01')""")
def _(t):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "O", "published").alias("status"), F.col("o_orderdate").alias("a"), F.when(F.col("o_totalprice") >= 100000, F.col("o_orderdate") + F.expr("INTERVAL 90 DAYS")).alias("b"))
    return nz.active_window(rows, "status", "a", "b", ntz("1998-01-01 00:00:00")).select("o_orderkey")


@query("prj12_retention", "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderdate < TIMESTAMP '1997-06-01'")
def _(t):
    return nz.retention_selection(t.orders, "o_orderpriority", ["1-URGENT", "5-LOW"], "o_orderdate", ntz("1997-06-01 00:00:00")).select("o_orderkey")


@query("prj13_value_map", "SELECT CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS v, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    padded = F.concat("o_orderstatus", F.lit("   "))
    return t.orders.select(nz.value_map(padded, {"F": "final", "O": "open"}).alias("v")).groupBy("v").agg(F.count("*").alias("n"))


@query("prj14_live_files", "SELECT doc_id AS id FROM documents WHERE source = 'src1' AND lang <> 'es' AND lang = 'en'")
def _(t):
    rows = t.documents.select(F.col("doc_id").alias("id"), F.col("source").alias("owner_id"), F.when(F.col("lang") != "en", F.col("lang")).alias("folder_id"), (F.col("lang") == "es").alias("is_trashed"), F.col("n_chars").alias("updated_at"))
    return nz.live_files(rows, "src1").select("id")


@query("prj15_validate_observations", """SELECT coalesce(CASE WHEN p_partkey IS NULL THEN 'unknown series' WHEN l_returnflag = 'R' THEN 'invalid date' WHEN l_shipdate > TIMESTAMP '1999-01-01' THEN 'future date'
  WHEN l_discount <= 0 THEN 'non-positive value' END, 'ok') AS reason, count(*) AS n FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 10) ON l_partkey = p_partkey GROUP BY 1""")
def _(t):
    obs = t.lineitem.select(F.col("l_partkey").alias("series_code"), F.when(F.col("l_returnflag") == "R", "1999-02-31").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("price_date"), F.col("l_discount").alias("value"))
    series = t.part.where("p_size > 10").select(F.col("p_partkey").alias("series_code"))
    return nz.validate_observations(obs, series, day("1999-01-01")).groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"))


@query("prj16_redact", "SELECT page_id, url || CASE WHEN contains(url, '#') THEN '' ELSE '&token=***&x=1' END AS url FROM pages")
def _(t):
    return t.pages.select("page_id", nz.redact(F.concat("url", F.when(F.contains("url", F.lit("#")), F.lit("")).otherwise("&token=abc.def&x=1"))).alias("url"))


@query("prj17_severity", "SELECT CASE event_type WHEN 'error' THEN 'critical' WHEN 'view' THEN 'low' WHEN 'click' THEN 'medium' ELSE 'medium' END AS severity, count(*) AS n FROM events GROUP BY 1")
def _(t):
    level = F.when(F.col("event_type") == "error", "critical").when(F.col("event_type") == "view", "info").when(F.col("event_type") == "click", "warning").otherwise(F.col("event_type"))
    return t.events.select(nz.severity_map(level).alias("severity")).groupBy("severity").agg(F.count("*").alias("n"))


@query("prj18_flags", """WITH u AS (SELECT DISTINCT user_id::VARCHAR AS user_id FROM events), f(name, enabled, pct) AS (VALUES ('beta', true, 40), ('off', false, 100), ('all', true, 100), ('listed', true, 0))
SELECT user_id, name, enabled AND (pct = 100 OR (name = 'listed' AND user_id IN ('3', '5')) OR ((('0x' || substr(h, 1, 8))::BIGINT * 36 + ('0x' || substr(h, 9, 8))::BIGINT * 16 + ('0x' || substr(h, 17, 8))::BIGINT * 96 + ('0x' || substr(h, 25, 8))::BIGINT) % 100) < pct) AS is_on
 FROM (SELECT *, md5(name || ':' || user_id) AS h FROM u, f)""")
def _(t):
    flags = t.spark.createDataFrame([("beta", True, 40, [], None), ("off", False, 100, [], None), ("all", True, 100, [], None), ("listed", True, 0, ["3", "5"], None)], "name string, enabled boolean, pct int, targets array<string>, expires_at timestamp")
    return nz.flag_enabled_for(t.e.select("user_id").distinct(), flags, F.lit(NOW).cast("timestamp"))


@query("prj19_index_rows", f"WITH {DOCS} SELECT id::VARCHAR AS id, title, 'document' AS type FROM d WHERE title <> ''")
def _(t):
    return nz.index_rows(documents(t), "document", {"id": ["document_id", "id"], "title": ["name", "title"]})


@query("prj19_rejects", f"WITH {DOCS} SELECT id::VARCHAR AS id, '' AS title, 'document' AS type, 'title is missing' AS reason FROM d WHERE id % 3 = 1 OR id % 3 = 2 AND title = '' UNION ALL SELECT '', title, 'document', 'id is missing' FROM d WHERE id % 3 = 0")
def _(t):
    """A third of the rows without an id, a third without a title."""
    rows = documents(t).withColumns({"id": F.when(F.col("id") % 3 > 0, F.col("id")), "title": F.when(F.col("id") % 3 != 1, F.col("title")).otherwise("")})
    rows = rows.withColumn("title", F.coalesce("title", F.lit("")))
    return nz.index_rejects(rows, "document", {"id": ["document_id", "id"], "title": ["name", "title"]})


@query("prj20_word_count", r"SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[\t\n\v\f\r ]+'), lambda x: x <> ''))::BIGINT AS n FROM documents")
def _(t):
    return t.documents.select("doc_id", nz.word_count(F.col("text")).cast("long").alias("n"))


# Joins


@query("jn01_asof", """WITH p AS (SELECT user_id, ts, max(value) AS v FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT event_id, v FROM (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error') l ASOF JOIN p ON l.user_id = p.user_id AND l.ts >= p.ts""")
def _(t):
    left = t.events.where("event_type = 'error'").select("event_id", "ts", "user_id")
    right = t.events.where("event_type = 'purchase'").select("ts", "user_id", F.col("value").alias("v"))
    return jn.asof_backward(left, right, "ts", ["user_id"], ["v"]).select("event_id", "v")


TERMS = """terms AS (SELECT c_custkey AS k, DATE '1995-01-01' + INTERVAL (n * 400) DAYS AS a, CASE WHEN n = 4 THEN NULL ELSE DATE '1995-01-01' + INTERVAL (n * 400 + 420) DAYS END AS b, n FROM customer, range(5) r(n))"""


def terms(t: Tables, key: str) -> DataFrame:
    n = F.explode(F.sequence(F.lit(0), F.lit(4))).alias("n")
    return t.customer.select(F.col("c_custkey").alias(key), n).select(key, F.date_add(day("1995-01-01"), F.col("n") * 400).alias("starts_on"), F.when(F.col("n") < 4, F.date_add(day("1995-01-01"), F.col("n") * 400 + 420)).alias("ends_on"), "n")


@query("jn02_effective_dated", f"""WITH {TERMS} SELECT o_orderkey, max(n)::BIGINT AS n FROM orders JOIN terms ON k = o_custkey AND a <= o_orderdate AND (b IS NULL OR b >= o_orderdate) GROUP BY 1""")
def _(t):
    facts = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("on_day"))
    return jn.effective_dated(facts, terms(t, "o_custkey"), "o_custkey", "on_day").select("o_orderkey", F.col("n").cast("long").alias("n"))


RATES = """rates AS (SELECT p_partkey * 10 AS rate_id, p_brand AS product, NULL::BIGINT AS agent, (p_size % 20 + 1)::DOUBLE AS pct, DATE '1995-01-01' + INTERVAL (p_size * 30) DAYS AS a, DATE '1995-01-01' + INTERVAL (p_size * 30 + 900) DAYS AS b FROM part WHERE p_partkey % 5 = 0
 UNION ALL SELECT p_partkey * 10 + 1, p_brand, p_partkey % 10, 50.0, DATE '1996-01-01', NULL FROM part WHERE p_partkey % 7 = 0)"""


def rates(t: Tables) -> DataFrame:
    p = t.part
    start = lambda n: F.date_add(day("1995-01-01"), n)
    a = p.where("p_partkey % 5 = 0").select((F.col("p_partkey") * 10).alias("rate_id"), F.col("p_brand").alias("product"), F.lit(None).cast("long").alias("agent"), (F.col("p_size") % 20 + 1).cast("double").alias("rate_pct"), start(F.col("p_size") * 30).alias("effective_from"), start(F.col("p_size") * 30 + 900).alias("effective_to"))
    b = p.where("p_partkey % 7 = 0").select((F.col("p_partkey") * 10 + 1).alias("rate_id"), F.col("p_brand").alias("product"), (F.col("p_partkey") % 10).alias("agent"), F.lit(50.0).alias("rate_pct"), day("1996-01-01").alias("effective_from"), F.lit(None).cast("date").alias("effective_to"))
    return a.unionByName(b)


@query("jn03_resolve_rate", f"""WITH {RATES}, q AS (SELECT o_orderkey, 'Brand#' || (o_custkey % 25 + 1) AS product, o_custkey % 12 AS agent, o_orderdate FROM orders)
SELECT o_orderkey, rate_id, CASE WHEN rate_id IS NULL THEN 'NO_RATE' END AS error FROM (SELECT o_orderkey, rate_id, row_number() OVER (PARTITION BY o_orderkey ORDER BY (r.agent IS NULL), a DESC, rate_id) AS n
 FROM q LEFT JOIN rates r ON r.product = q.product AND (r.agent IS NULL OR r.agent = q.agent) AND a <= o_orderdate AND (b IS NULL OR b >= o_orderdate)) WHERE n = 1""")
def _(t):
    q = t.orders.select("o_orderkey", F.concat(F.lit("Brand#"), (F.col("o_custkey") % 25 + 1).cast("string")).alias("product"), (F.col("o_custkey") % 12).alias("agent"), F.to_date("o_orderdate").alias("on_day"))
    return jn.resolve_rate(q, rates(t), "product", "agent", "on_day").select("o_orderkey", "rate_id", "error")


@query("jn04_orphans", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(t):
    return jn.orphans(t.documents.select("doc_id"), t.labels, "doc_id", "doc_id")


@query("jn05_parent_present", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' OR o_totalprice > 200000)")
def _(t):
    key = lambda df: df.select(F.rpad(F.col("o_orderkey").cast("string"), 12, " ").alias("k"))
    child = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_orderkey").cast("string").alias("k"))
    return jn.parent_present(child, key(t.orders.where("o_orderstatus = 'F'")), key(t.orders.where("o_totalprice > 200000")), ["k"]).select("l_orderkey", "l_linenumber")


@query("jn06_with_events", "SELECT o_orderkey, l_linenumber::BIGINT AS line FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_quantity > 25) ON l_orderkey = o_orderkey")
def _(t):
    lines = t.lineitem.where("l_quantity > 25").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").cast("long").alias("line"), "l_shipdate")
    return jn.with_events(t.orders.select("o_orderkey"), lines, "o_orderkey", ["l_shipdate", "line"]).select("o_orderkey", "line")


@query("jn07_temporal_violations", "SELECT l_orderkey, l_linenumber::BIGINT AS line FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate")
def _(t):
    events = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").cast("long").alias("line"), "l_shipdate")
    return jn.temporal_violations(events, t.orders, "o_orderkey", "l_shipdate", "o_orderdate").select(F.col("o_orderkey").alias("l_orderkey"), "line")


@query("jn08_latest_rows", "SELECT p_partkey, l_extendedprice AS price FROM part JOIN lineitem ON l_partkey = p_partkey WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem)")
def _(t):
    margins = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_shipdate", F.col("l_extendedprice").alias("price"))
    return jn.latest_rows(t.part.select("p_partkey"), margins, "p_partkey", "l_shipdate").select("p_partkey", "price")


@query("jn09_star_join", "SELECT n_name, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def _(t):
    ledger = t.lineitem.select(F.col("l_orderkey").alias("policy_id"))
    policies = t.orders.select(F.col("o_orderkey").alias("policy_id"), F.col("o_custkey").alias("c"))
    dims = [(t.customer, "c_custkey", "c", "c_nationkey"), (t.nation, "n_nationkey", "c_nationkey", "n_name")]
    return jn.star_join(ledger, policies, dims).groupBy("n_name").agg(F.count("*").alias("n"))


@query("jn10_users_with_quota", """WITH u AS (SELECT c_custkey, CASE WHEN c_custkey % 4 > 0 THEN (c_acctbal * 100)::BIGINT END AS used, CASE WHEN c_custkey % 4 > 0 THEN (c_custkey % 3) * 300000 END::BIGINT AS quota FROM customer)
SELECT c_custkey, used AS used_bytes, quota AS quota_bytes, CASE WHEN quota > 0 THEN sign(used) * ((abs(used) * 20000 + quota) // (2 * quota)) / 100.0 END AS usage_pct, CASE WHEN quota IS NOT NULL THEN greatest(quota - used, 0) ELSE 0 END AS remaining_bytes, used > quota AS over_quota FROM u""")
def _(t):
    quotas = t.customer.where("c_custkey % 4 > 0").select("c_custkey", F.round(F.col("c_acctbal") * 100).cast("long").alias("used_bytes"), (F.col("c_custkey") % 3 * 300000).alias("quota_bytes"))
    return jn.users_with_quota(t.customer.select("c_custkey"), quotas, "c_custkey")


@query("jn11_file_with_shares", "SELECT doc_id, coalesce(string_agg(q, ',' ORDER BY q), '') AS shares FROM documents LEFT JOIN (SELECT doc_id, quality || ':' || toxic AS q FROM labels) USING (doc_id) GROUP BY 1")
def _(t):
    out = jn.file_with_shares(t.documents.select("doc_id"), t.labels, "doc_id", ["quality", "toxic"])
    return out.select("doc_id", F.array_join(F.transform("shares", lambda s: F.concat_ws(":", s["quality"], s["toxic"])), ",").alias("shares"))


_SHARES = "s AS (SELECT l_orderkey AS file_id, l_suppkey AS shared_with, o_custkey AS owner_id, l_linenumber AS permission FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"


def _shares(t: Tables) -> DataFrame:
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_orderkey").alias("file_id"), F.col("l_suppkey").alias("shared_with"), F.col("o_custkey").alias("owner_id"), F.col("l_linenumber").alias("permission"))


def _listed(df: DataFrame, who: str) -> DataFrame:
    return df.select(who, F.array_join(F.transform("shares", lambda s: F.concat_ws(":", s["file_id"], s["permission"])), ",").alias("shares"))


@query("jn11_shared_with", f"WITH {_SHARES} SELECT shared_with, string_agg(file_id || ':' || permission, ',' ORDER BY file_id, permission) AS shares FROM s GROUP BY 1")
def _(t):
    return _listed(jn.shares_by(_shares(t), "shared_with", ["file_id", "permission"]), "shared_with")


@query("jn11_shared_by_owner", f"WITH {_SHARES} SELECT owner_id, string_agg(file_id || ':' || permission, ',' ORDER BY file_id, permission) AS shares FROM s GROUP BY 1")
def _(t):
    return _listed(jn.shares_by(_shares(t), "owner_id", ["file_id", "permission"]), "owner_id")


@query("jn11_share_of", f"WITH {_SHARES}, q AS (SELECT o_orderkey AS file_id, o_custkey % 100 AS shared_with FROM orders) SELECT file_id, shared_with, owner_id, permission FROM q LEFT JOIN s USING (file_id, shared_with)")
def _(t):
    asked = t.orders.select(F.col("o_orderkey").alias("file_id"), (F.col("o_custkey") % 100).alias("shared_with"))
    return jn.share_of(_shares(t), asked, ["file_id", "shared_with"])


@query("jn12_compare_sides", """WITH b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 1 THEN 'X' ELSE o_orderstatus END AS s, o_orderpriority AS p FROM orders WHERE o_orderkey % 10 <> 2 UNION ALL SELECT -1, 'O', 'x')
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'MISSING_TARGET' WHEN a.o_orderkey IS NULL THEN 'MISSING_SOURCE' WHEN a.o_orderstatus = b.s THEN 'AGREE' ELSE 'MISMATCH' END AS status,
 CASE WHEN a.o_orderstatus <> b.s THEN 'o_orderstatus' END AS field FROM orders a FULL JOIN b ON a.o_orderkey = b.o_orderkey""")
def _(t):
    a = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    b = a.where("o_orderkey % 10 <> 2").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 10 == 1, "X").otherwise(F.col("o_orderstatus")))
    extra = a.limit(1).select(F.lit(-1).cast("long").alias("o_orderkey"), F.lit("O").alias("o_orderstatus"), F.lit("x").alias("o_orderpriority"))
    return jn.compare_sides(a, b.unionByName(extra), "o_orderkey", ["o_orderstatus", "o_orderpriority"])


@query("jn12_by_digests", """WITH b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 997 = 1 THEN 'X' ELSE o_orderstatus END AS s, o_totalprice AS p FROM orders WHERE o_orderkey % 991 <> 2 UNION ALL SELECT -1, 'O', 0)
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'MISSING_TARGET' WHEN a.o_orderkey IS NULL THEN 'MISSING_SOURCE' ELSE 'MISMATCH' END AS status,
 CASE WHEN a.o_orderstatus <> b.s THEN 'o_orderstatus' END AS field FROM orders a FULL JOIN b ON a.o_orderkey = b.o_orderkey WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_orderstatus <> b.s""")
def _(t):
    """A few rows changed, gone and new; only rows of their buckets are compared."""
    k = F.col("o_orderkey")
    a = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    b = a.where(k % 991 != 2).withColumn("o_orderstatus", F.when(k % 997 == 1, "X").otherwise(F.col("o_orderstatus")))
    extra = a.limit(1).select(F.lit(-1).cast("long").alias("o_orderkey"), F.lit("O").alias("o_orderstatus"), F.lit(0.0).alias("o_totalprice"))
    return dg.compare_by_digests(a, b.unionByName(extra), "o_orderkey", ["o_orderstatus", "o_totalprice"])


@query("jn13_successor_class", "SELECT n_nationkey::BIGINT AS k, CASE WHEN n_nationkey % 2 = 0 THEN 'N' || n_nationkey WHEN n_name = 'NATION_3' THEN 'three' ELSE n_name END AS new_class FROM nation")
def _(t):
    policies = t.nation.select(F.col("n_name").alias("policy_code"), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))).otherwise("  ").alias("successor_code"))
    return jn.successor_class(t.nation, policies, "n_name", nz.value_map(F.col("n_name"), {"NATION_3": "three"})).select(F.col("n_nationkey").cast("long").alias("k"), "new_class")


# Aggregations


def _daily_sql() -> str:
    n = lambda k, a: f"count(*) FILTER (WHERE event_type = '{DAILY[k]}') AS {a}"
    return f"""WITH {E} SELECT count(DISTINCT CASE WHEN user_id <> 'unknown' THEN user_id END) AS active_users,
 count(DISTINCT CASE WHEN event_type IN ('signup', 'click') THEN resource_id END) AS active_documents, count(DISTINCT CASE WHEN event_type IN ('purchase', 'error', '-') THEN resource_id END) AS active_files, count(*) AS total_events,
 {n('document_created', 'documents_created')}, {n('document_edited', 'documents_edited')}, {n('comment_added', 'comments_added')}, {n('file_uploaded', 'files_uploaded')}, {n('file_shared', 'files_shared')}, {n('file_deleted', 'files_deleted')},
 coalesce(sum(bytes) FILTER (WHERE event_type = 'purchase'), 0)::BIGINT AS bytes_uploaded FROM e WHERE ts::DATE = DATE '2024-01-10'"""


@query("agg01_daily_summary", _daily_sql())
def _(t):
    return ag.daily_activity_summary(t.e.where(F.to_date("ts") == day("2024-01-10")), DAILY)


@query("agg02_user_actions", f"WITH {E} SELECT user_id, event_type, count(*) AS n, sum(count(*)) OVER (PARTITION BY user_id)::BIGINT AS total FROM e GROUP BY 1, 2")
def _(t):
    return ag.user_action_counts(t.e).select("user_id", F.explode("actions").alias("event_type", "n"), "total")


@query("agg03_hourly", "SELECT strftime(ts, '%H') AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(t):
    return ag.hourly_breakdown(t.e)


@query("agg04_peak_hour", "SELECT strftime(ts, '%H') AS hour, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, hour LIMIT 1")
def _(t):
    return ag.peak_hour(ag.hourly_breakdown(t.e))


def _rollup_sql() -> str:
    n = lambda k, a: f"count(*) FILTER (WHERE event_type = '{USAGE[k]}') AS {a}"
    s = lambda k: f"coalesce(sum(bytes) FILTER (WHERE event_type = '{USAGE[k]}'), 0)"
    return f"""SELECT ts::DATE AS day, count(*) AS total_events, count(DISTINCT user_id) AS users, {n('document.created', 'created')}, {n('document.viewed', 'viewed')}, {n('document.edited', 'edited')},
 {n('file.uploaded', 'uploaded')}, {n('file.downloaded', 'downloaded')}, {n('collab.session_started', 'sessions')}, {s('storage.allocated')}::BIGINT AS allocated, {s('storage.released')}::BIGINT AS released,
 ({s('storage.allocated')} - {s('storage.released')})::BIGINT AS net FROM e GROUP BY 1"""


@query("agg05_daily_usage_rollup", f"WITH {E} {_rollup_sql()}")
def daily_usage(t):
    return ag.daily_usage_rollup(t.e, USAGE)


@query("agg06_usage_header", f"WITH {E}, r AS ({_rollup_sql()}) SELECT min(day) AS window_start, max(day) AS window_end, count(*) AS day_count, sum(total_events)::BIGINT AS total_events FROM r")
def _(t):
    return ag.usage_report_header(daily_usage(t))


@query("agg07_dashboard", f"""WITH {E} SELECT count(DISTINCT user_id) AS active_users, count(*) FILTER (WHERE event_type = 'signup') AS documents_created, count(*) FILTER (WHERE event_type = 'purchase') AS files_uploaded,
 coalesce(sum(bytes) FILTER (WHERE event_type = 'purchase'), 0)::BIGINT AS storage_bytes, count(*) FILTER (WHERE event_type = 'signup') AS collab_sessions, count(*) AS total_events FROM e WHERE ts BETWEEN {NOW_SQL} - INTERVAL 30 DAYS AND {NOW_SQL}""")
def _(t):
    return ag.dashboard_summary(nz.period_filter(t.e, "ts", "month", ntz(NOW)), USAGE)


@query("agg08_user_activity", f"""WITH {E}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS n FROM e)
SELECT user_id, count(*) AS total, max(ts) AS last_active, string_agg(event_id::VARCHAR, ',' ORDER BY n) FILTER (WHERE n <= 10) AS recent FROM r GROUP BY 1""")
def _(t):
    return ag.user_activity(t.e).select("user_id", "total", "last_active", F.array_join(F.transform("recent", lambda x: x.cast("string")), ",").alias("recent"))


@query("agg09_document_stats", f"""WITH {E} SELECT resource_id, count(*) FILTER (WHERE event_type = 'view') AS views, count(*) FILTER (WHERE event_type = 'click') AS edits, count(*) FILTER (WHERE event_type = 'error') AS shares,
 count(DISTINCT CASE WHEN event_type = 'view' THEN user_id END) AS viewers, max(ts) FILTER (WHERE event_type = 'view') AS last_viewed, max(ts) FILTER (WHERE event_type = 'click') AS last_edited FROM e GROUP BY 1""")
def _(t):
    return ag.document_stats(t.e, {"viewed": "view", "edited": "click", "shared": "error"})


@query("agg10_top_content", f"WITH {E} SELECT resource_id, count(*) AS n, count(DISTINCT user_id) AS users FROM e WHERE event_type = 'view' GROUP BY 1 ORDER BY n DESC, resource_id LIMIT 10")
def _(t):
    return ag.top_content(t.e, "view", 10)


@query("agg10_top_titles", f"WITH {E}, n AS (SELECT resource_id, count(*) AS n, count(DISTINCT user_id) AS users FROM e WHERE event_type = 'view' GROUP BY 1 ORDER BY n DESC, resource_id LIMIT 10) SELECT resource_id, split_part(text, chr(10), 1) AS title, n, users FROM n LEFT JOIN documents ON doc_id::VARCHAR = resource_id")
def _(t):
    titles = t.documents.select(F.col("doc_id").cast("string").alias("resource_id"), F.split("text", "\n")[0].alias("title"))
    return ag.top_titles(ag.top_content(t.e, "view", 10), titles)


@query("agg11_active_users", f"WITH {E} SELECT user_id, count(*) AS n, max(ts) AS last_active FROM e WHERE ts BETWEEN {NOW_SQL} - INTERVAL 7 DAYS AND {NOW_SQL} GROUP BY 1")
def _(t):
    return ag.active_users(nz.period_filter(t.e, "ts", "7d", ntz(NOW)))


@query("agg12_storage_usage", f"""WITH {E}, k AS (SELECT user_id, event_type, sum(coalesce(bytes, 0))::BIGINT AS b FROM e GROUP BY 1, 2)
SELECT user_id, coalesce(sum(CASE event_type WHEN 'purchase' THEN bytes WHEN 'error' THEN -bytes ELSE 0 END), 0)::BIGINT AS total_bytes,
 count(DISTINCT CASE WHEN event_type = 'purchase' THEN resource_id END) AS files, count(DISTINCT CASE WHEN event_type = 'signup' THEN resource_id END) AS documents,
 any_value(t) AS bytes_by_type
FROM e JOIN (SELECT user_id, string_agg(event_type || '=' || b, ',' ORDER BY event_type) AS t FROM k GROUP BY 1) USING (user_id) GROUP BY 1""")
def _(t):
    return ag.storage_usage(t.e, "purchase", "error", "signup").withColumn("bytes_by_type", listed("bytes_by_type"))


@query("agg13_activity_trend", f"""WITH {E}, r AS ({_rollup_sql()}) SELECT sum(total_events)::BIGINT AS total_events, max(users) AS peak_users, round(sum(total_events)::DECIMAL(30, 6) / count(*), 2)::DOUBLE AS avg_daily, count(*) AS days
 FROM r WHERE day BETWEEN DATE '2024-01-25' - 10 AND DATE '2024-01-25'""")
def _(t):
    return ag.activity_trend(daily_usage(t), day("2024-01-25"), 10)


@query("agg14_user_totals", f"""WITH {E}, d AS (SELECT user_id, ts::DATE AS day, event_type, count(*) AS n FROM e GROUP BY ALL),
u AS (SELECT user_id, sum(n)::BIGINT AS total, count(DISTINCT day) AS active_days FROM d GROUP BY 1 ORDER BY total DESC, user_id LIMIT 500)
SELECT user_id, event_type AS kind, sum(n)::BIGINT AS n, any_value(total) AS total, any_value(active_days) AS active_days FROM d JOIN u USING (user_id) GROUP BY 1, 2""")
def _(t):
    daily = t.e.groupBy("user_id", F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))
    daily = daily.groupBy("user_id", "day").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("actions"))
    return ag.user_totals(daily, top=500).select("user_id", F.explode("actions").alias("kind", "n"), "total", "active_days")


@query("agg15_user_audit", f"""WITH {E}, a AS (SELECT *, 'r' || (resource_id::INT % 4) AS resource_type FROM e),
x AS (SELECT user_id, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS actions FROM (SELECT user_id, event_type, count(*) AS n FROM a GROUP BY ALL) GROUP BY 1),
y AS (SELECT user_id, string_agg(resource_type || '=' || n, ',' ORDER BY resource_type) AS resource_types FROM (SELECT user_id, resource_type, count(*) AS n FROM a GROUP BY ALL) GROUP BY 1),
z AS (SELECT user_id, string_agg(event_id::VARCHAR, ',' ORDER BY ts DESC, event_id DESC) AS recent FROM (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 10) GROUP BY 1)
SELECT user_id, total, first_activity, last_activity, actions, resource_types, recent
FROM (SELECT user_id, count(*) AS total, min(ts) AS first_activity, max(ts) AS last_activity FROM a GROUP BY 1) JOIN x USING (user_id) JOIN y USING (user_id) JOIN z USING (user_id)""")
def _(t):
    audit = t.e.withColumn("resource_type", F.concat(F.lit("r"), (F.col("resource_id").cast("int") % 4).cast("string")))
    report = ag.user_audit_report(audit)
    return report.withColumns({"actions": listed("actions"), "resource_types": listed("resource_types"), "recent": F.array_join(F.transform("recent", lambda x: x.cast("string")), ",")})


@query("agg16_compliance", f"""WITH {E} SELECT CASE WHEN grouping(event_type) = 0 THEN 'action' WHEN grouping(resource_id) = 0 THEN 'resource' ELSE 'all' END AS part, coalesce(event_type, resource_id, '') AS name, count(*) AS n, count(DISTINCT user_id) AS users
 FROM e GROUP BY GROUPING SETS ((event_type), (resource_id), ())""")
def _(t):
    return ag.compliance_report(t.e)


@query("agg17_suspicious", f"""WITH {E}, n AS (SELECT CASE WHEN user_id::INT % 20 < 16 THEN '0' ELSE user_id END AS user_id, count(*) AS n FROM e GROUP BY 1)
SELECT user_id, n, 'Unusually high activity: ' || n || ' events (threshold: ' || round(l)::BIGINT || ')' AS reason FROM n, (SELECT greatest(avg(n) * 3, 100) AS l FROM n) WHERE n > l""")
def _(t):
    u = F.when(F.col("user_id").cast("int") % 20 < 16, "0").otherwise(F.col("user_id"))
    return ag.suspicious_users(t.e.withColumn("user_id", u))


SEARCH = "s AS (SELECT lower(split_part(text, ' ', 1)) AS query, (length(text) % 7)::BIGINT AS result_count FROM conversations)"


@query("agg18_search_analytics", f"""WITH {SEARCH} SELECT * FROM (SELECT 'top' AS part, query, count(*) AS n FROM s GROUP BY 2 ORDER BY n DESC, query LIMIT 20) UNION ALL
 SELECT * FROM (SELECT 'zero', query, count(*) AS n FROM s WHERE result_count = 0 GROUP BY 2 ORDER BY n DESC, query LIMIT 20) UNION ALL SELECT 'total', round(sum(result_count)::DECIMAL(30, 6) / count(*), 2)::DOUBLE::VARCHAR, count(*) FROM s""")
def _(t):
    q = t.conversations.select(F.lower(F.split("text", " ")[0]).alias("query"), (F.length("text") % 7).cast("long").alias("result_count"))
    top, zero, total = ag.search_analytics(q)
    part = lambda df, n: df.select(F.lit(n).alias("part"), "query", "n")
    return part(top, "top").unionByName(part(zero, "zero")).unionByName(total.select(F.lit("total").alias("part"), F.col("avg_results").cast("string").alias("query"), F.col("total").alias("n")))


@query("agg19_admin_metrics", """SELECT c_mktsegment, count(*) AS users, sum(c_acctbal::DECIMAL(20, 2))::DOUBLE AS used, round(avg(CASE WHEN quota <> 0 THEN (c_acctbal::DECIMAL(20, 4) * 100 / quota)::DECIMAL(28, 6) END), 2)::DOUBLE AS avg_pct,
 count(*) FILTER (WHERE c_acctbal > quota) AS over_quota FROM (SELECT *, c_custkey % 5 * 1000 AS quota FROM customer) GROUP BY 1""")
def _(t):
    return ag.admin_metrics(t.customer.withColumn("quota", F.col("c_custkey") % 5 * 1000), "c_mktsegment", "c_acctbal", "quota")


@query("agg19_platform_metrics", f"""WITH u AS (SELECT *, TIMESTAMP '2023-11-01' + INTERVAL (c_custkey % 100) DAYS AS created, 'role' || (c_custkey % 4) AS role, CASE WHEN c_acctbal < 0 THEN 'suspended' ELSE 'active' END AS status, 'tier' || (c_nationkey % 3) AS tier FROM customer),
w AS (SELECT * FROM events WHERE ts >= {NOW_SQL} - INTERVAL 7 DAYS)
SELECT 'role' AS part, role AS name, count(*) AS n FROM u GROUP BY 2 UNION ALL SELECT 'status', status, count(*) FROM u GROUP BY 2 UNION ALL SELECT 'tier', tier, count(*) FROM u GROUP BY 2
UNION ALL SELECT 'total', 'users', count(*) FROM u UNION ALL SELECT 'total', 'recent_signups', count(*) FROM u WHERE created >= {NOW_SQL} - INTERVAL 30 DAYS
UNION ALL SELECT 'total', 'enabled', count(*) FROM u WHERE c_acctbal > 5000 UNION ALL SELECT 'total', 'disabled', count(*) FROM u WHERE NOT c_acctbal > 5000
UNION ALL SELECT 'total', 'total_events', count(*) FROM events UNION ALL SELECT 'total', 'events_today', count(*) FROM events WHERE ts >= date_trunc('day', {NOW_SQL}) UNION ALL SELECT 'total', 'events_this_week', count(*) FROM w
UNION ALL SELECT * FROM (SELECT 'top_actions', event_type, count(*) AS n FROM w GROUP BY 2 ORDER BY n DESC, event_type LIMIT 5)""")
def _(t):
    users = t.customer.select(
        F.expr("TIMESTAMP_NTZ'2023-11-01 00:00:00' + make_dt_interval(cast(c_custkey % 100 as int))").alias("created"), F.concat(F.lit("role"), (F.col("c_custkey") % 4).cast("string")).alias("role"),
        F.when(F.col("c_acctbal") < 0, "suspended").otherwise("active").alias("status"), F.concat(F.lit("tier"), (F.col("c_nationkey") % 3).cast("string")).alias("tier"), "c_acctbal",
    )
    rich = F.col("c_acctbal") > 5000
    return ag.platform_metrics(users, t.events, ntz(NOW), "created", ["role", "status", "tier"], [("enabled", rich), ("disabled", ~rich)])


@query("agg20_class_totals", "SELECT o_orderpriority, count(*) AS n, sum(o_totalprice::DECIMAL(31, 8))::DOUBLE AS total FROM orders GROUP BY 1")
def _(t):
    return ag.class_totals(t.orders, "o_orderpriority", ["o_totalprice"]).select("o_orderpriority", "n", F.col("sum_o_totalprice").cast("double").alias("total"))


@query("agg21_usage_summary", f"WITH {E} SELECT event_type AS kind, count(*) AS events, sum(bytes)::BIGINT AS units FROM e WHERE ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-15' GROUP BY 1")
def _(t):
    return ag.usage_summary(t.e.select("ts", F.col("event_type").alias("kind"), F.col("bytes").alias("units")), day("2024-01-05"), day("2024-01-15"), at="ts")


@query("agg22_commission_summary", """SELECT s_suppkey AS agent_id, strftime(l_shipdate, '%Y-%m') AS period_month, p_type AS line_of_business, count(*) AS n, sum(l_extendedprice::DECIMAL(12, 2))::DOUBLE AS commission
 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY ALL""")
def _(t):
    month = F.date_format("l_shipdate", "yyyy-MM")
    fact = t.lineitem.select(F.col("l_suppkey").alias("agent_key"), F.xxhash64(month).alias("period_key"), F.col("l_partkey").alias("product_key"), F.col("l_extendedprice").cast("decimal(12,2)").alias("commission_amt"))
    agents = t.supplier.select(F.col("s_suppkey").alias("agent_key"), F.col("s_suppkey").alias("agent_id"))
    periods = t.lineitem.select(month.alias("period_month")).distinct().withColumn("period_key", F.xxhash64("period_month"))
    products = t.part.select(F.col("p_partkey").alias("product_key"), F.col("p_type").alias("line_of_business"))
    out = ag.commission_summary(fact, agents, periods, products)
    return out.withColumn("commission", F.col("commission").cast("double"))


@query("agg24_margin_series", "SELECT p_brand, l_shipdate::DATE AS d, round(sum((l_discount * 100)::DECIMAL(10, 4)) / count(*), 4)::DOUBLE AS margin_pct FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2")
def _(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_brand", F.to_date("l_shipdate").alias("d"), (F.col("l_discount") * 100).cast("decimal(10,4)").alias("margin_pct"))
    return ag.margin_series(rows, "p_brand", "d").withColumn("margin_pct", F.col("margin_pct").cast("double"))


@query("agg24_margins_of", "SELECT p_brand, l_shipdate::DATE AS d, round(sum((l_discount * 100)::DECIMAL(10, 4)) / count(*), 4)::DOUBLE AS margin_pct FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand IN ('Brand#11', 'Brand#23', 'Brand#1', 'Brand#2') AND l_shipdate::DATE BETWEEN DATE '1995-01-01' AND DATE '1996-06-30' GROUP BY 1, 2")
def _(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_brand", F.to_date("l_shipdate").alias("d"), (F.col("l_discount") * 100).cast("decimal(10,4)").alias("margin_pct"))
    some = ag.margin_series(rows, "p_brand", "d", ["Brand#11", "Brand#23", "Brand#1", "Brand#2"], day("1995-01-01"), day("1996-06-30"))
    return some.withColumn("margin_pct", F.col("margin_pct").cast("double"))


@query("agg25_price_series", "SELECT o_orderdate::DATE AS price_date, o_totalprice AS value FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'")
def _(t):
    prices = t.orders.select(F.col("o_orderpriority").alias("series_code"), F.to_date("o_orderdate").alias("price_date"), F.col("o_totalprice").alias("value"))
    return ag.price_series(prices, "1-URGENT", day("1996-01-01"), day("1996-12-31")).select("price_date", "value")


@query("agg25_market_status", "SELECT o_orderkey AS id, o_orderstatus AS status, o_custkey AS observations_count FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def _(t):
    return ag.market_status(t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("observations_count"), F.col("o_orderdate").alias("completed_at")))


@query("agg26_document_totals", "SELECT count(*) FILTER (WHERE lang <> 'es') AS documents, coalesce(sum(n_chars) FILTER (WHERE lang <> 'es'), 0)::BIGINT AS words, (SELECT count(*) FROM labels) AS versions FROM documents")
def _(t):
    docs = t.documents.select((F.col("lang") == "es").alias("is_deleted"), F.col("n_chars").alias("word_count"))
    return ag.document_totals(docs, t.labels)


@query("agg27_duplicate_windows", f"SELECT w, count(*) AS n FROM (SELECT date_trunc('hour', ts) AS w FROM events) WHERE w >= {NOW_SQL} GROUP BY 1 HAVING count(*) > 1")
def _(t):
    return ag.duplicate_windows(t.events.select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("w")), "w", ntz(NOW))


@query("agg28_cleanup_report", """WITH o AS (SELECT n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
SELECT (SELECT count(*) FROM documents) AS objects, (SELECT sum(n_chars) FROM documents)::BIGINT AS bytes, count(*) AS orphans, sum(n_chars)::BIGINT AS orphan_bytes,
 round(count(*)::DECIMAL(20, 6) * 100 / (SELECT count(*) FROM documents), 2)::DOUBLE AS orphan_pct FROM o""")
def _(t):
    inventory = t.documents.select("doc_id", F.col("n_chars").alias("size"))
    return ag.cleanup_report(inventory, jn.orphans(inventory, t.labels, "doc_id", "doc_id")).select("objects", "bytes", "orphans", "orphan_bytes", "orphan_pct")


@query("agg29_average_rating", "SELECT avg(quality + toxic * 6)::DOUBLE AS average, count(*) AS n, count(*) FILTER (WHERE quality + toxic * 6 NOT BETWEEN 1 AND 5) AS problems FROM labels")
def _(t):
    f = t.labels.select((F.col("quality") + F.col("toxic") * 6).alias("rating"))
    return ag.average_rating(f).join(ag.rating_problems(f).agg(F.count("*").alias("problems")))


@query("agg29_feedback_list", "SELECT event_id AS id, 1 + (floor(value)::BIGINT % 5) AS rating, ts AS created_at FROM events WHERE user_id = 7")
def _(t):
    f = t.events.select(F.col("event_id").alias("id"), "user_id", (1 + F.floor("value") % 5).alias("rating"), F.col("ts").alias("created_at"))
    return ag.feedback_list(f, 7).drop("user_id")


@query("agg30_reports_selected", "SELECT o_orderkey AS id, o_custkey AS requested_by FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' AND o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '2001-12-31' UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey = 7")
def _(t):
    reports = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("requested_by"), F.col("o_orderpriority").alias("category"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("created_at"))
    one = ag.reports_selected(reports, category="1-URGENT", status="O", since=ntz("1997-01-01 00:00:00"), until=ntz("2001-12-31 00:00:00"))
    return one.unionByName(ag.reports_selected(reports, requester=7)).select("id", "requested_by")


@query("agg30_report_registry", "SELECT o_orderstatus, year(o_orderdate)::BIGINT AS y, count(*) AS n FROM orders GROUP BY 1, 2")
def _(t):
    return ag.report_registry(t.orders.withColumn("y", F.year("o_orderdate").cast("long")), "o_orderstatus", ["y"])


@query("agg31_daily_type_counts", "SELECT ts::DATE AS event_date, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(t):
    return ag.daily_type_counts(t.events)


@query("agg32_unread", "SELECT conv_id, count(*) FILTER (WHERE role <> 'user') AS unread, count(*) AS total FROM conversations GROUP BY 1")
def _(t):
    notes = t.conversations.select("conv_id", F.when(F.col("role") == "user", F.col("turn")).alias("read_at"))
    return ag.unread_counts(notes, "conv_id", "read_at")


@query("agg32_page", """SELECT conv_id, turn, total, total > 2 AS has_more FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n, count(*) OVER (PARTITION BY conv_id) AS total FROM conversations) WHERE n <= 2""")
def _(t):
    return ag.notes_page(t.conversations.select("conv_id", "turn"), "conv_id", [F.desc("turn")], 1, 2)


# Windows


@query("win01_top_users", f"WITH {E} SELECT user_id, count(*) AS total FROM e GROUP BY 1 ORDER BY total DESC, user_id LIMIT 10")
def _(t):
    return wn.top_rows(ag.user_action_counts(t.e).select("user_id", "total"), "total", "user_id", 10)


@query("win02_recent_versions", "SELECT l_orderkey, l_linenumber::BIGINT AS line FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber, l_partkey, l_suppkey) <= 3")
def _(t):
    order = [F.col("l_shipdate").desc(), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]
    return wn.recent_per_key(t.lineitem, "l_orderkey", order, 3).select("l_orderkey", F.col("l_linenumber").cast("long").alias("line"))


@query("win03_latest_per_key", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def _(t):
    return wn.latest_per_key(t.events.select("user_id", "event_id", "event_type", "ts"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("win04_rollover", """WITH m AS (SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS m, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT a.o_custkey, a.m, least(6, coalesce((SELECT sum(b.n) FROM m b WHERE b.o_custkey = a.o_custkey AND b.m < a.m AND b.m >= a.m - INTERVAL 3 MONTHS), 0))::BIGINT AS rollover FROM m a""")
def _(t):
    m = t.orders.groupBy("o_custkey", F.to_date(F.date_trunc("month", "o_orderdate")).alias("m")).agg(F.count("*").alias("n"))
    return wn.rollover(m, "o_custkey", "m", "n", F.lit(3)).select("o_custkey", "m", F.col("rollover").cast("long").alias("rollover"))


@query("win05_fifo", """WITH r AS (SELECT o_custkey, o_orderkey, (o_totalprice * 100)::BIGINT AS c, coalesce(sum((o_totalprice * 100)::BIGINT) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM orders)
SELECT o_orderkey, greatest(0, least(c, 50000000 - before))::BIGINT AS used FROM r""")
def _(t):
    notes = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", F.round(F.col("o_totalprice") * 100).cast("long").alias("c"), F.lit(50000000).cast("long").alias("amount"))
    return wn.fifo_allocate(notes, "o_custkey", ["o_orderdate", "o_orderkey"], "c", "amount").select("o_orderkey", F.col("used").cast("long").alias("used"))


@query("win06_next_attempt", "SELECT o_orderkey, coalesce(max(l_linenumber), 0)::BIGINT + 1 AS attempt_no FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') ON l_orderkey = o_orderkey GROUP BY 1")
def _(t):
    attempts = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").cast("long").alias("attempt_no"))
    return wn.next_attempt(t.orders.select("o_orderkey"), attempts, "o_orderkey")


@query("win07_scd2", """WITH d AS (SELECT o_custkey, o_orderdate::DATE AS starts_on, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1, 2)
SELECT *, (lead(starts_on) OVER (PARTITION BY o_custkey ORDER BY starts_on) - INTERVAL 1 DAY)::DATE AS ends_on FROM d""")
def _(t):
    changes = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("starts_on"), F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("_seq"))
    return wn.scd2(changes, ["o_custkey"], "starts_on", "ends_on")


@query("win08_key_ranges", "SELECT (floor((n - 1) / 1000) + 1)::BIGINT AS seq, min(o_orderkey) AS from_key, max(o_orderkey) AS to_key, count(*) AS rows FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders) GROUP BY 1")
def _(t):
    return wn.key_ranges(t.orders, "o_orderkey", 1000)


@query("win09_resource_history", f"WITH {E} SELECT event_id, row_number() OVER (PARTITION BY resource_id ORDER BY ts DESC, event_id) AS place, count(*) OVER (PARTITION BY resource_id) AS n FROM e")
def _(t):
    return wn.resource_history(t.e, "resource_id", "ts", "event_id").select("event_id", F.col("place").cast("long").alias("place"), "n")


@query("win10_version_append", "SELECT conv_id, turn, 3 + row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS version FROM conversations")
def _(t):
    docs = t.conversations.select("conv_id").distinct().withColumn("version", F.lit(3).cast("long"))
    return wn.version_append(docs, t.conversations.select("conv_id", "turn"), "conv_id", ["turn"])


@query("win10_version_restore", "SELECT conv_id, max(turn) + 2 AS version, min_by(text, turn) AS text FROM conversations GROUP BY 1 HAVING count(*) > 1")
def _(t):
    versions = t.conversations.select("conv_id", (F.col("turn") + 1).alias("version"), "text")
    first = versions.groupBy("conv_id").agg(F.min("version").alias("version"), F.count("*").alias("n")).where("n > 1").select("conv_id", "version")
    return wn.version_restore(versions, first, "conv_id")


# Sets


@query("set01_union_sources", "SELECT event_id, event_type, NULL::DOUBLE AS value FROM events WHERE event_type = 'click' UNION ALL SELECT event_id, NULL, value FROM events WHERE event_type = 'view'")
def _(t):
    return st.union_sources(t.events.where("event_type = 'click'").select("event_id", "event_type"), t.events.where("event_type = 'view'").select("event_id", "value"))


@query("set02_distinct", "SELECT DISTINCT o_orderpriority FROM orders")
def _(t):
    return st.distinct_values(t.orders, "o_orderpriority")


@query("set03_except_intersect", "SELECT 'only' AS part, count(*) AS n FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) UNION ALL SELECT 'both', count(*) FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)")
def _(t):
    n = lambda df, p: df.agg(F.lit(p).alias("part"), F.count("*").alias("n"))
    return n(st.except_keys(t.documents, t.labels, "doc_id"), "only").unionByName(n(st.intersect_keys(t.documents, t.labels, "doc_id"), "both"))


@query("set04_numbered_lines", """SELECT o_orderkey, n AS line_no, CASE n WHEN 1 THEN 'plan' ELSE 'tax' END AS line_type, (CASE n WHEN 1 THEN o_totalprice ELSE 0.5 END)::DOUBLE AS amount FROM orders, range(1, 3) r(n)""")
def _(t):
    out = st.numbered_lines(t.orders, ["o_orderkey"], [("plan", F.col("o_totalprice")), ("tax", F.lit(0.5))])
    return out.withColumn("line_no", F.col("line_no").cast("long"))


@query("set05_merged_page", "SELECT id, source_rank FROM (SELECT doc_id AS id, 0::BIGINT AS source_rank FROM documents WHERE n_chars < 100 UNION ALL SELECT page_id, 1 FROM pages) ORDER BY source_rank, id LIMIT 20 OFFSET 20")
def _(t):
    docs, pages = t.documents.where("n_chars < 100").select(F.col("doc_id").alias("id")), t.pages.select(F.col("page_id").alias("id"))
    return st.merged_page([docs, pages], [F.col("id")], 2, 20).select("id", F.col("source_rank").cast("long").alias("source_rank"))


@query("set06_plan_catalog", "SELECT p_partkey, p_retailprice FROM part WHERE p_size > 25")
def _(t):
    return st.plan_catalog(t.part, "p_retailprice", "p_partkey", F.col("p_size") > 25).select("p_partkey", "p_retailprice")


@query("snk02_upsert", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE o_orderstatus END AS s FROM orders")
def _(t):
    old = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("s"))
    return st.upsert_by_key(old, old.where("o_orderkey % 3 = 0").withColumn("s", F.lit("new")), ["o_orderkey"])


@query("snk03_insert_if_absent", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE 'new' END AS n FROM part")
def _(t):
    part = t.part.select("p_partkey", F.col("p_name").alias("n"))
    return st.insert_if_absent(part.where("p_partkey % 2 = 0"), part.withColumn("n", F.lit("new")), ["p_partkey"])


@query("snk04_csv_lines", """SELECT event_id::VARCHAR || ',' || CASE WHEN contains(props, '"') THEN '"' || replace(props, '"', '""') || '"' ELSE props END AS value FROM events""")
def _(t):
    return sinks.csv_lines(t.events, ["event_id", "props"])
