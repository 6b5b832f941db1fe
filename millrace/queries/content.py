"""Archiving, orphans, search, incidents and bulk changes over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import normalize as nz
from ..plans import content as ct
from ..plans import search as se
from ..scratch import scratch_path
from ..sources.sinks import decimal_text
from .events import documents, ntz
from .registry import Tables, query

CUT, CUT_SQL = "2024-01-15 00:00:00", "TIMESTAMP '2024-01-15'"


@query("dom14_archive", f"SELECT count(*) FILTER (WHERE ts < {CUT_SQL}) AS archived, count(*) FILTER (WHERE ts >= {CUT_SQL}) AS remaining, min(ts) FILTER (WHERE ts < {CUT_SQL}) AS oldest FROM events")
def _(t: Tables) -> DataFrame:
    return ct.archive_report(t.events, "ts", ntz(CUT))


@query("dom14_archive_rows", f"SELECT event_id, ts < {CUT_SQL} AS archived FROM events")
def _(t):
    old, new = ct.archive_split(t.events, "ts", ntz(CUT))
    return old.select("event_id", F.lit(True).alias("archived")).unionByName(new.select("event_id", F.lit(False).alias("archived")))


@query("dom15_quarantine", "SELECT doc_id, 'quarantined/2024-01-15/' || doc_id AS destination FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(t):
    return ct.quarantine_orphans(t.documents.select("doc_id"), t.labels, "doc_id", "2024-01-15")


@query("dom16_reindex", "SELECT doc_id::VARCHAR AS id, source AS title, 'document' AS type FROM documents WHERE source <> ''")
def _(t):
    rows = nz.index_rows(t.documents.withColumn("title", F.col("source")), "document", {"id": ["doc_id"], "title": ["title"]})
    return ct.checked_reindex(t.documents.where("source <> ''"), rows)


_INDEX = r"""w AS (SELECT id, term, max(weight) AS weight FROM (SELECT doc_id AS id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS term, 1 AS weight FROM documents UNION ALL
 SELECT doc_id, unnest(regexp_split_to_array(lower(split_part(text, chr(10), 1)), '[^\p{L}\p{N}]+')), 3 FROM documents) WHERE term IN ('the', 'und', 'tiing', 'ciónes') GROUP BY 1, 2)"""


@query("dom17_keyword_search", f"WITH {_INDEX} SELECT id, count(*) AS matched, sum(weight)::BIGINT AS score FROM w GROUP BY 1 ORDER BY matched DESC, score DESC, id LIMIT 20")
def _(t):
    rows = t.documents.select(F.col("doc_id").alias("id"), "text", F.split("text", "\n")[0].alias("title"))
    return ct.keyword_search(rows, [("title", 3), ("text", 1)], "The und tiing ciónes")


@query("dom17_filtered_search", f"WITH {_INDEX} SELECT id, count(*) AS matched, sum(weight)::BIGINT AS score FROM w JOIN documents ON doc_id = id WHERE lang = 'en' AND (source IN ('src1', 'src2') OR n_chars % 2 = 1) AND n_chars BETWEEN 100 AND 5000 GROUP BY 1 ORDER BY matched DESC, score DESC, id LIMIT 20 OFFSET 20")
def _(t):
    tags = F.array("source", F.when(F.col("n_chars") % 2 == 1, "odd").otherwise("even"))
    rows = t.documents.select(F.col("doc_id").alias("id"), "text", F.split("text", "\n")[0].alias("title"), F.col("lang").alias("type"), tags.alias("tags"), F.lpad(F.col("n_chars").cast("string"), 9, "0").alias("created_at"))
    rows = ct.search_filter(rows, kind="en", tags=["src1", "src2", "odd"], since="000000100", until="000005000")
    return ct.keyword_search(rows, [("title", 3), ("text", 1)], "The und tiing ciónes", page=2)


@query("dom17_inverted_index", r"""SELECT term, count(*) AS rows FROM (SELECT DISTINCT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS term FROM documents) WHERE term IN ('the', 'und', 'tiing', 'ciónes') GROUP BY 1""")
def _(t):
    index = ct.inverted_index(t.documents.select(F.col("doc_id").alias("id"), "text"), [("text", 1)])
    return index.where(F.col("term").isin("the", "und", "tiing", "ciónes")).groupBy("term").agg(F.count("*").alias("rows"))


@query("dom17_highlight", r"""SELECT doc_id, array_to_string(list_transform(regexp_extract_all(substr(text, 1, 200), '[\p{L}\p{Nd}\p{Mn}_]+|[^\p{L}\p{Nd}\p{Mn}_]+'),
 lambda x: CASE WHEN lower(x) IN ('the', 'und') THEN '<em>' || x || '</em>' ELSE x END), '') AS snippet FROM documents WHERE lang = 'en'""")
def _(t):
    return t.documents.where("lang = 'en'").select("doc_id", ct.highlight(F.col("text"), ["the", "und"]).alias("snippet"))


#: DuckDB's edit distance counts bytes, so the other letters of the tables stand as capitals, which lower-cased terms have none of.
_BYTES = "translate({}, 'ßäçèéêíñóöü', 'ABCDEFGHIJK')"
_EDITS = f"levenshtein({_BYTES.format('word')}, {_BYTES.format('term')})"
#: Queries of three words of each benchmark item, the first with a letter left out and the second with two swapped.
_TERMS = r"list_filter(regexp_split_to_array(lower(coalesce({}, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
_RANKED = rf"""q AS (SELECT item_id, list_distinct([substr(w[4], 1, 2) || substr(w[4], 4), substr(w[7], 1, 1) || substr(w[7], 3, 1) || substr(w[7], 2, 1) || substr(w[7], 4), w[9]]) AS ws,
  [substr(w[4], 1, 2) || substr(w[4], 4), substr(w[7], 1, 1) || substr(w[7], 3, 1) || substr(w[7], 2, 1) || substr(w[7], 4), w[9]] AS l FROM (SELECT item_id, {_TERMS.format("text")} AS w FROM benchmark) WHERE len(w) >= 9),
qw AS (SELECT DISTINCT item_id AS query_id, list_position(l, w) AS pos, w AS word FROM (SELECT item_id, l, unnest(ws) AS w FROM q) WHERE w <> ''),
o AS (SELECT doc_id AS id, field, weight, ts[i] AS term, i - 1 + field * 1000000000 AS place FROM (SELECT doc_id, field, weight, ts, unnest(range(1, len(ts) + 1)) AS i FROM (
  SELECT doc_id, 0 AS field, 3 AS weight, {_TERMS.format("split_part(text, chr(10), 1)")} AS ts FROM documents UNION ALL SELECT doc_id, 1, 1, {_TERMS.format("text")} FROM documents))),
v AS (SELECT word, term, {_EDITS} AS typos FROM (SELECT DISTINCT word FROM qw), (SELECT DISTINCT term FROM o)
  WHERE abs(length(word) - length(term)) <= 2 AND {_EDITS} <= CASE WHEN length(word) >= 9 THEN 2 WHEN length(word) >= 5 THEN 1 ELSE 0 END),
h AS (SELECT query_id, id, pos, typos, weight, place, min(typos) OVER (PARTITION BY query_id, id, pos) AS least FROM qw JOIN v USING (word) JOIN o USING (term)),
b AS (SELECT * FROM h WHERE typos = least),
p AS (SELECT query_id, id, sum(typos)::BIGINT AS typos, count(*) AS matched, sum(weight)::BIGINT AS score, count(*) FILTER (WHERE typos = 0) AS exact FROM (SELECT query_id, id, pos, min(typos) AS typos, max(weight) AS weight FROM b GROUP BY ALL) GROUP BY ALL),
s AS (SELECT query_id, id, place, [max(CASE WHEN pos = 1 THEN place END) OVER w, max(CASE WHEN pos = 2 THEN place END) OVER w, max(CASE WHEN pos = 3 THEN place END) OVER w] AS last FROM b WINDOW w AS (PARTITION BY query_id, id ORDER BY place ROWS UNBOUNDED PRECEDING)),
d AS (SELECT query_id, id, min(place - list_min(last)) AS proximity FROM s JOIN p USING (query_id, id) WHERE len(list_filter(last, lambda x: x IS NOT NULL)) = matched GROUP BY ALL),
r AS (SELECT query_id, id, matched, typos, CASE WHEN proximity < 500000000 THEN proximity END AS proximity, score, exact FROM p LEFT JOIN d USING (query_id, id))
SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY matched DESC, typos, proximity NULLS LAST, score DESC, exact DESC, id) AS rank, id, matched, typos, proximity, score, exact FROM r) WHERE rank <= 20"""


@query("dom17_ranked_search", f"WITH {_RANKED}")
def _(t):
    """The index is written once, and all queries are answered from it together."""
    at = scratch_path(t.spark, "index")
    se.write_index(t.documents.select(F.col("doc_id").alias("id"), "text", F.split("text", "\n")[0].alias("title")), [("title", 3), ("text", 1)], at)
    w = F.filter(ct.terms(F.col("text")), lambda x: x != "")
    four, seven, nine = (F.get(w, k) for k in (3, 6, 8))
    less = F.concat(F.substr(four, F.lit(1), F.lit(2)), F.substr(four, F.lit(4)))
    swapped = F.concat(F.substr(seven, F.lit(1), F.lit(1)), F.substr(seven, F.lit(3), F.lit(1)), F.substr(seven, F.lit(2), F.lit(1)), F.substr(seven, F.lit(4)))
    queries = t.benchmark.where(F.size(w) >= 9).select(F.col("item_id").alias("query_id"), F.concat_ws(" ", less, swapped, nine).alias("query"))
    return se.ranked_search(t.spark, at, queries)


@query("dom18_suggest", "SELECT title, min(rank)::BIGINT AS rank FROM (SELECT p_name AS title, 0 AS rank FROM part UNION ALL SELECT s_name, 1 FROM supplier) WHERE len(list_filter(regexp_split_to_array(lower(title), '[^a-z0-9]+'), lambda w: starts_with(w, 's'))) > 0 GROUP BY 1 ORDER BY rank, title LIMIT 10")
def _(t):
    parts = [t.part.select(F.col("p_name").alias("title")), t.supplier.select(F.col("s_name").alias("title"))]
    return ct.suggest(parts, "S").withColumn("rank", F.col("rank").cast("long"))


_ALERTS = "a AS (SELECT event_id, CASE WHEN user_id % 11 = 0 THEN ' ' ELSE 's' || (user_id % 20) END AS service, CASE event_type WHEN 'error' THEN 'firing' WHEN 'signup' THEN 'resolved' ELSE 'other' END AS status, ts FROM events)"


def alerts(events: DataFrame) -> DataFrame:
    status = F.when(F.col("event_type") == "error", "firing").when(F.col("event_type") == "signup", "resolved").otherwise("other")
    service = F.when(F.col("user_id") % 11 == 0, " ").otherwise(F.concat(F.lit("s"), (F.col("user_id") % 20).cast("string")))
    return events.select("event_id", service.alias("service"), status.alias("status"), "ts")


@query("dom19_incidents", f"""WITH {_ALERTS}, r AS (SELECT *, lag(status) OVER (PARTITION BY service ORDER BY ts, event_id) AS before FROM a WHERE trim(service) <> '' AND status IN ('firing', 'resolved')),
i AS (SELECT *, sum(CASE WHEN status = 'firing' AND coalesce(before, 'resolved') = 'resolved' THEN 1 ELSE 0 END) OVER (PARTITION BY service ORDER BY ts, event_id) AS no FROM r)
SELECT service, no::BIGINT AS incident_no, min(ts) AS opened_at, min(ts) FILTER (WHERE status = 'resolved') AS closed_at, count(*) FILTER (WHERE status = 'firing') AS alerts FROM i WHERE no > 0 GROUP BY 1, 2""")
def _(t):
    return ct.alerts_to_incidents(alerts(t.events))


@query("dom20_bulk_update", "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'suspended' ELSE c_mktsegment END AS status FROM customer UNION ALL SELECT DISTINCT o_custkey + 1000000, 'missing' FROM orders WHERE o_orderkey < 10")
def _(t):
    extra = t.orders.where("o_orderkey < 10").select((F.col("o_custkey") + 1000000).alias("c_custkey"))
    ids = t.customer.where("c_custkey % 5 = 0").select("c_custkey").unionByName(extra)
    changed, missing = ct.bulk_update(t.customer, ids, "c_custkey", "c_mktsegment", "suspended")
    return changed.select("c_custkey", F.col("c_mktsegment").alias("status")).unionByName(missing.withColumn("status", F.lit("missing")))


@query("dom20_bulk_counts", """SELECT count(*) FILTER (WHERE found) AS success_count, count(*) FILTER (WHERE NOT found) AS failure_count, count(*) FILTER (WHERE NOT found) AS missing, (SELECT count(*) FROM customer WHERE c_custkey % 5 = 0) AS deleted
FROM (SELECT DISTINCT k, k <= (SELECT max(c_custkey) FROM customer) AS found FROM (SELECT c_custkey AS k FROM customer WHERE c_custkey % 5 = 0 UNION ALL SELECT o_custkey + 1000000000 FROM orders WHERE o_orderkey < 10))""")
def _(t):
    users = t.customer.select("c_custkey", F.lit("active").alias("status"))
    ids = users.where("c_custkey % 5 = 0").select("c_custkey").unionByName(t.orders.where("o_orderkey < 10").select((F.col("o_custkey") + 1000000000).alias("c_custkey")))
    changed, counts = ct.bulk_operation(users, ids, "c_custkey", "delete")
    return counts.join(changed.agg(F.count_if(F.col("status") == "deleted").alias("deleted")))


@query("snk09_decimal_text", "SELECT o_orderpriority, sum(o_totalprice::DECIMAL(31, 8))::DECIMAL(38, 8)::VARCHAR AS total FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy("o_orderpriority").agg(decimal_text(F.sum(F.col("o_totalprice").cast("decimal(31,8)"))).alias("total"))


@query("prj09_documents_page", "SELECT doc_id AS id FROM documents WHERE lang <> 'es' ORDER BY doc_id DESC LIMIT 10 OFFSET 10")
def _(t):
    return nz.document_metadata_filter(documents(t)).offset(10).limit(10).select("id")
