"""Fixed-width conversion, reconciliation and data-quality checks over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import convert as cv
from ..operators import checks as dq
from ..operators import criteria as cr
from ..operators import purge as pg
from ..operators import reconcile as rc
from ..scratch import scratch_path, staged
from .registry import Tables, query

#: Cents as a packed decimal in text: the digits, then the sign half-byte.
_CENTS = "(o_totalprice * 100)::BIGINT"


@query("cnv01_unpack_decimal", f"SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN -{_CENTS} ELSE {_CENTS} END AS cents FROM orders")
def _(t: Tables) -> DataFrame:
    digits = F.lpad(F.round(F.col("o_totalprice") * 100).cast("long").cast("string"), 15, "0")
    sign = F.when(F.col("o_orderkey") % 7 == 0, "7").when(F.col("o_orderkey") % 2 == 0, "D").otherwise("C")
    raw = F.unhex(F.concat(digits, sign))
    return t.orders.select("o_orderkey", (cv.unpack_decimal(raw, 2) * 100).cast("long").alias("cents"))


#: A number as its lowest bytes hold it, in two's complement.
_LOW = "(({0} + {1}) % (2 * {1}) + 2 * {1}) % (2 * {1}) - {1}"


@query("cnv02_unpack_int", f"SELECT o_orderkey, {_LOW.format('(o_custkey - 500)', 1 << 15)} AS two, {_LOW.format('(-o_orderkey)', 1 << 31)} AS four, (o_orderkey - 7) * 1000003 AS eight FROM orders")
def _(t):
    """Fields of two, four and eight bytes; keys that need more are cut to their lowest bytes."""
    raw = lambda v, n: F.unhex(F.right(F.lpad(F.hex(v.cast("long")), 16, "0"), F.lit(2 * n)))
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return t.orders.select("o_orderkey", cv.unpack_int(raw(c - 500, 2)).alias("two"), cv.unpack_int(raw(-k, 4)).alias("four"), cv.unpack_int(raw((k - 7) * 1000003, 8)).alias("eight"))


@query("cnv03_decode_ebcdic", "SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_name || c_mktsegment END AS name FROM customer")
def _(t):
    latin = "".join(map(chr, range(32, 127)))
    text = F.concat("c_name", "c_mktsegment")
    raw = F.encode(F.translate(text, latin, latin.encode("cp037").decode("latin-1")), "ISO-8859-1")
    raw = F.when(F.col("c_custkey") % 9 == 0, F.concat(raw, F.unhex(F.lit("07")))).otherwise(raw)
    return t.customer.select("c_custkey", cv.decode_ebcdic(raw).alias("name"))


@query("cnv04_parse_ts12", "SELECT event_id, CASE WHEN event_type <> 'error' THEN epoch_us(ts) END AS us, CASE WHEN event_type <> 'error' THEN event_id % 1000000 END AS tail FROM events")
def _(t):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd-HH.mm.ss.SSSSSS"), F.lpad((F.col("event_id") % 1000000).cast("string"), 6, "0"))
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("2024-13-01"), F.substring(text, 11, 30))).otherwise(text)
    parsed = cv.parse_ts12(text)
    return t.events.select("event_id", F.unix_micros(parsed["ts"]).alias("us"), parsed["tail"].cast("long").alias("tail"))


@query("cnv05_parse_date8", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate::DATE END AS d FROM orders")
def _(t):
    text = F.when(F.col("o_orderkey") % 5 == 0, F.lit("19970231")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return t.orders.select("o_orderkey", cv.parse_date8(text).alias("d"))


@query("cnv06_fit", "SELECT CASE WHEN l_extendedprice >= 50000 THEN 'DECIMAL_OVERFLOW' END AS d, CASE WHEN length(l_linestatus || l_orderkey) > 4 THEN 'STRING_TRUNCATION' END AS s, count(*) AS n FROM lineitem GROUP BY 1, 2")
def _(t):
    price = F.col("l_extendedprice").cast("decimal(31,2)")
    rows = t.lineitem.select(cv.fit_decimal(price * 2, 7, 2).alias("d"), cv.fit_string(F.concat("l_linestatus", F.col("l_orderkey").cast("string")), 4).alias("s"))
    return rows.groupBy("d", "s").agg(F.count("*").alias("n"))


def _converted(t: Tables) -> DataFrame:
    """Orders as records with planted faults: bad sums, bad dates, repeated keys."""
    k = F.col("o_orderkey")
    raw = t.orders.select(
        F.when(k % 13 == 0, k - 1).otherwise(k).alias("key"), k.alias("idx"), F.when(k % 10 == 3, "x").otherwise(F.col("o_totalprice").cast("string")).alias("amount"),
        F.when(k % 10 == 3, "19971399").when(k % 10 == 4, "00000000").otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("day"),
    )
    amount, date = F.col("amount").try_cast("decimal(31,2)"), cv.parse_date8(F.col("day"))
    fields = [
        cv.Field("amount", amount, F.when(amount.isNull(), "PACKED_INVALID"), raw=F.col("amount")),
        cv.Field("day", date, F.when(date.isNull(), "DATE_INVALID"), "22007", F.col("day")),
    ]
    return cv.convert(raw, fields, ["key", "idx"])


_RULES = """raw AS (SELECT CASE WHEN o_orderkey % 13 = 0 THEN o_orderkey - 1 ELSE o_orderkey END AS key, o_orderkey AS idx, CASE WHEN o_orderkey % 10 = 3 THEN 'PACKED_INVALID' WHEN o_orderkey % 10 = 4 THEN 'DATE_INVALID' END AS rule FROM orders)"""


@query("cnv07_rejects", f"WITH {_RULES} SELECT coalesce(rule, 'loaded') AS rule, CASE rule WHEN 'PACKED_INVALID' THEN 'amount' WHEN 'DATE_INVALID' THEN 'day' END AS field, CASE rule WHEN 'PACKED_INVALID' THEN '78' WHEN 'DATE_INVALID' THEN '3030303030303030' END AS raw, count(*) AS n FROM raw GROUP BY 1, 2, 3")
def _(t):
    rows = _converted(t)
    none = F.lit(None).cast("string")
    good = cv.accepted(rows).select(F.lit("loaded").alias("rule"), none.alias("field"), none.alias("raw"))
    return good.unionByName(cv.rejected(rows).select("rule", "field", F.hex("raw").alias("raw"))).groupBy("rule", "field", "raw").agg(F.count("*").alias("n"))


@query("cnv08_first_wins", f"WITH {_RULES} SELECT idx, CASE WHEN rule IS NULL AND row_number() OVER (PARTITION BY key, rule IS NULL ORDER BY idx) > 1 THEN 'DUPLICATE_SOURCE_KEY' ELSE rule END AS rule FROM raw")
def _(t):
    return cv.first_wins(_converted(t), ["key"], "idx").select("idx", F.col("reject.rule").alias("rule"))


@query("cnv09_refusals", "SELECT CASE o_orderstatus WHEN 'F' THEN 'STRING_TRUNCATION' WHEN 'O' THEN 'DUPLICATE_TARGET_KEY' ELSE 'TARGET_REJECTED' END AS rule, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    code = F.when(F.col("o_orderstatus") == "F", "22001").when(F.col("o_orderstatus") == "O", "23505").otherwise("99999")
    return t.orders.select(cv.refusal_rule(code).alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


_HASH = "sha256(o_orderkey || '  |' || o_orderstatus || '|' || CASE WHEN o_custkey % 3 = 0 THEN '' ELSE (o_totalprice::DECIMAL(31, 8))::VARCHAR END || '|' || strftime(o_orderdate, '%Y%m%d'))"


def _hashed(t: Tables) -> DataFrame:
    columns = [(F.concat(F.col("o_orderkey").cast("string"), F.lit("  ")), "key"), (F.concat("o_orderstatus", F.lit("  ")), "text"), (F.when(F.col("o_custkey") % 3 > 0, F.col("o_totalprice")), "decimal"), (F.col("o_orderdate"), "date")]
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", cv.business_hash(columns).alias("hash"))


@query("cnv10_business_hash", f"SELECT o_orderkey, {_HASH} AS hash FROM orders")
def _(t):
    return _hashed(t).select("o_orderkey", "hash")


@query("cnv10_time_hash", "SELECT event_id, sha256(event_id || '|' || strftime(ts, '%Y-%m-%d-%H.%M.%S.%f') || lpad((event_id % 1000000)::VARCHAR, 6, '0')) AS hash FROM events")
def _(t):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd-HH.mm.ss.SSSSSS"), F.lpad((F.col("event_id") % 1000000).cast("string"), 6, "0"))
    return t.events.select("event_id", cv.business_hash([(F.col("event_id"), "int"), (cv.parse_ts12(text), "timestamp12")]).alias("hash"))


# Reconciliation


def _verdicts(t: Tables) -> DataFrame:
    rows = _hashed(t)
    staged = rows.withColumn("hash", F.when(F.col("o_orderkey") % 17 == 0, "bad").otherwise(F.col("hash")))
    archived = rows.where("o_orderkey % 19 = 0").withColumn("hash", F.when(F.col("o_orderkey") % 2 == 0, "other").otherwise(F.col("hash")))
    parents = t.customer.where("c_custkey % 23 > 0").select(F.col("c_custkey").alias("o_custkey"))
    return rc.row_verdicts(rows, staged, archived, parents, "o_orderkey", "o_custkey")


_VERDICT = "CASE WHEN o_orderkey % 17 = 0 THEN 'HASH_MISMATCH' WHEN o_orderkey % 38 = 0 THEN 'ARCHIVE_CONFLICT' WHEN o_custkey % 23 = 0 THEN 'ORPHAN_PARENT_NOT_SELECTED' ELSE 'OK' END"


@query("rec01_row_verdicts", f"SELECT o_orderkey, {_VERDICT} AS verdict FROM orders")
def _(t):
    return _verdicts(t)


def _moved(t: Tables) -> tuple[DataFrame, DataFrame]:
    a = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    k = F.col("o_orderkey")
    b = a.withColumns({
        "o_orderpriority": F.when((k % 100 == 7) & (F.col("o_orderpriority") == "1-URGENT"), "2-HIGH").otherwise(F.col("o_orderpriority")),
        "o_totalprice": F.when((k == 11) | (k == 12), F.col("o_totalprice") + 0.25).otherwise(F.col("o_totalprice")),
    })
    return a, b


_MOVED = """a AS (SELECT o_orderkey AS k, o_orderpriority AS c, o_totalprice::DECIMAL(31, 8) AS v FROM orders),
b AS (SELECT k, CASE WHEN k % 100 = 7 AND c = '1-URGENT' THEN '2-HIGH' ELSE c END AS c, CASE WHEN k IN (11, 12) THEN v + 0.25 ELSE v END AS v FROM a),
m AS (SELECT coalesce(x.c, y.c) AS c, CASE WHEN x.n IS DISTINCT FROM y.n THEN 'CLASS_COUNT_MISMATCH' WHEN x.s IS DISTINCT FROM y.s THEN 'CLASS_TOTAL_MISMATCH' END AS rule
 FROM (SELECT c, count(*) AS n, sum(v) AS s FROM a GROUP BY 1) x FULL JOIN (SELECT c, count(*) AS n, sum(v) AS s FROM b GROUP BY 1) y ON x.c = y.c)"""


@query("rec02_class_mismatch", f"WITH {_MOVED} SELECT c AS o_orderpriority, rule FROM m WHERE rule IS NOT NULL")
def _(t):
    return rc.class_mismatch(*_moved(t), "o_orderpriority", ["o_totalprice"])


@query("rec03_fail_moved", f"""WITH {_MOVED}, bad AS (SELECT c FROM m WHERE rule IS NOT NULL), j AS (SELECT a.k, a.c AS f, b.c AS g FROM a JOIN b USING (k)), mv AS (SELECT k, unnest([f, g]) AS c FROM j WHERE f <> g)
SELECT DISTINCT k AS o_orderkey FROM (SELECT k FROM mv JOIN bad USING (c) UNION ALL SELECT k FROM j JOIN bad ON g = bad.c WHERE bad.c NOT IN (SELECT c FROM mv))""")
def _(t):
    a, b = _moved(t)
    return rc.fail_moved_rows(a, b, rc.class_mismatch(a, b, "o_orderpriority", ["o_totalprice"]), "o_orderkey", "o_orderpriority")


@query("rec04_promote", f"SELECT o_orderkey, 'run-1' AS run_id FROM orders WHERE {_VERDICT} = 'OK' AND o_orderkey % 19 > 0")
def _(t):
    archive = t.orders.where("o_orderkey % 19 = 0")
    return rc.promote(t.orders.select("o_orderkey"), _verdicts(t), archive, "o_orderkey", "run-1")


@query("rec05_purge_plan", f"SELECT o_orderkey, 2 AS purge_order FROM orders WHERE {_VERDICT} = 'OK' AND o_orderkey % 3 > 0")
def _(t):
    return rc.purge_plan(_verdicts(t), t.orders.where("o_orderkey % 3 = 0"), "o_orderkey", 2)


_OK = f"(SELECT count(*) FROM orders WHERE {_VERDICT} = 'OK')"


@query("rec05_guarded_plan", f"SELECT o_orderkey, 2 AS purge_order FROM orders WHERE {_VERDICT} = 'OK' AND o_orderkey % 3 > 0")
def _(t):
    """The plan with the guard as a part of it."""
    verdicts = _verdicts(t)
    plan = rc.purge_plan(verdicts, t.orders.where("o_orderkey % 3 = 0"), "o_orderkey", 2)
    return pg.guarded(plan, verdicts.where("verdict = 'OK'"), rc.run_ledger(_stages(t)))


@query("rec05_order", "SELECT 'lineitem' AS table_name, 1 AS purge_order, count(*) AS n_rows FROM lineitem UNION ALL SELECT 'orders', 2, count(*) FROM orders UNION ALL SELECT 'customer', 3, count(*) FROM customer UNION ALL SELECT 'supplier', 2, count(*) FROM supplier")
def _(t):
    references = [("lineitem", "orders"), ("lineitem", "supplier"), ("orders", "customer"), ("customer", "nation"), ("supplier", "nation")]
    return pg.run_order({n: getattr(t, n) for n in ("orders", "customer", "supplier", "lineitem")}, references)


class _CutOff(Exception):
    pass


@query("rec05_purge_run", f"""SELECT 'orders' AS table_name, {_OK} AS validated, {_OK} AS purge_intended, {_OK} AS purged, false AS dry_run, (SELECT count(*) FROM orders) - {_OK} AS live
UNION ALL SELECT 'dry', {_OK}, {_OK}, 0, true, (SELECT count(*) FROM orders) - {_OK}""")
def _(t):
    """A run that is cut off after the source has deleted some waves, one of which the audit does not hold; then a rerun, and a dry run."""
    at, waves = scratch_path(t.spark, "purge"), []

    class Cut(pg.LakeSource):
        def delete(self, batches: DataFrame, run_id: str) -> None:
            super().delete(batches, run_id)
            waves.append(run_id)
            if len(waves) == 2:
                raise _CutOff

    orders = t.orders.select("o_orderkey")
    safe = staged(_verdicts(t).where("verdict = 'OK'").select("o_orderkey"))  # each run begins with them
    validated = safe.count()
    more = {"key": "o_orderkey", "validated": validated, "audit": pg.Audit(f"{at}/audit"), "run_id": "run-1", "batch_rows": 100, "wave": 3}
    try:
        pg.purge_table(t.spark, "orders", safe, source=Cut(orders, "o_orderkey", f"{at}/deleted"), **more)
    except _CutOff:
        pass
    source = pg.LakeSource(orders, "o_orderkey", f"{at}/deleted")
    ledger = pg.purge_table(t.spark, "orders", safe, source=source, **more | {"wave": 1000})
    dry = pg.purge_table(t.spark, "dry", safe, source=source, **more, dry_run=True)
    return ledger.unionByName(dry).crossJoin(F.broadcast(source.live(t.spark).agg(F.count("*").alias("live"))))


def _stages(t: Tables) -> DataFrame:
    verdict = _verdicts(t).select(F.lit("orders").alias("table_name"), F.when(F.col("verdict") == "OK", "validated").otherwise("validate_failed").alias("stage"))
    fixed = t.orders.select(F.lit("orders").alias("table_name"), F.explode(F.array(F.lit("extracted"), F.lit("loaded"))).alias("stage"))
    return fixed.unionByName(verdict).unionByName(verdict.where("stage = 'validated'").withColumn("stage", F.lit("purge_intended")))


@query("rec06_run_ledger", f"""SELECT 'orders' AS table_name, count(*) AS extracted, count(*) AS loaded, 0::BIGINT AS rejected, count(*) FILTER (WHERE {_VERDICT} = 'OK') AS validated, count(*) FILTER (WHERE {_VERDICT} <> 'OK') AS validate_failed,
 count(*) FILTER (WHERE {_VERDICT} = 'OK') AS purge_intended, 0::BIGINT AS purged FROM orders""")
def _(t):
    return rc.run_ledger(_stages(t))


@query("rec07_closes", "SELECT 'orders' AS table_name, true AS closes UNION ALL SELECT 'lineitem', false WHERE (SELECT count(*) FROM lineitem WHERE l_linenumber = 7) > 0")
def _(t):
    """The orders' ledger closes; of the lineitems those with number 7 were extracted and never loaded."""
    lines = t.lineitem.select(F.lit("lineitem").alias("table_name"), F.explode(F.when(F.col("l_linenumber") == 7, F.array(F.lit("extracted"))).otherwise(F.array(*map(F.lit, ("extracted", "loaded", "validated"))))).alias("stage"))
    return rc.closes(rc.run_ledger(_stages(t).unionByName(lines))).select("table_name", "closes")


@query("rec08_rejects_view", f"SELECT 'orders' AS table_name, o_orderkey AS key, 'validate' AS stage, {_VERDICT} AS rule, NULL::VARCHAR AS field FROM orders WHERE {_VERDICT} <> 'OK'")
def _(t):
    rows = _verdicts(t).where("verdict <> 'OK'").select(F.lit("orders").alias("table_name"), F.col("o_orderkey").alias("key"), F.lit("validate").alias("stage"), F.col("verdict").alias("rule"), F.lit(None).cast("string").alias("field"))
    return rc.rejects_view(rows, "key")


# Data quality


def suite(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    return dq.run_suite([
        dq.row_count_between(t.orders, "orders rows", 1000, 10**12), dq.not_null(t.orders, "orders not null", ["o_orderkey", "o_custkey", "o_orderdate"]), dq.unique(t.orders, "orders unique", "o_orderkey"),
        dq.unique(t.lineitem, "lineitem unique", "l_orderkey"), dq.foreign_key(t.orders, t.customer, "orders customer", "o_custkey", "c_custkey"), dq.foreign_key(t.documents, t.labels, "documents labels", "doc_id", "doc_id"),
        dq.temporal(lines, t.orders, "ships after order", "o_orderkey", "l_shipdate", "o_orderdate"), dq.enum(t.orders, "order status", "o_orderstatus", ["F", "O"]),
        dq.business_rule(t.lineitem, "discount", F.col("l_discount") <= 0.05),
    ])


_SUITE = """SELECT * FROM (SELECT 'orders rows' AS check_name, count(*) >= 1000 AS ok, count(*)::VARCHAR AS detail FROM orders
UNION ALL SELECT 'orders not null', count(*) = 0, count(*)::VARCHAR FROM orders WHERE o_orderkey IS NULL OR o_custkey IS NULL OR o_orderdate IS NULL
UNION ALL SELECT 'orders unique', count(o_orderkey) = count(DISTINCT o_orderkey), (count(o_orderkey) - count(DISTINCT o_orderkey))::VARCHAR FROM orders
UNION ALL SELECT 'lineitem unique', count(l_orderkey) = count(DISTINCT l_orderkey), (count(l_orderkey) - count(DISTINCT l_orderkey))::VARCHAR FROM lineitem
UNION ALL SELECT 'orders customer', count(*) = 0, count(*)::VARCHAR FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'documents labels', count(*) = 0, count(*)::VARCHAR FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'ships after order', count(*) = 0, count(*)::VARCHAR FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate
UNION ALL SELECT 'order status', count(*) = 0, coalesce(string_agg(s, ',' ORDER BY s), '') FROM (SELECT DISTINCT o_orderstatus AS s FROM orders WHERE o_orderstatus NOT IN ('F', 'O'))
UNION ALL SELECT 'discount', count(*) = 0, count(*)::VARCHAR FROM lineitem WHERE NOT coalesce(l_discount <= 0.05, false))"""


@query("dq01_to_dq07_suite", f"SELECT check_name, CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS status, detail FROM ({_SUITE})")
def _(t):
    return suite(t)


@query("dq08_suite_totals", f"SELECT count(*) FILTER (WHERE ok) AS passed, count(*) FILTER (WHERE NOT ok) AS failed FROM ({_SUITE})")
def _(t):
    return dq.suite_totals(suite(t))


#: Acceptance criteria as they come in a file.
_CRITERIA = """{"orders": {"min_rows": 1000, "max_rows": 1000000000000, "required_columns": ["o_orderkey", "o_custkey", "o_orderdate"], "unique_columns": ["o_orderkey"], "enum_constraints": {"o_orderstatus": ["F", "O"], "o_orderpriority": ["1-URGENT"]}},
"customer": {"min_rows": 1000000000000, "required_columns": ["c_name"], "unique_columns": ["c_nationkey", "c_mktsegment"]}, "labels": {"min_rows": 1, "required_columns": ["doc_id"], "unique_columns": ["doc_id"]}, "missing": {"min_rows": 1}}"""


@query("dq08_criteria", """SELECT check_name, CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS status, detail FROM (
SELECT 'orders: row count' AS check_name, count(*) BETWEEN 1000 AND 1000000000000 AS ok, count(*)::VARCHAR AS detail FROM orders
UNION ALL SELECT 'orders: not null', count(*) = 0, count(*)::VARCHAR FROM (SELECT o_orderkey AS c FROM orders UNION ALL SELECT o_custkey FROM orders UNION ALL SELECT CASE WHEN o_orderdate IS NULL THEN NULL ELSE 1 END FROM orders) WHERE c IS NULL
UNION ALL SELECT 'orders: unique', count(o_orderkey) = count(DISTINCT o_orderkey), (count(o_orderkey) - count(DISTINCT o_orderkey))::VARCHAR FROM orders
UNION ALL SELECT 'orders: values of o_orderstatus', count(*) = 0, coalesce(string_agg(s, ',' ORDER BY s), '') FROM (SELECT DISTINCT o_orderstatus AS s FROM orders WHERE o_orderstatus NOT IN ('F', 'O'))
UNION ALL SELECT 'orders: values of o_orderpriority', count(*) = 0, coalesce(string_agg(s, ',' ORDER BY s), '') FROM (SELECT DISTINCT o_orderpriority AS s FROM orders WHERE o_orderpriority NOT IN ('1-URGENT'))
UNION ALL SELECT 'customer: row count', count(*) >= 1000000000000, count(*)::VARCHAR FROM customer
UNION ALL SELECT 'customer: not null', count(*) = 0, count(*)::VARCHAR FROM customer WHERE c_name IS NULL
UNION ALL SELECT 'customer: unique', n = 0, n::VARCHAR FROM (SELECT count(c_nationkey) - count(DISTINCT c_nationkey) + count(c_mktsegment) - count(DISTINCT c_mktsegment) AS n FROM customer)
UNION ALL SELECT 'labels: row count', count(*) >= 1, count(*)::VARCHAR FROM labels
UNION ALL SELECT 'labels: not null', count(*) = 0, count(*)::VARCHAR FROM labels WHERE doc_id IS NULL
UNION ALL SELECT 'labels: unique', count(doc_id) = count(DISTINCT doc_id), (count(doc_id) - count(DISTINCT doc_id))::VARCHAR FROM labels
UNION ALL SELECT 'missing: exists', false, 'no such table')""")
def _(t):
    return cr.run_criteria(t.spark, {n: getattr(t, n) for n in ("orders", "customer", "labels")}, _CRITERIA)
