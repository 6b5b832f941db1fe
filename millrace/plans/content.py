"""Archiving, orphan quarantine, search rows, key-word search, incidents and bulk changes."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import orphans


def archive_split(audit: DataFrame, ts: str, cutoff: Column) -> tuple[DataFrame, DataFrame]:
    """Rows to archive (before the cutoff) and rows that stay; a null time stays."""
    old = F.coalesce(F.col(ts) < cutoff, F.lit(False))
    return audit.where(old), audit.where(~old)


def archive_report(audit: DataFrame, ts: str, cutoff: Column) -> DataFrame:
    old = F.coalesce(F.col(ts) < cutoff, F.lit(False))
    return audit.agg(F.count_if(old).alias("archived"), F.count_if(~old).alias("remaining"), F.min(F.when(old, F.col(ts))).alias("oldest"))


def quarantine_orphans(inventory: DataFrame, metadata: DataFrame, key: str, day: str) -> DataFrame:
    return orphans(inventory, metadata, key, key).withColumn("destination", F.concat(F.lit(f"quarantined/{day}/"), F.col(key).cast("string")))


def checked_reindex(source: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows, if there are as many as in the source; else an error when they are read."""
    n = source.agg(F.count("*").alias("_n")).join(rows.agg(F.count("*").alias("_m")))
    ok = F.broadcast(n.select(F.when(F.col("_n") == F.col("_m"), True).otherwise(F.raise_error(F.lit("search rows do not match their source")).cast("boolean")).alias("_ok")))
    return rows.join(ok).where("_ok").drop("_ok")


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def inverted_index(rows: DataFrame, fields: Sequence[tuple[str, int]]) -> DataFrame:
    """``term, id, weight``: each term of each row once for each field, the weightiest field kept."""
    parts = [rows.select("id", F.explode(F.array_distinct(terms(F.col(f)))).alias("term"), F.lit(w).alias("weight")) for f, w in fields]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("term", "id").agg(F.max("weight").alias("weight"))


def search_filter(rows: DataFrame, kind: str | None = None, owner: str | None = None, tags: Sequence[str] = (), since: str | None = None, until: str | None = None) -> DataFrame:
    """Rows of a type and an owner, with any of the tags, made within two dates; what is not given does not filter."""
    if kind:
        rows = rows.where(F.col("type") == kind)
    if owner:
        rows = rows.where(F.col("owner_id") == owner)
    if tags:
        rows = rows.where(F.arrays_overlap("tags", F.array(*map(F.lit, tags))))
    if since:
        rows = rows.where(F.col("created_at") >= since)
    return rows.where(F.col("created_at") <= until) if until else rows


def keyword_search(rows: DataFrame, fields: Sequence[tuple[str, int]], query: str, page: int = 1, size: int = 20) -> DataFrame:
    """``id, matched, score``: rows with most of the query's words first, then by field weight, then by id; without words, all rows.

    A text is searched for each word where it is read, without taking it
    apart, and nothing but the page's candidates is shuffled. For many queries
    over the same rows there are kept postings (``plans/search.py``).
    """
    words = sorted({w for w in query.lower().split() if w})
    if words:
        low = rows.select("id", *[F.lower(F.coalesce(f, F.lit(""))).alias(f"_{k}") for k, (f, _) in enumerate(fields)])
        # A plain search first; letters next to what it finds are looked at only in texts that have it.
        has = lambda k, w: F.col(f"_{k}").contains(w) & F.col(f"_{k}").rlike(rf"(?<![\p{{L}}\p{{N}}]){re.escape(w)}(?![\p{{L}}\p{{N}}])")
        weights = [F.greatest(F.lit(0), *[F.when(has(k, w), n).otherwise(0) for k, (_, n) in enumerate(fields)]) for w in words]
        hits = low.select("id", F.array(*weights).alias("w")).select("id", F.size(F.filter("w", lambda x: x > 0)).cast("long").alias("matched"), F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + x).alias("score"))
        hits = hits.where("matched > 0")
    else:
        hits = rows.select("id", F.lit(0).cast("long").alias("matched"), F.lit(0).cast("long").alias("score"))
    return hits.orderBy(F.desc("matched"), F.desc("score"), "id").offset((page - 1) * size).limit(size)


def highlight(text: Column, words: Sequence[str], length: int = 200) -> Column:
    """The start of a text with the words marked, but not as parts of longer ones: beside letters and digits of any script, marks over letters or underscores."""
    part = r"[\p{L}\p{Nd}\p{Mn}_]"
    pattern = f"(?i)(?<!{part})(" + "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True)) + f")(?!{part})"
    return F.regexp_replace(F.substring(text, 1, length), pattern, "<em>$1</em>")


def suggest(parts: Sequence[DataFrame], prefix: str, n: int = 10) -> DataFrame:
    """Distinct titles with a word that begins with the prefix, those of the first part first."""
    out = None
    for k, p in enumerate(parts):
        hit = p.where(F.exists(terms(F.col("title")), lambda w: w.startswith(prefix.lower()))).select("title", F.lit(k).alias("rank"))
        out = hit if out is None else out.unionByName(hit)
    return out.groupBy("title").agg(F.min("rank").alias("rank")).orderBy("rank", "title").limit(n)


def alerts_to_incidents(alerts: DataFrame, service: str = "service", status: str = "status", ts: str = "ts", id_col: str = "event_id") -> DataFrame:
    """Incidents: one opens with a firing alert unless its service has one open, and closes with the next resolved alert. Blank services are ignored.

    Alerts are taken day by day, and what a day begins with follows from how
    the one before ended, so no task sorts all alerts of a service.
    """
    rows = alerts.where((F.trim(service) != "") & F.col(status).isin("firing", "resolved")).withColumn("_day", F.to_date(ts))
    w = Window.partitionBy(service, "_day").orderBy(ts, id_col)
    fires = F.col(status) == "firing"
    rows = rows.withColumns({"_at": F.row_number().over(w), "_open": F.coalesce(fires & (F.lag(status).over(w) == "resolved"), F.lit(False)).cast("int")})
    days = rows.groupBy(service, "_day").agg(F.min_by(status, "_at").alias("_first"), F.max_by(status, "_at").alias("_last"), F.sum("_open").alias("_opens"))
    order = Window.partitionBy(service).orderBy("_day")
    opens = (F.col("_first") == "firing") & (F.coalesce(F.lag("_last").over(order), F.lit("resolved")) == "resolved")
    days = days.withColumn("_begins", opens.cast("int"))
    past = F.sum(F.col("_opens") + F.col("_begins")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    days = days.select(F.col(service).alias("_s"), F.col("_day").alias("_d"), (F.coalesce(past, F.lit(0)) + F.col("_begins")).alias("_base"))
    rows = rows.withColumn("_own", F.sum("_open").over(w)).join(days, (F.col(service) == F.col("_s")) & F.col("_day").eqNullSafe(F.col("_d")))
    rows = rows.withColumn("_no", F.col("_base") + F.col("_own"))
    end = F.min(F.when(F.col(status) == "resolved", F.col(ts)))
    out = rows.where("_no > 0").groupBy(service, "_no").agg(F.min(ts).alias("opened_at"), end.alias("closed_at"), F.count_if(F.col(status) == "firing").alias("alerts"))
    return out.withColumnRenamed("_no", "incident_no")


def bulk_update(users: DataFrame, ids: DataFrame, key: str, column: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Users with the listed ones changed, and ids that no user has."""
    listed = ids.select(key).distinct()
    hit = users.join(listed.withColumn("_hit", F.lit(True)), key, "left")
    changed = hit.withColumn(column, F.when(F.col("_hit"), F.lit(value)).otherwise(F.col(column))).drop("_hit")
    return changed, listed.join(users.select(key), key, "left_anti")


def bulk_operation(users: DataFrame, ids: DataFrame, key: str, operation: str, role: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Users after ``suspend``, ``activate``, ``delete`` or ``update_role`` of the listed ones, and ``success_count, failure_count, missing``."""
    done = {"suspend": ("status", "suspended"), "activate": ("status", "active"), "delete": ("status", "deleted"), "update_role": ("role", role)}
    if operation not in done:
        raise ValueError(f"Invalid operation: {operation}")
    changed, missing = bulk_update(users, ids, key, *done[operation])
    listed = ids.agg(F.count_distinct(key).alias("_listed"))
    counts = listed.join(missing.agg(F.count("*").alias("missing")))
    return changed, counts.select((F.col("_listed") - F.col("missing")).alias("success_count"), F.col("missing").alias("failure_count"), "missing")
