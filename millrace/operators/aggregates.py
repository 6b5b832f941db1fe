"""Aggregations over events, audit rows, documents, storage and markets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _n(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def _kind(*kinds: str, column: str = "event_type") -> Column:
    return F.coalesce(F.col(column).isin(*kinds), F.lit(False))


def daily_activity_summary(events: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Eleven measures of a day's events in one pass; the user 'unknown' is not active.

    ``names`` maps the platform's event types to those of the table.
    """
    t = lambda *ks: _kind(*[(names or {}).get(k, k) for k in ks])
    return events.agg(
        F.count_distinct(F.when(F.col("user_id") != "unknown", F.col("user_id"))).alias("active_users"),
        F.count_distinct(F.when(t("document_created", "document_edited"), F.col("resource_id"))).alias("active_documents"),
        F.count_distinct(F.when(t("file_uploaded", "file_shared", "file_deleted"), F.col("resource_id"))).alias("active_files"),
        F.count("*").alias("total_events"),
        _n(t("document_created"), "documents_created"), _n(t("document_edited"), "documents_edited"), _n(t("comment_added"), "comments_added"),
        _n(t("file_uploaded"), "files_uploaded"), _n(t("file_shared"), "files_shared"), _n(t("file_deleted"), "files_deleted"),
        F.coalesce(F.sum(F.when(t("file_uploaded"), F.coalesce("bytes", F.lit(0)))), F.lit(0)).cast("long").alias("bytes_uploaded"),
    )


def user_action_counts(events: DataFrame) -> DataFrame:
    """``user_id, actions`` (MAP of type to count) ``, total``."""
    n = events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return n.groupBy("user_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("event_type", "n")))).alias("actions"), F.sum("n").alias("total"))


def hourly_breakdown(events: DataFrame, ts: str = "ts") -> DataFrame:
    return events.groupBy(F.date_format(ts, "HH").alias("hour"), "event_type").agg(F.count("*").alias("n"))


def peak_hour(hourly: DataFrame) -> DataFrame:
    """The hour with most events, the earliest of equals."""
    total = hourly.groupBy("hour").agg(F.sum("n").alias("n"))
    return total.agg(F.max_by("hour", F.struct("n", -F.col("hour").cast("int"))).alias("hour"), F.max("n").alias("n"))


def daily_usage_rollup(events: DataFrame, names: dict[str, str], ts: str = "ts") -> DataFrame:
    """Per day with events: users, created, viewed, edited, transfers, sessions and storage allocated, released and net."""
    t = lambda k: _kind(names.get(k, k))
    size = F.coalesce(F.col("bytes"), F.lit(0)).cast("long")
    part = lambda k: F.coalesce(F.sum(F.when(t(k), size)), F.lit(0))
    return events.groupBy(F.to_date(ts).alias("day")).agg(
        F.count("*").alias("total_events"), F.count_distinct("user_id").alias("users"),
        _n(t("document.created"), "created"), _n(t("document.viewed"), "viewed"), _n(t("document.edited"), "edited"),
        _n(t("file.uploaded"), "uploaded"), _n(t("file.downloaded"), "downloaded"), _n(t("collab.session_started"), "sessions"),
        part("storage.allocated").alias("allocated"), part("storage.released").alias("released"),
        (part("storage.allocated") - part("storage.released")).alias("net"),
    )


def usage_report_header(rollup: DataFrame) -> DataFrame:
    return rollup.agg(F.min("day").alias("window_start"), F.max("day").alias("window_end"), F.count("*").alias("day_count"), F.coalesce(F.sum("total_events"), F.lit(0)).alias("total_events"))


def dashboard_summary(events: DataFrame, names: dict[str, str]) -> DataFrame:
    t = lambda k: _kind(names.get(k, k))
    return events.agg(
        F.count_distinct("user_id").alias("active_users"), _n(t("document.created"), "documents_created"), _n(t("file.uploaded"), "files_uploaded"),
        F.coalesce(F.sum(F.when(t("storage.allocated"), F.col("bytes"))), F.lit(0)).cast("long").alias("storage_bytes"),
        _n(t("collab.session_started"), "collab_sessions"), F.count("*").alias("total_events"),
    )


def user_activity(events: DataFrame, recent: int = 10, ts: str = "ts") -> DataFrame:
    """All users at once: counts by kind, last time, latest ``recent`` event ids (bounded for each user)."""
    counts = user_action_counts(events)
    last = events.groupBy("user_id").agg(F.max(ts).alias("last_active"))
    return counts.join(last, "user_id").join(latest_ids(events, "user_id", ts, "event_id", recent).withColumnRenamed("latest", "recent"), "user_id")


def latest_ids(events: DataFrame, key: str, ts: str, id_col: str, n: int) -> DataFrame:
    """The ids of the latest ``n`` rows of each key, ranked before they are gathered."""
    at = F.row_number().over(Window.partitionBy(key).orderBy(F.col(ts).desc(), id_col))
    top = events.select(key, ts, id_col, at.alias("_n")).where(F.col("_n") <= n)
    return top.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", id_col))), lambda x: x[id_col]).alias("latest"))


def document_stats(events: DataFrame, names: dict[str, str], ts: str = "ts") -> DataFrame:
    t = lambda k: _kind(names.get(k, k))
    return events.groupBy("resource_id").agg(
        _n(t("viewed"), "views"), _n(t("edited"), "edits"), _n(t("shared"), "shares"),
        F.count_distinct(F.when(t("viewed"), F.col("user_id"))).alias("viewers"),
        F.max(F.when(t("viewed"), F.col(ts))).alias("last_viewed"), F.max(F.when(t("edited"), F.col(ts))).alias("last_edited"),
    )


def top_content(events: DataFrame, kind: str | None, limit: int, resource: str = "resource_id", user: str = "user_id") -> DataFrame:
    df = events if kind is None else events.where(F.col("event_type") == kind)
    return df.groupBy(resource).agg(F.count("*").alias("n"), F.count_distinct(user).alias("users")).orderBy(F.desc("n"), resource).limit(limit)


def top_titles(top: DataFrame, titles: DataFrame, resource: str = "resource_id") -> DataFrame:
    """A short list of ``top_content`` with the ``title`` of each resource, null where none is known. ``titles`` has one row a resource."""
    return titles.select(resource, "title").join(F.broadcast(top), resource, "right")  # the list has a limit


def active_users(events: DataFrame, ts: str = "ts") -> DataFrame:
    return events.groupBy("user_id").agg(F.count("*").alias("n"), F.max(ts).alias("last_active"))


def counted(df: DataFrame, by: Sequence[str], kind: str, name: str, value: Column | None = None) -> DataFrame:
    """``by`` and a MAP ``name`` of ``kind`` to its rows, or to the sum of ``value``: two keyed aggregations, no list of rows."""
    per = df.groupBy(*by, F.col(kind).alias("_k")).agg((F.count("*") if value is None else F.sum(value)).cast("long").alias("_v"))
    return per.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_k", "_v")))).alias(name))


def storage_usage(events: DataFrame, allocated: str, released: str, created: str, by: Sequence[str] = ("user_id",)) -> DataFrame:
    """Bytes allocated less released, files, documents, and bytes by type of event."""
    signed = F.when(_kind(allocated), F.col("bytes")).when(_kind(released), -F.col("bytes")).otherwise(0)
    totals = events.groupBy(*by).agg(
        F.coalesce(F.sum(signed), F.lit(0)).cast("long").alias("total_bytes"), F.count_distinct(F.when(_kind(allocated), F.col("resource_id"))).alias("files"),
        F.count_distinct(F.when(_kind(created), F.col("resource_id"))).alias("documents"),
    )
    return totals.join(counted(events, by, "event_type", "bytes_by_type", F.coalesce("bytes", F.lit(0))), list(by))


def activity_trend(daily: DataFrame, day: Column, lookback: int = 30) -> DataFrame:
    df = daily.where(F.col("day").between(F.date_sub(day, lookback), day))
    n = F.count("*")
    total = F.coalesce(F.sum("total_events"), F.lit(0))
    return df.agg(
        total.alias("total_events"), F.coalesce(F.max("users"), F.lit(0)).alias("peak_users"),
        F.when(n > 0, F.round(total.cast("decimal(30,6)") / n, 2)).otherwise(0).cast("double").alias("avg_daily"), n.alias("days"),
    )


def user_totals(daily_users: DataFrame, top: int | None = None) -> DataFrame:
    """Per user over days of ``user_id, day, actions`` (MAP): total, active days and merged counts; with ``top``, the users with the most, ties by id."""
    rows = daily_users.select("user_id", "day", F.explode("actions").alias("kind", "n"))
    kinds = rows.groupBy("user_id", "kind").agg(F.sum("n").alias("n"))
    days = daily_users.groupBy("user_id").agg(F.count_distinct("day").alias("active_days"))
    merged = kinds.groupBy("user_id").agg(F.sum("n").alias("total"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "n")))).alias("actions"))
    out = merged.join(days, "user_id")
    return out if top is None else out.orderBy(F.desc("total"), "user_id").limit(top)


def user_audit_report(audit: DataFrame, ts: str = "ts", id_col: str = "event_id", latest: int = 10) -> DataFrame:
    """Per user: total, counts by action and by resource type, first and last time, and the ids of the ``latest`` events, newest first."""
    totals = audit.groupBy("user_id").agg(F.count("*").alias("total"), F.min(ts).alias("first_activity"), F.max(ts).alias("last_activity"))
    # Spark cuts each user's rows before the shuffle, so a list holds ``latest`` rows at most.
    w = Window.partitionBy("user_id").orderBy(F.desc(ts), F.desc(id_col))
    newest = audit.select("user_id", id_col, F.row_number().over(w).alias("_n")).where(F.col("_n") <= latest)
    newest = newest.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", id_col))), lambda x: x[id_col]).alias("recent"))
    out = totals.join(counted(audit, ["user_id"], "event_type", "actions"), "user_id")
    return out.join(counted(audit, ["user_id"], "resource_type", "resource_types"), "user_id").join(newest, "user_id")


def compliance_report(audit: DataFrame) -> DataFrame:
    """Totals and users by action, by resource and over all, in one pass by grouping sets."""
    spark = audit.sparkSession
    return spark.sql(
        """SELECT CASE WHEN grouping(event_type) = 0 THEN 'action' WHEN grouping(resource_id) = 0 THEN 'resource' ELSE 'all' END AS part,
                  coalesce(event_type, cast(resource_id AS STRING), '') AS name, count(*) AS n, count(DISTINCT user_id) AS users
           FROM {audit} GROUP BY GROUPING SETS ((event_type), (resource_id), ())""",
        audit=audit,
    )


def suspicious_users(audit: DataFrame, factor: int = 3, least: int = 100) -> DataFrame:
    """Users with more events than ``factor`` times the mean user and than ``least``; the mean is one value, broadcast."""
    n = audit.groupBy("user_id").agg(F.count("*").alias("n"))
    mean = n.agg(F.greatest(F.avg("n") * factor, F.lit(float(least))).alias("limit"))
    hit = n.join(F.broadcast(mean), F.col("n") > F.col("limit"))
    reason = F.concat(F.lit("Unusually high activity: "), F.col("n").cast("string"), F.lit(" events (threshold: "), F.round("limit", 0).cast("long").cast("string"), F.lit(")"))
    return hit.select("user_id", "n", reason.alias("reason"))


def search_analytics(queries: DataFrame, query: str = "query", results: str = "result_count", top: int = 20) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Most frequent queries, most frequent ones without results, and totals."""
    ranked = lambda df: df.groupBy(query).agg(F.count("*").alias("n")).orderBy(F.desc("n"), query).limit(top)
    n = F.count("*")
    totals = queries.agg(n.alias("total"), _n(F.col(results) == 0, "without_results"), F.when(n > 0, F.round(F.sum(results).cast("decimal(30,6)") / n, 2)).otherwise(0).cast("double").alias("avg_results"))
    return ranked(queries), ranked(queries.where(F.col(results) == 0)), totals


def admin_metrics(users: DataFrame, by: str, used: str, quota: str) -> DataFrame:
    """Users, sums and mean usage in percent by group; users without quota do not count in the mean."""
    pct = F.when(F.col(quota) != 0, F.col(used).cast("decimal(20,4)") * 100 / F.col(quota).cast("decimal(20,4)"))
    return users.groupBy(by).agg(
        F.count("*").alias("users"), F.sum(F.col(used).cast("decimal(20,2)")).cast("double").alias("used"),
        F.round(F.avg(pct.cast("decimal(28,6)")), 2).cast("double").alias("avg_pct"), _n(F.col(used) > F.col(quota), "over_quota"),
    )


def platform_metrics(users: DataFrame, audit: DataFrame, now: Column, created: str, groups: Sequence[str], flags: Sequence[tuple[str, Column]], ts: str = "ts", top: int = 5) -> DataFrame:
    """``part, name, n``: users by each of ``groups``, sign-ups of 30 days, ``flags`` that hold, events of all time, of today and of a week, and the week's ``top`` actions."""
    spark = users.sparkSession
    counts = [users.groupBy(F.lit(g).alias("part"), F.col(g).cast("string").alias("name")).agg(F.count("*").alias("n")) for g in groups]
    own = [("users", F.count("*")), ("recent_signups", F.count_if(F.col(created) >= now - F.expr("INTERVAL 30 DAYS"))), *[(name, F.count_if(c)) for name, c in flags]]
    week = F.col(ts) >= now - F.expr("INTERVAL 7 DAYS")
    log = [("total_events", F.count("*")), ("events_today", F.count_if(F.col(ts) >= F.date_trunc("day", now))), ("events_this_week", F.count_if(week))]
    for df, items in ((users, own), (audit, log)):
        row = df.agg(*[c.alias(n) for n, c in items])
        counts.append(row.select(F.explode(F.array(*[F.struct(F.lit("total").alias("part"), F.lit(n).alias("name"), F.col(n).alias("n")) for n, _ in items])).alias("x")).select("x.*"))
    best = audit.where(week).groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "event_type").limit(top)
    counts.append(best.select(F.lit("top_actions").alias("part"), F.col("event_type").alias("name"), "n"))
    out = spark.createDataFrame([], "part string, name string, n long")
    for c in counts:
        out = out.unionByName(c)
    return out


def class_totals(df: DataFrame, class_col: str, columns: Sequence[str]) -> DataFrame:
    """Exact count and sums by class: DECIMAL(31,8) sums to DECIMAL(38,8) without rounding."""
    return df.groupBy(class_col).agg(F.count("*").alias("n"), *[F.sum(F.col(c).cast("decimal(31,8)")).alias(f"sum_{c}") for c in columns])


def usage_summary(usage: DataFrame, start: Column, end: Column, by: Sequence[str] = ("kind",), at: str = "occurred_at") -> DataFrame:
    return usage.where(F.to_date(at).between(start, end)).groupBy(*by).agg(F.count("*").alias("events"), F.sum("units").alias("units"))


def commission_summary(fact: DataFrame, agents: DataFrame, periods: DataFrame, products: DataFrame) -> DataFrame:
    joined = fact.join(agents, "agent_key").join(periods, "period_key").join(products, "product_key")
    return joined.groupBy("agent_id", "period_month", "line_of_business").agg(F.count("*").alias("n"), F.sum("commission_amt").alias("commission"))


def margin_kpis(rows: DataFrame, prices: DataFrame, commodity: str, freight: str) -> DataFrame:
    """Mean margin and cost, and the last values of two series of ``prices``."""
    last = lambda code, name: F.max_by(F.when(F.col("series_code") == code, F.col("value")), F.when(F.col("series_code") == code, F.col("price_date"))).alias(name)
    means = rows.agg(F.round(F.avg("margin_pct"), 2).alias("avg_margin_pct"), F.round(F.avg("cogs_usd"), 2).alias("avg_cogs_usd"))
    return means.join(prices.agg(last(commodity, "commodity_index"), last(freight, "freight_index")))


def margin_series(margins: DataFrame, by: str, on: str = "margin_date", keys: Sequence[str] = (), start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Mean margin by key and day, of the given keys and between two days if these are given."""
    if keys:
        margins = margins.where(F.col(by).isin(list(keys)))
    if start is not None:
        margins = margins.where(F.col(on) >= start)
    if end is not None:
        margins = margins.where(F.col(on) <= end)
    return margins.groupBy(by, on).agg(F.round(F.avg("margin_pct"), 4).alias("margin_pct"))


def price_series(prices: DataFrame, code: str, start: Column, end: Column) -> DataFrame:
    return prices.where((F.col("series_code") == code) & F.col("price_date").between(start, end)).orderBy("price_date")


def market_status(runs: DataFrame) -> DataFrame:
    """The run that was completed last."""
    return runs.agg(F.max_by(F.struct("id", "status", "observations_count"), F.struct("completed_at", "id")).alias("r")).select("r.*")


def document_totals(docs: DataFrame, versions: DataFrame) -> DataFrame:
    return docs.agg(_n(~F.col("is_deleted"), "documents"), F.coalesce(F.sum(F.when(~F.col("is_deleted"), F.col("word_count"))), F.lit(0)).alias("words")).join(versions.agg(F.count("*").alias("versions")))


def duplicate_windows(rollups: DataFrame, key: str, since: Column) -> DataFrame:
    return rollups.where(F.col(key) >= since).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def cleanup_report(inventory: DataFrame, orphans: DataFrame, price: str = "0.023") -> DataFrame:
    """Objects and bytes of all and of orphans, shares in percent, gigabytes and the monthly price saved."""
    a = inventory.agg(F.count("*").alias("objects"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
    b = orphans.agg(F.count("*").alias("orphans"), F.coalesce(F.sum("size"), F.lit(0)).alias("orphan_bytes"))
    gb = F.col("orphan_bytes").cast("decimal(30,10)") / F.lit(1 << 30)
    return a.join(b).select(
        "*", F.when(F.col("objects") > 0, F.round(F.col("orphans").cast("decimal(20,6)") * 100 / F.col("objects"), 2)).otherwise(0).cast("double").alias("orphan_pct"),
        F.round(gb, 4).cast("double").alias("orphan_gb"), F.round(gb * F.lit(price).cast("decimal(10,4)"), 6).cast("double").alias("saving"),
    )


def average_rating(feedback: DataFrame, rating: str = "rating") -> DataFrame:
    return feedback.agg(F.coalesce(F.avg(rating), F.lit(0.0)).alias("average"), F.count("*").alias("n"))


def feedback_list(feedback: DataFrame, user: object, user_col: str = "user_id", at: str = "created_at", key: str = "id") -> DataFrame:
    """A user's feedback, newest first."""
    return feedback.where(F.col(user_col) == F.lit(user)).orderBy(F.col(at).desc(), F.col(key).desc())


def rating_problems(feedback: DataFrame, rating: str = "rating", low: int = 1, high: int = 5) -> DataFrame:
    return feedback.where(F.col(rating).isNull() | ~F.col(rating).between(low, high))


def report_registry(reports: DataFrame, status: str, by: Sequence[str]) -> DataFrame:
    return reports.groupBy(status, *by).agg(F.count("*").alias("n"))


def reports_selected(
    reports: DataFrame, requester: object | None = None, category: object | None = None, status: object | None = None, since: Column | None = None, until: Column | None = None,
    at: str = "created_at",
) -> DataFrame:
    """Reports by requester, category, status and time, newest first; what is not given does not filter."""
    for name, value in (("requested_by", requester), ("category", category), ("status", status)):
        if value is not None:
            reports = reports.where(F.col(name) == F.lit(value))
    if since is not None:
        reports = reports.where(F.col(at) >= since)
    if until is not None:
        reports = reports.where(F.col(at) <= until)
    return reports.orderBy(F.col(at).desc(), "id")


def daily_type_counts(events: DataFrame, ts: str = "ts") -> DataFrame:
    return events.groupBy(F.to_date(ts).alias("event_date"), "event_type").agg(F.count("*").alias("n"))


def unread_counts(notes: DataFrame, user: str, read_at: str) -> DataFrame:
    return notes.groupBy(user).agg(_n(F.col(read_at).isNull(), "unread"), F.count("*").alias("total"))


def notes_page(notes: DataFrame, user: str, order: Sequence[Column], page: int, size: int = 20) -> DataFrame:
    """A page of each user's notes with ``total`` and ``has_more``; Spark cuts rows beyond the page before the shuffle."""
    w = Window.partitionBy(user).orderBy(*order)
    rows = notes.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= page * size).where(F.col("_n") > (page - 1) * size).drop("_n")
    total = notes.groupBy(user).agg(F.count("*").alias("total"))
    return rows.join(total, user).withColumn("has_more", F.col("total") > page * size)
