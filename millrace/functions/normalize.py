"""Projections, filters and normalisation of events, audit rows, documents and flags.

Reference times are arguments, so that results can be repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns that may name the acting user, in order.
USER_COLUMNS = ("ownerId", "editedBy", "authorId", "deletedBy", "userId")
#: Days that a named period looks back; any other name is 30 days.
PERIOD_DAYS = {"day": 1, "24h": 1, "week": 7, "7d": 7, "month": 30, "30d": 30, "quarter": 90, "90d": 90, "year": 365, "365d": 365}
#: Severities of alerts as severities of incidents; all others are medium.
SEVERITIES = {"critical": "critical", "high": "high", "warning": "medium", "info": "low"}


def resolve_user_id(df: DataFrame, columns: Sequence[str] = USER_COLUMNS, to: str = "user_id") -> DataFrame:
    """The first non-empty of those columns that exist, else 'unknown'."""
    found = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in columns if c in df.columns]
    return df.withColumn(to, F.coalesce(*found, F.lit("unknown")))


def normalise_event_type(df: DataFrame, to: str = "eventType") -> DataFrame:
    found = [F.col(c) for c in ("eventType", "event_type") if c in df.columns]
    return df.withColumn(to, F.coalesce(*found, F.lit("unknown")))


def uuid5(namespace: str, name: Column) -> Column:
    """The name-based id of a text in a namespace: SHA-1 of both, with the bits for version and variant set."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    part = lambda at, n: F.substring(h, at, n)
    variant = F.translate(part(17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("5"), part(14, 3)), F.concat(variant, part(18, 3)), part(21, 12))


def hour_bucket(ts: Column) -> Column:
    """The hour as written in an ISO text, '00' if it is not a time."""
    return F.when(F.try_to_timestamp(ts).isNotNull() & ts.rlike(r"^.{10}[T ]\d\d"), F.substring(ts, 12, 2)).otherwise("00")


def unwrap_envelope(body: Column) -> Column:
    """The inner message of a topic envelope, else the body itself."""
    return F.coalesce(F.get_json_object(body, "$.Message"), body)


def normalise_index_event(df: DataFrame, body: str = "body") -> DataFrame:
    """``action, id, title`` of messages in three shapes: event_type with a payload, flat eventType, and action with data.

    Events that do not change what is indexed (shared, moved) have a null action.
    """
    get = lambda p: F.get_json_object(F.col(body), p)
    kind = F.coalesce(get("$.event_type"), get("$.eventType"))
    action = (
        F.when(kind.isin("file_shared", "file_moved"), F.lit(None).cast("string"))
        .when(kind.rlike("(deleted|trashed)$"), "delete")
        .when(kind.isNotNull(), "index")
        .otherwise(get("$.action"))
    )
    first = lambda *ps: F.coalesce(*[get(p) for p in ps])
    return df.withColumns(
        {
            "action": action,
            "id": first("$.payload.document_id", "$.payload.file_id", "$.documentId", "$.fileId", "$.data.id"),
            "title": first("$.payload.title", "$.payload.name", "$.title", "$.name", "$.data.title"),
        }
    )


def audit_from_message(df: DataFrame, now: Column, body: str = "body") -> DataFrame:
    """Audit rows of messages: sharing has its own form, all else takes defaults for what is missing."""
    get = lambda p: F.get_json_object(F.col(body), p)
    shared = get("$.eventType") == "file_shared"
    shared = F.coalesce(shared, F.lit(False))
    return df.select(
        F.when(shared, F.coalesce(get("$.ownerId"), F.lit("system"))).otherwise(F.coalesce(get("$.userId"), F.lit("system"))).alias("user_id"),
        F.when(shared, "share").otherwise(F.coalesce(get("$.action"), get("$.eventType"), F.lit("unknown"))).alias("action"),
        F.when(shared, "file").otherwise(F.coalesce(get("$.resourceType"), F.lit("unknown"))).alias("resource_type"),
        F.coalesce(get("$.fileId"), get("$.resourceId"), F.lit("")).alias("resource_id"),
        F.when(shared, F.create_map(F.lit("sharedWith"), F.coalesce(get("$.sharedWith"), F.lit("")))).alias("details"),
        F.coalesce(F.try_to_timestamp(get("$.timestamp")), now).alias("timestamp"),
    )


def period_filter(df: DataFrame, ts: str, period: str | None, now: Column) -> DataFrame:
    """Rows of the period up to ``now``, both ends included."""
    days = PERIOD_DAYS.get((period or "").lower(), 30)
    return df.where(F.col(ts).between(now - F.expr(f"INTERVAL {days} DAYS"), now))


def filtered(df: DataFrame, equal: dict[str, object | None], ts: str, since: Column | None, until: Column | None) -> DataFrame:
    """Rows that pass all given filters; what is None does not filter."""
    for name, value in equal.items():
        if value is not None:
            df = df.where(F.col(name) == F.lit(value))
    if since is not None:
        df = df.where(F.col(ts) >= since)
    if until is not None:
        df = df.where(F.col(ts) <= until)
    return df


def filter_page(
    df: DataFrame, equal: dict[str, object | None], ts: str, since: Column | None, until: Column | None, key: str, page: int, size: int
) -> DataFrame:
    """A page of the rows that pass all given filters, newest first, ties by ``key``; sizes are kept within 1 to 100."""
    df = filtered(df, equal, ts, since, until)
    size = min(100, max(1, size))
    return df.orderBy(F.col(ts).desc(), key).offset((max(1, page) - 1) * size).limit(size)


#: Columns that callers may sort documents by.
SORTABLE = ("updated_at", "created_at", "title", "word_count")


def document_metadata_filter(
    df: DataFrame, owner: str | None = None, folder: str | None = None, content_type: str | None = None, title: str | None = None,
    sort: str = "updated_at", descending: bool = True,
) -> DataFrame:
    """Live documents that are no templates, by equality and by a part of the title in any case, ties by id."""
    if sort not in SORTABLE:
        raise ValueError(f"cannot sort by {sort}")
    df = df.where(~F.col("is_deleted") & ~F.col("is_template"))
    for name, value in (("owner_id", owner), ("folder_id", folder), ("content_type", content_type)):
        if value is not None:
            df = df.where(F.col(name) == value)
    if title:
        df = df.where(F.lower("title").contains(title.lower()))
    return df.orderBy(F.col(sort).desc() if descending else F.col(sort).asc(), "id")


def ilike_search(df: DataFrame, query: str, columns: Sequence[str]) -> DataFrame:
    """Rows with the text in any of the columns, in any case; no character is a wildcard."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.lower(c).contains(query.lower()), F.lit(False))
    return df.where(hit)


def active_window(df: DataFrame, status: str, starts: str, ends: str, now: Column) -> DataFrame:
    return df.where((F.col(status) == "published") & (F.col(starts).isNull() | (F.col(starts) <= now)) & (F.col(ends).isNull() | (F.col(ends) >= now)))


def retention_selection(df: DataFrame, class_col: str, classes: Sequence[str] | None, ts: str, cutoff: Column) -> DataFrame:
    """Rows of the classes last used before the cutoff; without classes (reference tables) all rows."""
    return df if classes is None else df.where(F.col(class_col).isin(list(classes)) & (F.col(ts) < cutoff))


def value_map(value: Column, mapping: dict[str, str], width: int | None = None) -> Column:
    """The value without trailing blanks, or what the map has for it; padded again to ``width`` if one is given."""
    plain = F.rtrim(value)
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]) if mapping else None
    out = F.coalesce(F.try_element_at(table, plain), plain) if mapping else plain
    return F.rpad(out, width, " ") if width else out


def live_files(df: DataFrame, owner: str | None = None, folder: str | None = None, trashed: bool = False) -> DataFrame:
    """Files of an owner in a folder; no folder is the root. Trashed ones come newest first, whatever their folder."""
    df = df.where(F.col("is_trashed") == trashed)
    if owner is not None:
        df = df.where(F.col("owner_id") == owner)
    if trashed:
        return df.orderBy(F.col("updated_at").desc(), "id")
    return df.where(F.col("folder_id").isNull() if folder is None else F.col("folder_id") == folder)


def validate_observations(obs: DataFrame, series: DataFrame, today: Column) -> DataFrame:
    """Observations with ``reason``: the first rule that fails, null if none does."""
    known = series.select("series_code", F.lit(True).alias("_known")).distinct()
    day = F.try_to_date("price_date", "yyyy-MM-dd")
    reason = (
        F.when(F.col("_known").isNull(), "unknown series")
        .when(day.isNull(), "invalid date")
        .when(day > today, "future date")
        .when(F.col("value").isNull() | (F.col("value") <= 0), "non-positive value")
    )
    return obs.join(known, "series_code", "left").withColumn("reason", reason).drop("_known")


def redact(text: Column) -> Column:
    """Request text with the values of credential parameters, JSON secrets and authorisation headers masked."""
    out = F.regexp_replace(text, r"(?i)([?&](?:token|access_token|api_key|apikey|password|secret|signature)=)[^&#\s]*", "$1***")
    out = F.regexp_replace(out, r'(?i)("(?:password|token|secret|api_key|authorization)"\s*:\s*")[^"]*', "$1***")
    return F.regexp_replace(out, r"(?i)(authorization:\s*(?:bearer|basic)\s+)\S+", "$1***")


def severity_map(value: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in SEVERITIES.items() for x in kv])
    return F.coalesce(F.try_element_at(table, value), F.lit("medium"))


def md5_mod_100(text: Column) -> Column:
    """The 128-bit MD5 of a text, modulo 100, from its four 32-bit parts."""
    digest = F.md5(text.cast("binary"))
    parts = [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") % 100 for k in range(4)]
    weights = [pow(2**32, 3 - k, 100) for k in range(4)]
    return (sum((p * w for p, w in zip(parts, weights, strict=True)), F.lit(0)) % 100).cast("int")


def flag_enabled_for(users: DataFrame, flags: DataFrame, now: Column, user: str = "user_id") -> DataFrame:
    """Each user with each flag and whether it is on for them. ``flags`` is a list of settings, a handful of rows, and is broadcast."""
    pairs = users.join(F.broadcast(flags), F.lit(True))
    on = F.col("enabled") & (F.col("expires_at").isNull() | (F.col("expires_at") > now)) & (
        F.array_contains("targets", F.col(user)) | (F.col("pct") == 100) | (md5_mod_100(F.concat_ws(":", "name", user)) < F.col("pct"))
    )
    return pairs.select(user, "name", F.coalesce(on, F.lit(False)).alias("is_on"))


def word_count(text: Column) -> Column:
    """Runs without white space."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != ""))


def filter_total(df: DataFrame, equal: dict[str, object | None], ts: str, since: Column | None, until: Column | None, size: int) -> DataFrame:
    """One row beside a page: ``total`` rows that pass the filters, and ``pages`` of the size."""
    size = min(100, max(1, size))
    return filtered(df, equal, ts, since, until).agg(F.count("*").alias("total")).withColumn("pages", F.ceil(F.col("total") / size))


def index_rows(df: DataFrame, kind: str, names: dict[str, Sequence[str]]) -> DataFrame:
    """Search rows: each field from the first of its columns that is there, rows without id or title left out, ``type`` added."""
    return _index_fields(df, kind, names).where((F.col("id") != "") & (F.col("title") != ""))


def index_rejects(df: DataFrame, kind: str, names: dict[str, Sequence[str]]) -> DataFrame:
    """The rows that ``index_rows`` leaves out, with ``reason``."""
    reason = F.when(F.col("id") == "", "id is missing").when(F.col("title") == "", "title is missing")
    return _index_fields(df, kind, names).withColumn("reason", reason).where("reason IS NOT NULL")


def _index_fields(df: DataFrame, kind: str, names: dict[str, Sequence[str]]) -> DataFrame:
    pick = lambda cs: F.coalesce(*[F.col(c).cast("string") for c in cs if c in df.columns], F.lit(""))
    return df.select(*[pick(cs).alias(n) for n, cs in names.items()], F.lit(kind).alias("type"))
