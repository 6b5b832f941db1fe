"""Typed conversion of fixed-width records, with rejects."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rules of target refusals by SQLSTATE.
REFUSALS = {"22001": "STRING_TRUNCATION", "22003": "DECIMAL_OVERFLOW", "22007": "DATE_INVALID", "23505": "DUPLICATE_TARGET_KEY", "23502": "NULL_VIOLATION", "23503": "FOREIGN_KEY_VIOLATION"}
#: EBCDIC code page 037, read from Python's own codec.
_CP037 = bytes(range(256)).decode("cp037")


def unpack_decimal(raw: Column, scale: int) -> Column:
    """Packed decimal: two digits a byte and a sign half-byte; null where a digit or the sign is not valid."""
    text = F.hex(raw)
    body = F.regexp_extract(text, r"^([0-9]+)[ABCDEF]$", 1)
    number = body.try_cast("decimal(31,0)") * F.when(text.rlike("[BD]$"), -1).otherwise(1)
    return F.when(body != "", (number / F.lit(10**scale).cast("decimal(31,0)")).cast(f"decimal(31,{scale})"))


def unpack_int(raw: Column) -> Column:
    """Big-endian signed integer of 2, 4 or 8 bytes."""
    n = F.octet_length(raw)
    value = F.conv(F.hex(raw), 16, -10).cast("long")
    return F.when(n == 2, F.when(value >= 1 << 15, value - (1 << 16)).otherwise(value)).when(n == 4, F.when(value >= 1 << 31, value - (1 << 32)).otherwise(value)).when(n == 8, value)


def decode_ebcdic(raw: Column) -> Column:
    """Text of code page 037; null where it holds a control character."""
    latin = "".join(map(chr, range(1, 256)))
    text = F.translate(F.decode(raw, "ISO-8859-1"), latin, _CP037[1:])
    return F.when(~text.rlike(r"[\x00-\x1F\x7F-\x9F]"), text)


def parse_ts12(text: Column) -> Column:
    """STRUCT<ts, tail>: the time to the microsecond and the six digits beyond it; null if it is no time."""
    ok = text.rlike(r"^\d{4}-\d\d-\d\d-\d\d\.\d\d\.\d\d\.\d{12}$")
    iso = F.concat(F.substring(text, 1, 10), F.lit(" "), F.translate(F.substring(text, 12, 8), ".", ":"), F.lit("."), F.substring(text, 21, 6))
    ts = F.when(ok, F.try_to_timestamp(iso))
    return F.when(ts.isNotNull(), F.struct(ts.alias("ts"), F.substring(text, 27, 6).cast("int").alias("tail")))


def parse_date8(text: Column) -> Column:
    return F.when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "yyyyMMdd"))


def fit_decimal(value: Column, precision: int, scale: int) -> Column:
    """The name of the rule that a decimal breaks by its integer digits, null if it fits.

    Integer parts are compared, as a wide decimal beside a limit of 38 digits is rounded to whole numbers.
    """
    return F.when(F.floor(F.abs(value)) > F.lit(Decimal(10 ** (precision - scale) - 1)), "DECIMAL_OVERFLOW")


def fit_string(value: Column, length: int) -> Column:
    return F.when(F.length(value) > length, "STRING_TRUNCATION")


@dataclass(frozen=True)
class Field:
    """A column to make: ``value`` from the raw row, ``rule`` the name of the first rule it breaks, null if none, ``raw`` the bytes it is made from."""

    name: str
    value: Column
    rule: Column
    sqlstate: str = "22000"
    raw: Column | None = None


def convert(df: DataFrame, fields: Sequence[Field], keep: Sequence[str] = ()) -> DataFrame:
    """All fields, with ``reject`` STRUCT<rule, field, sqlstate, raw>: the first field in order that fails, null for good rows.

    One pass; ``accepted`` and ``rejected`` are filters on its result, which
    callers that need both should write or persist first.
    """
    tries = [F.when(f.rule.isNotNull(), F.struct(f.rule.alias("rule"), F.lit(f.name).alias("field"), F.lit(f.sqlstate).alias("sqlstate"), (F.lit(None) if f.raw is None else f.raw).cast("binary").alias("raw"))) for f in fields]
    return df.select(*keep, *[f.value.alias(f.name) for f in fields], F.coalesce(*tries).alias("reject"))


def accepted(converted: DataFrame) -> DataFrame:
    return converted.where("reject is null").drop("reject")


def rejected(converted: DataFrame, *keep: str) -> DataFrame:
    return converted.where("reject is not null").select(*keep, "reject.*")


def first_wins(converted: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """Good rows after the first of their key, in file order, become rejects; bad rows claim no key."""
    good = F.col("reject").isNull()
    at = F.row_number().over(Window.partitionBy(*key, good).orderBy(order))
    again = F.struct(F.lit("DUPLICATE_SOURCE_KEY").alias("rule"), F.lit(key[0]).alias("field"), F.lit("23505").alias("sqlstate"), F.lit(None).cast("binary").alias("raw"))
    return converted.withColumn("_n", at).withColumn("reject", F.when(good & (F.col("_n") > 1), again).otherwise(F.col("reject"))).drop("_n")


def refusal_rule(code: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in REFUSALS.items() for x in kv])
    return F.coalesce(F.try_element_at(table, code), F.lit("TARGET_REJECTED"))


def canonical(value: Column, kind: str) -> Column:
    """Text of a value for hashing: keys keep their padding, other text does not; 8 decimals, no minus zero; times with 12 digits; YYYYMMDD dates."""
    if kind == "key":
        text = value.cast("string")
    elif kind == "decimal":
        text = (value.cast("decimal(31,8)") + F.lit(0).cast("decimal(31,8)")).cast("decimal(31,8)").cast("string")
    elif kind == "date":
        text = F.date_format(value, "yyyyMMdd")
    elif kind == "timestamp":
        text = F.concat(F.date_format(value, "yyyy-MM-dd-HH.mm.ss.SSSSSS"), F.lit("000000"))
    elif kind == "timestamp12":  # a struct as ``parse_ts12`` gives it
        text = F.concat(F.date_format(value["ts"], "yyyy-MM-dd-HH.mm.ss.SSSSSS"), F.lpad(value["tail"].cast("string"), 6, "0"))
    elif kind == "int":
        text = value.cast("long").cast("string")
    else:
        text = F.rtrim(value.cast("string"))
    return F.coalesce(text, F.lit(""))


def business_hash(columns: Sequence[tuple[Column, str]]) -> Column:
    """SHA-256 of the canonical texts, joined by bars; nulls are empty."""
    return F.sha2(F.concat_ws("|", *[canonical(c, k) for c, k in columns]), 256)
