"""Validation and reconciliation of an archive migration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .aggregates import class_totals


def row_verdicts(source: DataFrame, staged: DataFrame, archived: DataFrame, parents: DataFrame | None, key: str, parent: str | None, digest: str = "hash") -> DataFrame:
    """``key, verdict`` of staged rows: the first of HASH_MISMATCH, ARCHIVE_CONFLICT, ORPHAN_PARENT_NOT_SELECTED, else OK."""
    s, a = source.select(key, F.col(digest).alias("_s")), archived.select(key, F.col(digest).alias("_a"))
    out = staged.join(s, key, "left").join(a, key, "left")
    if parents is not None:
        out = out.join(parents.select(F.col(parent), F.lit(True).alias("_p")).distinct(), parent, "left")
    else:
        out = out.withColumn("_p", F.lit(True))
    verdict = (
        F.when(F.col("_s").isNull() | (F.col("_s") != F.col(digest)), "HASH_MISMATCH").when(F.col("_a").isNotNull() & (F.col("_a") != F.col(digest)), "ARCHIVE_CONFLICT")
        .when(F.col("_p").isNull(), "ORPHAN_PARENT_NOT_SELECTED").otherwise("OK")
    )
    return out.select(key, verdict.alias("verdict"))


def class_mismatch(source: DataFrame, target: DataFrame, class_col: str, columns: Sequence[str]) -> DataFrame:
    """Classes whose counts or exact sums differ between the sides."""
    a, b = class_totals(source, class_col, columns).alias("a"), class_totals(target, class_col, columns).alias("b")
    joined = a.join(b, F.col(f"a.{class_col}") == F.col(f"b.{class_col}"), "full_outer")
    totals = F.lit(False)
    for c in columns:
        totals = totals | ~F.col(f"a.sum_{c}").eqNullSafe(F.col(f"b.sum_{c}"))
    rule = F.when(~F.col("a.n").eqNullSafe(F.col("b.n")), "CLASS_COUNT_MISMATCH").when(totals, "CLASS_TOTAL_MISMATCH")
    return joined.select(F.coalesce(f"a.{class_col}", f"b.{class_col}").alias(class_col), rule.alias("rule")).where("rule is not null")


def fail_moved_rows(source: DataFrame, target: DataFrame, mismatches: DataFrame, key: str, class_col: str) -> DataFrame:
    """Keys that fail: rows that changed into or out of a bad class; where no row moved, all rows of the class."""
    both = source.select(key, F.col(class_col).alias("_from")).join(target.select(key, F.col(class_col).alias("_to")), key)
    bad = mismatches.select(F.col(class_col).alias("_c")).distinct()
    moved = both.where("_from <> _to").select(key, F.explode(F.array("_from", "_to")).alias("_c")).join(bad, "_c")
    still = bad.join(moved.select("_c").distinct(), "_c", "left_anti")
    whole = both.select(key, F.col("_to").alias("_c")).join(still, "_c", "left_semi")
    return moved.select(key).unionByName(whole.select(key)).distinct()


def promote(staged: DataFrame, verdicts: DataFrame, archive: DataFrame, key: str, run_id: str) -> DataFrame:
    """Good rows that the archive does not hold yet, with the run's id."""
    good = verdicts.where("verdict = 'OK'").select(key)
    return staged.join(good, key, "left_semi").join(archive.select(key), key, "left_anti").withColumn("run_id", F.lit(run_id))


def purge_plan(verdicts: DataFrame, purged: DataFrame, key: str, rank: int) -> DataFrame:
    """Keys that are safe to purge and not purged yet; ``rank`` puts children before parents."""
    return verdicts.where("verdict = 'OK'").select(key).join(purged.select(key), key, "left_anti").withColumn("purge_order", F.lit(rank))


def purge_guard(planned: int, validated: int) -> None:
    """Refuses unless as many rows are safe to purge as are validated, before purged ones are taken off; ``purge.guarded`` is the same without a count in the driver."""
    if planned != validated:
        raise ValueError(f"{planned} rows are planned for purging, {validated} are validated")


def run_ledger(stages: DataFrame) -> DataFrame:
    """``table_name`` with a count for each stage, from rows of ``table_name, stage``."""
    names = ["extracted", "loaded", "rejected", "validated", "validate_failed", "purge_intended", "purged"]
    return stages.groupBy("table_name").agg(*[F.count_if(F.col("stage") == n).alias(n) for n in names])


def closes(ledger: DataFrame, reference: Sequence[str] = ()) -> DataFrame:
    """Whether each table's counts add up; reference tables are never purged, data is purged in full or, dry, not at all."""
    adds = (F.col("extracted") == F.col("loaded") + F.col("rejected")) & (F.col("loaded") == F.col("validated") + F.col("validate_failed"))
    whole = (F.col("purged") == F.col("validated")) | ((F.col("purge_intended") == F.col("validated")) & (F.col("purged") == 0))
    return ledger.withColumn("closes", adds & F.when(F.col("table_name").isin(list(reference)), F.col("purged") == 0).otherwise(whole))


def rejects_view(rejects: DataFrame, key: str) -> DataFrame:
    return rejects.select("table_name", key, "stage", "rule", "field").orderBy("table_name", key, "stage")
