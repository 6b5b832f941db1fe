from bisect import bisect_left

import pytest
from pyspark.sql import functions as F

from millrace.operators import checks as dq
from millrace.operators import criteria as cr
from millrace.operators import purge
from millrace.operators import reconcile as rc
from millrace.operators.purge import Audit, LakeSource, PurgeGuardError, guarded, purge_batches, purge_ranks, purge_table
from millrace.queries import QUERIES, migration


def test_children_before_parents():
    ranks = purge_ranks(["a", "b", "c", "d"], [("a", "b"), ("b", "c"), ("a", "c"), ("d", "d")])
    assert ranks["a"] < ranks["b"] < ranks["c"] and ranks["d"] == 1
    with pytest.raises(ValueError, match="circle"):
        purge_ranks([], [("a", "b"), ("b", "c"), ("c", "a")])


@pytest.mark.parametrize("n, rows", [(0, 10), (1, 10), (1000, 7), (1000, 1000), (1001, 1000)])
def test_batches(spark, n, rows, monkeypatch):
    monkeypatch.setattr("millrace.operators.purge._BUCKET", 150)
    keys = spark.range(n).select(F.concat(F.lit("k"), "id").alias("key"))
    got, batches = purge_batches(keys, "key", rows)
    sizes = {r.batch: r["count"] for r in got.groupBy("batch").count().collect()}
    assert sum(sizes.values()) == n and sorted(sizes) == list(range(1, batches + 1)) and max(sizes.values(), default=0) <= rows
    again, _ = purge_batches(keys.repartition(3), "key", rows)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))


class Cut(LakeSource):
    """Deletes ``calls`` waves, then stops before or after the next one."""

    def delete(self, batches, run_id):
        left = self.__dict__.setdefault("left", [2, "after"])
        left[0] -= 1
        if left[0] < 0 and left[1] == "before":
            raise RuntimeError("cut")
        super().delete(batches, run_id)
        if left[0] < 0:
            raise RuntimeError("cut")


@pytest.mark.parametrize("when", ["before", "after"])
def test_cut_run_ends_with_the_same_ledger(spark, tmp_path, when):
    table = spark.range(500).withColumnRenamed("id", "k")
    safe = table.where("k % 5 > 0")

    def run(at, source, **more):
        return tuple(purge_table(spark, "t", safe, "k", 400, source, Audit(f"{at}/audit"), "run-1", batch_rows=30, wave=2, **more).first())

    whole = LakeSource(table, "k", f"{tmp_path}/a/deleted")
    want = run(tmp_path / "a", whole)
    assert want == ("t", 400, 400, 400, False) and whole.live(spark).count() == 100
    cut = Cut(table, "k", f"{tmp_path}/b/deleted")
    cut.__dict__["left"] = [2, when]
    with pytest.raises(RuntimeError, match="cut"):
        run(tmp_path / "b", cut)
    before = Audit(f"{tmp_path}/b/audit").rows(spark).count()
    assert 0 < before < 400
    again = LakeSource(table, "k", f"{tmp_path}/b/deleted")
    assert run(tmp_path / "b", again) == want and again.live(spark).count() == 100
    rows = Audit(f"{tmp_path}/b/audit").rows(spark)
    assert rows.select("key").distinct().count() == rows.count() == 400
    assert (rows.where("batch = 0").count() > 0) == (when == "after")
    assert run(tmp_path / "b", again) == want  # nothing is left to do


def test_guard_and_dry_run(spark, tmp_path):
    table = spark.range(10).withColumnRenamed("id", "k")
    source, audit = LakeSource(table, "k", f"{tmp_path}/deleted"), Audit(f"{tmp_path}/audit")
    for validated in (9, 11):
        with pytest.raises(PurgeGuardError, match=f"10 keys are safe to purge, {validated} rows"):
            purge_table(spark, "t", table, "k", validated, source, audit, "run-1")
        with pytest.raises(ValueError):
            rc.purge_guard(10, validated)
        with pytest.raises(Exception, match="10 keys are safe"):
            guarded(table, table, spark.createDataFrame([(validated,)], "validated long")).collect()
    rc.purge_guard(10, 10)
    assert guarded(table, table, spark.createDataFrame([(10,)], "validated long")).count() == 10
    assert tuple(purge_table(spark, "t", table, "k", 10, source, audit, "run-1", dry_run=True).first()) == ("t", 10, 10, 0, True)
    assert source.live(spark).count() == 10 and audit.rows(spark).count() == 0


CRITERIA = {"min_rows": 3, "max_rows": 4, "required_columns": ["a", "b"], "unique_columns": ["a"], "enum_constraints": {"b": ["x", "y"]}}


def test_compiled_criteria_are_the_single_checks(spark):
    df = spark.createDataFrame([(1, "x"), (1, "z"), (2, None), (None, "w"), (3, "y")], "a int, b string")
    got = {r.check_name: (r.status, r.detail) for r in cr.table_criteria(df, "t", CRITERIA).collect()}
    single = dq.run_suite([dq.row_count_between(df, "t: row count", 3, 4), dq.not_null(df, "t: not null", ["a", "b"]), dq.unique(df, "t: unique", "a"), dq.enum(df, "t: values of b", "b", ["x", "y"])])
    assert got == {r.check_name: (r.status, r.detail) for r in single.collect()} == {
        "t: row count": ("FAIL", "5"), "t: not null": ("FAIL", "2"), "t: unique": ("FAIL", "1"), "t: values of b": ("FAIL", "w,z"),
    }
    empty = {r.check_name: r.status for r in cr.table_criteria(df.limit(0), "t", CRITERIA).collect()}
    assert empty == {"t: row count": "FAIL", "t: not null": "PASS", "t: unique": "PASS", "t: values of b": "PASS"}
    with pytest.raises(ValueError, match="not known"):
        cr.read_criteria('{"t": {"min_row": 1}}')


def test_criteria_of_a_table_make_one_scan(spark, tmp_path):
    at = str(tmp_path / "t")
    spark.createDataFrame([(1, "x"), (2, "y"), (2, "q")], "a int, b string").write.parquet(at)
    plan = cr.table_criteria(spark.read.parquet(at), "t", CRITERIA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1
    watched = cr.Observed(spark.read.parquet(at), "t", CRITERIA)
    watched.rows.write.parquet(str(tmp_path / "copy"))
    got = {r.check_name: (r.status, r.detail) for r in watched.results().collect()}
    assert got == {"t: row count": ("PASS", "3"), "t: not null": ("PASS", "0"), "t: values of b": ("FAIL", "q")}
    rest = cr.table_criteria(spark.read.parquet(at), "t", watched.left).collect()
    assert [(r.check_name, r.detail) for r in rest] == [("t: unique", "1")]


def test_a_wave_finds_its_batches_in_few_folders(spark, monkeypatch):
    monkeypatch.setattr(purge, "_BUCKET", 150)
    rows, ends = purge._numbered(spark.range(1000).withColumnRenamed("id", "k"), "k", 7)
    got = rows.select("batch", "_bucket", F.regexp_extract("_metadata.file_path", "_bucket=([0-9]+)", 1).cast("int").alias("folder")).collect()
    assert len(got) == 1000 and len({r.folder for r in got}) == 7
    assert all(bisect_left(ends, r.batch) == r["_bucket"] == r.folder for r in got)


def test_safe_keys_are_found_once(spark, monkeypatch):
    n, real = spark.sparkContext.accumulator(0), migration._verdicts

    def count(v):
        n.add(1)
        return v

    monkeypatch.setattr(migration, "_verdicts", lambda t: real(t).withColumn("verdict", F.udf(count)("verdict")))
    QUERIES["rec05_purge_run"](spark, "/root/testdata/sf0.001").collect()
    assert n.value == spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
