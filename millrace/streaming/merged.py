"""Tables that batches of a stream are merged into, as runs that are merged in their turn.

A batch writes its own rows alone, as a new run; nothing that is there is
rewritten for it. So many runs of a level make one of the next, so a row is
rewritten a logarithmic number of times and there are a few runs at any size.
A manifest for each batch lists the runs that make up the table; runs and
manifests that none of the latest needs are removed. How a run is cut into
files follows from its bytes, as for any other result.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Manifests that are kept: the last one, and those before it for readers that have begun.
KEPT = 3


def latest(keys: Sequence[str], order: str) -> Callable[[DataFrame], DataFrame]:
    """Merging keeps the row with the greatest ``order`` of each key."""

    def merge(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in keys]
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")

    return merge


def added(keys: Sequence[str], bitmaps: Sequence[str] = ()) -> Callable[[DataFrame], DataFrame]:
    """Merging adds the other columns up; of ``bitmaps`` it takes the union."""

    def merge(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in keys]
        return rows.groupBy(*keys).agg(*[(F.bitmap_or_agg(c) if c in bitmaps else F.sum(c)).alias(c) for c in rest]).select(*rows.columns)

    return merge


class _Store:
    """The table's folder, in any store that Spark writes."""

    def __init__(self, spark: SparkSession, at: str):
        self.jvm, self.at = spark._jvm, at
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.at}/{name}" if name else self.at)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(f.getPath().getName() for f in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> dict:
        stream = self.fs.open(self.path(name))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, name: str, value: dict) -> None:
        """Under another name first, so that a manifest is there whole or not at all."""
        part, to = self.path(f"_{name.replace('/', '-')}"), self.path(name)
        out = self.fs.create(part, True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        self.fs.mkdirs(to.getParent())
        self.fs.delete(to, False)
        self.fs.rename(part, to)

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


@dataclass(frozen=True)
class MergedTable:
    """A Parquet table at ``path`` with one row of each key. ``merge`` makes one row of a key's rows, in any order and grouping.

    ``write`` is what ``foreachBatch`` calls. A batch that runs again replaces
    what it wrote before; batches may be skipped.
    """

    path: str
    merge: Callable[[DataFrame], DataFrame]
    fan: int = 8

    def write(self, batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        store = _Store(spark, self.path)
        names = store.names("manifests")
        before = [x for x in names if int(x) < n]
        runs = store.read(f"manifests/{before[-1]}")["runs"] if before else []

        def add(rows: DataFrame, level: int) -> None:
            name = f"{n:012d}-{level}"
            rows.write.mode("overwrite").parquet(f"{self.path}/runs/{name}")
            runs.append({"name": name, "level": level})

        add(self.merge(batch), 0)
        level = 0
        while len(own := [r["name"] for r in runs if r["level"] == level]) >= self.fan:
            runs = [r for r in runs if r["level"] != level]
            level += 1
            add(self.merge(self._runs(spark, own, batch.schema)), level)
        store.write(f"manifests/{n:012d}", {"runs": runs})
        self._clear(store, n)

    def _runs(self, spark: SparkSession, names: Sequence[str], schema: StructType) -> DataFrame:
        return spark.read.schema(schema).parquet(*[f"{self.path}/runs/{x}" for x in names])

    def _clear(self, store: _Store, n: int) -> None:
        """Removes manifests before the last few, and runs that none of those needs."""
        names = [x for x in store.names("manifests") if int(x) <= n]
        kept = names[-KEPT:]
        used = {r["name"] for x in kept for r in store.read(f"manifests/{x}")["runs"]}
        for x in set(names) - set(kept):
            store.delete(f"manifests/{x}")
        for x in store.names("runs"):
            if x not in used and int(x.split("-")[0]) <= n:
                store.delete(f"runs/{x}")

    def read(self, spark: SparkSession, schema: StructType) -> DataFrame:
        """The table as of its last batch; a table of one run is read without a shuffle."""
        store = _Store(spark, self.path)
        names = store.names("manifests")
        runs = [r["name"] for r in store.read(f"manifests/{names[-1]}")["runs"]] if names else []
        if not runs:
            return spark.createDataFrame([], schema)
        rows = self._runs(spark, runs, schema)
        return rows if len(runs) == 1 else self.merge(rows)
