"""Tables in buckets by key hash, kept in numbered versions: a version rewrites only the buckets it touches.

A version's data lies beside the others'; what it consists of is said by its commit, a small table written last.
A commit counts once it is whole (Spark's success marker), so a run that is killed before leaves the version before
as it was, and one that runs again under the same number writes the same anew. The version before stays for
that; what neither needs is removed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "_bucket"
#: Parts that a large bucket is written in at most.
PARTS = 8


@dataclass
class Store:
    """schemas: by table its columns as DDL; keys: by table the column that it is bucketed by."""

    spark: SparkSession
    root: str
    schemas: dict[str, str]
    keys: dict[str, str]
    buckets: int = 64
    _contents: dict = field(default_factory=dict, repr=False)

    def bucket(self, key: str):
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _path(self, at: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(at)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, at: str) -> list[str]:
        path, fs = self._path(at)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _numbers(self, at: str) -> list[int]:
        return sorted(int(n[8:]) for n in self._names(at) if n.startswith("version="))

    def newest(self, most: int | None = None) -> int | None:
        """The last whole version, up to most."""
        commits = f"{self.root}/commits"
        for number in reversed(self._numbers(commits)):
            if (most is None or number <= most) and "_SUCCESS" in self._names(f"{commits}/version={number}"):
                return number
        return None

    def contents(self, number: int | None) -> dict[tuple[str, int], int]:
        """By table and bucket the version that wrote it; tables times buckets rows at most."""
        if number is None:
            return {}
        if number not in self._contents:
            rows = self.spark.read.schema("name string, bucket int, version long").parquet(f"{self.root}/commits/version={number}").collect()
            self._contents[number] = {(r["name"], r["bucket"]): r["version"] for r in rows}
        return self._contents[number]

    def read(self, name: str, number: int | None, buckets: list[int] | None = None) -> DataFrame:
        """A table as of a version, or some buckets of it."""
        held = {b: v for (n, b), v in self.contents(number).items() if n == name and (buckets is None or b in set(buckets))}
        paths = [f"{self.root}/data/{name}/version={v}/{BUCKET}={b}" for b, v in sorted(held.items())]
        return self.spark.read.schema(self.schemas[name]).parquet(*paths) if paths else self.spark.createDataFrame([], self.schemas[name])

    def touched(self, keys: DataFrame, key: str) -> list[int]:
        """The buckets of these keys."""
        return sorted(r["b"] for r in keys.select(self.bucket(key).alias("b")).distinct().collect())

    def commit(self, number: int, changes: dict[str, tuple[DataFrame, list[int]]], before: int | None) -> None:
        """Make version number out of the one before, the given buckets of the given tables rewritten with these rows."""
        now = dict(self.contents(before))
        self._contents.pop(number, None)
        for name, (rows, touched) in changes.items():
            key = self.keys[name]
            ordered = rows.select(*self.spark.createDataFrame([], self.schemas[name]).columns).withColumn(BUCKET, self.bucket(key))
            at = f"{self.root}/data/{name}/version={number}"
            dealt = ordered.repartition(BUCKET, F.pmod(F.hash(*rows.columns[:2]), F.lit(PARTS)))
            dealt.write.partitionBy(BUCKET).mode("overwrite").parquet(at)
            now = {k: v for k, v in now.items() if k[0] != name or k[1] not in set(touched)}
            now |= {(name, int(n.partition("=")[2])): number for n in self._names(at) if n.startswith(f"{BUCKET}=")}
        commit = self.spark.createDataFrame([(n, b, v) for (n, b), v in sorted(now.items())], "name string, bucket int, version long")
        commit.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/commits/version={number}")
        self._tidy(number, before, now)

    def _tidy(self, number: int, before: int | None, now: dict) -> None:
        keep = {number, before}
        needed = {(n, v) for held in (now, self.contents(before)) for (n, _), v in held.items()}
        doomed = [f"{self.root}/commits/version={n}" for n in self._numbers(f"{self.root}/commits") if n not in keep]
        doomed += [f"{self.root}/data/{name}/version={v}" for name in self.schemas for v in self._numbers(f"{self.root}/data/{name}") if (name, v) not in needed]
        for at in doomed:
            path, fs = self._path(at)
            fs.delete(path, True)
