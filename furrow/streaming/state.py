"""Table state that micro-batches change: parents and their children in hash
buckets, replaced bucket by bucket.

A micro-batch reads and rewrites only the buckets that its parents fall into;
the files of all others stay where they are. Which version of a bucket is
valid is told by a manifest, one row per bucket, written last: that is the
commit. A batch that fails before it leaves files that no manifest names; a
batch that is replayed after it finds its own commit and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.sources.sinks import upsert_parent_replace_children

SEED = -1
_MANIFEST = "kind string, bucket int, version long"


class BucketedState:
    """Parents and children under ``folder``. ``parent_key`` and ``child_fk`` are columns of equal types, in the
    same order: their hash is the bucket. ``buckets`` bounds the part of the state that one parent makes a batch
    rewrite (1 / ``buckets``) and the size of the manifest."""

    def __init__(self, spark: SparkSession, folder: str, parents: T.StructType, children: T.StructType, parent_key, child_fk,
                 buckets: int = 64):
        self.spark, self.folder, self.buckets = spark, folder, buckets
        self.schemas = {"parents": parents, "children": children}
        self.keys = {"parents": list(parent_key), "children": list(child_fk)}
        types = [[schema[k].dataType for k in self.keys[kind]] for kind, schema in self.schemas.items()]
        if types[0] != types[1]:
            raise ValueError("parent key and foreign key need the same types")

    def _bucket(self, kind: str) -> Column:
        return F.pmod(F.xxhash64(*self.keys[kind]), F.lit(self.buckets)).cast("int")

    def _commits(self) -> dict[int, str]:
        """Number and folder of every commit."""
        try:
            files = self.spark.read.schema(_MANIFEST).option("recursiveFileLookup", "true").parquet(f"{self.folder}/manifest").inputFiles()
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return {}
            raise
        folders = {f.rsplit("/", 1)[0] for f in files}
        return {int(f.rsplit("commit-", 1)[1]): f for f in folders}

    def _versions(self, commit: str) -> dict[str, dict[int, int]]:
        out: dict[str, dict[int, int]] = {"parents": {}, "children": {}}
        for r in self.spark.read.schema(_MANIFEST).parquet(commit).collect():  # two rows for each bucket
            out[r.kind][r.bucket] = r.version
        return out

    def _read(self, kind: str, versions: dict[int, int]) -> DataFrame:
        paths = [f"{self.folder}/{kind}/version-{v}/state_bucket={b}" for b, v in sorted(versions.items())]
        reader = self.spark.read.schema(self.schemas[kind])
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], self.schemas[kind])

    def _write(self, kind: str, df: DataFrame, version: int) -> set[int]:
        """Write buckets; returns those that have rows."""
        path = f"{self.folder}/{kind}/version-{version}"
        rows = df.select(*self.schemas[kind].names).withColumn("state_bucket", self._bucket(kind))
        rows.repartition("state_bucket").write.mode("overwrite").partitionBy("state_bucket").parquet(path)
        schema = T.StructType([*self.schemas[kind].fields, T.StructField("state_bucket", T.IntegerType())])
        return {r[0] for r in self.spark.read.schema(schema).parquet(path).select("state_bucket").distinct().collect()}

    def _commit(self, number: int, versions: dict[str, dict[int, int]]) -> None:
        rows = [(kind, b, v) for kind, of in versions.items() for b, v in sorted(of.items())]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/manifest/commit-{number}")

    def seed(self, parents: DataFrame, children: DataFrame) -> None:
        """The state before the first batch; nothing if there is a commit already."""
        if not self._commits():
            self._commit(SEED, {kind: dict.fromkeys(self._write(kind, df, SEED), SEED)
                                for kind, df in (("parents", parents), ("children", children))})

    def apply(self, new_parents: DataFrame, new_children: DataFrame, batch_id: int) -> None:
        """Upsert the parents and replace the children of each; a batch that is committed already changes nothing."""
        commits = self._commits()
        if batch_id in commits:
            return
        versions = self._versions(commits[max(c for c in commits if c < batch_id)])
        touched = {r[0] for r in new_parents.select(self._bucket("parents")).distinct().collect()}  # bucket numbers
        if not touched:
            return
        old = {kind: self._read(kind, {b: v for b, v in of.items() if b in touched}) for kind, of in versions.items()}
        state = upsert_parent_replace_children(old["parents"], old["children"], new_parents, new_children,
                                               self.keys["parents"], self.keys["children"])
        for kind, df in zip(("parents", "children"), state):
            have = self._write(kind, df, batch_id)
            kept = {b: v for b, v in versions[kind].items() if b not in touched}
            versions[kind] = kept | dict.fromkeys(have, batch_id)
        self._commit(batch_id, versions)

    def read(self, kind: str) -> DataFrame:
        """The committed rows of 'parents' or 'children'."""
        commits = self._commits()
        return self._read(kind, self._versions(commits[max(commits)])[kind] if commits else {})
