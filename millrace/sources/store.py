"""A table in hash buckets whose buckets are replaced atomically, on any file system Hadoop knows.

A commit writes the new buckets to a folder of their own, then renames a manifest into place under
the next version number. The rename fails if that number is taken, so of two writers that began from
one version only one commits; readers see all of a version or nothing of it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Conflict(RuntimeError):
    """Another writer has committed the version this one was about to."""


class BucketStore:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self._fs = self._at("").getFileSystem(self._conf())

    def _conf(self):
        return self.spark._jsc.hadoopConfiguration()

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """The buckets that hold keys of ``rows``, at most ``buckets`` numbers."""
        return sorted(r.b for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def version(self) -> int:
        """The last committed version; 0 for none."""
        if not self._fs.exists(self._at("")):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at(""))]
        return max((int(n.removeprefix("MANIFEST-")) for n in names if n.startswith("MANIFEST-")), default=0)

    def manifest(self, version: int | None = None) -> dict[str, str]:
        """bucket -> folder of a version, the last by default."""
        version = self.version() if version is None else version
        if not version:
            return {}
        stream = self._fs.open(self._at(f"MANIFEST-{version:09d}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, buckets: Sequence[int] | None = None, version: int | None = None) -> DataFrame | None:
        """The table, or some buckets of it; None if there is nothing."""
        now = self.manifest(version)
        folders = sorted(f for b, f in now.items() if buckets is None or int(b) in set(buckets))
        return self.spark.read.parquet(*[f"{self.path}/{f}" for f in folders]) if folders else None

    def replace(self, rows: DataFrame, hit: Sequence[int], begun: int) -> int:
        """Make ``rows`` the whole content of the buckets ``hit``; returns the new version.

        ``begun`` is the version the rows were made from. A failed commit leaves only folders that no
        manifest names, which ``vacuum`` removes.
        """
        now, name = self.manifest(begun), uuid.uuid4().hex
        rows.withColumn("bucket", self.bucket()).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/{name}")
        there = {s.getPath().getName() for s in self._fs.listStatus(self._at(name))}
        for b in hit:
            if f"bucket={b}" in there:
                now[str(b)] = f"{name}/bucket={b}"
            else:
                now.pop(str(b), None)
        temporary = self._at(f".{name}")
        out = self._fs.create(temporary, False)
        out.write(bytearray(json.dumps(now).encode()))
        out.close()
        jvm = self.spark._jvm
        options = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        none = self.spark.sparkContext._gateway.new_array(options, 1)
        none[0] = options.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf())
        try:
            context.rename(self._fs.makeQualified(temporary), self._fs.makeQualified(self._at(f"MANIFEST-{begun + 1:09d}")), none)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                raise Conflict(f"version {begun + 1} of {self.path} is there already") from e
            raise
        return begun + 1

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove manifests but the last ``keep`` and the folders that none of those names; no writer may be at work."""
        last = self.version()
        kept = range(max(1, last - keep + 1), last + 1)
        used = {f.partition("/")[0] for v in kept for f in self.manifest(v).values()} | {f"MANIFEST-{v:09d}" for v in kept}
        gone = [s.getPath() for s in self._fs.listStatus(self._at("")) if s.getPath().getName() not in used]
        for p in gone:
            self._fs.delete(p, True)
        return sorted(p.getName() for p in gone)
