"""Tables that change whole or by parts: what is new is written beside the old, then a pointer moves.

Readers see the old or the new generation, never a mixture; a failed write leaves the old one. One
writer at a time is assumed.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        path = spark._jvm.org.apache.hadoop.fs.Path
        self._path = path
        self._fs = path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(path(self.root))

    def generation(self) -> int:
        """The current generation; 0 before the first write."""
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.root))]
        return max((int(n.removeprefix("current-")) for n in names if n.startswith("current-")), default=0)

    def read(self, spark: SparkSession) -> DataFrame | None:
        g = self.generation()
        return spark.read.parquet(f"{self.root}/generation-{g}") if g else None

    def write(self, df: DataFrame, refuse_empty: bool = False) -> int:
        """Writes the next generation and moves the pointer; returns its number."""
        g = self.generation() + 1
        target = f"{self.root}/generation-{g}"
        df.write.mode("overwrite").parquet(target)
        if refuse_empty and df.sparkSession.read.parquet(target).isEmpty():
            self._fs.delete(self._path(target), True)
            raise ValueError("an empty table does not replace the current one")
        self._fs.create(self._path(f"{self.root}/current-{g}"), True).close()
        for old in range(1, g - 1):
            self._fs.delete(self._path(f"{self.root}/current-{old}"), False)
            self._fs.delete(self._path(f"{self.root}/generation-{old}"), True)
        return g

    def merge(self, spark: SparkSession, arrived: DataFrame, combine) -> int:
        """Writes ``combine(current or None, arrived)`` as the next generation; the whole table is written."""
        return self.write(combine(self.read(spark), arrived))


class PartitionedStore:
    """A table in a fixed number of parts by the hash of its key; a merge reads and writes only the parts that rows arrive for.

    Each merge writes its parts beside the others and then a manifest that names the folder of every
    part. Readers go by the newest manifest; a failed merge leaves the old one. One writer at a time is
    assumed. The parts of the manifest before the newest are kept for readers that still use it.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, parts: int = 256):
        self.root, self.key, self.parts = root.rstrip("/"), key, parts
        self._jvm = spark._jvm
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(self.root))

    def generation(self) -> int:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.root))]
        return max((int(n.removeprefix("manifest-")) for n in names if n.startswith("manifest-")), default=0)

    def manifest(self, generation: int | None = None) -> dict[int, int]:
        """part -> the generation that wrote it last."""
        g = self.generation() if generation is None else generation
        if not g:
            return {}
        stream = self._fs.open(self._path(f"{self.root}/manifest-{g}"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return {int(k): v for k, v in json.loads(text).items()}

    def read(self, spark: SparkSession, parts: list[int] | None = None) -> DataFrame | None:
        """The table, or only some parts of it; None before the first merge and where none of them has rows."""
        own = {k: g for k, g in self.manifest().items() if parts is None or k in set(parts)}
        paths = [f"{self.root}/generation-{g}/_part={k}" for k, g in sorted(own.items())]
        return spark.read.parquet(*paths) if paths else None

    def merge(self, spark: SparkSession, arrived: DataFrame, combine) -> int:
        """Writes ``combine(current or None, arrived)`` of the touched parts and moves the manifest; the generation is returned, unchanged where nothing arrived."""
        part = F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("int")
        rows = arrived.where(F.col(self.key).isNotNull())
        touched = sorted(r[0] for r in rows.select(part.alias("p")).distinct().collect())  # at most ``parts`` numbers
        g, kept = self.generation(), self.manifest()
        if not touched:
            return g
        merged = combine(self.read(spark, touched), rows).withColumn("_part", part)
        merged.repartition("_part").write.mode("overwrite").partitionBy("_part").parquet(f"{self.root}/generation-{g + 1}")
        self._write(f"{self.root}/manifest-{g + 1}", json.dumps(kept | dict.fromkeys(touched, g + 1)))
        # what neither the old nor the new manifest names
        named = set(kept.values()) | {g + 1}
        for status in self._fs.listStatus(self._path(self.root)):
            name = status.getPath().getName()
            kind, _, number = name.partition("-")
            if (kind == "generation" and int(number) not in named) or (kind == "manifest" and int(number) < g):
                self._fs.delete(status.getPath(), True)
        return g + 1

    def _write(self, path: str, text: str) -> None:
        beside = self._path(f"{self.root}/_new-manifest")
        out = self._fs.create(beside, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not self._fs.rename(beside, self._path(path)):
            raise OSError(f"cannot move the manifest to {path}")
