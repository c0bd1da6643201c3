"""A table that micro-batches add to, in runs that are merged level by level.

A batch writes one run of level 0. When ``fan`` runs of a level are there they
are merged into one of the next level, so however many batches came, a key's
rows lie in a few runs only. A run of more than ``bucket_rows`` rows is cut into
folders by the hash of its key; a reader that knows its keys opens the folders
of their hashes and no others. The larger a run, the more folders it has.

Which runs are live stands in a small manifest per batch. A batch starts from
the manifest of the batch before, also when it is run again, and what neither of
the two newest manifests names is removed. A table read earlier should be read
anew once two more batches have passed.
"""

import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacanta.streaming.batches import hadoop_folder

FAN = 8
BUCKET_ROWS = 1 << 20
MOST_BITS = 16  # 65,536 folders a run, and as many numbers on the driver


class Run(NamedTuple):
    level: int
    batch: int
    bits: int  # folders are numbered by so many bits of the hash; 0: no folders
    rows: int


class LevelledTable:
    """Rows of ``schema`` below ``path``; ``merge`` says what becomes of the rows of
    merged runs (by default they all stay)."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: list[str], merge=None,
        fan: int = FAN, bucket_rows: int = BUCKET_ROWS,
    ):
        self.spark, self.path, self.schema, self.key = spark, path, schema, key
        self.merge, self.fan, self.bucket_rows = merge, fan, bucket_rows

    # --- manifests ----------------------------------------------------------------

    def _batches(self) -> list[int]:
        store, folder = hadoop_folder(self.spark, f"{self.path}/manifest")
        if not store.exists(folder):
            return []
        names = [f.getPath().getName() for f in store.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def runs(self, before: int | None = None) -> list[Run]:
        """Live runs of the newest manifest, or of the newest before a batch."""
        batches = [b for b in self._batches() if before is None or b < before]
        if not batches:
            return []
        store, file = hadoop_folder(self.spark, f"{self.path}/manifest/{batches[-1]}")
        stream = store.open(file)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [Run(*r) for r in json.loads(text)]

    def _commit(self, batch: int, runs: list[Run]) -> None:
        """The manifest appears whole, under its name, or not at all."""
        store, draft = hadoop_folder(self.spark, f"{self.path}/manifest/_{batch}")
        stream = store.create(draft, True)
        stream.write(bytearray(json.dumps(runs).encode()))
        stream.close()
        final = hadoop_folder(self.spark, f"{self.path}/manifest/{batch}")[1]
        store.delete(final, False)
        store.rename(draft, final)

    def _clean(self, batch: int, live: list[Run]) -> None:
        kept = {f"{r.level}-{r.batch}" for r in [*live, *self.runs(before=batch)]}
        store, folder = hadoop_folder(self.spark, f"{self.path}/runs")
        for entry in store.listStatus(folder) if store.exists(folder) else []:
            if entry.getPath().getName() not in kept:
                store.delete(entry.getPath(), True)
        for old in self._batches()[:-2]:
            store.delete(hadoop_folder(self.spark, f"{self.path}/manifest/{old}")[1], False)

    # --- rows ---------------------------------------------------------------------

    def _bucket(self, bits: int) -> Column:
        return F.xxhash64(*self.key).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")

    def touched(self, rows: DataFrame, runs: list[Run]) -> list[int] | None:
        """Folder numbers, of the finest run, that the keys of ``rows`` fall into."""
        bits = max((r.bits for r in runs), default=0)
        return [r[0] for r in rows.select(self._bucket(bits)).distinct().collect()] if bits else None

    def read(self, runs: list[Run] | None = None, touched: list[int] | None = None) -> DataFrame:
        """Rows of some runs (by default the live ones), with ``touched`` only from those folders."""
        parts = []
        bits = max((r.bits for r in runs or []), default=0)
        for run in self.runs() if runs is None else runs:
            schema = self.schema
            if run.bits:
                schema = T.StructType([*schema, T.StructField("bucket", T.IntegerType())])
            rows = self.spark.read.schema(schema).parquet(f"{self.path}/runs/{run.level}-{run.batch}")
            if run.bits and touched is not None and bits:
                rows = rows.where(F.col("bucket").isin({t & ((1 << run.bits) - 1) for t in touched}))
            parts.append(rows.select(*[f.name for f in self.schema]))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionAll(part)
        return whole

    def _write(self, rows: DataFrame, level: int, batch: int, bits: int) -> Run:
        counted = Observation()
        out = rows.select(*[f.name for f in self.schema]).observe(counted, F.count(F.lit(1)).alias("rows"))
        path = f"{self.path}/runs/{level}-{batch}"
        if bits:  # each folder is written by one task: one file
            out.withColumn("bucket", self._bucket(bits)).repartition("bucket").write.mode("overwrite").partitionBy(
                "bucket"
            ).parquet(path)
        else:
            out.write.mode("overwrite").parquet(path)
        return Run(level, batch, bits, counted.get["rows"])

    def _merged(self, runs: list[Run], level: int, batch: int) -> Run:
        rows = self.read(runs)
        if self.merge:
            rows = self.merge(rows)
        n = sum(r.rows for r in runs)
        bits = min(MOST_BITS, max(0, (n - 1) // self.bucket_rows).bit_length())
        return self._write(rows if bits else rows.coalesce(1), level, batch, bits)

    def add(self, rows: DataFrame, batch: int) -> list[Run]:
        """Add the rows of a batch; returns the runs that are live from now on."""
        live = self.runs(before=batch)
        new = self._write(rows, 0, batch, 0)
        if new.rows:
            live.append(new)
        level = 0
        while True:
            here = [r for r in live if r.level == level]
            if len(here) < self.fan and not any(r.level == 0 and r.rows > self.bucket_rows for r in here):
                if level >= max((r.level for r in live), default=0):
                    break
            else:
                live = [r for r in live if r.level != level] + [self._merged(here, level + 1, batch)]
            level += 1
        self._commit(batch, live)
        self._clean(batch, live)
        return live
