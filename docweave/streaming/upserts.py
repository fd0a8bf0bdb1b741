"""Upserts from a stream into a plain Parquet table: a version a batch, a ledger of batches, and a swap that is one file put in place.

A table's folder holds ``versions``, whole tables that are never changed once written, and ``ledger``, a file for each batch that is done, which names
the version that came of it. A batch that the ledger has is passed over, so one that runs again after a crash changes nothing; one that broke off before its entry
leaves a version that nothing names, which a later batch removes. The entry is written beside its place and renamed, and a rename onto an entry that is there fails, so that of two
runs of a batch one counts. Readers take the version of the last entry; the one before stays for those that began with it.

Of a key's rows the last by ``order`` stays, nulls first; where that ties the later batch, and within a batch the greater row of all columns. So the table
after all batches doesn't depend on how the changes were cut into them. Rows with a null in their key conflict with none. Each batch is one shuffle of table and changes on the keys; partition a large
table by a column of the key and give it as ``part``: then only the parts that a batch touches are read and written, and the version names the rest from before.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def merged(current: DataFrame, changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``current`` with the rows of ``changes`` that come after them, and those that are new."""
    columns = current.columns
    new, rank = _unused(columns, "new"), _unused(columns, "rank")
    both = current.withColumn(new, F.lit(0)).unionByName(changes.select(*columns).withColumn(new, F.lit(1)))
    keyed = ~F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    last = W.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last(), F.col(new).desc(), *[F.col(c).desc_nulls_last() for c in columns if not isinstance(current.schema[c].dataType, (T.MapType, T.VariantType))])
    kept = both.where(keyed).withColumn(rank, F.row_number().over(last)).where(F.col(rank) == 1)
    return kept.select(*columns).unionByName(both.where(~keyed).select(*columns))


def _unused(columns: list[str], name: str) -> str:
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


class VersionedTable:
    def __init__(self, spark: SparkSession, folder: str, schema: str | T.StructType, part: str | None = None):
        self.spark, self.folder, self.part = spark, folder.rstrip("/"), part
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _path(self, name: str):
        path = self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self._conf), path

    def _names(self, name: str) -> list[str]:
        fs, path = self._path(name)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def batches(self) -> list[int]:
        """Those that are done."""
        return [int(n) for n in self._names("ledger") if n.isdigit()]

    def entry(self, batch: int | None = None) -> dict[str, str]:
        """The folder of each part in the last version, or in a batch's; a table without parts has one, named ``*``."""
        done = self.batches()
        if not done:
            return {}
        fs, path = self._path(f"ledger/{max(done) if batch is None else batch:020d}")
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _read(self, parts: dict[str, str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.folder}/versions/{p}" for p in parts.values()])

    def current(self) -> DataFrame:
        return self._read(self.entry())

    def _commit(self, batch: int, parts: dict[str, str]) -> bool:
        fs, path = self._path(f"ledger/{batch:020d}")
        _, beside = self._path(f"ledger/.{batch:020d}.{uuid.uuid4().hex}")
        stream = fs.create(beside, False)
        stream.write(bytearray(json.dumps(parts).encode()))
        stream.close()
        if not fs.exists(path) and fs.rename(beside, path):
            return True
        fs.delete(beside, False)
        return False

    def apply(self, changes: DataFrame, batch: int, keys: list[str], order: str) -> bool:
        """Put a batch of changes into a new version; whether it did, which it doesn't twice."""
        if batch in self.batches():
            return False
        before = self.entry()
        name = f"{batch:020d}-{uuid.uuid4().hex}"
        fs, path = self._path(f"versions/{name}")
        if self.part is None:
            merged(self._read(before), changes, keys, order).write.parquet(str(path))
            parts = {"*": name}
        else:
            if self.part not in keys:
                raise ValueError("a table's parts come from a column of its key")
            label = F.coalesce(F.col(self.part).cast("string"), F.lit(""))
            touched = [r[0] for r in changes.select(label).distinct().limit(MOST_PARTS + 1).collect()]
            if len(touched) > MOST_PARTS:
                raise ValueError(f"a batch touches more than {MOST_PARTS} parts")
            rows = merged(self._read({p: before[p] for p in touched if p in before}), changes, keys, order)
            folder = _unused(rows.columns, "part")
            rows.withColumn(folder, F.hex(F.coalesce(F.col(self.part).cast("string"), F.lit("")))).write.partitionBy(folder).parquet(str(path))
            written = {s for s in self._names(f"versions/{name}") if "=" in s}
            there = {p: f"{folder}={p.encode().hex().upper() or '__HIVE_DEFAULT_PARTITION__'}" for p in touched}
            parts = before | {p: f"{name}/{s}" for p, s in there.items() if s in written}
        if not self._commit(batch, parts):
            fs.delete(path, True)
            return False
        self._clean()
        return True

    def _clean(self) -> None:
        """Versions that neither of the last two entries names go."""
        named = {p.split("/")[0] for b in sorted(self.batches())[-2:] for p in self.entry(b).values()}
        for v in self._names("versions"):
            if v not in named:
                fs, path = self._path(f"versions/{v}")
                fs.delete(path, True)


#: Parts that one batch touches at most.
MOST_PARTS = 10_000


def start(changes: DataFrame, table: VersionedTable, checkpoint: str, *, keys: list[str], order: str):
    """The query that applies each micro-batch; all that is there now, then it ends."""
    return changes.writeStream.foreachBatch(lambda batch, n: table.apply(batch, n, keys, order)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
