"""Snapshots of several tables, their catalog and the ledger that move together.

A table lies in buckets by the hash of its key. A commit writes the buckets that its events touch and its own ledger rows
into new folders, then a manifest that names every folder of the snapshot. Manifests are numbered, and the largest number
is the current snapshot: it appears by one rename, nothing is ever deleted or replaced to make room for it, so readers see
a whole snapshot before or after, whenever a writer stops. Folders that neither this snapshot nor the one before it names
are deleted afterwards. Files go through Spark's own file system, so a store may stand on any storage the cluster shares.

Columns are kept as the texts that the source sent; typed() reads them by the catalog.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pgtypes
from . import compat
from . import ledger as _ledger

#: Ledger folders from which on a commit puts them together.
LEDGER_FOLDERS = 64
_NONE = {"number": 0, "tables": {}, "ledger": [], "catalog": []}


def _rows(catalog: DataFrame) -> list[tuple]:
    """A catalog's rows, one for each column of a table."""
    return [tuple(r) for r in catalog.select(*[f.split(" ")[0] for f in compat.CATALOG.split(", ")]).collect()]


class Store:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, at: str):
        return self._jvm.org.apache.hadoop.fs.Path(at)

    def _names(self, at: str) -> list[str]:
        where = self._path(at)
        return [s.getPath().getName() for s in self._fs.listStatus(where)] if self._fs.exists(where) else []

    def current(self) -> int:
        """Number of the current snapshot; 0 before the first."""
        return max((int(n[:-5]) for n in self._names(f"{self.path}/manifests") if n.endswith(".json")), default=0)

    def manifest(self, number: int | None = None) -> dict:
        n = self.current() if number is None else number
        if not n:
            return _NONE | {"buckets": self.buckets}
        stream = self._fs.open(self._path(f"{self.path}/manifests/{n:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def table(self, name: str, buckets: Sequence[int] | None = None, columns: Sequence[str] | None = None) -> DataFrame | None:
        """A table of the current snapshot, or only some buckets of it; columns that it doesn't have yet are null."""
        own = self.manifest()["tables"].get(name)
        if own is None:
            return None
        folders = [at for b, at in sorted(own["buckets"].items()) if buckets is None or int(b) in buckets]
        schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns or own["columns"])
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def typed(self, name: str) -> DataFrame | None:
        """A table with its columns as the types of the catalog; those of unknown types stay texts."""
        rows = self.table(name)
        if rows is None:
            return None
        oid = {r["column"]: r["type_oid"] for r in self.catalog().where(F.concat_ws(".", "namespace", "name") == name).collect()}
        return rows.select(*[pgtypes.decoded(F.col(c), oid.get(c, 25)).alias(c) for c in rows.columns])

    def ledger(self) -> DataFrame:
        folders = self.manifest()["ledger"]
        return self.spark.read.schema(_ledger.SCHEMA).parquet(*folders) if folders else self.spark.createDataFrame([], _ledger.SCHEMA)

    def catalog(self) -> DataFrame:
        return self.spark.createDataFrame([tuple(r) for r in self.manifest()["catalog"]], compat.CATALOG)

    def bucket_of(self, keys: Sequence[Column]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.manifest()["buckets"])).cast("int")

    def create(self, catalog: DataFrame) -> int:
        """Makes the tables of a catalog, empty; they must not be there."""
        rows = _rows(catalog)
        tables = {f"{r[0]}.{r[1]}": [x[3] for x in sorted(rows, key=lambda x: x[2]) if x[:2] == r[:2]] for r in rows}
        old = self.manifest()
        if clash := set(tables) & set(old["tables"]):
            raise ValueError(f"tables are there already: {sorted(clash)}")
        new = {name: {"columns": columns, "buckets": {}} for name, columns in tables.items()}
        return self._publish(old, {"tables": old["tables"] | new, "ledger": old["ledger"], "catalog": [*old["catalog"], *rows]})

    def commit(self, tables: dict[str, tuple[DataFrame, Sequence[str], Sequence[int] | None]], ledger: DataFrame, catalog: DataFrame | None = None) -> int:
        """Makes the next snapshot current; its number.

        tables: by name, the new rows of some buckets, the key columns, and which buckets these are (None: all). Other
        buckets, and tables that aren't named, are carried over by name, not copied.
        """
        old = self.manifest()
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        new = dict(old["tables"])
        for k, (name, (rows, key, touched)) in enumerate(tables.items()):
            bucket = "_bucket"
            while bucket in rows.columns:
                bucket += "_"
            at = f"{folder}/{k}"
            rows.withColumn(bucket, self.bucket_of([F.col(c) for c in key])).repartition(bucket).write.partitionBy(bucket).parquet(at)
            kept = {} if touched is None else {b: x for b, x in old["tables"].get(name, {"buckets": {}})["buckets"].items() if int(b) not in set(touched)}
            new[name] = {"columns": rows.columns, "buckets": kept | {n.split("=")[1]: f"{at}/{n}" for n in self._names(at) if n.startswith(f"{bucket}=")}}
        folders = [*old["ledger"], f"{folder}/ledger"]
        if len(folders) > LEDGER_FOLDERS:
            ledger, folders = self.ledger().unionByName(ledger), folders[-1:]
        ledger.write.parquet(folders[-1])
        rows = old["catalog"] if catalog is None else _rows(catalog)
        return self._publish(old, {"tables": new, "ledger": folders, "catalog": rows})

    def _publish(self, old: dict, new: dict) -> int:
        n = old["number"] + 1
        temporary, at = (self._path(f"{self.path}/manifests/{name}") for name in (f".{uuid.uuid4().hex}", f"{n:012d}.json"))
        out = self._fs.create(temporary, False)
        out.write(bytearray(json.dumps({"number": n, "buckets": old["buckets"]} | new).encode()))
        out.close()
        if self._fs.exists(at) or not self._fs.rename(temporary, at):
            self._fs.delete(temporary, False)
            raise OSError(f"snapshot {n} is there already: another writer was faster")
        self._clean(n)
        return n

    @staticmethod
    def _folders(manifest: dict) -> set[str]:
        return {*manifest["ledger"], *(at for t in manifest["tables"].values() for at in t["buckets"].values())}

    def _clean(self, n: int) -> None:
        """Deletes what only snapshots before the previous one name."""
        past = sorted(k for k in (int(x[:-5]) for x in self._names(f"{self.path}/manifests") if x.endswith(".json")) if k < n - 1)
        live = set().union(*(self._folders(self.manifest(k)) for k in (n, n - 1) if k))
        for k in past:
            for at in self._folders(self.manifest(k)) - live:
                self._fs.delete(self._path(at), True)
            self._fs.delete(self._path(f"{self.path}/manifests/{k:012d}.json"), False)
