"""A table store over plain Parquet: every write makes a new snapshot, a numbered list of the files that the table holds.

A snapshot appears by one rename to a number that doesn't exist yet; readers take the highest number, so they see the old
table or the new one, never a mixture and never none, and a writer that another has overtaken fails instead of undoing
its work.  Appends and upserts refer to the old files again: an append writes its rows only, and an upsert rewrites just
those files that hold a key of the new rows.  ``vacuum`` removes what no kept snapshot refers to.  Works on any file system
that Spark reaches.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom import catalog


class Conflict(RuntimeError):
    """Another writer made the next snapshot first."""


class TableStore:
    #: What the store can do besides reading and appending.
    can_replace = True

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self, name: str) -> list[int]:
        p, fs = self._path(f"{self.root}/{name}/_snapshots")
        found = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n.removesuffix(".json")) for n in found if n.endswith(".json") and not n.startswith("_"))

    def _listed(self, name: str, number: int) -> list[str]:
        p, fs = self._path(f"{self.root}/{name}/_snapshots/{number:020d}.json")
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _state(self, name: str) -> tuple[int, list[str]]:
        """The number of the current snapshot (0: none), and its files and folders, relative to the table's."""
        numbers = self._numbers(name)
        return (numbers[-1], self._listed(name, numbers[-1])) if numbers else (0, [])

    def _commit(self, name: str, number: int, parts: list[str]) -> None:
        """Makes the snapshot after the given one."""
        folder = f"{self.root}/{name}/_snapshots"
        draft, fs = self._path(f"{folder}/_{uuid.uuid4().hex}.json")
        out = fs.create(draft)
        out.write(bytearray(json.dumps(parts).encode()))
        out.close()
        final, _ = self._path(f"{folder}/{number + 1:020d}.json")
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri() if final.toUri().getScheme() else fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        none = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(draft, final, none)  # fails if the number is taken
        except Exception as e:
            fs.delete(draft, False)
            raise Conflict(f"{name}: snapshot {number + 1} can't be made, another writer was first") from e

    def exists(self, name: str) -> bool:
        return bool(self._state(name)[1])

    def _files(self, name: str, parts: list[str]) -> DataFrame:
        schema = catalog.spec(name).schema()
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{name}/{p}" for p in parts)) if parts else catalog.empty(self.spark, name)

    def read(self, name: str) -> DataFrame:
        """The whole table; an absent table is empty, with its columns."""
        catalog.spec(name)
        return self._files(name, self._state(name)[1])

    def _part(self, name: str, df: DataFrame) -> str:
        part = uuid.uuid4().hex
        catalog.conform(name, df).write.parquet(f"{self.root}/{name}/{part}")
        return part

    def _write(self, name: str, df: DataFrame) -> tuple[str, int]:
        part = self._part(name, df)
        return part, self._files(name, [part]).count()

    def append(self, name: str, df: DataFrame) -> int:
        number, parts = self._state(name)
        part, n = self._write(name, df)
        if n:
            self._commit(name, number, [*parts, part])
        return n

    def overwrite(self, name: str, df: DataFrame) -> int:
        number, _ = self._state(name)
        part, n = self._write(name, df)
        self._commit(name, number, [part])
        return n

    def _rewritten(self, name: str, parts: list[str], touched: DataFrame, keep) -> list[str]:
        """The parts with keep(rows) in place of the files that hold a row of touched (_metadata.file_path); others stay."""
        prefix = f"{self.root}/{name}/".split("://")[-1].lstrip("/")
        hit = {r[0].split("://")[-1].split(":", 1)[-1].lstrip("/").split(prefix, 1)[-1] for r in touched.collect()}  # one row a file
        if not hit:
            return parts
        stay: list[str] = []
        for p in parts:
            inside = {h for h in hit if h == p or h.startswith(f"{p}/")}
            if not inside:
                stay.append(p)
            elif p not in inside:
                folder, fs = self._path(f"{self.root}/{name}/{p}")
                names = [s.getPath().getName() for s in fs.listStatus(folder)]
                stay += [f"{p}/{n}" for n in names if not n.startswith(("_", ".")) and f"{p}/{n}" not in inside]
        new, n = self._write(name, keep(self._files(name, sorted(hit))))
        return [*stay, new] if n else stay

    def upsert(self, name: str, df: DataFrame) -> int:
        """Rows of df replace those of equal key; a key that df repeats raises ValueError, as MERGE would."""
        key = list(catalog.spec(name).key)
        number, parts = self._state(name)
        part = self._part(name, df)
        new = self._files(name, [part])
        n, most = new.groupBy(*key).agg(F.count("*").alias("c")).agg(F.coalesce(F.sum("c"), F.lit(0)), F.max("c")).first()
        if n and most > 1:
            raise ValueError(f"{name}: the rows to merge repeat a key")
        if n:
            keys = new.select(*key)
            touched = self._files(name, parts).select(*key, "_metadata.file_path").join(keys, key, "left_semi").select("file_path").distinct() if parts else self.spark.createDataFrame([], "file_path string")
            self._commit(name, number, [*self._rewritten(name, parts, touched, lambda rows: rows.join(keys, key, "left_anti")), part])
        return n

    def delete(self, name: str, where) -> None:
        """Rows that meet the condition go; NULL keeps a row."""
        number, parts = self._state(name)
        if parts:
            gone = F.coalesce(where, F.lit(False))
            touched = self._files(name, parts).filter(gone).select("_metadata.file_path").distinct()
            self._commit(name, number, self._rewritten(name, parts, touched, lambda rows: rows.filter(~gone)))

    def drop(self, name: str) -> None:
        p, fs = self._path(f"{self.root}/{name}")
        fs.delete(p, True)

    def vacuum(self, name: str, keep: int = 1) -> int:
        """Removes snapshots but the last few, and the folders of which none of these holds a file; returns how many folders went.
        No write may be under way."""
        numbers = self._numbers(name)
        held = {part.split("/")[0] for n in numbers[-keep:] for part in self._listed(name, n)}
        table, fs = self._path(f"{self.root}/{name}")
        old = [s.getPath() for s in fs.listStatus(table) if s.getPath().getName() not in held | {"_snapshots"}] if fs.exists(table) else []
        for n in numbers[:-keep]:
            fs.delete(self._path(f"{self.root}/{name}/_snapshots/{n:020d}.json")[0], False)
        for p in old:
            fs.delete(p, True)
        return len(old)

    def views(self) -> list[str]:
        """Every existing table as view <layer>_<table>, lazily."""
        out = []
        for name in catalog.TABLES:
            if self.exists(name):
                self.read(name).createOrReplaceTempView(name.replace(".", "_"))
                out.append(name.replace(".", "_"))
        return out

    def counts(self) -> DataFrame:
        return counted(self.spark, {n: self.read(n) for n in catalog.TABLES if self.exists(n)})


def counted(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows) of tables."""
    total = spark.createDataFrame([], "table_name string, rows long")
    for name, df in tables.items():
        total = total.unionByName(df.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows")))
    return total
