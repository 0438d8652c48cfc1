"""Reading the test tables, and registering a query with its SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexloom import scratch

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def shared(self) -> str:
        """A folder that driver and executors share; what plans write there goes at the session's end."""
        return scratch.owned(self.spark, f"{scratch.shared_dir(self.spark)}/lexloom-plans-{self.spark.sparkContext.applicationId}")

    def state(self, *names: str) -> str:
        """What changes with the files of tables: their names, sizes and times, hashed."""
        seen = []
        for name in names:
            p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.sf_dir}/{name}.parquet")
            fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            seen += sorted((str(f.getPath()), f.getLen(), f.getModificationTime()) for f in fs.listStatus(p))
        return hashlib.sha256(repr(seen).encode()).hexdigest()[:24]

    def values(self, rows: list[tuple], schema: str) -> DataFrame:
        return self.spark.createDataFrame(rows, schema)


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None) -> Callable:
        def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
            self.queries[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
            if sql is not None:
                self.sql[name] = sql
            return f

        return register
