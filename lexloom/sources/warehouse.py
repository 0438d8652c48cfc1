"""Declared tables behind a SQL warehouse: read and appended to over a DB-API connection, never replaced.

connect() gives a connection with cursors (execute, and fetchall_arrow or fetchall and description); rows go in as bound
parameters, names are quoted.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lexloom import catalog
from lexloom.governance import quote_name, quote_text
from lexloom.tables import TableStore

#: Rows of one INSERT.
ROWS = 1000


class Warehouse(TableStore):
    """A store for small appends, such as logs, from where there is no access to the tables' files."""

    can_replace = False

    def __init__(self, spark: SparkSession, connect: Callable, database: str):
        super().__init__(spark, "")
        self.connect, self.database = connect, database

    def full(self, name: str) -> str:
        return quote_name(f"{self.database}.{catalog.spec(name).name}")

    def exists(self, name: str) -> bool:
        layer, _, table = name.partition(".")
        with self.connect() as con, con.cursor() as cur:
            cur.execute(f"SHOW TABLES IN {quote_name(f'{self.database}.{layer}')} LIKE {quote_text(table)}")
            return bool(cur.fetchall())

    def read(self, name: str) -> DataFrame:
        """The declared columns, in their order; an absent table is empty."""
        spec = catalog.spec(name)
        if not self.exists(name):
            return catalog.empty(self.spark, name)
        columns = [n for n, _, _ in spec.fields()]
        with self.connect() as con, con.cursor() as cur:
            cur.execute(f"SELECT {', '.join(map(quote_name, columns))} FROM {self.full(name)}")
            if hasattr(cur, "fetchall_arrow"):
                got: pa.Table = cur.fetchall_arrow()
                return catalog.conform(name, self.spark.createDataFrame(got))
            return self.spark.createDataFrame(cur.fetchall(), spec.schema())

    def append(self, name: str, df: DataFrame) -> int:
        if not self.exists(name):
            raise RuntimeError(f"{name} isn't there, and a warehouse session may not make tables")
        columns, n = [c for c, _, _ in catalog.spec(name).fields()], 0
        rows = catalog.conform(name, df).toLocalIterator()  # a driver's own log rows
        with self.connect() as con, con.cursor() as cur:
            while batch := [r for r, _ in zip(rows, range(ROWS), strict=False)]:
                marks = ", ".join("(" + ", ".join(f":r{k}_{c}" for c in columns) + ")" for k in range(len(batch)))
                bound = {f"r{k}_{c}": r[c] for k, r in enumerate(batch) for c in columns}
                cur.execute(f"INSERT INTO {self.full(name)} ({', '.join(map(quote_name, columns))}) VALUES {marks}", bound)
                n += len(batch)
        return n

    def _refused(self, *_) -> int:
        raise NotImplementedError("a warehouse store only reads and appends")

    overwrite = upsert = delete = drop = vacuum = _refused
