"""A connector as a Spark data source, for batches and for streams.

spark.dataSource.register(ConnectorSource); spark.read or spark.readStream .format("lexloom_connector")
.option("connector", name).option("settings", json).option("sources", json).load().

A batch reads everything approved, a partition for each source, on executors.  A stream's offset holds the saved positions of
all scopes: each micro-batch brings what has changed behind them, and they move when Spark commits its offset, so a batch
that fails is delivered again, from the same positions.  What is delivered twice has the same content hash, by which tables are
merged.  A stream looks at its service from the driver, as positions are compared one scope after the other.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from lexloom.sources import connectors

SCHEMA = "source_id string, file_name string, source_ref string, source_url string, source_version string, remote_hash string, content binary"


class OneSource(InputPartition):
    def __init__(self, sources: list[dict]):
        super().__init__(len(sources))
        self.sources = sources


class Reading:
    """A connector by the options of a read."""

    def __init__(self, options: dict):
        self.name, self.settings, self.sources = options["connector"], json.loads(options["settings"]), json.loads(options["sources"])
        self.module = options.get("module")

    def approved(self) -> list[dict]:
        return [s for s in self.sources if s["connector"] == self.name and s["status"] == "approved"]

    def fetched(self, sources: list[dict], marks: connectors.Marks, full: bool) -> connectors.Result:
        if self.module:  # where a connector of the user's own is registered
            __import__(self.module)
        return connectors.build(self.name, self.settings, "datasource").fetch(sources, lambda _: set(), marks, full)


def rows(got: connectors.Result) -> Iterator[tuple]:
    for f in got.files:
        yield (f.source["source_id"], f.file_name, f.source_ref, f.source_url, f.source_version, f.remote_hash, f.content)


class Reader(DataSourceReader):
    def __init__(self, reading: Reading):
        self.reading = reading

    def partitions(self) -> list[InputPartition]:
        return [OneSource([s]) for s in self.reading.approved()] or [OneSource([])]

    def read(self, partition: OneSource):
        if partition.sources:
            yield from rows(self.reading.fetched(partition.sources, lambda *_: None, True))


class StreamReader(SimpleDataSourceStreamReader):
    """Offsets are {scope: position}."""

    def __init__(self, reading: Reading):
        self.reading = reading

    def initialOffset(self) -> dict:  # noqa: N802  Spark's name
        return {}

    def _since(self, start: dict) -> connectors.Result:
        return self.reading.fetched(self.reading.approved(), lambda _, scope: start.get(scope), False)

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        got = self._since(start)
        return iter(list(rows(got))), start | dict(got.marks)  # a list is kept until its batch is planned

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        """A batch again, after a failure: what is behind its positions now."""
        return iter(list(rows(self._since(start))))


class ConnectorSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "lexloom_connector"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return Reader(Reading(dict(self.options)))

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:  # noqa: N802
        return StreamReader(Reading(dict(self.options)))
