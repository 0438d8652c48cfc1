"""A connector for tests, registered where executors can import it."""

from collections import Counter
from pathlib import Path

from lexloom.sources.connectors import Connector, Fetched, Result, connector


@connector("tests_fixed")
class Fixed(Connector):
    system = "tests_fixed"

    def __init__(self, settings, run_id, send, **_):
        self.client = None

    def fetch(self, sources, known, marks, full=False):
        return Result([Fetched(s, f"{s['source_id']}.txt", s["source_id"], "", s["source_id"].encode()) for s in self.mine(sources)], Counter())


@connector("tests_folder")
class Folder(Connector):
    """A folder as a service: a scope for each source's file, whose position is the file's text."""

    system = "tests_folder"

    def __init__(self, settings, run_id, send, **_):
        self.client, self.root = None, Path(settings["root"])

    def fetch(self, sources, known, marks, full=False):
        out = Result()
        for s in self.mine(sources):
            text = (self.root / s["source_id"]).read_text()
            if text == marks(self.system, s["source_id"]) and not full:
                out.skipped["not_modified"] += 1
                continue
            out.files.append(Fetched(s, s["source_id"], s["source_id"], "", text.encode()))
            out.marks.append((s["source_id"], text))
        with (self.root / "_asked").open("a") as f:
            f.write(f"{len(out.files)}\n")
        return out
