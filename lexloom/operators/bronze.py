"""Loads of raw documents: fetched through a connector, or registered from landed batches.

Either way files are known by the hash of their content, the first of equal ones wins, rules look at the whole table as it
would be, and the saved position moves last.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom import catalog
from lexloom.functions import ids
from lexloom.operators import dq
from lexloom.operators.runs import Run, mark, set_marks, start_run
from lexloom.sources import landing
from lexloom.sources.connectors import Connector
from lexloom.tables import TableStore

TABLE = "bronze.raw_documents"
SOURCES = "source_id string, connector string, status string, title string, doc_type string, jurisdiction string, repo_path string, document_id string"


def source_frame(store: TableStore, sources: list[dict]) -> DataFrame:
    names = [c.split()[0] for c in SOURCES.split(", ")]
    return store.spark.createDataFrame([tuple(s.get(n) for n in names) for s in sources], SOURCES)


def registered(store: TableStore, column: str, system: str | None = None) -> Callable[[list[str]], set[str]]:
    """Which of some values a column of the register has."""
    def known(values: list[str]) -> set[str]:
        rows = store.read(TABLE) if system is None else store.read(TABLE).filter(F.col("source_system") == system)
        asked = store.spark.createDataFrame([(v,) for v in set(values)], f"{column} string")
        return {r[0] for r in asked.join(rows.select(column), column, "left_semi").collect()}  # at most those asked for

    return known


def described(files: DataFrame, system: str, sources: DataFrame, run: Run) -> DataFrame:
    """Register rows of files (source_id, doc_id, file_name, ...) with what their source adds."""
    own = landing.register(sources.select("source_id", "doc_type", "jurisdiction"), "sources")
    out = files.join(own, "source_id").withColumns({"source_system": F.lit(system), "mime_type": ids.mime_type(F.col("file_name")), "ingested_at": F.lit(datetime.now(UTC)).cast("timestamp"), "load_id": F.lit(run.run_id)})
    return out.select(*(n for n, _, _ in catalog.spec(TABLE).fields()))


def gated(store: TableStore, new: DataFrame, rules: dict[str, list[dq.Rule]], run: Run, context: dq.Context | None) -> dq.Report:
    rep = dq.run_checks(TABLE, store.read(TABLE).unionByName(new), rules.get(TABLE, []), run.run_id, store, context)
    dq.gate(rep, TABLE)
    return rep


def ingest(store: TableStore, connector: Connector, sources: list[dict], landing_root: str, rules: dict[str, list[dq.Rule]] | None = None, context: dq.Context | None = None, full: bool = False) -> dict:
    """One run of a connector: fetch, land, check, append, move the positions.  The audit rows are saved whatever happens.

    A service is read file by file, so a run's new files pass through the driver.
    """
    system = connector.system
    summary: dict = {"connector": system}
    try:
        with start_run(store, f"bronze_ingest:{system}") as run:
            connector.client.run_id = run.run_id
            got = connector.fetch(sources, registered(store, "remote_hash", system), lambda s, scope: mark(store, s, scope), full)
            summary |= got.info
            if got.info.get("up_to_date"):
                run.rows_in = run.rows_out = 0
                summary["result"] = "no changes at source, nothing to do"
                return summary
            hashes = [hashlib.sha256(f.content).hexdigest() for f in got.files]
            seen, rows, skipped = registered(store, "doc_id")(hashes) if hashes else set(), [], Counter(got.skipped)
            for f, doc_id in zip(got.files, hashes, strict=True):
                if doc_id in seen:
                    skipped["duplicate_content"] += 1
                    continue
                seen.add(doc_id)
                path = landing.landing_path(system, f.source["source_id"], doc_id, f.file_name)
                landing.write_bytes(store.spark, f"{landing_root}/{path}", f.content)
                rows.append((doc_id, f.source["source_id"], f.file_name, f.source_ref, f.source_version, f.remote_hash, path, f.source_url, len(f.content)))
            new = store.spark.createDataFrame(rows, "doc_id string, source_id string, file_name string, source_ref string, source_version string, remote_hash string, landing_path string, source_url string, file_size_bytes long")
            new = described(new, system, source_frame(store, sources), run)
            summary["dq"] = gated(store, new, rules or {}, run, context).summary
            loaded = store.append(TABLE, new) if rows else 0
            set_marks(store, [(system, scope, value) for scope, value in got.marks], run.run_id)
            run.rows_in, run.rows_out = len(got.files) + sum(got.skipped.values()), loaded
            summary |= {"loaded": loaded, "skipped": dict(skipped), "result": "succeeded"}
            return summary
    finally:
        summary["api_calls"] = len(connector.client.log)
        connector.client.flush(store)


def ingest_all(connectors: dict[str, Callable[[], Connector]], load: Callable[[Connector], dict]) -> list[dict]:
    """Each connector as a run of its own; one that fails doesn't stop the others."""
    out = []
    for name, make in connectors.items():
        try:
            out.append(load(make()))
        except Exception as e:  # noqa: BLE001  reported, and logged by its run
            out.append({"connector": name, "result": f"FAILED: {e}"})
    return out


def register(store: TableStore, connector: str, sources: list[dict], landing_root: str, rules: dict[str, list[dq.Rule]] | None = None, context: dq.Context | None = None) -> dict:
    """Landed batches that are newer than the position, all of them or none: every listed file must be there, whole, and of a
    known source."""
    summary: dict = {"connector": connector}
    with start_run(store, f"bronze_register:{connector}") as run:
        batches = landing.pending(store.spark, landing_root, connector, mark(store, connector, "landing")).cache()
        newest, n = batches.agg(F.max("fetched_at"), F.count("*")).first()
        summary["batches"] = n
        if not n:
            run.rows_in = run.rows_out = 0
            return summary | {"result": "no new batches"}
        if odd := batches.filter("manifest_version IS NULL OR manifest_version <> 1").select("folder").first():
            raise dq.GateFailed(f"{odd[0]}: this manifest version isn't supported")
        files = landing.verified(store.spark, batches, landing_root, connector).withColumn("file_size_bytes", F.octet_length("content").cast("long")).drop("content").cache()
        own = source_frame(store, sources)
        for what, bad in (("missing, or its hash isn't the manifest's", files.filter("NOT intact")), ("of a source that isn't registered", files.join(own, "source_id", "left_anti"))):
            if row := bad.select("path").first():
                raise dq.GateFailed(f"{row[0]}: {what}. Nothing written.")
        judged = landing.first_wins(files, store.read(TABLE), "doc_id", F.col("fetched_at"), F.col("load_id"), F.col("position")).cache()
        counts = {r.reason: r["count"] for r in judged.groupBy("reason").count().collect()}
        prefix = landing.plain(F.lit(landing_root.rstrip("/") + "/"))
        fresh = judged.filter("reason = 'loaded'").withColumns({"landing_path": F.substring(landing.plain(F.col("path")), F.char_length(prefix) + 1, F.lit(1 << 20)), "remote_hash": F.lit(None).cast("string")})
        new = described(fresh.drop("load_id"), connector, own, run).cache()
        summary["dq"] = gated(store, new, rules or {}, run, context).summary
        loaded = store.append(TABLE, new)
        calls = batches.select(F.explode("api_calls").alias("c")).select("c.*").withColumns({"run_id": F.lit(run.run_id), "connector": F.lit(connector), "called_at": F.col("called_at").cast("timestamp")})
        summary["api_calls"] = store.append("ops.api_call_log", calls.select(*(n for n, _, _ in catalog.spec("ops.api_call_log").fields())))
        set_marks(store, [(connector, "landing", newest)], run.run_id)
        run.rows_in, run.rows_out = sum(counts.values()), loaded
        return summary | {"loaded": loaded, "skipped": {k: v for k, v in counts.items() if k != "loaded"}, "result": "succeeded"}


def fetch_to_landing(out: str, connector: Connector, sources: list[dict], load_id: str, commit: str | None = None):
    """Everything approved as one batch below out, where there is no table store; a failure leaves no manifest."""
    connector.client.run_id = load_id
    got = connector.fetch(sources, lambda _: set(), lambda *_: None, full=True)
    files = [{"source_id": f.source["source_id"], "file_name": f.file_name, "source_ref": f.source_ref, "source_url": f.source_url, "source_version": f.source_version, "content": f.content} for f in got.files]
    return landing.write_batch(out, connector.system, load_id, files, connector.client.log, dict(got.skipped), commit)
