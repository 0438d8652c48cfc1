"""Run receipts, watermarks, and the incremental steps of a load over a table store."""

from __future__ import annotations

import contextlib
import os
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from datetime import UTC, datetime

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom import catalog, config
from lexloom.functions import ids
from lexloom.operators import dq, silver
from lexloom.sources import landing, markup
from lexloom.tables import TableStore


@dataclass
class Run:
    """A run's receipt."""

    run_id: str
    pipeline: str
    started_at: datetime
    status: str = "RUNNING"
    ended_at: datetime | None = None
    rows_in: int | None = None
    rows_out: int | None = None
    git_commit: str | None = None
    config_hash: str = ""
    error_message: str | None = None

    def save(self, store: TableStore) -> None:
        row = tuple(getattr(self, n) for n, _, _ in catalog.spec("ops.run_log").fields())
        store.upsert("ops.run_log", store.spark.createDataFrame([row], catalog.spec("ops.run_log").schema()))


@contextlib.contextmanager
def start_run(store: TableStore, pipeline: str, settings: config.Config | None = None) -> Iterator[Run]:
    """A receipt that is RUNNING inside, then SUCCEEDED, or FAILED with the first 2,000 characters of the error."""
    run = Run(str(uuid.uuid4()), pipeline, datetime.now(UTC), git_commit=config.commit_id(), config_hash=(settings or config.Config(os.environ.get("LEXLOOM_CONFIG_DIR"))).hash())
    run.save(store)
    try:
        yield run
        run.status = "SUCCEEDED"
    except Exception as e:
        run.status, run.error_message = "FAILED", f"{type(e).__name__}: {e}"[:2000]
        raise
    finally:
        run.ended_at = datetime.now(UTC)
        run.save(store)


def mark(store: TableStore, system: str, scope: str) -> str | None:
    row = store.read("ops.watermarks").filter((F.col("source_system") == system) & (F.col("scope") == scope)).select("watermark_value").first()
    return row[0] if row else None


def set_marks(store: TableStore, marks: list[tuple[str, str, str]] | DataFrame, run_id: str) -> None:
    """Saves positions (source_system, scope, watermark_value), all in one write."""
    if isinstance(marks, list):
        if not marks:
            return
        marks = store.spark.createDataFrame(marks, "source_system string, scope string, watermark_value string")
    store.upsert("ops.watermarks", marks.withColumns({"updated_at": _now(), "load_id": F.lit(run_id)}))


def set_mark(store: TableStore, system: str, scope: str, value: str, run_id: str) -> None:
    set_marks(store, [(system, scope, value)], run_id)


def _now() -> Column:
    return F.lit(datetime.now(UTC)).cast("timestamp")


Rules = dict[str, list[dq.Rule]]


def latest_documents(store: TableStore, system: str, landing_root: str) -> DataFrame:
    """(source_id, doc_id, content): of each source of a system the newest registered file, with its bytes.

    Only those files are read: sources are a register of bounded size, so their paths may pass through the driver.
    """
    docs = store.read("bronze.raw_documents").filter(F.col("source_system") == system)
    newest = silver.latest(docs, ["source_id"], F.col("ingested_at").desc(), F.col("doc_id").desc()).select("source_id", "doc_id", "landing_path")
    root, rows = landing_root.rstrip("/"), newest.limit(landing.REGISTER + 1).collect()
    if len(rows) > landing.REGISTER:
        raise ValueError(f"{system} has more than {landing.REGISTER} sources")
    if not rows:
        return store.spark.createDataFrame([], "source_id string, doc_id string, content binary")
    files = store.spark.read.format("binaryFile").load([f"{root}/{r.landing_path}" for r in rows]).select(landing.plain(F.col("path")).alias("_path"), "content")
    return newest.join(files, landing.plain(F.concat(F.lit(f"{root}/"), F.col("landing_path"))) == F.col("_path")).select("source_id", "doc_id", "content")


def parsed_units(todo: DataFrame, run_id: str, per_token: int = 4) -> DataFrame:
    """Unit rows of documents, with their links."""
    found = markup.units(todo).withColumn("text_hash", ids.sha(F.col("text"))).withColumn("unit_id", ids.sha(F.col("source_id"), F.col("unit_ref"), F.col("text_hash")))
    return found.select(
        "unit_id", "source_id", "doc_id", F.lit("section").alias("unit_type"), "unit_ref", "unit_order", "context_path", "heading", "text", F.char_length("text").alias("char_count"),
        ids.estimate_tokens(F.col("text"), per_token).alias("token_estimate"), "text_hash", "history_note", "is_repealed", "in_force", F.lit("xml").alias("extraction_method"),
        F.lit(None).cast("timestamp").alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"), F.lit(True).alias("is_current"), F.lit(run_id).alias("load_id"), "links",
    )


def build_history(store: TableStore, contents: DataFrame, settings: config.Config | None = None) -> int:
    """silver.document_units rebuilt from all registered versions: contents (source_id, doc_id, at, content), in any order.

    Each content is parsed once, however often it was registered.  A text that comes back is a version of its own, so ids hold the
    time from which a version counts.  Of a reference that a document repeats the last counts, as in ``build_silver``.
    """
    key = ["source_id", "unit_ref"]
    with start_run(store, "silver_history", settings) as run:
        parsed = parsed_units(contents.dropDuplicates(["source_id", "doc_id"]).drop("at"), run.run_id).drop("links", "valid_from", "valid_to", "is_current")
        parsed = silver.latest(parsed, [*key, "doc_id"], F.col("unit_order").desc())
        times = contents.select("source_id", "doc_id", "at").distinct()
        found = silver.history(times.select("source_id", "at"), parsed.join(times, ["source_id", "doc_id"]), ["source_id"], key)
        found = found.withColumn("unit_id", ids.sha(*map(F.col, key), F.col("text_hash"), F.col("valid_from").cast("string")))
        store.overwrite("silver.document_units", found.select(*(n for n, _, _ in catalog.spec("silver.document_units").fields())))
        run.rows_out = store.read("silver.document_units").count()
        return run.rows_out


class Staged:
    """Rows to merge into tables, kept until every table has passed its gate; then written in the order they came."""

    def __init__(self, store: TableStore, run: Run, rules: Rules, context: dq.Context | None):
        self.store, self.run, self.rules, self.context = store, run, rules, context
        self.rows: list[tuple[str, DataFrame]] = []
        self.images: dict[str, DataFrame] = {}
        self.dq: dict[str, str] = {}

    def image(self, table: str) -> DataFrame:
        """A table as it will be."""
        return self.images[table] if table in self.images else self.store.read(table)

    def add(self, table: str, merged: DataFrame, look_at: Callable[[DataFrame], DataFrame] = lambda df: df) -> int:
        """Stages rows and gates on what look_at takes of the table as it will be; rules see other tables so, too."""
        merged = merged.select(*(n for n, _, _ in catalog.spec(table).fields())).cache()
        self.images[table] = silver.apply_merge(self.store.read(table), merged, list(catalog.spec(table).key))
        rep = dq.run_checks(table, look_at(self.images[table]), self.rules.get(table, []), self.run.run_id, self.store, replace(self.context or dq.Context(), tables=self.image))
        self.dq[table] = rep.summary
        dq.gate(rep, table)
        self.rows.append((table, merged))
        return merged.count()

    def write(self) -> None:
        for table, merged in self.rows:
            if merged.limit(1).count():
                self.store.upsert(table, merged)


def build_silver(store: TableStore, contents: DataFrame, sources: DataFrame, rules: Rules | None = None, version: str = "1", max_tokens: int = 1200, target_tokens: int = 600, context: dq.Context | None = None, settings: config.Config | None = None) -> dict[str, int]:
    """contents (source_id, doc_id, content), one row a source, to units, references and chunks.

    All three are staged and gated before any is written, an unchanged document isn't parsed again, and the positions move
    last.  After a failure between two writes the same call completes them: links are those of current units that the
    table lacks, and chunks are compared with what the units ask for.
    """
    with start_run(store, "silver", settings) as run:
        done = store.read("ops.watermarks").filter("source_system = 'silver'").select(F.col("scope").alias("_s"), F.col("watermark_value").alias("_w"))
        todo = contents.join(done, (F.col("source_id") == F.col("_s")) & (F.col("doc_id") == F.col("_w")), "left_anti").cache()
        total, fresh = contents.count(), todo.count()
        stats: dict[str, int] = {"documents_up_to_date": total - fresh, "documents_parsed": fresh}
        staged = Staged(store, run, rules or {}, context)
        if fresh:
            parsed, existing = parsed_units(todo, run.run_id).cache(), store.read("silver.document_units")
            mine, key = existing.join(todo.select("source_id"), "source_id", "left_semi").select(*existing.columns), ["source_id", "unit_ref"]
            for r in silver.scd2_compare(mine.filter("is_current"), silver.latest(parsed, key, F.col("unit_order").desc()), key).groupBy("change").count().collect():
                stats[r.change] = r["count"]
            stats["repeated_refs"] = parsed.count() - parsed.select(*key).distinct().count()
            merged = silver.scd2(mine, parsed.drop("links"), key, _now())
            staged.add("silver.document_units", merged.withColumn("load_id", F.lit(run.run_id)))
            current = staged.image("silver.document_units").filter("is_current").select("unit_id")
            refs = markup.references(parsed.join(current, "unit_id", "left_semi")).dropDuplicates(["ref_id"]).withColumn("load_id", F.lit(run.run_id))
            refs = refs.join(store.read("silver.cross_references").select("ref_id"), "ref_id", "left_anti")
            stats["cross_references_added"] = staged.add("silver.cross_references", refs)
        units = staged.image("silver.document_units").join(landing.register(sources.select("source_id", "title", "jurisdiction"), "sources"), "source_id", "left")
        stats |= sync_chunks(staged, units, version, max_tokens, target_tokens)
        staged.write()
        set_marks(store, todo.select(F.lit("silver").alias("source_system"), F.col("source_id").alias("scope"), F.col("doc_id").alias("watermark_value")), run.run_id)
        run.rows_in, run.rows_out = total, stats["inserted"] + stats["retired"]
        return stats


def sync_chunks(staged: Staged, units: DataFrame, version: str, max_tokens: int, target_tokens: int) -> dict[str, int]:
    """Stages the chunks that units ask for; rules look at active ones."""
    existing = staged.store.read("silver.chunks")
    desired = silver.build_chunks(units, max_tokens, target_tokens, version).cache()
    actions = silver.sync(existing, desired).cache()
    stats = {"inserted": 0, "retired": 0, "unchanged": 0} | {r.action: r["count"] for r in actions.groupBy("action").count().collect()}
    new = desired.join(actions.filter("action = 'inserted'").select("chunk_id"), "chunk_id", "left_semi").withColumns({"is_active": F.lit(True), "retired_at": F.lit(None).cast("timestamp"), "load_id": F.lit(staged.run.run_id)})
    old = existing.filter("is_active").join(actions.filter("action = 'retired'").select("chunk_id"), "chunk_id", "left_semi").withColumns({"is_active": F.lit(False), "retired_at": _now()})
    staged.add("silver.chunks", new.select(*existing.columns).unionByName(old.select(*existing.columns)), lambda df: df.filter("is_active"))
    return stats


Embed = Callable[[DataFrame], DataFrame]


def embed_chunks(store: TableStore, embed: Embed, model: str, dim: int, rules: list[dq.Rule] | None = None, context: dq.Context | None = None, settings: config.Config | None = None) -> dict[str, int]:
    """Vectors in step with chunks: embed(df of chunk_id, text) gives chunk_id and vector; retired and private chunks lose theirs.

    Rules look at active vectors.
    """
    with start_run(store, "gold_embeddings", settings) as run:
        chunks, vectors = store.read("silver.chunks"), store.read("gold.chunk_embeddings")
        todo = silver.embed_todo(chunks, vectors, model).cache()
        stats = {"inserted": 0, "retired": 0, "unchanged": 0} | {r.action: r["count"] for r in todo.groupBy("action").count().collect()}
        new = embed(chunks.join(todo.filter("action = 'inserted'"), "chunk_id", "left_semi").select("chunk_id", "text"))
        new = new.select("chunk_id", F.lit(model).alias("embedding_model"), F.size("vector").alias("embedding_dim"), "vector", F.lit(True).alias("is_active"), F.lit(None).cast("timestamp").alias("retired_at"), F.lit(run.run_id).alias("load_id")).cache()
        if new.count() != stats["inserted"]:
            raise RuntimeError("the embedder left out or repeated chunks; nothing written")
        wrong = new.filter(F.size("vector") != dim).count()
        if wrong:
            raise dq.GateFailed(f"gold.chunk_embeddings: {wrong} vectors aren't {dim} long")
        old = vectors.filter((F.col("embedding_model") == model) & F.col("is_active")).join(todo.filter("action = 'retired'"), "chunk_id", "left_semi").withColumns({"is_active": F.lit(False), "retired_at": _now()})
        staged = Staged(store, run, {"gold.chunk_embeddings": rules or []}, context)
        staged.add("gold.chunk_embeddings", new.unionByName(old.select(*new.columns)), lambda df: df.filter("is_active"))
        staged.write()
        run.rows_in, run.rows_out = stats["inserted"] + stats["unchanged"], stats["inserted"] + stats["retired"]
        return stats


def batches(rows: DataFrame, size: int, lanes: int = 1) -> DataFrame:
    """rows (chunk_id, ...) with lane and batch: size rows a batch, in the order of chunk_id within a lane."""
    lane = F.pmod(F.xxhash64("chunk_id"), F.lit(lanes)).cast("int")
    order = Window.partitionBy("lane").orderBy("chunk_id")
    return rows.withColumn("lane", lane).withColumn("batch", F.floor((F.row_number().over(order) - 1) / size).cast("long"))


def in_order(reply: list[dict]) -> list[list[float]]:
    """The vectors of a service's reply in the order of what was sent, whatever the order in which they come."""
    return [d["embedding"] for d in sorted(reply, key=lambda d: d.get("index", 0))]


def batched_embedder(send: Callable[[list[str]], list[dict]], size: int = 8, pause: float = 1.0, lanes: int = 1, sleep: Callable[[float], None] = time.sleep) -> Embed:
    """An embedder over a service that takes size texts a call: send(texts) gives {index, embedding} entries.

    Calls of a lane follow each other after a pause; lanes are as many calls at once as the service allows.  A lane passes by in
    the order of chunk_id, and only the texts of one call are held.
    """
    def called(ids_: list[str], texts: list[str]) -> pa.RecordBatch:
        got = in_order(send(texts))
        if len(got) != len(texts):
            raise RuntimeError(f"asked for {len(texts)} vectors, got {len(got)}")
        return pa.RecordBatch.from_arrays([pa.array(ids_, pa.string()), pa.array([[float(x) for x in v] for v in got], pa.list_(pa.float32()))], names=["chunk_id", "vector"])

    def lane(arrived: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now, calls = [], None, 0
        for chunk, text, number in (row for batch in arrived for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)):
            if held and (len(held) == size or number != now):
                if calls:
                    sleep(pause)
                yield called(*map(list, zip(*held, strict=True)))
                held, calls = [], calls + 1
            if number != now:
                now, calls = number, 0
            held.append((chunk, text))
        if held:
            if calls:
                sleep(pause)
            yield called(*map(list, zip(*held, strict=True)))

    def embed(df: DataFrame) -> DataFrame:
        dealt = df.select("chunk_id", "text", F.pmod(F.xxhash64("chunk_id"), F.lit(lanes)).alias("lane"))
        return dealt.repartition(lanes, "lane").sortWithinPartitions("lane", "chunk_id").mapInArrow(lane, "chunk_id string, vector array<float>")

    return embed


def word_slots(text: Column, dim: int) -> Column:
    """A slot for each word of a text, by its hash."""
    return F.transform(ids.words(text), lambda w: F.pmod(F.conv(F.substring(F.md5(w.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(dim)).cast("int"))


def hash_embedder(dim: int = 1024) -> Embed:
    """A deterministic stand-in for a model: words hashed to slots and counted, of length one."""
    @F.pandas_udf("array<float>")
    def counted(slots: pd.Series) -> pd.Series:
        def one(x):
            v = np.bincount(x, minlength=dim).astype(np.float64) if len(x) else np.zeros(dim)
            return (v / (np.linalg.norm(v) or 1.0)).astype(np.float32)

        return slots.map(one)

    return lambda df: df.select("chunk_id", counted(word_slots(F.col("text"), dim)).alias("vector"))
