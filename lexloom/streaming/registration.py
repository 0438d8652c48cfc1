"""Registration by content as a stream: of equal contents the first by event time is loaded, in whatever order rows arrive.

State is one (time, id, when last seen) a content, kept by buckets of contents' hashes, so Python is called once a bucket and batch and not
once a content; a batch rewrites the buckets that it touches.  A row that comes before the one held takes its place, and the one held becomes a duplicate.
So an outcome can change once, from loaded to duplicate_content, and never back: outcomes of any batches, delivered in any order
and any number of times, fold to the same result (``settled``).

Rows that another row of the same batch of an input partition beats, and rows whose content is known, never meet the state.
They are dealt by id, so a content that a third of all rows share reaches its task as one row a batch of Arrow.  State lies in
the session's state store (spark.sql.streaming.stateStore.providerClass); take RocksDB where contents outgrow an executor's memory.

Defined results: a null content is a content like any other, a null time comes last, ties go to the lesser id as text; a row that
comes again changes nothing; an id has one time for a content.  An empty stream gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import DataType, IntegralType

from lexloom import scratch

#: The time of a row that has none.
NEVER = 2**63 - 1
LOADED, DUPLICATE = "loaded", "duplicate_content"
#: Tasks among which rows that have lost are dealt.
SLOTS = 256
#: Buckets that contents are kept in: some hundred contents each where there are millions.
BUCKETS = 1 << 14
HELD = "content array<string>, at array<long>, id array<string>, seen array<long>"
FOUND = "id string, content string, reason string"


def _order(at: int, row_id: str | None) -> tuple:
    return at, row_id is None, row_id or ""


def _beaten(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Marks rows that an earlier one of their content beats in the same batch; repeats of that one go."""
    for df in frames:
        df = df.sort_values(["at", "id"], kind="stable", na_position="last")
        first = df[~df["lost"]].drop_duplicates("content").set_index("content")["id"]
        late = ~df["lost"] & df.duplicated(["content", "lost"])
        same = late & (df["content"].map(first).fillna("") == df["id"].fillna(""))
        df["lost"] |= late
        yield df[~same]


def _first(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState, keep_ms: int) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        state.remove()
        return
    if key[0] < 0:  # rows that have lost already
        for df in frames:
            yield df[["id", "content"]].assign(reason=DUPLICATE)
        return
    now = state.getCurrentProcessingTimeMs()
    best = {c: (at, row_id, seen) for c, at, row_id, seen in zip(*state.get, strict=True) if seen + keep_ms > now} if state.exists else {}
    came = {}
    for df in frames:
        lost = []
        for content, at, row_id in zip(df["content"].tolist(), df["at"].tolist(), df["id"].tolist(), strict=True):
            one = best.get(content)
            if one is None or _order(at, row_id) < _order(*one[:2]):
                lost += [(one[1], content)] if one is not None and one[1] != row_id else []
                best[content], came[content] = (at, row_id, now), True
                continue
            best[content] = (*one[:2], now)
            if row_id != one[1]:
                lost.append((row_id, content))
            else:
                came[content] = True
        if lost:
            yield _rows(lost, DUPLICATE)
    state.update((list(best), *(list(x) for x in zip(*best.values(), strict=True))))
    state.setTimeoutDuration(keep_ms)
    if came:
        yield _rows([(best[c][1], c) for c in came], LOADED)


def _rows(rows: list[tuple], reason: str) -> pd.DataFrame:
    return pd.DataFrame({"id": [r[0] for r in rows], "content": [r[1] for r in rows], "reason": [reason] * len(rows)}, dtype=object)


def _time(rows: DataFrame, at: str) -> Column:
    whole = isinstance(rows.schema[at].dataType, IntegralType)
    return F.coalesce(F.col(at).cast("long") if whole else F.unix_micros(F.col(at).cast("timestamp")), F.lit(NEVER))


def outcomes(rows: DataFrame, known: DataFrame, key: str, at: str, row_id: str, keep: timedelta = timedelta(days=30), buckets: int = BUCKETS) -> DataFrame:
    """Changes (id, content, reason) of a stream's rows, in update mode; known has contents registered elsewhere (key).

    A content that no row had for as long as keep (processing time) is forgotten; the registry that the stream feeds still
    knows it and has to be among the known ones.  The number of buckets stays as it is while a checkpoint is in use; more of them
    hold fewer contents each.
    """
    keep_ms = int(keep / timedelta(milliseconds=1))
    old = known.select(F.col(key).alias("_known")).distinct()
    asked = rows.select(F.col(key).cast("string").alias("content"), _time(rows, at).alias("at"), F.col(row_id).cast("string").alias("id"))
    asked = asked.join(old, F.col("content") == F.col("_known"), "left").select("content", "at", "id", F.col("_known").isNotNull().alias("lost"))
    thin = asked.mapInPandas(_beaten, asked.schema)
    slot = F.when(F.col("lost"), -1 - F.pmod(F.xxhash64("id"), F.lit(SLOTS))).otherwise(F.pmod(F.xxhash64("content"), F.lit(buckets))).cast("int")
    dealt = thin.select(slot.alias("slot"), "content", "at", "id")
    return dealt.groupBy("slot").applyInPandasWithState(lambda k, frames, state: _first(k, frames, state, keep_ms), FOUND, HELD, "update", GroupStateTimeout.ProcessingTimeTimeout)


def deliver(changes: DataFrame, out: str, checkpoint: str) -> int:
    """Writes everything not yet delivered below out, a folder a batch, so a batch that comes again replaces itself; returns the
    number of batches.

    Contents are forgotten in batches that have rows: batches without any would follow each other for ever, as clocks go on.
    """
    conf, empty = changes.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(empty)
    conf.set(empty, "false")
    try:
        q = changes.writeStream.outputMode("update").foreachBatch(lambda df, k: df.write.mode("overwrite").parquet(f"{out}/batch={k}")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.set(empty, before)
    q.awaitTermination()
    return sum(1 for p in q.recentProgress if p["numInputRows"])


def settled(spark: SparkSession, out: str, kind: DataType | str = "string") -> DataFrame:
    """One row (id, content, reason) for each id and content that was delivered below out; ids are cast to kind."""
    folder, fs = scratch.hadoop(spark, out)
    rows = spark.read.schema(FOUND).parquet(out) if fs.exists(folder) else spark.createDataFrame([], FOUND)
    return rows.groupBy(F.col("id").cast(kind).alias("id"), "content").agg(F.min("reason").alias("reason"))  # a duplicate stays one
