"""Snapshots: what readers see while writers fail, and what writes cost."""

import pytest
from pyspark.sql import functions as F

from lexloom.tables import Conflict, TableStore

MARK = "source_system string, scope string, watermark_value string, updated_at timestamp, load_id string"
T = "ops.watermarks"


def marks(spark, rows, **values):
    df = spark.createDataFrame([("s", str(k), v) for k, v in rows], "source_system string, scope string, watermark_value string")
    return df.withColumns({"updated_at": F.lit("2024-01-01").cast("timestamp"), "load_id": F.lit("r")} | values)


def seen(store):
    return {r.scope: r.watermark_value for r in store.read(T).collect()}


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, f"file://{tmp_path}/lake")


def test_upserts_rewrite_only_files_that_hold_their_keys(spark, store):
    store.append(T, marks(spark, [(k, "a") for k in range(50)]).repartition(5))
    store.append(T, marks(spark, [(k, "b") for k in range(50, 60)]).coalesce(1))
    _, before = store._state(T)
    store.upsert(T, marks(spark, [(3, "new"), (99, "new")]))
    _, after = store._state(T)
    assert before[1] in after and len([p for p in after if p.startswith(before[0])]) == 4
    assert seen(store) == {str(k): "a" for k in range(50)} | {str(k): "b" for k in range(50, 60)} | {"3": "new", "99": "new"}
    store.upsert(T, marks(spark, [(3, "newer"), (55, "newer")]))
    assert store.read(T).count() == 61 and seen(store)["3"] == "newer" and seen(store)["55"] == "newer"
    store.delete(T, F.col("watermark_value") == "newer")
    assert store.read(T).count() == 59
    store.delete(T, F.lit(None).cast("boolean"))
    assert store.read(T).count() == 59


def test_a_writer_that_is_overtaken_fails(spark, store):
    store.append(T, marks(spark, [(1, "a")]))
    number, parts = store._state(T)
    store.upsert(T, marks(spark, [(2, "b")]))
    with pytest.raises(Conflict):
        store._commit(T, number, parts)
    assert seen(store) == {"1": "a", "2": "b"}


def test_a_crash_before_the_rename_leaves_the_old_table(spark, store, monkeypatch):
    store.append(T, marks(spark, [(1, "a")]))
    monkeypatch.setattr(TableStore, "_commit", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    for write in (store.append, store.overwrite, store.upsert):
        with pytest.raises(OSError, match="gone"):
            write(T, marks(spark, [(1, "z")]))
        assert seen(store) == {"1": "a"}


def test_vacuum_keeps_what_the_last_snapshots_hold(spark, store):
    for k in range(4):
        store.upsert(T, marks(spark, [(1, str(k)), (k + 10, "x")]))
    rows = seen(store)
    assert store.vacuum(T) >= 3 and seen(store) == rows and len(store._numbers(T)) == 1
    store.overwrite(T, marks(spark, []))
    assert store.read(T).count() == 0 and store.read(T).schema.names == MARK.replace(",", "").split()[::2]


def test_repeated_keys_are_refused(spark, store):
    with pytest.raises(ValueError, match="repeat"):
        store.upsert(T, marks(spark, [(1, "a"), (1, "b")]))
    assert not store.exists(T)
