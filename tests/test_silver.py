"""Silver and gold loads: incremental, gated on active rows, staged, and whole after a failure between any two writes."""

import pytest
from pyspark.sql import functions as F

from lexloom.operators import dq, runs, silver
from lexloom.tables import TableStore
from tests.test_engine import DOC


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, f"file://{tmp_path}/lake")


def load(spark, store, doc, name, rules=None, version="1", context=None):
    sources = spark.createDataFrame([("a", "Harbour Regulation", "XX")], "source_id string, title string, jurisdiction string")
    contents = spark.createDataFrame([("a", name, bytearray(doc))], "source_id string, doc_id string, content binary")
    return runs.build_silver(store, contents, sources, rules, version, context=context)


def image(store):
    """What counts, without run ids and times."""
    units = {(r.unit_ref, r.text, r.is_current, r.valid_to is None) for r in store.read("silver.document_units").collect()}
    chunks = {(r.chunk_id, r.is_active, r.retired_at is None) for r in store.read("silver.chunks").collect()}
    return units, chunks, {r.ref_id for r in store.read("silver.cross_references").collect()}


def test_silver_load_is_incremental(spark, store):
    first = load(spark, store, DOC, "1")
    assert (first["added"], first["inserted"], first["cross_references_added"], first["repeated_refs"]) == (5, 3, 1, 0)
    again = load(spark, store, DOC, "1")
    assert again == {"documents_up_to_date": 1, "documents_parsed": 0, "inserted": 0, "retired": 0, "unchanged": 3}
    third = load(spark, store, DOC.replace(b"once a month", b"every week"), "2")
    assert (third["changed"], third["unchanged"], third["inserted"], third["retired"]) == (1, 2, 1, 1)
    rows = store.read("silver.document_units").filter("unit_ref = 's. 13'").collect()
    assert sorted(r.is_current for r in rows) == [False, True] and all((r.valid_to is None) == r.is_current for r in rows)
    assert "[XX | Harbour Regulation | Part 2 Care > Division 1 Safety | s. 13 Drills]" in {r.context_header for r in store.read("silver.chunks").collect()}
    receipts = store.read("ops.run_log").collect()
    assert {(r.status, r.rows_in) for r in receipts} == {("SUCCEEDED", 1)} and all(len(r.config_hash) == 16 for r in receipts)


def test_rules_look_at_active_chunks_only(spark, store):
    """A change of the chunker's version retires all old chunks; a rule that asks for the new one must not see them."""
    rules = {"silver.chunks": [dq.Rule("DQ-S-010", "custom")]}
    load(spark, store, DOC, "1", rules, "1", dq.Context(chunker_version="1"))
    out = load(spark, store, DOC, "1", rules, "2", dq.Context(chunker_version="2"))
    assert (out["inserted"], out["retired"]) == (3, 3)
    assert {r.chunker_version for r in store.read("silver.chunks").filter("is_active").collect()} == {"2"}
    with pytest.raises(dq.GateFailed, match="DQ-S-010"):
        load(spark, store, DOC, "1", rules, "3", dq.Context(chunker_version="2"))


def test_rules_see_staged_tables(spark, store):
    """Chunks of a section that is repealed now are retired in the same load, and links belong to units of the same load."""
    rules = {"silver.chunks": [dq.Rule("DQ-S-008", "custom")], "silver.cross_references": [dq.Rule("DQ-S-009", "foreign_key", "unit_id", references="silver.document_units.unit_id")], "silver.document_units": [dq.Rule("DQ-S-007", "custom")]}
    load(spark, store, DOC, "1", rules)
    out = load(spark, store, DOC.replace(b"<num>13</num><text>", b"<num>13</num><text>Repealed. "), "2", rules)
    assert (out["changed"], out["retired"], out["inserted"]) == (1, 1, 0)


def test_a_failed_gate_writes_nothing(spark, store):
    load(spark, store, DOC, "1")
    before = image(store)
    with pytest.raises(dq.GateFailed):
        load(spark, store, DOC.replace(b"once a month", b"every week"), "2", {"silver.chunks": [dq.Rule("never", "row_count_min", threshold=10**6)]})
    assert image(store) == before and runs.mark(store, "silver", "a") == "1"
    assert {r.status for r in store.read("ops.dq_results").collect()} == {"fail"}


@pytest.mark.parametrize("fail_at", ["silver.document_units", "silver.cross_references", "silver.chunks", "ops.watermarks"])
def test_a_load_that_broke_off_is_completed_by_the_next(spark, tmp_path, monkeypatch, fail_at):
    changed = DOC.replace(b"once a month", b"every week").replace(b"give access", b'give <link href="/legislation/b">access</link>')
    whole, broken = (TableStore(spark, f"file://{tmp_path}/{n}") for n in ("whole", "broken"))
    for s in (whole, broken):
        load(spark, s, DOC, "1")
    load(spark, whole, changed, "2")
    upsert = TableStore.upsert
    monkeypatch.setattr(TableStore, "upsert", lambda self, name, df: (_ for _ in ()).throw(OSError(name)) if name == fail_at else upsert(self, name, df))
    with pytest.raises(OSError, match=fail_at):
        load(spark, broken, changed, "2")
    monkeypatch.undo()
    assert runs.mark(broken, "silver", "a") == "1"
    load(spark, broken, changed, "2")
    assert image(broken) == image(whole) and runs.mark(broken, "silver", "a") == "2"


def test_vectors_follow_chunks(spark, store):
    rules = [dq.Rule("DQ-G-001", "custom", threshold=1.0), dq.Rule("DQ-G-002", "custom"), dq.Rule("DQ-G-010", "custom")]
    context = dq.Context(vector_length=64)
    load(spark, store, DOC, "1")
    embed = lambda e=runs.hash_embedder(64), m="m": runs.embed_chunks(store, e, m, 64, rules, context)
    assert embed() == {"inserted": 3, "retired": 0, "unchanged": 0}
    assert embed() == {"inserted": 0, "retired": 0, "unchanged": 3}
    load(spark, store, DOC.replace(b"once a month", b"every week"), "2")
    assert embed() == {"inserted": 1, "retired": 1, "unchanged": 2}
    load(spark, store, DOC.replace(b"once a month", b"every week"), "2", version="2")
    assert embed() == {"inserted": 3, "retired": 3, "unchanged": 0}
    before = store.read("gold.chunk_embeddings").count()
    with pytest.raises(dq.GateFailed):
        embed(runs.hash_embedder(32), "n")
    with pytest.raises(RuntimeError, match="left out"):
        embed(lambda df: runs.hash_embedder(64)(df.limit(1)), "n")
    assert store.read("gold.chunk_embeddings").count() == before
    assert {r.status for r in store.read("ops.run_log").collect()} == {"SUCCEEDED", "FAILED"}


def test_a_service_is_called_in_batches_and_its_order_restored(spark, tmp_path):
    def send(texts):
        (tmp_path / f"call-{texts[0]}").write_text(str(len(texts)))
        return [{"index": k, "embedding": [float(t), float(len(texts))]} for k, t in reversed(list(enumerate(texts)))]

    def nap(seconds):
        (tmp_path / f"nap-{len(list(tmp_path.iterdir()))}").write_text(str(seconds))

    df = spark.createDataFrame([(f"{k:02d}", str(k)) for k in range(19)], "chunk_id string, text string")
    got = {r.chunk_id: r.vector[0] for r in runs.batched_embedder(send, 8, 1.5, sleep=nap)(df).collect()}
    assert got == {f"{k:02d}": float(k) for k in range(19)}
    assert sorted(p.read_text() for p in tmp_path.glob("call-*")) == ["3", "8", "8"] and [p.read_text() for p in tmp_path.glob("nap-*")] == ["1.5"] * 2
    with pytest.raises(Exception, match="asked for 8 vectors"):
        runs.batched_embedder(lambda texts: send(texts)[1:], 8, 0.0)(df).collect()


def test_the_stand_in_counts_words(spark):
    v = runs.hash_embedder(16)(spark.createDataFrame([("a", "drill drill access"), ("b", "")], "chunk_id string, text string")).collect()
    assert sorted(round(x, 4) for x in v[0].vector if x) in ([0.4472, 0.8944], [1.0]) and not any(v[1].vector)


def test_a_history_at_once_equals_its_loads(spark, monkeypatch):
    """Snapshots of two sources in any order: the fold gives what one load after the other gives, reverts as versions of their own."""
    import random

    monkeypatch.setattr(silver, "STRETCH", 3)
    rng = random.Random(4)
    snapshots, rows = [], []
    for source in ("a", None):
        for at in rng.sample(range(100), 13):
            snapshots.append((source, at))
            rows += [(source, k, at, rng.choice("AB"), f"{k}{at}") for k in range(5) if rng.random() < 0.8]
    rows += [("a", 9, a, "A", "always") for s, a in snapshots if s == "a"]
    made = spark.createDataFrame(snapshots, "source_id string, at int")
    got = silver.history(made, spark.createDataFrame(rows, "source_id string, unit_ref int, at int, text_hash string, note string"), ["source_id"], ["source_id", "unit_ref"]).collect()
    want = []
    for source in ("a", None):
        open_ = {}
        for at in sorted(a for s, a in snapshots if s == source):
            now = {k: (h, note) for s, k, a, h, note in rows if (s, a) == (source, at)}
            for k in [k for k, v in open_.items() if k not in now or now[k][0] != v[0]]:
                want.append((source, k, *open_.pop(k), at, False))
            open_ |= {k: (*v, at) for k, v in now.items() if k not in open_}
        want += [(source, k, *v, None, True) for k, v in open_.items()]
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.source_id, r.unit_ref, r.text_hash, r.note, r.valid_from, r.valid_to, r.is_current) for r in got), key=key) == sorted(want, key=key)
    assert sum(r.unit_ref == 9 for r in got) == 1
    # the same by loads, a version's id made of its start
    loads = None
    for at in sorted(a for s, a in snapshots if s == "a"):
        parsed = spark.createDataFrame([(f"{k}-{h}", k, h) for s, k, a, h, _ in rows if (s, a) == ("a", at)], "unit_id string, unit_ref int, text_hash string")
        old = loads if loads is not None else spark.createDataFrame([], "unit_id string, unit_ref int, text_hash string, valid_from timestamp, valid_to timestamp, is_current boolean")
        now = F.timestamp_seconds(F.lit(at))
        merged = silver.scd2(old, parsed, ["unit_ref"], now, F.concat("unit_id", F.lit(f"@{at}")))
        loads = spark.createDataFrame(silver.apply_merge(old, merged, ["unit_id"]).collect(), old.schema)
    by_loads = sorted(map(tuple, loads.selectExpr("unit_ref", "text_hash", "int(unix_timestamp(valid_from))", "int(unix_timestamp(valid_to))", "is_current").collect()), key=key)
    assert by_loads == sorted(((r.unit_ref, r.text_hash, r.valid_from, r.valid_to, r.is_current) for r in got if r.source_id == "a"), key=key)


def test_units_of_all_registered_versions(spark, tmp_path):
    """Contents A, B and A again, the late one given first: three versions of the section that changed, with ids of their own."""
    store, changed = TableStore(spark, f"file://{tmp_path}/lake"), DOC.replace(b"month", b"week")
    assert changed != DOC
    rows = [("a", "two", "2024-02-01 00:00:00", bytearray(changed)), ("a", "one", "2024-01-01 00:00:00", bytearray(DOC)), ("a", "one", "2024-03-01 00:00:00", bytearray(DOC))]
    contents = spark.createDataFrame(rows, "source_id string, doc_id string, at string, content binary").withColumn("at", F.to_timestamp("at"))
    n = runs.build_history(store, contents)
    units = store.read("silver.document_units")
    assert n == units.count() and units.select("unit_id").distinct().count() == n
    drills = units.filter("unit_ref = 's. 13'").orderBy("valid_from").collect()
    assert [(str(r.valid_from)[:7], str(r.valid_to)[:7], r.is_current, r.doc_id) for r in drills] == [("2024-01", "2024-02", False, "one"), ("2024-02", "2024-03", False, "two"), ("2024-03", "None", True, "one")]
    assert units.filter("unit_ref <> 's. 13' AND (NOT is_current OR valid_from <> TIMESTAMP '2024-01-01')").count() == 0
