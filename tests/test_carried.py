"""Rule outcomes carried from load to load against full checks of the whole table."""

import random

import pytest

from lexloom.operators import carried, dq

SCHEMA = "id long, grp string, part int, value double, note string"
RULES = [
    dq.Rule("U1", "unique", "id"), dq.Rule("U2", "unique", columns=("grp", "part")), dq.Rule("F1", "foreign_key", "grp", references="parents.name"), dq.Rule("N1", "not_null", "note"), dq.Rule("L1", "min_value", "value", 3.0),
    dq.Rule("H1", "max_value", "value", 95.0), dq.Rule("A1", "allowed_values", "note", values=("a", "b")), dq.Rule("C1", "row_count_min", threshold=120.0), dq.Rule("Q1", "ratio_min", expression="value > 50", threshold=0.5), dq.Rule("Q2", "ratio_max", expression="part = 1", threshold=0.2),
]


def outcomes(df):
    return sorted((r.rule_id, r.passed, r.observed_value, r.threshold, r.failed_rows) for r in df.collect())


def test_ten_loads_equal_full_checks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(carried, "COMPACT", 3)
    rng, rows, parents = random.Random(2), [], []
    state = carried.Carried(spark, f"file://{tmp_path}/s", RULES, buckets=8)
    frame = lambda rs: spark.createDataFrame(rs, SCHEMA)
    for load in range(10):
        came = [(rng.randrange(400), rng.choice(["x", "y", "z", None, f"g{rng.randrange(40)}"]), rng.choice([None, 1, 2]), rng.choice([None, rng.random() * 100]), rng.choice(["a", "b", "c", " ", None])) for _ in range(rng.randrange(40))]
        gone = [rows.pop(rng.randrange(len(rows))) for _ in range(min(len(rows), rng.randrange(25)))] if load else []
        rows += came
        new = [(f"g{rng.randrange(40)}",) for _ in range(5)] + ([("x",), (None,)] if load == 4 else [])
        lost = [parents.pop(rng.randrange(len(parents)))] if load % 3 == 2 else []
        parents += new
        whole = frame(rows)
        named = lambda rs: spark.createDataFrame(rs, "name string")
        draft = state.draft(frame(came), frame(gone) if gone else None, {"parents": (named(new), named(lost) if lost else None)}, whole=lambda: whole)  # noqa: B023
        assert outcomes(draft.outcomes) == outcomes(dq.check_rules(whole, RULES, lambda _: named(parents)))  # noqa: B023
        if load == 6:  # a gate that fails leaves the state as it was
            before = state.state()
            draft.drop()
            assert state.state() == before
            draft = state.draft(frame(came), frame(gone) if gone else None, {"parents": (named(new), named(lost) if lost else None)}, whole=lambda: whole)  # noqa: B023
        draft.commit()


def test_a_load_reads_its_own_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(carried, "COMPACT", 2)
    state = carried.Carried(spark, f"file://{tmp_path}/s", [dq.Rule("U", "unique", "id")], buckets=64)
    table = lambda a, b: spark.range(a, b)
    state.draft(table(0, 20_000)).commit()
    state.draft(table(20_000, 20_001)).commit()
    for size in (1, 8):
        draft = state.draft(table(5, 5 + size))
        read = state.read["U/"].count()
        assert read < 20_000 * size / 64 * 1.6 + 50 and draft.outcomes.first().failed_rows == 2 * size
        draft.drop()
    with pytest.raises(RuntimeError):
        a, b = state.draft(table(1, 2)), state.draft(table(2, 3))
        a.commit()
        b.commit()


def test_an_extreme_that_goes_needs_the_table(spark, tmp_path):
    state = carried.Carried(spark, f"file://{tmp_path}/s", [dq.Rule("L", "min_value", "id", 1.0)])
    state.draft(spark.range(0, 10)).commit()
    with pytest.raises(ValueError):
        state.draft(spark.range(20, 21), spark.range(0, 1))
    draft = state.draft(spark.range(20, 21), spark.range(0, 1), whole=lambda: spark.range(1, 21))
    assert outcomes(draft.outcomes) == [("L", True, 1.0, 1.0, 0)]
