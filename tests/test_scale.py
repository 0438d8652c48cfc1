"""What grows with the tables isn't held to the bounds of small registers, nor moved more often than needed."""

import math
import sys
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lexloom.operators import postings, route, search
from lexloom.plans import QUERIES
from lexloom.sources import landing


def test_more_approved_sources_than_a_register_holds(spark, sf, monkeypatch):
    want = QUERIES["dq_source_approved"](spark, sf).collect()
    monkeypatch.setattr(landing, "REGISTER", 3)
    assert QUERIES["dq_source_approved"](spark, sf).collect() == want
    assert spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").count() > landing.REGISTER


def _exchanges(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_refs_and_sections_are_not_moved(spark, sf):
    for name in ("section_status", "section_lookup_range"):
        assert "rangepartitioning" not in _exchanges(QUERIES[name](spark, sf))  # a sort of all pairs


def test_sections_are_found_however_they_meet(spark):
    units = spark.createDataFrame([(k, s, f"s. {n}", True) for k, (s, n) in enumerate((s, n) for s in ("a", "b", None) for n in ("3", "2-4", "3-3", "4-2", "x", "03") for _ in range(3))], "k int, source_id string, unit_ref string, is_current boolean")
    refs = spark.createDataFrame([(i, n, law) for i, (n, law) in enumerate((n, law) for n in ("3", "2", "03", "2-4", "x", "9") for law in ("a", None, "c", "a"))], "id int, number string, law string")
    rows = lambda df: sorted(map(tuple, df.select("id", "k", "law", "source_id").collect()), key=repr)
    inside = {"3": ("3", "2-4", "3-3"), "2": ("2-4",), "03": ("03", "2-4", "3-3"), "2-4": ("2-4",), "x": ("x",), "9": ()}
    want = sorted(((r.id, u.k, r.law, u.source_id) for r in refs.collect() for u in units.collect() if r.law in (None, u.source_id) and u.unit_ref[3:] in inside[r.number]), key=repr)
    assert rows(route.named(refs, units)) == want == rows(route.named(refs, units, few=True)) == rows(route.lookup(refs, units))


def test_an_index_moves_words_once_and_merges_rows_of_an_id(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(1, "a1 b2 b2"), (2, "b2 the c3"), (1, "c3 a1"), (3, None), (4, "B2!")], "id long, text string")
    monkeypatch.setattr(postings, "term_frequencies", None)  # no row a word and text
    p = postings.Postings.build(docs, f"file://{tmp_path}/p", "id", "text")
    assert {(r.word, r.df) for r in p.words.collect()} == {("a1", 1), ("b2", 3), ("c3", 2)}
    assert p.totals.first().n == 5 and p.totals.first().mean_length == 8 / 5
    assert sorted(i for r in p.ids.collect() for i in r.ids) == [1, 2, 4]
    assert p.blocks.agg(F.sum("n")).first()[0] == 6
    one = {r.id: r.kw for r in p.scores(spark.createDataFrame([(0, "b2")], "q long, question string"), "q", "question").collect()}
    weight = math.log(1 + (5 - 3 + 0.5) / (3 + 0.5))
    assert one == {i: round(weight * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * n / 1.6)), 9) for i, tf, n in ((1, 2, 5), (2, 1, 2), (4, 1, 1))}


def test_postings_of_a_question_are_added_at_once():
    asked, words, docs, steps = 20, 200, 64, []
    parts, idf = np.random.default_rng(1).random((words, docs)) + 0.1, np.linspace(1, 2, words)
    sent = SimpleNamespace(value=(list(range(asked)), {f"w{k}": (np.arange(asked), idf[k]) for k in range(words)}, np.zeros(asked), None))
    slots = np.arange(docs, dtype="<i4").tobytes()
    rows = pa.RecordBatch.from_arrays([pa.array([f"w{k}" for k in range(words)]), pa.array([7] * words), pa.array(parts.max(axis=1)), pa.array([slots] * words), pa.array([p.tobytes() for p in parts])], names=["word", "range", "top", "slots", "parts"])
    sys.setprofile(lambda frame, event, arg: steps.append(event) if event in ("call", "c_call") else None)
    try:
        found = list(postings._scored(sent, None, pa.int64())(iter([rows.slice(0, 90), rows.slice(90)])))
    finally:
        sys.setprofile(None)
    got, ended = pa.Table.from_batches(found[:-1]).to_pydict(), found[-1].to_pydict()
    assert got["_q"] == [q for q in range(asked) for _ in range(docs)] and got["slot"] == list(range(docs)) * asked and set(got["range"]) == {7}
    assert np.allclose(np.array(got["kw"]).reshape(asked, docs), idf @ parts, rtol=0, atol=1e-8) and ended["kw"] == [asked * words * docs]
    assert len(steps) < asked * words  # no step a question and word


def test_recall_searches_words_once(spark, sf, monkeypatch):
    asked, plain = [], search.SearchIndex.keyword_top
    monkeypatch.setattr(search.SearchIndex, "keyword_top", lambda self, *a: asked.append(a[-1]) or plain(self, *a))
    QUERIES["recall_at_k"](spark, sf)
    assert asked == [20]


def test_few_questions_go_to_the_texts(spark, sf, monkeypatch):
    seen, plain = [], route.named
    monkeypatch.setattr(route, "named", lambda refs, units, few=False: seen.append(few) or plain(refs, units, few))
    rows = lambda: sorted(map(tuple, QUERIES["failover_chain"](spark, sf).collect()))
    some = rows()
    monkeypatch.setattr(landing, "REGISTER", 3)
    assert some == rows() and seen == [True, False]
