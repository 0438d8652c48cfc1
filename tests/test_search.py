"""Pruned keyword and vector search against scoring everything, with the work counted."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.operators import cells, postings, search

LARGE = "/root/testdata/sf0.1"


@pytest.mark.parametrize("ranges", [4, 128])
def test_keyword_top_equals_scoring_everything(spark, tmp_path, monkeypatch, ranges):
    monkeypatch.setattr(postings, "RANGE", ranges)
    rng = random.Random(3)
    weights = [1 / (k + 1) for k in range(300)]
    words = [f"w{k}" for k in range(300)]
    docs = [(k, " ".join(rng.choices(words, weights, k=rng.randrange(0, 60)))) for k in range(700)]
    docs += [(1000 + k, "w1 w7 w250") for k in range(30)] + [(2000, None), (2001, "the of"), (2002, "w5 " * 400)]
    corpus = spark.createDataFrame(docs, "id long, text string")
    p = postings.Postings.build(corpus, f"file://{tmp_path}/p", "id", "text")
    asked = [(k, " ".join(rng.choices(words, k=rng.randrange(1, 14)))) for k in range(40)] + [(90, "unheard of"), (91, None), (92, "w0"), (93, "w1 w7 w250 w0 w2 w3"), (94, "w1 w1 W7")]
    questions = spark.createDataFrame(asked, "q long, question string")
    by = defaultdict(list)
    for r in p.scores(questions, "q", "question").collect():
        by[r.q].append((-r.kw, r.id))
    for n in (1, 10, 10_000):
        got = defaultdict(list)
        for r in sorted(p.top(questions, "q", "question", n).collect(), key=lambda r: (r.q, r.rank)):
            got[r.q].append((-r.kw, r.id, r.rank))
        assert got == {q: [(*x, k + 1) for k, x in enumerate(sorted(xs)[:n])] for q, xs in by.items()}
    assert p.blocks.agg(F.max("n")).first()[0] < 4 * ranges + 40


def test_few_postings_are_scored(spark, tmp_path):
    """Of 10,000 documents and some that answer the questions, less than a fifth of the questions' postings are added for the best
    three; documents alone, of which the tenth best hardly differs from the hundredth, spare a third.  No word is one row."""
    docs, asked = spark.read.parquet(f"{LARGE}/documents.parquet"), spark.read.parquet(f"{LARGE}/benchmark.parquet")
    answers = asked.select((F.col("item_id") * 10 + 1_000_000).alias("doc_id"), "text").withColumn("doc_id", F.explode(F.sequence("doc_id", F.col("doc_id") + 3)))
    p = postings.Postings.build(docs.select("doc_id", "text").unionByName(answers), f"file://{tmp_path}/p", "doc_id", "text")
    every = p.scores(asked, "item_id", "text")
    for n, share in ((3, 0.2), (10, 0.67)):
        top = {(r.item_id, r["rank"]): (r.doc_id, r.kw) for r in p.top(asked, "item_id", "text", n).collect()}
        assert p.added < share * p.asked(asked, "item_id", "text").agg(F.sum("df")).first()[0]
        assert top == {(r.item_id, r["rank"]): (r.doc_id, r.kw) for r in search.top(every, "item_id", "doc_id", "kw", n).collect()}
    assert p.blocks.groupBy("word").count().agg(F.max("count")).first()[0] > 30


def plain(vectors, asked, n):
    out = {}
    for q, v in asked:
        if v is None:
            continue
        a, rows = np.array(v, float), []
        for k, x in vectors:
            if x is not None and len(x) == len(v):
                b = np.array(x, float)
                d = (np.linalg.norm(a) or 1) * (np.linalg.norm(b) or 1)
                rows.append((-round(float(a @ b) / d, 9), k))
        out[q] = sorted(rows)[:n]
    return out


def test_vector_top_equals_brute_force_and_skips_cells(spark, tmp_path):
    rng = random.Random(8)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(30)]
    vectors = [(k, [c + rng.gauss(0, 0.08) for c in centres[k % 30]]) for k in range(3000)]
    asked = [(k, [c + rng.gauss(0, 0.08) for c in centres[k % 30]]) for k in range(25)]
    frame = lambda rows, i: spark.createDataFrame(rows, f"{i} long, v array<double>")
    index = cells.Cells.build(frame(vectors, "id"), f"file://{tmp_path}/c", "id", "v", rows=64)
    got = defaultdict(list)
    for r in sorted(index.top(frame(asked, "q"), "q", "v", 7).collect(), key=lambda r: r["rank"]):
        got[r.q].append((-r.vec, r.id))
    assert {q: [i for _, i in xs] for q, xs in got.items()} == {q: [i for _, i in xs] for q, xs in plain(vectors, asked, 7).items()}
    possible, touched = index.last
    assert possible == 25 * 3000 and touched < 0.25 * possible


def test_vectors_of_every_kind(spark, tmp_path):
    rng = random.Random(5)
    vectors = [(k, [rng.choice([-1.0, 0.0, 1.0, 2.0]) for _ in range(4)]) for k in range(400)]  # ties and zero vectors
    vectors += [(500 + k, [1.0, 1.0, 0.0, 0.0]) for k in range(300)] + [(900, None), (901, []), (902, [3.0, 4.0])]
    asked = [(1, [1.0, 1.0, 0.0, 0.0]), (2, [0.0] * 4), (3, [3.0, 4.0]), (4, None), (5, []), (6, [1.0] * 9), (7, [-2.0, 1.0, 0.5, 0.0])]
    index = cells.Cells.build(spark.createDataFrame(vectors, "id long, v array<float>"), f"file://{tmp_path}/c", "id", "v", rows=50)
    for n in (1, 12, 2000):
        got = defaultdict(list)
        for r in sorted(index.top(spark.createDataFrame(asked, "q long, v array<double>"), "q", "v", n).collect(), key=lambda r: r["rank"]):
            got[r.q].append((-r.vec, r.id))
        want = plain(vectors, asked, n)
        assert {q: [i for _, i in xs] for q, xs in got.items()} == {q: [i for _, i in xs] for q, xs in want.items() if xs}
        assert all(math.isclose(a, b, abs_tol=2e-9) for q, xs in got.items() for (a, _), (b, _) in zip(xs, want[q], strict=True))
    empty = cells.Cells.build(spark.createDataFrame([], "id string, v array<float>"), f"file://{tmp_path}/e", "id", "v")
    assert empty.top(spark.createDataFrame(asked, "q long, v array<double>"), "q", "v", 3).count() == 0


def test_an_index_appears_once(spark, tmp_path):
    corpus = spark.createDataFrame([(1, "a word", [1.0, 0.0])], "id long, text string, v array<double>")
    first = search.SearchIndex.open(corpus, f"file://{tmp_path}", "id", "text", "v", "k")
    again = search.SearchIndex.open(corpus.limit(0), f"file://{tmp_path}", "id", "text", "v", "k")
    assert first.path == again.path and again.postings.words.count() == 1
    search.SearchIndex.build(corpus, f"file://{tmp_path}/_late", "id", "text", "v")
    assert not search.publish(spark, f"file://{tmp_path}/_late", first.path)
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["index-k"]
