"""Keyword, vector and hybrid ranking for batches of questions, over an index that is written once a corpus.

Keyword ranking opens only the blocks of postings that can hold one of the best (``postings``), vector ranking only the cells that
can (``cells``).  Both give the same rows as scoring everything.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.functions import ids
from lexloom.operators import cells, postings
from lexloom.operators.postings import term_frequencies, tokens  # noqa: F401
from lexloom.scratch import hadoop, publish


def document_frequencies(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(word, df, n): texts that hold a word, and all texts.  A text's repeats go before anything moves."""
    each = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(ids.text(F.col(text_col))), F.lit("[a-z0-9]+"), F.lit(0)))).alias("word"))
    return each.filter(~F.col("word").isin(*ids.STOP)).groupBy("word").agg(F.count("*").alias("df")).withColumn("n", F.lit(docs.count()))


class SearchIndex:
    """Blocks of postings and cells of unit vectors of a corpus, as tables below a folder."""

    def __init__(self, spark: SparkSession, path: str, id_col: str):
        self.spark, self.path, self.id_col = spark, path.rstrip("/"), id_col
        self.postings = postings.Postings(spark, f"{self.path}/postings", id_col)
        self.cells = cells.Cells(spark, f"{self.path}/vectors", id_col)

    @classmethod
    def build(cls, corpus: DataFrame, path: str, id_col: str, text_col: str, vector_col: str) -> SearchIndex:
        postings.Postings.build(corpus, f"{path.rstrip('/')}/postings", id_col, text_col)
        cells.Cells.build(corpus, f"{path.rstrip('/')}/vectors", id_col, vector_col)
        return cls(corpus.sparkSession, path, id_col)

    @classmethod
    def open(cls, corpus: DataFrame, base: str, id_col: str, text_col: str, vector_col: str, key: str) -> SearchIndex:
        """The index of a corpus, built if none is there for its key (what names its snapshot).  It appears whole, by a rename;
        of two that build it at once, the first wins."""
        spark, path = corpus.sparkSession, f"{base.rstrip('/')}/index-{key}"
        p, fs = hadoop(spark, path)
        if not fs.exists(p):
            draft = f"{base.rstrip('/')}/_index-{uuid.uuid4().hex}"
            cls.build(corpus, draft, id_col, text_col, vector_col)
            publish(spark, draft, path)
        return cls(spark, path, id_col)

    def keyword_scores(self, questions: DataFrame, question_id: str, question_col: str) -> DataFrame:
        """(question_id, id, kw): BM25 of all documents that share a word with the question; each question word counts once."""
        return self.postings.scores(questions, question_id, question_col)

    def keyword_top(self, questions: DataFrame, question_id: str, question_col: str, n: int) -> DataFrame:
        """(question_id, id, kw, rank) of the n best, ties by id."""
        return self.postings.top(questions, question_id, question_col, n)

    def vector_top(self, asked: DataFrame, question_id: str, asked_col: str, n: int) -> DataFrame:
        """(question_id, id, vec, rank): the n vectors of the highest cosine with each question's, ties by id."""
        return self.cells.top(asked, question_id, asked_col, n)

    def search(self, questions: DataFrame, asked: DataFrame, question_id: str, question_col: str, asked_col: str, k: int = 5, candidates: int = 20, rrf: int = 60) -> DataFrame:
        """question_id, id, fused, vec, kw, rank of the k best of each question."""
        kw = self.keyword_top(questions, question_id, question_col, candidates).withColumnRenamed("rank", "kr")
        return fuse(self.vector_top(asked, question_id, asked_col, candidates).withColumnRenamed("rank", "vr"), kw, question_id, self.id_col, k, rrf)


def top(scores: DataFrame, question_id: str, id_col: str, score: str, n: int, rank: str = "rank") -> DataFrame:
    """The n best of each question, ranked from 1; ties by id."""
    w = Window.partitionBy(question_id).orderBy(F.col(score).desc(), id_col)
    return scores.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def fuse(v: DataFrame, w: DataFrame, question_id: str, id_col: str, k: int = 5, rrf: int = 60) -> DataFrame:
    """Reciprocal rank fusion of two ranked lists (vr, kr): question_id, id, fused, vec, kw, rank."""
    both = v.join(w, [question_id, id_col], "full_outer")
    both = both.withColumn("fused", F.round(F.coalesce(1 / (rrf + F.col("vr")), F.lit(0.0)) + F.coalesce(1 / (rrf + F.col("kr")), F.lit(0.0)), 12))
    order = Window.partitionBy(question_id).orderBy(F.col("fused").desc(), F.col("vr").asc_nulls_last(), F.col("kr").asc_nulls_last(), id_col)
    return both.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(question_id, id_col, "fused", "vec", "kw", "rank")
