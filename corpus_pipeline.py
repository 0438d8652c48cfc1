"""From raw documents to packed training sequences, by five of the corpus operators.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns
of documents.  run() writes every stage to the folder that driver and executors share and reads it back, so an executor's
loss costs no more than the stage that runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm import jaccard, langid, lines, packing, secrets
from lexloom.llm.shared import documents, fresh, row_mark, scratch, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: those with no text or no letter in it.  lang stays as the source gave it.

    Repeated rows share their fate; with nothing to learn from, a letter is enough; an empty table stays empty.
    """
    model = langid.train(docs.filter(~F.coalesce(langid.fold() == 1, F.lit(False))))
    if not model.langs:  # nothing to learn from
        return docs.filter(F.col("text").rlike("\\p{L}"))
    return langid.identify(docs, model).filter("lang_pred <> 'und'").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more are cut out of every text; no row goes, even if nothing of its text is left.

    A null text stays null; rows of one id count as one document; n_chars follows a text that changed.
    """
    out = lines.dedup_lines(docs)
    text = F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text"))
    n = F.when(F.col("n_dropped") > 0, F.char_length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumns({"text": text, "n_chars": n}).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that link by their word shingles one row of the smallest id stays, as do all rows without an id.

    Groups are of rows, not of ids: rows of one id whose texts don't link are in groups of their own.  A row without words is
    a group with its equals.
    """
    found = written(jaccard.Join(docs).result().withColumn("_group", F.coalesce("_group", "_mark")), f"{scratch(spark, 'groups')}/found")
    first = found.filter("_id = component_id").groupBy(F.col("_id").alias("_i"), F.col("_group").alias("_g")).agg(F.min("_mark").alias("_first"), F.count("*").alias("_rows"))
    lost = found.join(first, (found["_id"] == first["_i"]) & (found["_group"] == first["_g"]), "left").filter(F.col("_id").isNotNull() & (F.col("_first").isNull() | (F.col("_mark") != F.col("_first"))))
    lost = lost.select("_id", F.col("_mark").alias("_m")).distinct()
    (mark,) = fresh(docs, "_mark")
    marked = docs.withColumn(mark, row_mark("doc_id", "text"))
    kept = marked.join(lost, (marked[mark] == lost["_m"]) & (marked["doc_id"] == lost["_id"]), "left_anti")
    if first.filter("_rows > 1").limit(1).count():  # repeated rows of a document that stays
        kept = kept.filter("doc_id is null").unionByName(kept.filter("doc_id is not null").dropDuplicates(["doc_id", mark]))
    return kept.select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Credentials that look live are blanked out; examples that many owners copied stay, and so do all documents.

    A null text stays null, a null source is an owner like any other, equal rows change alike; n_chars is the new text's.
    """
    out = secrets.redact(docs)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long"))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2,048 tokens of balanced cost, one row a piece.

    A null text is the end id alone; repeated rows are packed each; an empty table gives no piece.
    """
    return packing.pack_documents(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("secret_scan", secret_scan), ("packing", pack)]

#: Viterbi over a trained model, expectation over owners and greedy packing have no SQL; a test holds each stage, and run(), to plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, base = documents(spark, sf_dir), scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"{base}/{k}-{name}")
    return docs
