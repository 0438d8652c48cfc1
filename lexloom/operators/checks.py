"""The registered checks of the shipped rule set: what no single expression over one table can say.

NULLs count as not known, not approved, not live.
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.operators import silver
from lexloom.operators.dq import Context, Rule, custom, duplicates
from lexloom.sources import landing


def outcome(one: DataFrame, rule: Rule, passed: Column, observed: Column, failed: Column, threshold: float = 0.0) -> DataFrame:
    """The outcome of a frame of one row."""
    return one.select(F.lit(rule.rule_id).alias("rule_id"), passed.alias("passed"), observed.cast("double").alias("observed_value"), F.lit(threshold).cast("double").alias("threshold"), failed.cast("long").alias("failed_rows"))


def none_of(bad: DataFrame, rule: Rule, threshold: float = 0.0) -> DataFrame:
    """Passed if there are no such rows; their number is observed."""
    n = F.col("n")
    return outcome(bad.agg(F.count("*").alias("n")), rule, n == 0, n, n, threshold)


def strangers(df: DataFrame, column: str, known: DataFrame, key: str) -> DataFrame:
    """Rows whose column isn't among the known keys."""
    return df.join(known.select(F.col(key).alias("_known")).distinct(), F.col(column) == F.col("_known"), "left_anti")


def wanted(context: Context) -> DataFrame:
    """Chunks that must be searchable."""
    return silver.wanted(context.tables("silver.chunks")).select("chunk_id").distinct()


@custom("DQ-B-004")
def source_approved(df: DataFrame, rule: Rule, context: Context) -> DataFrame:
    approved = context.sources.filter("status = 'approved'").select("source_id")  # met by equality, however many there are
    return none_of(strangers(df, "source_id", approved, "source_id"), rule)


@custom("DQ-B-005")
def landed_file_intact(df: DataFrame, rule: Rule, context: Context) -> DataFrame:
    root = context.landing_root.rstrip("/")
    found = df.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").load(root).select(landing.plain(F.col("path")).alias("_path"), F.sha2("content", 256).alias("_hash"))
    files = df.select(landing.plain(F.concat(F.lit(f"{root}/"), F.col("landing_path"))).alias("_at"), "doc_id")
    return none_of(files.join(found, F.col("_at") == F.col("_path"), "left").filter(~F.coalesce(F.col("_hash") == F.col("doc_id"), F.lit(False))), rule)


@custom("DQ-O-001")
def no_run_is_stuck(df: DataFrame, rule: Rule, context: Context) -> DataFrame:
    return none_of(df.filter((F.col("status") == "RUNNING") & (F.col("started_at") < F.lit(stuck_before(context.now)))), rule)


def stuck_before(now: datetime | None = None) -> datetime:
    """A run that has started before this and still runs is stuck."""
    return (now or datetime.now(UTC)) - timedelta(hours=2)


@custom("DQ-O-002")
def rule_known(df: DataFrame, rule: Rule, context: Context) -> DataFrame:
    return none_of(df.filter(~F.coalesce(F.col("rule_id").isin(*context.rule_ids), F.lit(False))), rule)


@custom("DQ-S-005")
def few_repeated_texts(df: DataFrame, rule: Rule, context: Context) -> DataFrame:
    share = F.when(F.col("total") == 0, F.lit(0.0)).otherwise(F.col("n") / F.col("total"))
    return outcome(duplicates(df, ["text_hash"]), rule, share <= rule.threshold, F.round(share, 4), F.col("n"), rule.threshold)


@custom("DQ-S-007")
def one_current_version(df: DataFrame, rule: Rule, context: Context) -> DataFrame:
    n = F.col("n")
    return outcome(duplicates(df.filter("is_current"), ["source_id", "unit_ref"]), rule, n == 0, n, n)


@custom("DQ-S-008")
def chunk_of_a_live_unit(df: DataFrame, rule: Rule, context: Context) -> DataFrame:
    return none_of(strangers(df, "unit_id", silver.live(context.tables("silver.document_units")), "unit_id"), rule)


@custom("DQ-S-010")
def current_chunker(df: DataFrame, rule: Rule, context: Context) -> DataFrame:
    return none_of(df.filter(~F.col("chunker_version").eqNullSafe(context.chunker_version)), rule)


@custom("DQ-G-001")
def every_wanted_chunk_embedded(df: DataFrame, rule: Rule, context: Context) -> DataFrame:
    have = df.select(F.col("chunk_id").alias("_have")).distinct()
    one = wanted(context).join(have, F.col("chunk_id") == F.col("_have"), "left").agg(F.count("*").alias("n"), F.count_if(F.col("_have").isNull()).alias("miss"))
    share = F.when(F.col("n") == 0, F.lit(1.0)).otherwise(F.round(1 - F.col("miss") / F.col("n"), 4))
    return outcome(one, rule, share >= rule.threshold, share, F.col("miss"), rule.threshold)


@custom("DQ-G-002")
def vector_length(df: DataFrame, rule: Rule, context: Context) -> DataFrame:
    length = context.vector_length
    right = (F.col("embedding_dim") == length) & (F.size("vector") == length)
    return none_of(df.filter(~F.coalesce(right, F.lit(False))), rule, length)


@custom("DQ-G-007")
def question_has_a_source(df: DataFrame, rule: Rule, context: Context) -> DataFrame:
    return none_of(df.filter(F.coalesce(F.size("expected_sources") <= 0, F.lit(True))), rule)


@custom("DQ-G-010")
def no_vector_without_a_chunk(df: DataFrame, rule: Rule, context: Context) -> DataFrame:
    return none_of(strangers(df, "chunk_id", wanted(context), "chunk_id"), rule)


@custom("DQ-G-011")
def class_allowed(df: DataFrame, rule: Rule, context: Context) -> DataFrame:
    allowed = F.lit(False)
    for model, classes in context.models.items():
        allowed = F.when(F.col("model") == model, F.col("data_classification").isin(*(c for c in classes if c != "restricted"))).otherwise(allowed)
    return none_of(df.filter(~F.coalesce(allowed, F.lit(False))), rule)
