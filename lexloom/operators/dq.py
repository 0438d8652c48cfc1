"""Data-quality rules: all scalar rules of a table in one aggregate, keyed and foreign-key rules as plans of their own.

An outcome is (rule_id, passed, observed_value, threshold, failed_rows).  NULLs are load-bearing: see each rule.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OUTCOME = "rule_id string, passed boolean, observed_value double, threshold double, failed_rows long"


@dataclass(frozen=True)
class Rule:
    """check: unique, not_null, min_value, max_value, allowed_values, foreign_key, row_count_min, ratio_min, ratio_max or custom."""

    rule_id: str
    check: str
    column: str | None = None
    threshold: float | None = None
    values: tuple = ()
    expression: str | None = None
    references: str | None = None
    severity: str = "critical"
    dimension: str = "validity"
    columns: tuple[str, ...] = field(default=())


@dataclass(frozen=True)
class Context:
    """What checks of their own may look at besides their table."""

    tables: Callable[[str], DataFrame] | None = None
    #: The source register, as a frame of source_id and status.
    sources: DataFrame | None = None
    landing_root: str | None = None
    rule_ids: tuple[str, ...] = ()
    #: The classes that each chat model may see.
    models: dict[str, tuple[str, ...]] = field(default_factory=dict)
    vector_length: int = 1024
    chunker_version: str = "1"
    now: datetime | None = None


Check = Callable[[DataFrame, Rule, Context], DataFrame]
_custom: dict[str, Check] = {}


def custom(rule_id: str):
    """Registers a check (df, rule, context) -> one outcome row."""
    def add(f: Check) -> Check:
        _custom[rule_id] = f
        return f

    return add


def _count(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def _ratio(expression: str) -> Column:
    """Share of rows that meet an expression: NULL counts as unmet, an empty table as 1."""
    return F.coalesce(F.avg(F.when(F.expr(expression), F.lit(1.0)).otherwise(F.lit(0.0))), F.lit(1.0))


def blank(c: str) -> Column:
    return F.col(c).isNull() | (F.regexp_replace(F.col(c).cast("string"), r"(?U)^\s+|\s+$", "") == "")


def _scalar(rule: Rule) -> tuple[Column, Column, Column, Column] | None:
    """(passed, observed, threshold, failed) as aggregates, or None if the rule needs a plan of its own."""
    t, none = F.lit(rule.threshold).cast("double"), F.lit(None)
    c = F.col(rule.column) if rule.column else None
    if rule.check == "not_null":
        n = _count(blank(rule.column))
        return n == 0, n, F.lit(0.0), n
    if rule.check in ("min_value", "max_value"):
        n = _count(c < rule.threshold if rule.check == "min_value" else c > rule.threshold)
        return n == 0, F.min(c) if rule.check == "min_value" else F.max(c), t, n
    if rule.check == "allowed_values":
        listed = [v for v in rule.values if v is not None]
        n = _count(~F.coalesce(c.isin(*listed), F.lit(None in rule.values)))
        return n == 0, n, F.lit(0.0), n
    if rule.check == "row_count_min":
        return F.count("*") >= rule.threshold, F.count("*"), t, none
    if rule.check in ("ratio_min", "ratio_max"):
        r = _ratio(rule.expression)
        return r >= rule.threshold if rule.check == "ratio_min" else r <= rule.threshold, r, t, none
    return None


def _outcome(df: DataFrame, rule: Rule, passed: Column, observed: Column, threshold: Column, failed: Column) -> DataFrame:
    return df.select(F.lit(rule.rule_id).alias("rule_id"), passed.alias("passed"), observed.cast("double").alias("observed_value"), threshold.cast("double").alias("threshold"), failed.cast("long").alias("failed_rows"))


def duplicates(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: n, the rows of any key that occurs more than once (NULLs are equal), and total."""
    return df.groupBy(*columns).agg(F.count("*").alias("c")).agg(F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c"))), F.lit(0)).alias("n"), F.coalesce(F.sum("c"), F.lit(0)).alias("total"))


def orphans(df: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows without a parent; NULL finds only NULL."""
    keys = parent.select(F.col(key).alias("_key")).distinct()
    return df.join(keys, df[column].eqNullSafe(keys["_key"]), "left_anti")


def check_rules(df: DataFrame, rules: list[Rule], tables: Callable[[str], DataFrame] | None = None, context: Context | None = None) -> DataFrame:
    """Outcomes of all rules of one table; a custom rule's check goes by its id, or by its expression if it has one."""
    context = replace(context or Context(), tables=tables) if tables else context or Context()
    scalar = [(r, s) for r in rules if (s := _scalar(r)) is not None]
    out: list[DataFrame] = []
    if scalar:
        names = [n for k in range(len(scalar)) for n in (f"p{k}", f"o{k}", f"t{k}", f"f{k}")]
        casts = ("boolean", "double", "double", "long")
        one = df.agg(*(v.cast(ty).alias(n) for n, v, ty in zip(names, (x for _, s in scalar for x in s), casts * len(scalar), strict=True)))
        rows = F.array(*(F.struct(F.lit(r.rule_id).alias("rule_id"), F.col(f"p{k}").alias("passed"), F.col(f"o{k}").alias("observed_value"), F.col(f"t{k}").alias("threshold"), F.col(f"f{k}").alias("failed_rows")) for k, (r, _) in enumerate(scalar)))
        out.append(one.select(F.explode(rows).alias("x")).select("x.*"))
    for r in rules:
        if r.check == "unique":
            d = duplicates(df, list(r.columns) or [r.column])
            out.append(_outcome(d, r, F.col("n") == 0, F.col("n"), F.lit(0.0), F.col("n")))
        elif r.check == "foreign_key":
            table, _, key = r.references.rpartition(".")
            d = orphans(df, r.column, context.tables(table), key).agg(F.count("*").alias("n"))
            out.append(_outcome(d, r, F.col("n") == 0, F.col("n"), F.lit(0.0), F.col("n")))
        elif r.check == "custom":
            name = r.expression or r.rule_id
            if name not in _custom:
                raise NotImplementedError(f"no check is registered for {name}")
            out.append(_custom[name](df, r, context))
    if not out:
        return df.sparkSession.createDataFrame([], OUTCOME)
    total = out[0]
    for d in out[1:]:
        total = total.unionByName(d)
    return total


def results(outcomes: DataFrame, rules: list[Rule], table: str, run_id: str) -> DataFrame:
    """Rows of ops.dq_results."""
    spark = outcomes.sparkSession
    meta = spark.createDataFrame([(r.rule_id, r.dimension, r.severity) for r in rules], "rule_id string, dimension string, severity string")
    return outcomes.join(F.broadcast(meta), "rule_id").select(
        F.lit(run_id).alias("run_id"), "rule_id", F.lit(table).alias("table_name"), "dimension", "severity", F.when(F.col("passed"), "pass").otherwise("fail").alias("status"),
        "observed_value", "threshold", "failed_rows", F.current_timestamp().alias("checked_at"),
    )


class GateFailed(RuntimeError):
    """A critical rule failed, so the table isn't written."""


@dataclass
class Report:
    """The outcome of one table's rules."""

    critical: list[str]
    warnings: list[str]
    passed: list[str]

    @property
    def summary(self) -> str:
        return "FAIL" if self.critical else "WARN" if self.warnings else "PASS"


def report(res: DataFrame) -> Report:
    rows = res.select("rule_id", "severity", "status").collect()  # one a rule
    bad = [r for r in rows if r.status == "fail"]
    return Report(sorted(r.rule_id for r in bad if r.severity == "critical"), sorted(r.rule_id for r in bad if r.severity != "critical"), sorted(r.rule_id for r in rows if r.status == "pass"))


def run_checks(table: str, df: DataFrame, rules: list[Rule], run_id: str, store=None, context: Context | None = None) -> Report:
    """Checks a candidate image and appends the results, also when it fails; the caller gates on the report."""
    if not rules:
        return Report([], [], [])
    tables = context.tables if context and context.tables else store.read if store else None
    res = results(check_rules(df, rules, tables, context), rules, table, run_id).cache()
    if store is not None:
        store.append("ops.dq_results", res)
    out = report(res)
    res.unpersist()
    return out


def gate(rep: Report, table: str) -> None:
    if rep.critical:
        raise GateFailed(f"{table}: {', '.join(rep.critical)}")
