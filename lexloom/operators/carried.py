"""Rule outcomes that are carried from load to load, so that a gate reads what a load brings and not the table.

The state of a table's rules is a row of mergeable statistics (counts of failing rows, extremes, rows that meet a share) and, for
keyed rules, the number of rows of each key, stored by buckets of keys.  A load is a frame of rows that come and one of rows
that go (those an upsert replaces).  Its statistics are added and subtracted; of the stored keys only the buckets are read that
the load's keys fall into, and a foreign key follows both its sides.  Every load adds a small file of changed counts; after
COMPACT of them the buckets are summed up again.

The gate looks at a draft: ``Carried.draft`` gives the outcomes as they will be, and only ``commit`` makes them the state, by one rename.
A lowest or highest value that goes with a load's rows can't be told from statistics: then, and for custom rules, the
whole table is looked at.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexloom.operators import dq
from lexloom.operators.dq import Context, Rule
from lexloom.scratch import delete, hadoop, publish

#: Buckets of a keyed rule's counts; loads after which they are summed up.
BUCKETS, COMPACT = 1024, 8
Delta = tuple[DataFrame, DataFrame | None]


def statistics(df: DataFrame, rules: list[Rule]) -> dict[str, list]:
    """For each scalar rule: failing rows, lowest or highest value, rows that meet its expression, all rows."""
    columns, scalar = [], [r for r in rules if r.check not in ("unique", "foreign_key", "custom")]
    for k, r in enumerate(scalar):
        c = F.col(r.column) if r.column else None
        bad: Column = F.lit(0)
        if r.check == "not_null":
            bad = F.count_if(F.coalesce(dq.blank(r.column), F.lit(False)))
        elif r.check in ("min_value", "max_value"):
            bad = F.count_if(F.coalesce(c < r.threshold if r.check == "min_value" else c > r.threshold, F.lit(False)))
        elif r.check == "allowed_values":
            listed = [v for v in r.values if v is not None]
            bad = F.count_if(~F.coalesce(c.isin(*listed), F.lit(None in r.values)))
        edge = F.min(c) if r.check == "min_value" else F.max(c) if r.check == "max_value" else F.lit(None)
        met = F.count_if(F.coalesce(F.expr(r.expression), F.lit(False))) if r.check in ("ratio_min", "ratio_max") else F.lit(0)
        columns += [bad.cast("long").alias(f"b{k}"), edge.cast("double").alias(f"e{k}"), met.cast("long").alias(f"m{k}")]
    one = df.agg(F.count("*").alias("n"), *columns).first()
    return {r.rule_id: [one[f"b{k}"], one[f"e{k}"], one[f"m{k}"], one.n] for k, r in enumerate(scalar)}


def merged(rule: Rule, old: list, new: list, sign: int) -> tuple[list, bool]:
    """Statistics after rows came (1) or went (-1), and whether the extreme may have gone with them."""
    edges = [e for e in (old[1], new[1]) if e is not None]
    best = min if rule.check == "min_value" else max
    edge = best(edges) if edges and sign > 0 else old[1]
    gone = sign < 0 and new[1] is not None and new[1] == old[1]
    return [old[0] + sign * new[0], edge, old[2] + sign * new[2], old[3] + sign * new[3]], gone


def outcome(rule: Rule, s: list) -> tuple:
    """(rule_id, passed, observed, threshold, failed) of a scalar rule's statistics."""
    bad, edge, met, n = s
    if rule.check == "row_count_min":
        return rule.rule_id, n >= rule.threshold, float(n), float(rule.threshold), None
    if rule.check in ("ratio_min", "ratio_max"):
        share = met / n if n else 1.0
        return rule.rule_id, share >= rule.threshold if rule.check == "ratio_min" else share <= rule.threshold, share, float(rule.threshold), None
    extreme = rule.check in ("min_value", "max_value")
    return rule.rule_id, bad == 0, edge if extreme else float(bad), float(rule.threshold) if extreme else 0.0, bad


@dataclass
class Draft:
    """A state as it will be, and its outcomes."""

    owner: Carried
    state: dict
    outcomes: DataFrame
    written: list[str] = field(default_factory=list)

    def commit(self) -> None:
        self.owner._commit(self.state)

    def drop(self) -> None:
        for p in self.written:
            delete(self.owner.spark, p)


class Carried:
    """The carried state of one table's rules, in a folder of its own."""

    def __init__(self, spark: SparkSession, path: str, rules: list[Rule], buckets: int = BUCKETS):
        self.spark, self.path, self.rules, self.buckets = spark, path.rstrip("/"), rules, buckets
        #: Stored counts that the last draft read, by rule and side: for tests and tuning.
        self.read: dict[str, DataFrame] = {}

    def _numbers(self) -> list[int]:
        p, fs = hadoop(self.spark, f"{self.path}/states")
        return sorted(int(s.getPath().getName().removesuffix(".json")) for s in fs.listStatus(p) if s.getPath().getName()[0].isdigit()) if fs.exists(p) else []

    def state(self) -> dict:
        """number, statistics by rule, and for keyed rules the rows that fail and the folders of counts of each side."""
        numbers = self._numbers()
        if not numbers:
            return {"number": 0, "scalar": {}, "failing": {}, "counts": {}}
        p, fs = hadoop(self.spark, f"{self.path}/states/{numbers[-1]:012d}.json")
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, state: dict) -> None:
        draft, fs = hadoop(self.spark, f"{self.path}/states/_{uuid.uuid4().hex}.json")
        out = fs.create(draft)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if not publish(self.spark, draft.toString(), f"{self.path}/states/{state['number']:012d}.json"):
            raise RuntimeError(f"{self.path}: another load was committed first")

    def _keys(self, rows: DataFrame, columns: list[str], sign: int) -> DataFrame:
        return rows.select(F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(columns))).alias("k")).groupBy("k").agg((F.count("*") * sign).alias("d"))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("k"), F.lit(self.buckets)).cast("int")

    def _change(self, delta: Delta, columns: list[str]) -> DataFrame:
        """(bucket, k, d): by how many rows each key of a load changes."""
        came, gone = delta
        each = self._keys(came, columns, 1)
        if gone is not None:
            each = each.unionByName(self._keys(gone, columns, -1))
        return each.groupBy("k").agg(F.sum("d").alias("d")).filter("d <> 0").select(self._bucket().alias("bucket"), "k", "d")

    def _stored(self, folders: list[str], schema: StructType, touched: list[int]) -> DataFrame:
        """(k, c) of the buckets that a load touches: a folder each in what is summed up, and the loads' changes since."""
        out = self.spark.createDataFrame([], schema)
        for base in (True, False):
            if some := [f for f in folders if ("/base-" in f) == base]:
                out = out.unionByName(self.spark.read.schema(schema).parquet(*some).filter(F.col("bucket").isin(*touched)))
        return out.select("k", F.col("d").alias("c"))

    def draft(self, came: DataFrame, gone: DataFrame | None = None, parents: dict[str, Delta] | None = None, whole: Callable[[], DataFrame] | None = None, context: Context | None = None) -> Draft:
        """The outcomes after a load of rows that come and go.

        parents: what changes in tables that foreign keys refer to.  whole: the table as it will be.
        """
        old, seq = self.state(), uuid.uuid4().hex
        new = {"number": old["number"] + 1, "scalar": {}, "failing": dict(old["failing"]), "counts": {k: list(v) for k, v in old["counts"].items()}}
        plus, minus = statistics(came, self.rules), statistics(gone, self.rules) if gone is not None else {}
        rows, again, made = [], [], []
        self.read = {}
        for r in self.rules:
            if r.rule_id in plus:
                s, lost = old["scalar"].get(r.rule_id, [0, None, 0, 0]), False
                if r.rule_id in minus:
                    s, lost = merged(r, s, minus[r.rule_id], -1)
                s, _ = merged(r, s, plus[r.rule_id], 1)
                if lost:
                    again.append(r)
                new["scalar"][r.rule_id] = s
        if again:  # an extreme went: only the table knows the next one
            if whole is None:
                raise ValueError(f"{self.path}: rows with the extreme of {', '.join(r.rule_id for r in again)} went, the whole table is needed")
            new["scalar"] |= statistics(whole(), again)
        for r in self.rules:
            if r.rule_id in new["scalar"]:
                rows.append(outcome(r, new["scalar"][r.rule_id]))
            elif r.check in ("unique", "foreign_key"):
                sides = {"": ((came, gone), list(r.columns) or [r.column])}
                if r.check == "foreign_key":
                    table, _, key = r.references.rpartition(".")
                    if parents and table in parents:
                        sides["parent"] = (parents[table], [key])
                n = self._keyed(r, sides, new, seq, made)
                rows.append((r.rule_id, n == 0, float(n), 0.0, n))
        custom = [r for r in self.rules if r.check == "custom"]
        out = self.spark.createDataFrame(rows, dq.OUTCOME)
        if custom:
            if whole is None:
                raise ValueError(f"{self.path}: custom rules need the whole table")
            out = out.unionByName(dq.check_rules(whole(), custom, context=context))
        return Draft(self, new, out, made)

    def _keyed(self, rule: Rule, sides: dict, new: dict, seq: str, made: list[str]) -> int:
        """Rows that fail a keyed rule after a load; the changes of its counts are written."""
        spark, total = self.spark, None
        names = ("", "parent") if rule.check == "foreign_key" else ("",)
        changes = {}
        for side, (delta, columns) in sides.items():
            at = f"{self.path}/counts/{rule.rule_id}{'-' + side if side else ''}/{seq}"
            self._change(delta, columns).repartition(1 if side else max(1, self.buckets // 256), "bucket").sortWithinPartitions("bucket").write.mode("overwrite").parquet(at)
            made.append(at)
            changes[side] = spark.read.parquet(at)
        touched = sorted({r[0] for c in changes.values() for r in c.select("bucket").distinct().collect()})  # at most BUCKETS
        for side in names:
            key = f"{rule.rule_id}/{side}"
            folders = new["counts"].get(key, [])
            some = next(iter(changes.values()))
            before = self._stored(folders, some.schema, touched)
            self.read[key] = before
            moved = changes[side].select("k", "d") if side in changes else spark.createDataFrame([], some.schema).select("k", "d")
            both = before.select("k", F.col("c").alias("was"), F.col("c").alias("now")).unionByName(moved.select("k", F.lit(0).cast("long").alias("was"), F.col("d").alias("now")))
            both = both.groupBy("k").agg(F.sum("was").alias(f"was{side}"), F.sum("now").alias(f"now{side}"))
            total = both if total is None else total.join(both, total["k"].eqNullSafe(both["k"]), "full_outer").select(F.coalesce(total["k"], both["k"]).alias("k"), "was", "now", "wasparent", "nowparent")
            if side in changes:
                new["counts"][key] = [*folders, made[list(changes).index(side) - len(changes)]]
        if rule.check == "unique":
            failing = lambda c: F.when(F.col(c) > 1, F.col(c)).otherwise(0)
        else:
            failing = lambda c: F.when(F.coalesce(F.col(f"{c}parent"), F.lit(0)) > 0, 0).otherwise(F.coalesce(F.col(c), F.lit(0)))
        diff = total.agg(F.coalesce(F.sum(failing("now") - failing("was")), F.lit(0)).alias("d")).first().d
        new["failing"][rule.rule_id] = new["failing"].get(rule.rule_id, 0) + diff
        for side in names:
            self._compact(f"{rule.rule_id}/{side}", new, made)
        return new["failing"][rule.rule_id]

    def _compact(self, key: str, new: dict, made: list[str]) -> None:
        """Sums up the counts of a side when it has COMPACT files: one folder a bucket, so a load reads its own."""
        folders = new["counts"].get(key, [])
        loose = [f for f in folders if "/base-" not in f]
        if len(loose) < COMPACT:
            return
        at = f"{self.path}/counts/{key.replace('/', '-').rstrip('-')}/base-{uuid.uuid4().hex}"
        schema = self.spark.read.parquet(loose[0]).schema
        every = self._stored(folders, schema, list(range(self.buckets))).groupBy("k").agg(F.sum("c").alias("d")).filter("d <> 0")
        every.withColumn("bucket", self._bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(at)
        made.append(at)
        new["counts"][key] = [at]
