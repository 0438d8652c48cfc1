"""Mixing sources to target weights by weighted fair queueing.

Every source gets a target number of words: its weight's share of the budget, at most ``epochs`` times what it has, the excess
shared by weight among the others until none is above.  A source's documents stand in a shuffled order (a hash of id and
epoch), epoch after epoch; an entry's virtual finish time is the source's words up to and with it, divided by the target.
Entries are range-sorted by finish time over all sources and cut where their running total meets the budget.  As every source
is served in proportion to its target, all reach theirs at time 1; an entry on its way then gives the words that are missing,
so a source takes its target to within a word however long its documents are.

No source is one task: running sums are formed over range partitions (sums within a partition, then the partitions' offsets,
one row a partition), for the ranks of sources, their limits, the words of each source and the total alike.

Defined results: a null or empty text has size 0 and takes nothing; a null source is a source of its own, the last; a null id
is shuffled like any other; repeated rows are entries of their own; rows that agree in id, source and size are
interchangeable, so results agree from run to run; an empty table, or one without a word, gives targets of 0; other columns
are ignored by ``mix`` and kept by ``mixed_texts``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm.shared import documents, fresh, heavy, row_mark, scratch, split_join, text_of, written

WORD = "[^\\x20\\x09-\\x0D]+"
#: Weights by the sources' order, repeating; times that a document may be used.
WEIGHTS, EPOCHS = (1, 2, 3), 3


def _sums(columns: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the partition's number and, for each column, the sum over the partition's earlier rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, so_far = TaskContext.get().partitionId(), dict.fromkeys(columns, 0)
        for batch in batches:
            new = []
            for c in columns:
                ends = np.cumsum(batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64)) + so_far[c]
                new.append(pa.array(np.concatenate(([so_far[c]], ends[:-1])) if len(ends) else ends, pa.int64()))
                so_far[c] = int(ends[-1]) if len(ends) else so_far[c]
            names = [*batch.schema.names, "_part", *(f"_before_{c}" for c in columns)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), *new], names=names)

    return run


def running(df: DataFrame, order: list[Column], sums: list[str], path: str) -> DataFrame:
    """df in the given order over range partitions, with _before_c for each whole-number column c: its sum over all earlier rows.

    The driver gets one row a partition, as many as the session has shuffle partitions.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), "_part int", *(f"_before_{c} long" for c in sums)])
    parts = written(df.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(_sums(sums), schema), path)
    totals = sorted(parts.groupBy("_part").agg(*(F.sum(c).cast("long").alias(c) for c in sums)).collect())
    offsets, at = [], [0] * len(sums)
    for part, *more in totals:
        offsets.append((part, *at))
        at = [a + m for a, m in zip(at, more, strict=True)]
    known = spark.createDataFrame(offsets, ", ".join(["_p int", *(f"_o_{c} long" for c in sums)]))
    out = parts.join(F.broadcast(known), F.col("_part") == F.col("_p"))
    return out.select(*df.columns, *((F.col(f"_before_{c}") + F.col(f"_o_{c}")).alias(f"_before_{c}") for c in sums))


def targets(sources: DataFrame, budget: int, path: str, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """sources (_source, source_size), one row each, with _rank, weight and target.

    A source is at its limit if the level at which it meets it, limit / weight, doesn't exceed the budget once all sources
    stand at that level or at their own limit.  In the order of that level a running sum tells.
    """
    ranked = running(sources.withColumn("_one", F.lit(1).cast("long")), [F.col("_source").asc_nulls_last()], ["_one"], f"{path}/ranks").drop("_one").withColumnRenamed("_before__one", "_rank")
    weight = F.get(F.array(*map(F.lit, weights)), F.pmod("_rank", F.lit(len(weights))).cast("int")).cast("long")
    leveled = ranked.withColumn("weight", weight).withColumn("_limit", F.col("source_size") * epochs).withColumn("_level", F.col("_limit").cast("double") / F.col("weight"))
    summed = running(leveled, [F.col("_level").asc(), F.col("_rank").asc()], ["_limit", "weight"], f"{path}/levels")
    total = summed.agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("w")).first().w
    full = F.col("_before__limit") + F.col("_level") * (F.lit(total) - F.col("_before_weight")) <= F.lit(budget)
    rest = summed.agg(F.coalesce(F.sum(F.when(full, F.col("_limit"))), F.lit(0)).alias("used"), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("left")).first()
    share = F.lit(budget - rest.used).cast("double") * F.col("weight") / F.lit(max(rest.left, 1)).cast("double")
    return summed.withColumn("target", F.when(full, F.col("_limit").cast("double")).otherwise(share)).select("_source", "source_size", "_rank", "weight", "target")


class Mix:
    """A mix of a table's sources: ``rows`` (a row each, with its source's target), ``entries`` (the mix, in its order)."""

    def __init__(self, docs: DataFrame, budget: int | None = None, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text"):
        self.docs, self.id_col, self.text_col = docs, id_col, text_col
        base = scratch(docs.sparkSession, "mixing")
        size = F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long")
        rows = docs.select(F.col(id_col).alias("_id"), row_mark(id_col, text_col).alias("_mark"), F.col(source_col).cast("string").alias("_source"), size.alias("_size"), F.monotonically_increasing_id().alias("_row"))
        rows = written(rows, f"{base}/rows")
        sources = written(rows.groupBy("_source").agg(F.sum("_size").alias("source_size"), F.count("*").alias("_held")), f"{base}/sources")
        sums = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("words"), F.coalesce(F.sum("_held"), F.lit(0)).alias("rows")).first()
        budget = sums.words if budget is None else budget
        key = F.concat(F.when(F.col("_source").isNull(), "-").otherwise("+"), F.coalesce("_source", F.lit(""))).alias("_key")
        found = targets(sources.select("_source", "source_size"), budget, f"{base}/targets", weights, epochs)
        # whole words of a source, and the words of the sources before it in the order of entries
        want = F.floor("target").cast("long")
        times = F.when(F.col("source_size") > 0, F.floor((want + F.col("source_size") - 1) / F.col("source_size"))).otherwise(0).cast("long")
        found = running(found.withColumn("_want", want).withColumn("_times", times).withColumn("_served", times * F.col("source_size")), [F.col("_rank").asc()], ["_served"], f"{base}/served")
        found = found.select(key, "source_size", "_rank", "weight", "target", "_want", "_times", F.col("_before__served").alias("_start"))
        # a source of one row in a thousand meets a broadcast of such sources, at most a thousand
        hot = sources.filter(F.col("_held") > max(sums.rows // 1000, 1000)).select(key)
        self.rows = written(split_join(rows.withColumn("_key", key), found, ["_key"], hot, "inner").drop("_key"), f"{base}/known")
        entries = self.rows.filter("_times > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_times") - 1)).alias("epoch"))
        entries = entries.withColumn("_turn", F.md5(F.concat_ws("-", F.coalesce(F.col("_id").cast("string"), F.lit("null")), F.col("epoch").cast("string")).cast("binary")))
        order = [F.col(c).asc() for c in ("_rank", "epoch", "_turn", "_id", "_mark", "_row")]
        queued = running(entries, order, ["_size"], f"{base}/queued").withColumn("_ahead", F.col("_before__size") - F.col("_start"))
        queued = queued.withColumn("_take", F.greatest(F.lit(0).cast("long"), F.least(F.col("_size"), F.col("_want") - F.col("_ahead")))).filter("_take > 0")
        queued = queued.withColumn("finish", (F.col("_ahead") + F.col("_take")) / F.col("target"))
        mixed = running(queued.drop("_before__size"), [F.col("finish").asc(), *order], ["_take"], f"{base}/mixed")
        self.entries = mixed.withColumn("taken", F.least(F.col("_take"), F.lit(budget) - F.col("_before__take"))).filter("taken > 0").withColumnRenamed("_before__take", "position")

    def taken(self) -> DataFrame:
        """One row a document: _id, _size, source_size, target, taken (its repeats counted)."""
        sums = self.entries.groupBy(F.col("_row").alias("_r")).agg(F.sum("taken").alias("taken"))
        return self.rows.join(sums, F.col("_row") == F.col("_r"), "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))

    def mixed_texts(self) -> DataFrame:
        """The mixed corpus: every entry's columns of docs, and mix_epoch, mix_finish and mix_position (words before it: the order
        of the mix).  A text that isn't taken whole is its first words, with single blanks between them."""
        mark, name, taken, size, epoch, finish, place = fresh(self.docs, "_mark", "_name", "_taken", "_size", "mix_epoch", "mix_finish", "mix_position")
        named = F.coalesce(F.col(self.id_col).cast("string"), F.lit(""))
        once = self.docs.withColumns({mark: row_mark(self.id_col, self.text_col), name: named}).dropDuplicates([name, mark])
        entries = self.entries.select(F.col("_mark").alias(mark), F.coalesce(F.col("_id").cast("string"), F.lit("")).alias(name), F.col("taken").alias(taken), F.col("_size").alias(size), F.col("epoch").alias(epoch), F.col("finish").alias(finish), F.col("position").alias(place))
        both = split_join(entries, once, [mark, name], heavy(entries, mark, name).select(mark, name), "inner")
        words = F.array_join(F.slice(F.regexp_extract_all(text_of(self.text_col), F.lit(WORD), F.lit(0)), F.lit(1), F.col(taken).cast("int")), " ")
        text = F.when(F.col(taken) < F.col(size), words).otherwise(F.col(self.text_col))
        return both.withColumn(self.text_col, text).select(*self.docs.columns, epoch, finish, place)


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Mix(documents(spark, sf_dir)).taken().select(F.col("_id").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target", "taken")


SQL = {
    "op13_mixing": r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM d GROUP BY source),
w AS (SELECT *, 1 + rk % 3 AS weight, 3 * source_size AS lim, (3 * source_size)::DOUBLE / (1 + rk % 3) AS lev FROM s),
c AS (SELECT *, coalesce(sum(lim) OVER p, 0)::BIGINT AS before_lim, coalesce(sum(weight) OVER p, 0)::BIGINT AS before_w, sum(weight) OVER ()::BIGINT AS all_w, sum(source_size) OVER ()::BIGINT AS budget
      FROM w WINDOW p AS (ORDER BY lev, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, before_lim + lev * (all_w - before_w) <= budget AS at_limit FROM c),
r AS (SELECT coalesce(sum(lim) FILTER (WHERE at_limit), 0)::BIGINT AS used, greatest(coalesce(sum(weight) FILTER (WHERE NOT at_limit), 0), 1)::BIGINT AS open FROM f),
t AS (SELECT source, source_size, CASE WHEN at_limit THEN lim::DOUBLE ELSE (budget - used)::DOUBLE * weight / open::DOUBLE END AS target FROM f, r),
e AS (SELECT d.doc_id, d.size, t.source, floor(target)::BIGINT AS want, x.epoch, md5(d.doc_id || '-' || x.epoch) AS turn
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source, (VALUES (0), (1), (2)) x(epoch)),
a AS (SELECT doc_id, size, want - coalesce(sum(size) OVER (PARTITION BY source ORDER BY epoch, turn, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM e),
g AS (SELECT doc_id, sum(greatest(0, least(size, room)))::BIGINT AS taken FROM a GROUP BY doc_id)
SELECT d.doc_id, d.size, t.source_size, t.target, g.taken FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source JOIN g ON g.doc_id = d.doc_id""",
}
QUERIES = {"op13_mixing": op13_mixing}
