"""Line deduplication by levelled sorted runs (native DataFrame operations only).

Every text is cut into lines once: a table of (row, line number, key hash) is written, from which both the counts and the
hits are read.  A *run* is a bucketed, sorted table of (key hash, number of documents).  Each batch of documents is reduced
to such counts, merge-anti-joined with the keys that the runs already know to be frequent (others have to be counted on),
and added as a run of level 0; two runs of a level are merged into one of the next (a sort-merge join of equal buckets,
without a shuffle).  A line found in ``min_docs`` documents or more loses all its occurrences.

Defined results: a null text is one empty line; keys shorter than ``min_chars`` are never dropped; rows that share an id are
one document when documents are counted, and rows without an id are one document for each text; equal rows get equal
results; input columns named like the results are replaced, all others stay whatever their names; an empty table gives an
empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm.shared import ascii_lower, ascii_trim, documents, fresh, heavy, row_mark, scratch, split_join, text_of, written

RESULT = ("kept_text", "n_lines", "n_dropped")


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1) -> DataFrame:
    """(_id, _mark, _at, key): every line's place and the hash of its key, of keys of at least min_chars code points.

    Lower-casing commutes with the cut into lines, so it's done once a text; a line is trimmed only if it has to be.
    """
    lines = docs.select(F.col(id_col).alias("_id"), row_mark(id_col, text_col).alias("_mark"), F.posexplode(lines_of(ascii_lower(text_of(text_col)))).alias("_at", "_line"))
    lines = lines.select("_id", "_mark", "_at", ascii_trim(F.col("_line")).alias("_line")).filter(F.char_length("_line") >= min_chars)
    return lines.select("_id", "_mark", "_at", F.unhex(F.md5(F.col("_line").cast("binary"))).alias("key"))


class LineRuns:
    """Levelled sorted runs of line hashes with their document counts."""

    def __init__(self, spark: SparkSession, min_docs: int):
        self.spark, self.min_docs = spark, min_docs
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.base, self.n = scratch(spark, "lines"), 0
        self.levels: list[list[DataFrame]] = []

    def _run(self, counts: DataFrame) -> DataFrame:
        """counts (key, docs), already dealt by key into the buckets, as a bucketed and sorted table."""
        name, self.n = f"lexloom_run_{uuid.uuid4().hex}", self.n + 1
        counts.write.format("parquet").bucketBy(self.buckets, "key").sortBy("key").option("path", f"{self.base}/{self.n}").saveAsTable(name)
        run = self.spark.table(name)
        run.schema  # noqa: B018  resolved, so that the files outlive the name
        self.spark.sql(f"DROP TABLE {name}")
        return run

    def add(self, lines: DataFrame) -> None:
        """A batch of keyed lines: its own counts, without keys that are known to be frequent.  A document is in one batch."""
        document = F.when(F.col("_id").isNull(), F.struct(F.lit(None).cast("string").alias("id"), F.col("_mark").alias("mark"))).otherwise(F.struct(F.col("_id").cast("string").alias("id"), F.lit(0).cast("long").alias("mark")))
        counts = lines.select("key", document.alias("d")).distinct().groupBy("key").agg(F.count("*").alias("docs"))
        for run in (r for level in self.levels for r in level):
            counts = counts.join(run.filter(F.col("docs") >= self.min_docs).select("key"), "key", "left_anti")
        new = self._run(counts.repartition(self.buckets, "key"))
        for level in range(len(self.levels) + 1):
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(new)
            if len(self.levels[level]) < 2:
                return
            a, b = self.levels[level]
            self.levels[level], new = [], self._run(self._merged(a, b))

    @staticmethod
    def _merged(a: DataFrame, b: DataFrame) -> DataFrame:
        b = b.select(F.col("key").alias("other"), F.col("docs").alias("more"))
        return a.join(b, a["key"] == b["other"], "full_outer").select(F.coalesce("key", "other").alias("key"), (F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("docs"))

    def counts(self) -> DataFrame:
        """(key, docs) over all batches.  Of a key that was frequent when a batch came, that batch isn't counted."""
        runs = [r for level in self.levels for r in level]
        total = runs[0]
        for r in runs[1:]:
            total = self._merged(total, r)
        return total

    def frequent(self) -> DataFrame:
        """Keys of lines found in min_docs documents or more, over all batches."""
        return self.counts().filter(F.col("docs") >= self.min_docs).select("key")


def drop_lines(docs: DataFrame, lines: DataFrame, frequent: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with kept_text, n_lines and n_dropped: without those of their keyed lines whose key is in frequent.

    Only (row, line number, hash) moves to find the hits, and a line that one in HEAVY lines equals meets a broadcast of such;
    a row's dropped line numbers come back as one array.
    """
    base = docs.drop(*RESULT)
    mark, gone_, mask_, id_, hit = fresh(base, "_mark", "_gone", "_mask", "_id", "_hit")
    base = base.withColumn(mark, row_mark(id_col, text_col))
    hits = split_join(lines, frequent, ["key"], heavy(lines, "key"), "left_semi")
    gone = hits.groupBy(F.col("_id").alias(id_), F.col("_mark").alias(hit)).agg(F.array_sort(F.collect_set("_at")).alias(gone_))
    both = base.join(gone, (base[mark] == gone[hit]) & base[id_col].eqNullSafe(gone[id_]), "left")
    # one byte a line, 1 if it goes: read by position in constant time
    mask = F.concat_ws("", F.transform(gone_, lambda p, i: F.concat(F.repeat(F.lit("0"), p - F.when(i == 0, F.lit(0)).otherwise(F.get(gone_, i - 1) + 1)), F.lit("1"))))
    lines_col = lines_of(text_of(text_col))
    out = both.withColumn(mask_, mask.cast("binary"))
    kept = F.filter(lines_col, lambda _, i: F.coalesce(F.substring(F.col(mask_), i + 1, F.lit(1)) != F.lit(b"1"), F.lit(True)))
    whole = F.col(gone_).isNull()
    result = [F.when(whole, text_of(text_col)).otherwise(F.array_join(kept, "\n")), F.size(lines_col).cast("long"), F.when(whole, 0).otherwise(F.size(gone_)).cast("long")]
    return out.select(*(out[c] for c in base.columns if c != mark), *(c.alias(n) for c, n in zip(result, RESULT, strict=True)))


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Line deduplication of a whole table, fed to the runs in batches as it would arrive.  Texts are cut into lines once."""
    base = scratch(docs.sparkSession, "keyed")
    lines = written(keyed(docs, id_col, text_col, min_chars), f"{base}/lines")
    runs = LineRuns(docs.sparkSession, min_docs)
    part = F.pmod(F.xxhash64("_id", F.when(F.col("_id").isNull(), F.col("_mark"))), F.lit(batches))
    for k in range(batches):
        runs.add(lines.filter(part == k))
    return drop_lines(docs, lines, written(runs.frequent(), f"{base}/frequent"), id_col, text_col)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


SQL = {
    "op1_line_dedup": r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
x AS (SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS l FROM d),
k AS (SELECT doc_id, i, l, translate(regexp_replace(regexp_replace(l, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
}
QUERIES = {"op1_line_dedup": op1_line_dedup}
