"""I-Match document fingerprints (native DataFrame operations only).

Terms are lower-cased words, by 64-bit hashes.  Each term's document frequency is counted over all different texts (copies
count once, however many), and the lexicon holds the terms whose inverse document frequency lies within a band: those that
at least ``MIN_DOCS`` texts and a share of ``MIN_SHARE`` of them, and at most a share of ``MAX_SHARE``, hold.  So the lexicon has no more
terms than an average text's different terms divided by ``MIN_SHARE``, whatever the corpus, and may reach the executors as a
scalar subquery: a hash table of nested arrays.  A text of which the lexicon holds less than ``LEAST_KEPT`` of the terms, as
those of a large group of near copies, keeps all its terms.  The kept distinct terms are sorted by hash and hashed once for
every randomised lexicon subset; subsets of several densities are drawn, because a short text shares hardly any term with
a sparse subset and a long text never agrees on a dense one.

A fingerprint is the subset hashes as text, eight hex digits each, or dashes where no term of the text is in the subset; a
text that meets no subset at all has the hash of all its terms at the densest ones, so only a text without a word is blank.
The likeness of two fingerprints is the share of equal hashes, among the subsets that either text meets, at the sparsest
density at which four subsets are met (else the densest).  Equal texts have likeness 1, and so have equal fingerprints that
aren't blank; different texts without a word have likeness 0.

Defined results: a null text counts as empty; equal texts have equal fingerprints; rows are ordered by id (nulls first),
rows of equal id by a hash of their text, and a table of one row is its own next; rows that share one id, or have none, come
to one task; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.llm.shared import documents, release, row_mark, scratch, text_of, written

#: Subsets keep one in 2^s of the lexicon's terms.
SCALES = (2, 4, 6, 8, 10, 12)
SUBSETS = 8
#: Highest and least share of the different texts, and least number of them, that hold a term within the band.
MAX_SHARE, MIN_SHARE, MIN_DOCS = 0.05, 1e-4, 2
#: A text keeps its terms within the band if they are at least this share of its terms, else all.
LEAST_KEPT = 0.25
#: Files of the written lexicon, however many tasks counted its terms: each file that is written to a local folder has
#: processes started by the executor.
FILES = 4
MET = 4
BLANK = "--------"
EMPTY = BLANK * len(SCALES) * SUBSETS


def term_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(text), "[ \\t-\\r]+", -1), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, text_col: str = "text", max_share: float = MAX_SHARE, min_share: float = MIN_SHARE, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h): the terms within the band, counted over all different texts."""
    spark = docs.sparkSession
    n = docs.select(F.xxhash64(text_of(text_col)).alias("_text")).distinct().count()
    texts = docs.select(F.xxhash64(text_of(text_col)).alias("_text"), term_hashes(text_of(text_col)).alias("_terms")).dropDuplicates(["_text"])
    counts = texts.select(F.explode("_terms").alias("h")).groupBy("h").agg(F.count("*").alias("n"))
    low = min(n, max(min_docs, math.ceil(min_share * n)))
    return written(counts.filter(F.col("n").between(low, max(low, int(max_share * n)))).select("h").repartition(FILES), f"{scratch(spark, 'lexicon')}/terms")


def table(terms: DataFrame) -> tuple[Column, int]:
    """The lexicon as an array of arrays, one of the terms of each slot, as a scalar subquery, and the number of slots."""
    spark = terms.sparkSession
    slots = 1 << max(4, (terms.count() // 2).bit_length())
    held = terms.groupBy(F.pmod("h", F.lit(slots)).alias("id")).agg(F.collect_list("h").alias("t"))
    each = spark.range(slots).join(held, "id", "left").select(F.struct("id", F.coalesce("t", F.array().cast("array<bigint>")).alias("t")).alias("s"))
    one = each.agg(F.array_sort(F.collect_list("s")).alias("all")).select(F.transform("all", lambda s: s["t"]).alias("lexicon"))
    return written(one, f"{scratch(spark, 'lexicon')}/table").scalar(), slots


def fingerprint(text: Column, lexicon: Column, slots: int) -> Column:
    # transform over an array of one: its value is computed, or copied out of the row, once for all that use it
    once = lambda x, f: F.get(F.transform(F.array(x), f), F.lit(0))
    banded = lambda ts, all_: F.filter(ts, lambda h: F.array_contains(F.get(all_, F.pmod(h, F.lit(slots)).cast("int")), h))
    enough = lambda ts, kept: F.when(F.size(kept) >= F.size(ts) * F.lit(LEAST_KEPT), kept).otherwise(ts)
    terms = once(lexicon, lambda all_: once(term_hashes(text), lambda ts: once(banded(ts, all_), lambda kept: F.array_sort(enough(ts, kept)))))
    # subset (k, s): a window of s hash bits has a given value, so each is drawn from the one before
    draws = F.array(*(F.struct(F.lit(18 + 4 * k).alias("at"), F.lit((k * 2654435761 + 977) % (1 << SCALES[-1])).cast("long").alias("want")) for k in range(SUBSETS)))
    scales = F.array(*(F.lit((1 << s) - 1).cast("long") for s in SCALES))
    hashed = lambda x: F.when(F.size(x) == 0, F.lit(BLANK)).otherwise(F.right(F.lpad(F.lower(F.hex(F.xxhash64(x))), F.lit(16), F.lit("0")), F.lit(8)))

    def denser(acc: Column, mask: Column, d: Column) -> Column:
        some = F.filter(acc["terms"], lambda h: F.call_function("shiftrightunsigned", h, d["at"]).bitwiseAND(mask) == d["want"].bitwiseAND(mask))
        return F.get(F.transform(F.array(some), lambda x: F.struct(x.alias("terms"), F.concat(acc["out"], hashed(x)).alias("out"))), F.lit(0))

    def of(ts: Column, d: Column) -> Column:
        return F.aggregate(scales, F.struct(ts.alias("terms"), F.lit("").alias("out")), lambda acc, mask: denser(acc, mask, d), lambda acc: acc["out"])

    # where no subset is met, the hash of all terms stands at the densest
    met = lambda ts, out: F.when(out != EMPTY, out).otherwise(F.repeat(F.concat(hashed(ts), F.lit(BLANK * (len(SCALES) - 1))), F.lit(SUBSETS)))
    return once(terms, lambda ts: once(F.array_join(F.transform(draws, lambda d: of(ts, d)), ""), lambda out: met(ts, out)))


def likeness(a: Column, b: Column, same: Column) -> Column:
    """0 to 1, of two fingerprints; same tells whether their texts are equal."""
    n = len(SCALES)
    part = lambda x, i: F.substring(x, i * 8 + 1, F.lit(8))
    state = F.transform(F.sequence(F.lit(0), F.lit(n * SUBSETS - 1)), lambda i: F.when(part(a, i) != part(b, i), 1).when(part(a, i) == BLANK, 0).otherwise(2))

    def at(states: Column, s: Column) -> Column:
        mine = F.filter(states, lambda x, i: i % n == s)
        return F.struct(F.size(F.filter(mine, lambda x: x > 0)).alias("met"), F.size(F.filter(mine, lambda x: x == 2)).alias("same"), s.alias("s"))

    scales = F.get(F.transform(F.array(state), lambda st: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda s: at(st, s))), F.lit(0))
    # the last, sparsest density that is met decides
    share = F.aggregate(scales, F.lit(0.0), lambda acc, x: F.when((x["met"] >= MET) | ((x["s"] == 0) & (x["met"] > 0)), x["same"] / x["met"]).otherwise(acc))
    return F.when(same | ((a == b) & (a != EMPTY)), F.lit(1.0)).otherwise(share)


def cut_at(value: Column, bounds: Column, n: int) -> Column:
    """How many of the n sorted bounds are at most value, by halving."""
    def step(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        below = value < F.get(bounds, mid)
        more = acc["lo"] < acc["hi"]
        return F.struct(F.when(more & ~below, mid + 1).otherwise(acc["lo"]).alias("lo"), F.when(more & below, mid).otherwise(acc["hi"]).alias("hi"))

    steps = F.array(*(F.lit(k) for k in range(n.bit_length() + 1)))
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi")), step, lambda acc: acc["lo"])


def with_next(rows: DataFrame, id_col: str, columns: list[str], derive: Callable[[DataFrame], DataFrame], ranges: int | None = None) -> DataFrame:
    """derive(rows) (with _mark) and _next, a struct of the columns of the row that follows by id; the first follows the last.

    Ids, which are numbers, are dealt into ranges of about equal size by their quantiles, each a window of its own; the first
    row of a range is repeated at the end of the range before it.  There are two ranges a shuffle partition, so what reaches
    the driver depends on the session's setting alone.  Rows move once, before they are derived from.
    """
    spark = rows.sparkSession
    ranges = ranges or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    points = rows.agg(F.percentile_approx(id_col, [k / ranges for k in range(1, ranges)], 10 * ranges)).first()[0] or []
    bounds = spark.createDataFrame([(sorted(set(points)),)], "b array<bigint>").scalar()
    rows = rows.withColumn("_bounds", bounds).withColumn("_range", F.when(F.col(id_col).isNull(), -1).otherwise(cut_at(F.col(id_col), F.col("_bounds"), len(set(points))))).drop("_bounds")
    # nulls come first in Spark's order; min() would pass over them
    key = F.struct(F.col(id_col).isNotNull().alias("some"), F.col(id_col).alias("id"), F.col("_mark").alias("mark"))
    firsts = sorted(rows.groupBy("_range").agg(F.min(key).alias("k")).collect(), key=lambda r: r["_range"])  # one row a range
    before = [(r["_range"], r.k.id, r.k.mark, firsts[i - 1]["_range"]) for i, r in enumerate(firsts)]
    heads = F.broadcast(spark.createDataFrame(before, "_r int, _i long, _m long, _to int"))
    tails = rows.join(heads, (rows["_range"] == F.col("_r")) & rows[id_col].eqNullSafe(F.col("_i")) & (rows["_mark"] == F.col("_m")))
    tails = tails.withColumn("_range", F.col("_to")).drop("_r", "_i", "_m", "_to").dropDuplicates(["_range"]).withColumn("_tail", F.lit(1))
    both = derive(rows.withColumn("_tail", F.lit(0)).unionByName(tails).repartition(ranges, "_range"))
    order = Window.partitionBy("_range").orderBy("_tail", F.col(id_col).asc_nulls_first(), "_mark")
    return both.withColumn("_next", F.lead(F.struct(*columns)).over(order)).filter("_tail = 0").drop("_tail", "_range")


def edited(text: Column, following: Column) -> Column:
    """The last quarter of the code points replaced by as many first ones of the following text."""
    quarter = F.floor(F.char_length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - quarter), F.substring(following, F.lit(1), quarter))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    terms, slots = table(lexicon(docs))
    release(spark)  # what was shuffled to count terms may go, now that nothing refers to it
    rows = docs.select("doc_id", row_mark("doc_id", "text").alias("_mark"), text_of("text").alias("text"))
    marked = lambda df, name, text: df.withColumn("_lexicon", terms).withColumn(name, fingerprint(F.col(text), F.col("_lexicon"), slots)).drop("_lexicon")
    out = with_next(rows, "doc_id", ["text", "fingerprint"], lambda df: marked(df, "fingerprint", "text")).withColumn("_edited", edited(F.col("text"), F.col("_next.text")))
    out = marked(out, "edited_fingerprint", "_edited")
    return out.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), F.col("text") == F.col("_edited")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next.fingerprint"), F.col("text") == F.col("_next.text")).alias("near_next"),
    )


QUERIES = {"op5_fingerprints": op5_fingerprints}
