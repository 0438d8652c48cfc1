"""Keyword top-n by BM25 with exact early termination.

Documents of about one length (within a tenth) are dealt into ranges of at most about RANGE documents by a hash of their ids.  A
word's postings are stored in blocks, one for each range that holds it, with the highest part that any posting of the block adds to
a score: documents of one length have parts close to it.  Each file of blocks is sorted by word, so a batch of questions reads little
but those of its words, and they meet by range, so a frequent word is many rows of many tasks.  An index moves its texts' words
once, as lists, to the tasks that count them, and nothing after that.

A batch of questions is sent to the tasks with their words' weights.  Each question's floor, a lower bound of its n-th best score, comes from the
ranges that promise most.  Then every range is gone through: a question whose words' highest parts together stay below its floor
skips it; otherwise its words are added from the one that may add most, and documents that can't reach the floor
any more drop out.  The floor rises as a task goes on.  Results equal scoring every posting.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lexloom.functions import ids
from lexloom.scratch import delete, folder, written

#: Documents of a range, and words of all of them together, at most; ranges that a question's floor is found in.
RANGE, WORDS, FIRST = 128, 1 << 18, 2
#: Distinct words that a filter on stored rows lists; words of questions that one batch sends to the tasks.
LISTED, SENT = 10_000, 1 << 17
#: Scores are compared with a margin for the order of sums, as they are rounded to 9 places.
MARGIN = 1e-8


def tokens(docs: DataFrame, text_col: str, *keep: str) -> DataFrame:
    """(keep..., word): one row a word; texts without words give no row."""
    each = docs.select(*keep, F.regexp_extract_all(F.lower(ids.text(F.col(text_col))), F.lit("[a-z0-9]+"), F.lit(0)).alias("_w"))
    return each.select(*keep, F.explode("_w").alias("word")).filter(~F.col("word").isin(*ids.STOP))


def term_frequencies(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return tokens(docs, text_col, id_col).groupBy(id_col, "word").agg(F.count("*").alias("tf"))


def _cut(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """values between edges, each stretch as bytes, and a null behind them."""
    ends = np.append(edges * values.itemsize, edges[-1] * values.itemsize).astype("<i4")
    bits = np.packbits(np.append(np.ones(len(edges) - 1, bool), False), bitorder="little")
    return pa.Array.from_buffers(pa.binary(), len(edges), [pa.py_buffer(bits.tobytes()), pa.py_buffer(ends.tobytes()), pa.py_buffer(values.tobytes())])


def _blocks(kind: pa.DataType, mean: float):
    """A range's texts (range, id, words, length), one an id -> its blocks, and a row with its ids, whose order numbers its documents."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        names = pa.array(table.column("id").combine_chunks(), kind)
        names = names.take(pc.sort_indices(names))
        slot, lists = pc.index_in(table.column("id").combine_chunks(), value_set=names).to_numpy(), table.column("words").combine_chunks()
        words = lists.flatten().dictionary_encode()
        length = np.zeros(len(names))
        length[slot] = table.column("length").to_numpy()
        each, tf = np.unique(words.indices.to_numpy().astype(np.int64) * len(names) + slot[pc.list_parent_indices(lists).to_numpy()], return_counts=True)
        codes, slots = each // len(names), (each % len(names)).astype("<i4")
        parts = ids.bm25(1.0, tf, length[slots], mean)
        starts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        edges = np.append(starts, len(codes))
        columns = {
            "word": pa.concat_arrays([words.dictionary.take(pa.array(codes[starts])), pa.nulls(1, words.dictionary.type)]), "range": pa.array(np.full(len(starts) + 1, key[0].as_py())), "top": pa.array(np.append(np.maximum.reduceat(parts, starts), 0.0)),
            "n": pa.array(np.append(np.diff(edges), len(names)).astype(np.int32)), "slots": _cut(slots, edges), "parts": _cut(parts, edges), "ids": pa.array([None] * len(starts) + [names.to_pylist()], pa.list_(kind)),
        }
        return pa.table(columns)

    return run


def _stretches(column: pa.Array, kind: str) -> list[np.ndarray]:
    """Each row's bytes as numbers, views of the column's one buffer."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], "<i8")[column.offset : column.offset + len(column) + 1]
    first, size = int(ends[0]), np.dtype(kind).itemsize
    values = np.frombuffer(column.buffers()[2], kind, (int(ends[-1]) - first) // size, first) if ends[-1] > first else np.zeros(0, kind)
    edges = ((ends - first) // size).tolist()
    return [values[i:j] for i, j in zip(edges, edges[1:], strict=False)]


def _scored(sent, n: int | None, kind: pa.DataType):
    """Blocks in the order of ranges -> (_q, range, slot, kw): the n best of each question in each range, as far as its floor
    admits them (None: all), and a row without a question that has the number of postings added."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, words, floors, only = sent.value
        floor, best, added = floors.copy(), np.full((len(names), n or 1), -np.inf), 0
        code, asking, idf = {w: k for k, w in enumerate(words)}, [qs for qs, _ in words.values()], np.array([x for _, x in words.values()])
        asked, labels = np.array([len(qs) for qs in asking], np.int64), pa.array(names, kind)

        def flush(number: int, rows: list) -> pa.RecordBatch | None:
            nonlocal added
            codes, tops, slots, parts = zip(*rows, strict=True)
            codes = np.array(codes)
            value, who = idf[codes] * np.array(tops), np.concatenate([asking[c] for c in codes.tolist()])  # a pair of a question and a row each
            row = np.repeat(np.arange(len(rows)), asked[codes])
            bound = np.bincount(who, value[row], len(names))
            open_ = bound >= np.maximum(floor, 1e-300)
            if only is not None:
                mine = np.zeros(len(names), bool)
                mine[only.get(number, [])] = True
                open_ &= mine
            if not open_.any():
                return None
            who, row = who[open_[who]], row[open_[who]]
            order = np.lexsort((-value[row], who))
            who, row = who[order], row[order]
            edges = np.append(np.flatnonzero(np.append(True, who[1:] != who[:-1])), len(who)).tolist()
            size = max(int(x[-1]) for x in slots) + 1
            out = []
            for i, j in zip(edges, edges[1:], strict=False):
                q, own = int(who[i]), row[i:j]
                weights = idf[codes[own]]
                left = np.subtract.accumulate(np.append(bound[q], value[own]))[1:]
                whole = int(np.count_nonzero(left >= floor[q]))  # up to here no document can drop out: their postings are added at once
                score, alive = np.zeros(size), None
                if whole:
                    some = own[:whole].tolist()
                    at = [slots[r] for r in some]
                    score = np.bincount(np.concatenate(at), np.repeat(weights[:whole], list(map(len, at))) * np.concatenate([parts[r] for r in some]), size)
                    added += sum(map(len, at))
                for k in range(whole, len(own)):
                    at, part = slots[own[k]], parts[own[k]]
                    if alive is not None:
                        keep = alive[at]
                        at, part = at[keep], part[keep]
                    score[at] += weights[k] * part
                    added += len(at)
                    alive = score + left[k] >= floor[q]
                    if not alive.any():
                        break
                at = np.flatnonzero((score > 0) if alive is None else alive & (score > 0))
                if not len(at):
                    continue
                kw = np.round(score[at], 9)
                if n is not None:
                    order = np.argsort(-kw, kind="stable")[:n]  # ties by id, as slots are
                    at, kw = at[order], kw[order]
                    best[q] = -np.sort(-np.concatenate((best[q], kw)))[:n]
                    floor[q] = max(floor[q], best[q][-1] - MARGIN)
                out.append((q, at, kw))
            if not out:
                return None
            counts = [len(at) for _, at, _ in out]
            return pa.RecordBatch.from_arrays([labels.take(pa.array(np.repeat([q for q, _, _ in out], counts))), pa.array(np.full(sum(counts), number, np.int64)), pa.array(np.concatenate([at for _, at, _ in out]).astype(np.int32)), pa.array(np.concatenate([kw for _, _, kw in out]))], names=["_q", "range", "slot", "kw"])

        last, held = None, []
        for batch in batches:
            spelled = batch.column(0).dictionary_encode()
            codes = np.array([code[w] for w in spelled.dictionary.to_pylist()], np.int64)[spelled.indices.to_numpy()]
            for c, number, *rest in zip(codes.tolist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), _stretches(batch.column(3), "<i4"), _stretches(batch.column(4), "<f8"), strict=True):
                if number != last:
                    if held and (found := flush(last, held)) is not None:
                        yield found
                    last, held = number, []
                held.append((c, *rest))
        if held and (found := flush(last, held)) is not None:
            yield found
        yield pa.RecordBatch.from_arrays([pa.array([None], kind), pa.array([-1], pa.int64()), pa.array([-1], pa.int32()), pa.array([float(added)])], names=["_q", "range", "slot", "kw"])

    return run


class Postings:
    """Blocks of postings (and the ids of each range), words with their document frequencies, and totals below a folder."""

    def __init__(self, spark: SparkSession, path: str, id_col: str):
        self.spark, self.path, self.id_col = spark, path, id_col
        #: Postings that the last search added to scores.
        self.added = 0

    @classmethod
    def build(cls, corpus: DataFrame, path: str, id_col: str, text_col: str) -> Postings:
        """Statistics are those of the whole corpus; texts without words count in them."""
        out, flat = cls(corpus.sparkSession, path, id_col), f"{path}/flat"
        kind, words = corpus.schema[id_col].dataType, ids.words(F.col(text_col))
        texts = written(corpus.select(F.col(id_col).alias("id"), words.alias("words")).withColumn("length", F.size("words").cast("long")), flat)
        lengths = texts.groupBy("id").agg(F.sum("length").alias("length"), F.count("*").alias("rows"))
        seen = lengths.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("total"), F.max("rows").alias("most")).first()
        mean = seen.total / max(1, seen.n)
        out.spark.range(1).select(F.lit(seen.n).cast("long").alias("n"), F.lit(mean).cast("double").alias("mean_length")).coalesce(1).write.mode("overwrite").parquet(f"{path}/totals")
        if (seen.most or 0) > 1:  # rows of one id are one document
            texts = texts.groupBy("id").agg(F.flatten(F.collect_list("words")).alias("words"), F.sum("length").alias("length"))
        size = F.floor(F.log("length") / math.log(1.1)).cast("long")  # some hundred of them
        sizes = lengths.filter("length > 0").groupBy(size.alias("size"))
        sizes = sizes.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / RANGE), F.ceil(F.sum("length") / WORDS)).cast("long").alias("ranges"))
        placed = texts.filter("length > 0").withColumn("size", size).join(F.broadcast(sizes), "size")
        rows = placed.select((F.col("size") * (1 << 40) + F.pmod(F.xxhash64("id"), F.col("ranges"))).alias("range"), "id", "words", "length")
        stored = rows.groupBy("range").applyInArrow(_blocks(to_arrow_type(kind), mean), f"word string, range long, top double, n int, slots binary, parts binary, ids array<{kind.simpleString()}>")
        stored.sortWithinPartitions("word", "range").write.mode("overwrite").parquet(f"{path}/blocks")
        words = out.blocks.groupBy("word").agg(F.sum("n").alias("df"))
        words.repartitionByRange("word").sortWithinPartitions("word").write.mode("overwrite").parquet(f"{path}/words")
        delete(out.spark, flat)
        return out

    @property
    def blocks(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/blocks").filter("word is not null").drop("ids")

    @property
    def ids(self) -> DataFrame:
        """(range, ids) of each range."""
        return self.spark.read.parquet(f"{self.path}/blocks").filter("word is null").select("range", "ids")

    @property
    def words(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/words")

    @property
    def totals(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/totals")

    def asked(self, questions: DataFrame, question_id: str, question_col: str) -> DataFrame:
        """(_q, word, df): each question's different words that the corpus has."""
        own = tokens(questions, question_col, question_id).distinct().withColumnRenamed(question_id, "_q")
        words = [r[0] for r in own.select("word").distinct().limit(LISTED + 1).collect()]
        mine = self.words.filter(F.col("word").isin(*words)) if len(words) <= LISTED else self.words
        return mine.join(own, "word").select("_q", "word", "df")

    def scores(self, questions: DataFrame, question_id: str, question_col: str) -> DataFrame:
        """(question_id, id, kw) of every document that shares a word with a question: all postings of its words."""
        return self._found(questions, question_id, question_col, None)

    def top(self, questions: DataFrame, question_id: str, question_col: str, n: int) -> DataFrame:
        """(question_id, id, kw, rank): the n best of each question, ties by id."""
        found = self._found(questions, question_id, question_col, n)
        return found.withColumn("rank", F.row_number().over(Window.partitionBy(question_id).orderBy(F.desc("kw"), self.id_col))).filter(F.col("rank") <= n)

    def _found(self, questions: DataFrame, question_id: str, question_col: str, n: int | None) -> DataFrame:
        base = folder(self.spark, "keywords")
        asked, total = written(self.asked(questions, question_id, question_col), f"{base}/asked"), None
        batches, self.added = max(1, -(-asked.count() // SENT)), 0
        for k in range(batches):
            own = asked if batches == 1 else asked.filter(F.pmod(F.xxhash64("_q"), F.lit(batches)) == k)
            one = self._batch(own, n, f"{base}/{k}")
            total = one if total is None else total.unionByName(one)
        out = total.join(self.ids, "range").select(F.col("_q").alias(question_id), F.get("ids", F.col("slot")).alias(self.id_col), "kw")
        return out

    def _batch(self, asked: DataFrame, n: int | None, base: str) -> DataFrame:
        """(_q, range, slot, kw) of one batch: about SENT words of questions."""
        spark, kind = self.spark, asked.schema["_q"].dataType
        rows, count = asked.collect(), self.totals.first().n
        names = list(dict.fromkeys(r[0] for r in rows))
        number, words = {q: k for k, q in enumerate(names)}, {}
        for r in rows:
            words.setdefault(r.word, (r.df, []))[1].append(number[r[0]])
        words = {w: (np.array(qs), math.log(1 + (count - df + 0.5) / (df + 0.5))) for w, (df, qs) in words.items()}
        mine = self.blocks.filter(F.col("word").isin(*words)) if len(words) <= LISTED else self.blocks.join(F.broadcast(asked.select("word").distinct()), "word", "left_semi")
        columns = ("word", "range", "top", "slots", "parts")
        schema = f"_q {kind.simpleString()}, range long, slot int, kw double"
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

        def scored(blocks: DataFrame, floors: np.ndarray, only: dict | None, name: str) -> DataFrame:
            sent = spark.sparkContext.broadcast((names, words, floors, only))
            dealt = blocks.select(*columns).repartition(parts, "range").sortWithinPartitions("range")
            out = written(dealt.mapInArrow(_scored(sent, n, to_arrow_type(kind)), schema), f"{base}/{name}")
            self.added += int(out.filter("_q is null and range = -1").agg(F.coalesce(F.sum("kw"), F.lit(0.0))).first()[0])
            return out.filter("range <> -1")

        floors = np.zeros(len(names))
        if n is not None and names:
            weights = F.broadcast(spark.createDataFrame([(w, x, q) for w, (qs, x) in words.items() for q in qs.tolist()], "word string, idf double, q int"))
            heads = mine.select("word", "range", "top").join(weights, "word").groupBy("q", "range").agg(F.sum(F.col("idf") * F.col("top")).alias("bound"))
            first = heads.withColumn("_r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("bound"), "range"))).filter(F.col("_r") <= FIRST).select("q", "range").collect()
            only: dict[int, list[int]] = {}
            for q, r in first:
                only.setdefault(r, []).append(q)
            some = scored(mine.join(F.broadcast(spark.createDataFrame([(r,) for r in only], "range long")), "range", "left_semi"), floors, only, "first")
            worst = some.withColumn("_r", F.row_number().over(Window.partitionBy("_q").orderBy(F.desc("kw")))).filter(F.col("_r") == n).select("_q", "kw")
            for q, kw in worst.collect():
                floors[number[q]] = kw - MARGIN
        return scored(mine, floors, None, "all")
