"""Exact nearest vectors by cosine, with cells skipped by the triangle inequality.

Unit vectors are dealt to the nearest of a bounded number of pivots (fitted to a bounded sample) and stored by cell in the order of
their angle to the pivot, in blocks of at most ROWS.  The angle between two directions obeys the triangle inequality, so
a block whose angles to its pivot run from low to high holds nothing nearer to a question than its own angle to the pivot allows.

A batch of questions is searched in rounds.  The first opens each question's nearest cells, as few as hold n vectors; the n-th best found is a
floor, and the next round opens only cells that can reach it, reads the nearest blocks first, and raises the floor as it goes.
Cells that no question needs are not read, as they are folders.  Zero vectors, and vectors of a length that is rare, are in a
cell without a bound.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lexloom.scratch import folder, written

#: Vectors of a block, pivots at most, vectors that they are fitted to, vector lengths that get pivots.
ROWS, PIVOTS, SAMPLE, LENGTHS = 1024, 256, 8192, 16
#: Questions of a batch.
BLOCK = 4096
#: Cosines are rounded to 9 places; angles carry the error of an arc cosine.
MARGIN, SLACK = 2e-9, 1e-6


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; zero rows stay."""
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(n == 0, 1, n)


def directions(x: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """k unit pivots for unit rows (spherical k-means from spread rows)."""
    out = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(rounds):
        near = np.argmax(x @ out.T, axis=1)
        for c in range(k):
            if (near == c).any():
                out[c] = x[near == c].sum(axis=0)
        out = unit(out)
    return out


def angles(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ pivots.T, -1, 1))


def _dealt(pivots: dict[int, np.ndarray]):
    """(id, vector) -> (dim, cell, angle, id, x)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column(1)])
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                x = unit(np.array(batch.column(1).take(pa.array(at)).to_pylist(), np.float64).reshape(len(at), dim))
                cell, angle = np.full(len(at), -1), np.zeros(len(at))
                if dim in pivots:
                    far, some = angles(x, pivots[dim]), np.flatnonzero(x.any(axis=1))
                    near = np.argmin(far, axis=1)
                    cell[some], angle[some] = near[some], far[np.arange(len(at)), near][some]
                raw, step = x.tobytes(), 8 * dim
                yield pa.RecordBatch.from_arrays([pa.array([dim] * len(at), pa.int32()), pa.array(cell, pa.int32()), pa.array(angle), batch.column(0).take(pa.array(at)), pa.array([raw[k * step : (k + 1) * step] for k in range(len(at))], pa.binary())], names=["dim", "cell", "angle", "id", "x"])

    return run


def _blocks(rows: int):
    """Sorted rows -> blocks of one cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, cells, angle = (batch.column(k).to_numpy() for k in range(3))
            edges = [0, *(np.flatnonzero((dims[1:] != dims[:-1]) | (cells[1:] != cells[:-1])) + 1).tolist(), len(dims)]
            for a, b in zip(edges, edges[1:], strict=False):
                for i in range(a, b, rows):
                    j = min(b, i + rows)
                    names = pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), batch.column(3).slice(i, j - i))
                    yield pa.RecordBatch.from_arrays([pa.array([dims[i]]), pa.array([cells[i]]), pa.array([angle[i]]), pa.array([angle[j - 1]]), pa.array([j - i], pa.int32()), names, pa.array([b"".join(batch.column(4).slice(i, j - i).to_pylist())], pa.binary())], names=["dim", "cell", "low", "high", "n", "ids", "x"])

    return run


class Cells:
    """Unit vectors in cells below a folder."""

    def __init__(self, spark: SparkSession, path: str, id_col: str):
        self.spark, self.path, self.id_col = spark, path, id_col
        #: Pairs of a question and a vector that the last search could have compared, and that it opened cells for.
        self.last = (0, 0)

    @classmethod
    def build(cls, vectors: DataFrame, path: str, id_col: str, vector_col: str, rows: int = ROWS) -> Cells:
        out, spark = cls(vectors.sparkSession, path, id_col), vectors.sparkSession
        kind = vectors.schema[id_col].dataType.simpleString()
        own = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter("v is not null")
        pivots: dict[int, np.ndarray] = {}
        for dim, n in own.groupBy(F.size("v")).count().orderBy(F.desc("count")).limit(LENGTHS).collect():
            k = min(PIVOTS, n // rows)
            if k > 1 and dim:
                some = np.array(own.filter(F.size("v") == dim).select("v").sample(fraction=min(1.0, 2 * SAMPLE / n), seed=1).limit(SAMPLE).toArrow().column(0).to_pylist(), np.float64)
                some = unit(some[some.any(axis=1)]) if len(some) else some
                if len(some) > k:
                    pivots[dim] = directions(some, k)
        rows_of = own.mapInArrow(_dealt(pivots), f"dim int, cell int, angle double, id {kind}, x binary")
        blocks = rows_of.repartitionByRange("dim", "cell", "angle", "id").sortWithinPartitions("dim", "cell", "angle", "id").mapInArrow(_blocks(rows), f"dim int, cell int, low double, high double, n int, ids array<{kind}>, x binary")
        blocks.write.mode("overwrite").partitionBy("dim", "cell").parquet(f"{path}/blocks")
        vectors.select(id_col).limit(0).write.mode("overwrite").parquet(f"{path}/kind")  # the type of ids
        spark.createDataFrame([(d, p.tobytes()) for d, p in pivots.items()], "dim int, x binary").coalesce(1).write.mode("overwrite").parquet(f"{path}/pivots")
        return out

    def _stored(self) -> DataFrame:
        kind = self.spark.read.parquet(f"{self.path}/kind").schema[self.id_col].dataType.simpleString()
        return self.spark.read.schema(f"low double, high double, n int, ids array<{kind}>, x binary, dim int, cell int").parquet(f"{self.path}/blocks")

    def top(self, asked: DataFrame, question_id: str, asked_col: str, n: int) -> DataFrame:
        """(question_id, id, vec, rank) of the n highest cosines (rounded to 9 places) of each question, ties by id."""
        q = asked.select(F.col(question_id).alias("_q"), F.col(asked_col).cast("array<double>").alias("_v")).filter("_v is not null")
        batches = max(1, -(-q.count() // BLOCK))
        self.last, total = (0, 0), None
        for k in range(batches):
            part = q if batches == 1 else q.filter(F.pmod(F.xxhash64("_q"), F.lit(batches)) == k)
            one = self._batch(part.collect(), q.schema["_q"].dataType, n)  # about BLOCK rows at most
            total = one if total is None else total.unionByName(one)
        return total.withColumnsRenamed({"_q": question_id, "_id": self.id_col})

    def _batch(self, rows: list, kind, n: int) -> DataFrame:
        stored, spark = self._stored(), self.spark
        pivots = {r.dim: np.frombuffer(r.x).reshape(-1, r.dim) for r in spark.read.schema("dim int, x binary").parquet(f"{self.path}/pivots").collect()}
        heads = stored.groupBy("dim", "cell").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).collect()  # a row a cell
        questions: dict[int, tuple[list, np.ndarray]] = {}
        for dim in {len(r[1]) for r in rows}:
            own = [r for r in rows if len(r[1]) == dim]
            questions[dim] = [r[0] for r in own], unit(np.array([r[1] for r in own], np.float64).reshape(len(own), dim))
        far = {d: angles(m, pivots[d]) if d in pivots else np.zeros((len(m), 0)) for d, (_, m) in questions.items()}
        cells = {d: [h for h in heads if h.dim == d] for d in questions}
        gap = {d: np.array([np.zeros(len(m)) if h.cell < 0 or not len(far[d]) else np.maximum(0, np.maximum(h.low - far[d][:, h.cell], far[d][:, h.cell] - h.high)) for h in cells[d]]).reshape(len(cells[d]), len(m)).T for d, (_, m) in questions.items()}
        id_kind = stored.schema["ids"].dataType.elementType
        kinds = f"_q {kind.simpleString()}, _id {id_kind.simpleString()}, vec double"
        floor = {d: np.full(len(m), -2.0) for d, (_, m) in questions.items()}
        opened = {d: np.zeros_like(g, bool) for d, g in gap.items()}
        base, found = folder(spark, "vectors"), spark.createDataFrame([], kinds)
        possible = sum(len(m) * sum(h.n for h in cells[d]) for d, (_, m) in questions.items())
        touched = 0
        for t in range(2):
            now = {}
            for d, g in gap.items():
                if not t:  # each question's nearest cells, until they hold n vectors
                    order = np.argsort(g, axis=1, kind="stable")
                    held = np.array([h.n for h in cells[d]], np.int64)[order] if len(cells[d]) else np.zeros(g.shape, np.int64)
                    now[d] = np.zeros_like(g, bool)
                    np.put_along_axis(now[d], order, np.cumsum(held, axis=1) - held < n, axis=1)
                else:
                    reach = np.where(np.array([h.cell < 0 for h in cells[d]], bool)[None, :], 1.0, np.cos(np.maximum(0, g - SLACK)))
                    now[d] = (reach >= floor[d][:, None] - MARGIN) & ~opened[d]
                opened[d] |= now[d]
            touched += sum(int(x[:, j].sum()) * cells[d][j].n for d, x in now.items() for j in range(x.shape[1]))
            needed = [(d, cells[d][j].cell) for d, x in now.items() for j in range(x.shape[1]) if x[:, j].any()]
            if not needed:
                continue
            sent = spark.sparkContext.broadcast((questions, far, floor, {(d, cells[d][j].cell): np.flatnonzero(x[:, j]) for d, x in now.items() for j in range(x.shape[1])}))
            by_dim = {d: [c for e, c in needed if e == d] for d, _ in needed}
            which = None
            for d, cs in by_dim.items():
                one = (F.col("dim") == d) & F.col("cell").isin(*cs)
                which = one if which is None else which | one
            got = stored.filter(which).select("dim", "cell", "low", "high", "ids", "x").mapInArrow(_near(sent, n, to_arrow_type(kind)), kinds)
            found = written(_best(got.unionByName(found), n).drop("rank"), f"{base}/{t}")
            if not t:
                worst = dict(_best(found, n).filter(F.col("rank") == n).select("_q", "vec").collect())  # a row a question at most
                floor = {d: np.array([worst.get(name, -2.0) for name in names]) for d, (names, _) in questions.items()}
        self.last = (self.last[0] + possible, self.last[1] + touched)
        return _best(found, n)


def _best(scores: DataFrame, n: int) -> DataFrame:
    return scores.withColumn("rank", F.row_number().over(Window.partitionBy("_q").orderBy(F.desc("vec"), "_id"))).filter(F.col("rank") <= n)


def _near(sent, n: int, kind: pa.DataType):
    """Blocks -> the best of each question that opens their cell: (_q, _id, vec)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        questions, far, floors, asking = sent.value
        floor = {d: f.copy() for d, f in floors.items()}
        best = {d: np.full((len(f), n), -2.0) for d, f in floors.items()}
        for batch in batches:
            for k in range(batch.num_rows):
                dim, cell, low, high = (batch.column(c)[k].as_py() for c in range(4))
                names, m = questions[dim]
                at = asking[dim, cell]
                if cell >= 0 and far[dim].shape[1]:
                    gap = np.maximum(0, np.maximum(low - far[dim][at, cell], far[dim][at, cell] - high) - SLACK)
                    at = at[np.cos(np.minimum(gap, math.pi)) >= floor[dim][at] - MARGIN]
                if not len(at):
                    continue
                key = batch.column(4)[k].values
                x = np.frombuffer(batch.column(5)[k].as_buffer(), np.float64).reshape(len(key), dim) if dim else np.zeros((len(key), 0))
                cosine = np.round(m[at] @ x.T, 9) + 0.0
                order = np.argsort(np.array(key.to_pylist(), object), kind="stable")
                ranked = order[np.argsort(-cosine[:, order], axis=1, kind="stable")[:, :n]]
                values = np.take_along_axis(cosine, ranked, axis=1)
                best[dim][at] = -np.sort(-np.concatenate((best[dim][at], values), axis=1), axis=1)[:, :n]
                i, j = np.nonzero(values >= floor[dim][at][:, None] - MARGIN)
                floor[dim][at] = np.maximum(floor[dim][at], best[dim][at][:, -1])
                yield pa.RecordBatch.from_arrays([pa.array([names[at[p]] for p in i.tolist()], kind), key.take(pa.array(ranked[i, j])), pa.array(values[i, j])], names=["_q", "_id", "vec"])

    return run
