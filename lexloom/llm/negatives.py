"""Hard negatives by one-dimensional distance keys.

Vectors become whole numbers and get one more coordinate that makes all as long as the longest, so that a higher inner product
with an anchor is a smaller distance to it.  Every vector's key is its nearest pivot and its distance to that pivot; vectors are
stored sorted by key, in blocks of one pivot and an interval of distances, each sorted by id.  By the triangle inequality a row at
distance r from an anchor has a key within r of the anchor's own distance to that pivot.  So an anchor's search begins with the
intervals that it lies in and goes on to annuli of keys on both sides of them, further out each round, until what is left is
too far to be among its best: no row is then missing, whatever the pivots are.  Pivots are fitted to a bounded sample.

Two searches follow each other: the nearest rows of the anchor's label give the positives, and for every positive the nearest of
other labels within its band of scores give the negatives.  An anchor's positives share one scan.  Blocks travel by segments,
anchors by groups, and a segment meets a group only if some key of the one is within reach of the other.  A task holds
one segment while groups pass by; what it finds is at most k rows for each anchor and positive.

Where distances to pivots tell little (vectors without structure), bounds exclude few blocks, and the search compares the
anchors, in blocks, with all rows: that is the price of a whole result.

Defined results: rows with a null label or vector, or with a null or non-finite component, take no part; rows without an id do,
and stand behind all others of their score; repeated rows are rows of their own, and only the anchor's own row is not its
positive; repeated anchors get their rows each; vectors of another length than the anchor's are none of its candidates; whole
numbers beyond the square root of 2^56 / length are cut to that, so that scores fit 64 bits; ids and labels are whole numbers;
a positive with a score below zero has an empty band; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.llm.shared import lean, scratch, written

#: Pivots of a vector length, at most; rows that they are fitted to; vector lengths that get fitted pivots.
PIVOTS, SAMPLE, LENGTHS = 64, 4096, 16
#: Rows of a block, blocks of a segment, anchors of a group, groups that a task meets.
BLOCK, SEGMENT, GROUP, TURNS = 1024, 32, 256, 64
#: How far the rounds go, in parts of the distance that proves a result whole; the last is all of it.
REACHES = (0.0, 0.25, 1.0)
FAR = 1 << 60
BLOCKS = "segment long, block long, dim int, pivot int, low double, high double, n int, ids binary, none binary, labels binary, anchors binary, x binary"
DEALT = "dim int, pivot int, low double, high double, at long, ids binary, none binary, labels binary, x binary, uids binary, keys binary, lows binary, highs binary, taus binary, done binary, reach binary"


def whole(v: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * v) as 64-bit integers whose inner products fit."""
    limit = math.isqrt((1 << 56) // max(1, v.shape[1]))
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * v), -limit, limit).astype(np.int64)


def by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places in the column, vectors)."""
    lengths = np.array([len(v) for v in column])
    for dim in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == dim)
        yield dim, at, np.array(column.take(pa.array(at)).to_pylist(), np.float64).reshape(len(at), dim)


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of integers, by floating point where that is exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, a.shape[1])
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    return (a.astype(kind) @ x.astype(kind).T).astype(np.int64)


def _sizes(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, v in by_length(batch.column(0)):
                x = whole(v, scale)
                yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([len(at)], pa.int64()), pa.array([int(np.abs(x).max(initial=0))], pa.int64()), pa.array([int((x * x).sum(axis=1).max(initial=0))], pa.int64())], names=["dim", "n", "most", "norm"])

    return run


def lifted(x: np.ndarray, longest: int) -> np.ndarray:
    """Rows with the coordinate that makes them as long as the longest."""
    return np.hstack((x, np.sqrt(np.maximum(0.0, longest - (x * x).sum(axis=1)))[:, None])).astype(np.float64)


def fitted(x: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """k centres of the rows of x (k-means from spread rows)."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(rounds):
        near = np.argmin((centres * centres).sum(axis=1) - 2 * x @ centres.T, axis=1)
        for c in range(k):
            if (near == c).any():
                centres[c] = x[near == c].mean(axis=0)
    return centres


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * x @ pivots.T))


class Space:
    """What workers need to know of the whole table: the scale, the longest vector, the width of components and the pivots."""

    def __init__(self, scale: float, longest: int, kind: str, pivots: dict[int, np.ndarray], block: int, segment: int, group: int):
        self.scale, self.longest, self.kind, self.fitted = scale, longest, kind, pivots
        self.block, self.segment, self.group = block, segment, group
        self.slack = 1e-6 * math.sqrt(longest) + 1e-9

    def pivots(self, dim: int) -> np.ndarray:
        return self.fitted[dim] if dim in self.fitted else np.zeros((1, dim + 1))


def _keyed(space: Space):
    """(id, label, anchor, v) -> (dim, pivot, distance, id, label, anchor, x)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, v in by_length(batch.column(3)):
                x = whole(v, space.scale)
                d = distances(lifted(x, space.longest), space.pivots(dim))
                pivot = np.argmin(d, axis=1)
                raw, step = x.astype(space.kind).tobytes(), dim * np.dtype(space.kind).itemsize
                rows = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim] * len(at), pa.int32()), pa.array(pivot, pa.int32()), pa.array(d[np.arange(len(at)), pivot]), *(batch.column(k).take(rows) for k in range(3)), pa.array([raw[k * step : (k + 1) * step] for k in range(len(at))], pa.binary())],
                    names=["dim", "pivot", "distance", "id", "label", "anchor", "x"],
                )

    return lean(run)


def _packed(space: Space):
    """Sorted rows -> blocks of rows of one pivot, each in the order of ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            dims, pivots, far = (batch.column(k).to_numpy() for k in range(3))
            edges = np.flatnonzero((dims[1:] != dims[:-1]) | (pivots[1:] != pivots[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(dims)], strict=True):
                for first in range(a, b, space.block):
                    last = min(b, first + space.block)
                    rows = batch.slice(first, last - first)
                    none = rows.column(3).is_null().to_numpy(zero_copy_only=False)
                    ids = rows.column(3).fill_null(0).to_numpy()
                    order = np.lexsort((ids, none))
                    x = rows.column(6).take(pa.array(order)).to_pylist()
                    one = [(part << 20) + number // space.segment, (part << 32) + number, int(dims[first]), int(pivots[first]), float(far[first]), float(far[last - 1]), last - first]
                    one += [ids[order].astype("<i8").tobytes(), none[order].astype("u1").tobytes(), rows.column(4).to_numpy()[order].astype("<i8").tobytes(), rows.column(5).to_numpy(zero_copy_only=False)[order].astype("u1").tobytes(), b"".join(x)]
                    number += 1
                    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), *(pa.binary(),) * 5)
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(one, kinds, strict=True)], names=[c.split()[0] for c in BLOCKS.split(", ")])

    return run


def _anchors(space: Space):
    """Blocks -> their anchors: (uid, group, dim, id, label, norm, x, keys); a uid is a row's place in the index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        group, held, last = TaskContext.get().partitionId() << 32, 0, None
        for batch in batches:
            for r in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                at = np.flatnonzero(np.frombuffer(r["anchors"], "u1"))
                if not len(at):
                    continue
                x = np.frombuffer(r["x"], space.kind).reshape(r["n"], r["dim"])[at].astype(np.int64)
                keys = distances(np.hstack((x, np.zeros((len(x), 1)))), space.pivots(r["dim"]))
                if last is not None and (last != r["dim"] or held + len(at) > space.group):
                    group, held = group + 1, 0
                last, held = r["dim"], held + len(at)
                ids, none, labels = np.frombuffer(r["ids"], "<i8")[at], np.frombuffer(r["none"], "u1")[at], np.frombuffer(r["labels"], "<i8")[at]
                columns = [pa.array(r["block"] * space.block + at), pa.array([group] * len(at), pa.int64()), pa.array([r["dim"]] * len(at), pa.int32()), pa.array(ids, mask=none == 1), pa.array(labels), pa.array((x * x).sum(axis=1)), pa.array([v.astype("<i8").tobytes() for v in x], pa.binary()), pa.array([v.tobytes() for v in keys], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["uid", "group", "dim", "id", "label", "norm", "x", "keys"])

    return run


GROUPS = f"group long, {DEALT}, done_least double, reach_most double, nearest array<double>, farthest array<double>"


def _grouped(key: tuple, table: pa.Table) -> pa.Table:
    """Anchors of one group as a row, with the interval of their distances to each pivot."""
    rows = table.sort_by("uid").to_pylist()
    keys = np.array([np.frombuffer(r["keys"]) for r in rows])
    flat = lambda c, kind: np.array([r[c] for r in rows]).astype(kind).tobytes()
    one = {
        "group": key[0].as_py(), "dim": rows[0]["dim"], "pivot": None, "low": None, "high": None, "at": key[0].as_py(), "ids": None, "none": None, "labels": flat("label", "<i8"),
        "x": b"".join(r["x"] for r in rows), "uids": flat("uid", "<i8"), "keys": keys.tobytes(), "lows": flat("lows", "<i8"), "highs": flat("highs", "<i8"), "taus": flat("taus", "<i8"), "done": flat("done", "<f8"), "reach": flat("reach", "<f8"),
        "done_least": min(r["done"] for r in rows), "reach_most": max(r["reach"] for r in rows), "nearest": keys.min(axis=0).tolist(), "farthest": keys.max(axis=0).tolist(),
    }
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}
    return pa.table({c.split()[0]: pa.array([one[c.split()[0]]], kinds[c.split()[1]]) for c in GROUPS.split(", ")})


class Block:
    def __init__(self, r: dict, space: Space):
        self.pivot, self.low, self.high, self.number, self.dim = r["pivot"], r["low"], r["high"], r["at"], r["dim"]
        self.ids, self.none, self.labels = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["none"], "u1"), np.frombuffer(r["labels"], "<i8")
        self.x = np.frombuffer(r["x"], space.kind).reshape(len(self.ids), r["dim"])


def annuli(r: dict, blocks: list[Block], space: Space, same: bool, k: int) -> pa.RecordBatch | None:
    """The best k rows of each anchor and slot of a group among the blocks, those within what is done left out."""
    uids, labels = np.frombuffer(r["uids"], "<i8"), np.frombuffer(r["labels"], "<i8")
    m = len(uids)
    x, keys = np.frombuffer(r["x"], "<i8").reshape(m, r["dim"]), np.frombuffer(r["keys"]).reshape(m, -1)
    lows, highs, taus = (np.frombuffer(r[c], "<i8").reshape(m, -1) for c in ("lows", "highs", "taus"))
    done, reach, norms = np.frombuffer(r["done"]), np.frombuffer(r["reach"]), (x * x).sum(axis=1).astype(np.float64)
    slots, open_ = lows.shape[1], lows <= highs
    best = np.full((m, slots, k), -FAR, np.int64)
    floor = np.maximum(lows, taus)
    highest = np.where(open_, highs, -FAR).max(axis=1)
    found: list[np.ndarray] = []
    gaps = [np.maximum(0.0, np.maximum(b.low - keys[:, b.pivot], keys[:, b.pivot] - b.high)) for b in blocks]
    for n in np.argsort([g.min() for g in gaps], kind="stable").tolist():
        b, gap = blocks[n], gaps[n]
        need = np.where(open_, floor, FAR).min(axis=1)
        sure = np.sqrt(np.maximum(0.0, space.longest + norms - 2.0 * need)) + space.slack  # farther rows have lower scores
        near = (space.longest + norms - (keys[:, b.pivot] + b.high + space.slack) ** 2) / 2  # no row of the block has a lower one
        at = np.flatnonzero((gap > done) & (gap <= reach + space.slack) & (gap - space.slack <= sure) & (near <= highest + 1.0))
        if not len(at):
            continue
        scores = products(x[at], b.x)
        fits = (labels[at][:, None] == b.labels) == same
        if same:
            own = np.flatnonzero(uids[at] // space.block == b.number)
            fits[own, uids[at][own] % space.block] = False
        scores[~fits] = -FAR
        order = np.argsort(-scores, axis=1, kind="stable")  # ties by id, as blocks are sorted
        ranked = np.take_along_axis(scores, order, axis=1)
        for s in range(slots):
            column = (ranked > highs[at, s][:, None]).sum(axis=1)[:, None] + np.arange(k)
            inside = column < ranked.shape[1]
            column = np.minimum(column, ranked.shape[1] - 1)
            got = np.take_along_axis(ranked, column, axis=1)
            good = inside & open_[at, s][:, None] & (got >= floor[at, s][:, None]) & (got > -FAR)
            if good.any():
                i, j = np.nonzero(good)
                row = np.take_along_axis(order, column, axis=1)[i, j]
                found.append(np.stack((at[i], np.full(len(i), s), got[i, j], b.ids[row], b.none[row].astype(np.int64))))
                kept = -np.sort(-np.concatenate((best[at, s], np.where(good, got, -FAR)), axis=1), axis=1)[:, :k]
                best[at, s] = kept
                floor[at, s] = np.maximum(floor[at, s], kept[:, -1])
    if not found:
        return None
    all_ = np.concatenate(found, axis=1)
    all_ = all_[:, all_[2] >= floor[all_[0], all_[1]]]
    all_ = all_[:, np.lexsort((all_[3], all_[4], -all_[2], all_[1], all_[0]))]
    key = all_[0] * slots + all_[1]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
    all_ = all_[:, np.arange(len(key)) - np.repeat(starts, np.diff(np.append(starts, len(key)))) < k]
    return pa.RecordBatch.from_arrays([pa.array(uids[all_[0]]), pa.array(all_[1], pa.int32()), pa.array(all_[2]), pa.array(all_[3], mask=all_[4] == 1)], names=["uid", "slot", "score", "id"])


def _scan(space: Space, same: bool, k: int):
    """Rows sorted by segment, turn and side: a segment's blocks come first and are held, its groups of anchors pass by."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            for n in range(batch.num_rows):
                r = batch.slice(n, 1).to_pylist()[0]
                if (r["segment"], r["turn"]) != last:
                    last, held = (r["segment"], r["turn"]), []
                if not r["side"]:
                    held.append(Block(r, space))
                elif (out := annuli(r, [b for b in held if b.dim == r["dim"]], space, same, k)) is not None:
                    yield out

    return lean(run)


class Index:
    """Vectors stored by (pivot, distance), and searches of its anchors over it."""

    def __init__(self, vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", scale: float = 256.0, block: int = BLOCK, segment: int = SEGMENT, group: int = GROUP):
        self.spark, self.base = vectors.sparkSession, scratch(vectors.sparkSession, "negatives")
        v = F.col(vec_col).cast("array<double>")
        sound = F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        rows = vectors.filter(F.coalesce(sound, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), v.alias("v"))
        sizes = rows.select("v").mapInArrow(_sizes(scale), "dim int, n long, most long, norm long").groupBy("dim").agg(F.sum("n").alias("n"), F.max("most").alias("most"), F.max("norm").alias("norm"))
        sizes = written(sizes, f"{self.base}/sizes")
        most = sizes.agg(F.coalesce(F.max("most"), F.lit(0)).alias("most"), F.coalesce(F.max("norm"), F.lit(0)).alias("norm")).first()
        kind = next(c for c, top in (("<i2", 1 << 15), ("<i4", 1 << 31), ("<i8", 1 << 63)) if most.most < top)
        pivots = {}
        for r in sizes.orderBy(F.desc("n"), "dim").limit(LENGTHS).collect():
            k = min(PIVOTS, r.n // block)
            if k > 1 and r.dim:
                some = rows.filter(F.size("v") == r.dim).select("v").sample(fraction=min(1.0, 2 * SAMPLE / r.n), seed=1).limit(SAMPLE).toArrow()
                sample = np.array(some.column(0).to_pylist(), np.float64)
                if len(sample) > k:
                    pivots[r.dim] = fitted(lifted(whole(sample, scale), most.norm), k)
        self.space = Space(scale, most.norm, kind, pivots, block, segment, group)
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        keyed = rows.mapInArrow(_keyed(self.space), "dim int, pivot int, distance double, id long, label long, anchor boolean, x binary")
        order = ("dim", "pivot", "distance", "id")
        self.blocks = written(keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(_packed(self.space), BLOCKS), f"{self.base}/blocks")
        self.ranges = written(self.blocks.groupBy("segment", "dim", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high")), f"{self.base}/ranges")
        self.anchors = written(self.blocks.mapInArrow(_anchors(self.space), "uid long, group long, dim int, id long, label long, norm long, x binary, keys binary"), f"{self.base}/anchors")
        self.asked = self.anchors.count()

    def search(self, asked: DataFrame, same: bool, k: int, name: str) -> DataFrame:
        """(uid, slot, rank, score, id): the best k rows of the anchors' own label (or of other labels) for each slot.

        asked: uid, and for each slot the lowest and highest score (lows, highs; an empty band asks for nothing).
        """
        space, spark = self.space, self.spark
        best = spark.createDataFrame([], "uid long, slot int, rank int, score long, id long")
        state = self.anchors.join(asked, "uid").filter(F.exists(F.arrays_zip("lows", "highs"), lambda s: s["lows"] <= s["highs"])).withColumn("done", F.lit(-1.0))
        for t, part in enumerate(REACHES):
            worst = best.filter(F.col("rank") == k).groupBy("uid").agg(F.collect_list(F.struct("slot", "score")).alias("_worst"))  # a row a slot at most
            known = F.map_from_entries(F.coalesce("_worst", F.array().cast("array<struct<slot:int,score:long>>")))
            now = state.join(worst, "uid", "left").withColumn("taus", F.transform("lows", lambda _, s: F.coalesce(F.element_at(known, s), F.lit(-FAR)))).drop("_worst")  # noqa: B023
            need = F.array_min(F.transform(F.arrays_zip("lows", "highs", "taus"), lambda s: F.when(s["lows"] <= s["highs"], F.greatest(s["lows"], s["taus"]))))
            sure = F.least(F.sqrt(F.greatest(F.lit(0.0), F.lit(float(space.longest)) + F.col("norm") - 2.0 * need.cast("double"))), F.lit(math.sqrt(space.longest)) + F.sqrt("norm")) + 2 * space.slack
            now = now.withColumn("reach", F.greatest("done", F.lit(part) * sure))
            columns = ("uid", "group", "dim", "label", "x", "keys", "lows", "highs", "taus", "done", "reach")
            groups = written(now.filter("reach > done").select(*columns).groupBy("group").applyInArrow(_grouped, GROUPS), f"{self.base}/{name}-{t}-groups")
            state = now.drop("taus", "done").withColumnRenamed("reach", "done")
            spans = groups.select("group", "dim", "done_least", "reach_most", F.posexplode(F.arrays_zip("nearest", "farthest")).alias("pivot", "_s")).select("group", "dim", "pivot", "done_least", "reach_most", F.col("_s.nearest").alias("a"), F.col("_s.farthest").alias("b"))
            meet = (F.col("low") <= F.col("b") + F.col("reach_most") + space.slack) & (F.col("high") >= F.col("a") - F.col("reach_most") - space.slack) & (F.greatest(F.lit(0.0), F.col("high") - F.col("a"), F.col("b") - F.col("low")) > F.col("done_least"))
            turns = max(1, self.asked // (TURNS * GROUP))
            cells = written(spans.join(self.ranges, ["dim", "pivot"]).filter(meet).select("segment", "group").distinct().withColumn("turn", F.pmod(F.xxhash64("group"), F.lit(turns))), f"{self.base}/{name}-{t}-cells")
            if not cells.limit(1).count():
                continue
            empty = {c.split()[0]: F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in DEALT.split(", ")}
            blocks = self.blocks.withColumn("at", F.col("block"))
            left = cells.select("segment", "turn").distinct().join(blocks, "segment").select("segment", "turn", F.lit(0).alias("side"), *(F.col(c) if c in blocks.columns else x for c, x in empty.items()))
            right = cells.join(groups, "group").select("segment", "turn", F.lit(1).alias("side"), *empty)
            n = int(spark.conf.get("spark.sql.shuffle.partitions"))
            dealt = left.unionByName(right).repartition(n, "segment", "turn").sortWithinPartitions("segment", "turn", "side", "at")
            found = dealt.mapInArrow(_scan(space, same, k), "uid long, slot int, score long, id long").unionByName(best.drop("rank"))
            place = F.row_number().over(Window.partitionBy("uid", "slot").orderBy(F.desc("score"), F.col("id").asc_nulls_last()))
            best = written(found.withColumn("rank", place).filter(F.col("rank") <= k).select("uid", "slot", "rank", "score", "id"), f"{self.base}/{name}-{t}")
        return best


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, band: tuple[int, int] = (30, 90), id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", scale: float = 256.0, **sizes: int) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and each of its best positives
    the first negatives whose score is within band (in hundredths) of the positive's."""
    index = Index(vectors, anchor, id_col, vec_col, label_col, scale, **sizes)
    everything = index.anchors.select("uid", F.array(F.lit(-FAR)).alias("lows"), F.array(F.lit(FAR)).alias("highs"))
    own = index.search(everything, True, positives, "positives")
    # in whole numbers: floor(x / 100) is (x - x mod 100) / 100
    low, high = F.expr(f"-((-{band[0]} * score - pmod(-{band[0]} * score, 100)) div 100)"), F.expr(f"({band[1]} * score - pmod({band[1]} * score, 100)) div 100")
    slots = own.select("uid", (F.col("rank") - 1).alias("slot"), "score", F.col("id").alias("positive_id"))
    bands = slots.select("uid", "slot", low.alias("low"), high.alias("high")).groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("slot", "low", "high"))).alias("s"))  # at most ``positives``
    other = index.search(bands.select("uid", F.col("s.low").alias("lows"), F.col("s.high").alias("highs")), False, negatives, "negatives")
    out = other.withColumnRenamed("score", "negative_score").withColumnRenamed("id", "negative_id").join(slots.withColumnRenamed("score", "positive_score"), ["uid", "slot"])
    return out.join(index.anchors.select("uid", F.col("id").alias("anchor_id")), "uid").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return hard_negatives(vectors.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)


SQL = {
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS own, list_inner_product(a.e, b.e)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE own QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 10""",
}
QUERIES = {"op11_hard_negatives": op11_hard_negatives}
