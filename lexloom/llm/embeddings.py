"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Vectors are normalised in double precision, equal ones of a label made one class, and rotated onto the principal axes of
the whole table (one bounded covariance matrix, summed on the executors).  Within a label the classes are sorted along the
leading axis and cut into tiles, and GROUP tiles that follow each other make a group.  Two groups, and two tiles in them, are
compared only if their leading coordinates allow the threshold; a tile travels once for each group that its group meets, not
once for each tile.  Within a pair of tiles the products of the leading dimensions are accumulated block by block, the rest
is bounded by the product of the suffix norms, and a pair stops as soon as that bound falls below the threshold.  What is
left is checked with the exact cosine.

A pair of tiles gives link counts and a spanning forest of its links, never all pairs, so a group of near copies costs its
size in output; components come from the forests.  Where the axes can't part a label's vectors, every pair of its tiles has
its leading products formed: that is the price of an exact result.

Defined results: null, zero, empty or non-finite vectors, vectors of another length than the table's most common one when
its label has none like it, and rows without a label link with nothing and are components of their own; vectors are scaled by
powers of two, so that no square of a component vanishes or overflows; repeated vec_ids
are told apart by their vectors; a null vec_id counts as none and gets null as its component unless it is linked; classes are
named by 64-bit hashes, and those of different vectors that agree by chance are renamed; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.llm.shared import components, lean, scratch, written

THRESHOLD = 0.93
#: Classes in a tile, and dimensions accumulated before bounds are checked.
TILE, BLOCK = 512, 8
#: Tiles of a group.
GROUP = 16
SLACK = 1e-9
#: Cut points of a label, at most.
SKETCH = 1024
TILES = "label int, tile long, dim int, n int, keys binary, counts binary, vectors binary, low double, high double"


def _covariance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for dim, x in by_dimension(batch.column(0)):
            sums[dim] = sums.get(dim, 0) + x.T @ x
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["dim", "cov"])


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, scaled by a power of two first."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def by_dimension(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    by: dict[int, list] = {}
    for v in column.to_pylist():
        by.setdefault(len(v), []).append(v)
    for dim, vs in by.items():
        yield dim, unit(np.array(vs, np.float64))


def axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes, the leading one first, for each dimension."""
    total: dict[int, np.ndarray] = {}
    for r in classes.select("v").mapInArrow(_covariance, "dim int, cov binary").toLocalIterator():  # one small matrix a task
        total[r.dim] = total.get(r.dim, 0) + np.frombuffer(r.cov).reshape(r.dim, r.dim)
    return {dim: np.linalg.eigh(c)[1][:, ::-1].copy() for dim, c in total.items()}


def compare(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows i of a and j of b, rotated unit vectors, that may reach the threshold."""
    dim = a.shape[1]
    sa, sb = (np.sqrt(np.maximum(0, np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1])) for x in (a, b))
    got = a[:, :BLOCK] @ b[:, :BLOCK].T
    if dim <= BLOCK:
        return np.nonzero(got >= threshold - SLACK)
    i, j = np.nonzero(got + np.outer(sa[:, BLOCK], sb[:, BLOCK]) >= threshold - SLACK)
    dot, at = got[i, j], BLOCK
    while at < dim and len(i):
        end = min(dim, at + BLOCK)
        if len(i) > 0.2 * a.shape[0] * b.shape[0]:  # most are left: whole blocks are faster than picked pairs
            dot = (a[:, :end] @ b[:, :end].T)[i, j]
        else:
            dot = dot + np.einsum("nd,nd->n", a[i, at:end], b[j, at:end])
        rest = sa[i, end] * sb[j, end] if end < dim else 0.0
        keep = dot + rest >= threshold - SLACK
        i, j, dot, at = i[keep], j[keep], dot[keep], end
    return i, j


def forest(n: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the links (i, j) connect, fewer than n."""
    parent, out = list(range(n)), []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    if len(i) > 4 * n:  # stars first: one numpy pass finds each node's least neighbour
        low = np.arange(n)
        np.minimum.at(low, i, j)
        np.minimum.at(low, j, i)
        for x, y in enumerate(low.tolist()):
            a, b = root(x), root(y)
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((x, y))
        roots = np.array([root(x) for x in range(n)])
        differ = roots[i] != roots[j]
        i, j = i[differ], j[differ]
    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        a, b = root(x), root(y)
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((x, y))
    return out


class Tile:
    """A tile in the worker that compares it."""

    def __init__(self, row: dict, rotations: dict[int, np.ndarray]):
        self.number, self.low, self.high = row["tile"], row["low"], row["high"]
        self.keys, self.counts = (np.frombuffer(row[c], "<i8") for c in ("keys", "counts"))
        self.x = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"])
        self.rotated = self.x @ rotations[row["dim"]]


def linked(a: Tile, b: Tile, threshold: float) -> pa.RecordBatch | None:
    """Link counts of the classes of two tiles, and a forest of their links."""
    same = a.number == b.number
    i, j = compare(a.rotated, b.rotated, threshold)
    if same:
        i, j = i[i < j], j[i < j]
    exact = np.empty(len(i))
    for k in range(0, len(i), 65536):
        exact[k : k + 65536] = np.einsum("nd,nd->n", a.x[i[k : k + 65536]], b.x[j[k : k + 65536]])
    i, j = i[exact >= threshold], j[exact >= threshold]
    if not len(i):
        return None
    na = np.bincount(i, b.counts[j], len(a.keys)).astype(np.int64)
    nb = np.bincount(j, a.counts[i], len(b.keys)).astype(np.int64)
    edges = forest(len(a.keys) + (0 if same else len(b.keys)), i, j if same else j + len(a.keys))
    keys = a.keys if same else np.concatenate((a.keys, b.keys))
    links = na + nb if same else np.concatenate((na, nb))
    at = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate((keys[at], keys[[e[0] for e in edges]]))), pa.array(np.concatenate((links[at], np.zeros(len(edges), np.int64)))), pa.array([None] * len(at) + keys[[e[1] for e in edges]].tolist(), pa.int64())],
        names=["a", "links", "b"],
    )


def _compare_groups(threshold: float, reach: float, rotations: dict[int, np.ndarray]):
    """Rows sorted by cell (a pair of groups), the tiles of the first group before those of the other: one group is held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                cell = (row["label"], row["dim"], row["g1"], row["g2"])
                if cell != last:
                    last, held = cell, []
                b = Tile(row, rotations)
                if not row["side"]:
                    held.append(b)
                if row["side"] or row["g1"] == row["g2"]:
                    for a in held:
                        if a.low <= b.high + reach and b.low <= a.high + reach and (found := linked(a, b, threshold)) is not None:
                            yield found

    return lean(run)


def _tile(key: tuple, table: pa.Table) -> pa.Table:
    """One tile of a label: its classes in the order of the leading axis."""
    t = table.sort_by([("_lead", "ascending"), ("_class", "ascending")])
    x = unit(np.array(t.column("v").to_pylist(), np.float64))
    lead = t.column("_lead").to_numpy()
    row = [key[0].as_py(), key[2].as_py(), key[1].as_py(), len(x), t.column("_class").to_numpy().astype("<i8").tobytes(), t.column("_count").to_numpy().astype("<i8").tobytes(), x.tobytes(), float(lead.min()), float(lead.max())]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
    return pa.table({c.split()[0]: pa.array([v], ty) for c, v, ty in zip(TILES.split(", "), row, types, strict=True)})


def renamed(rows: DataFrame, sums: DataFrame, base: str) -> tuple[DataFrame, DataFrame]:
    """rows and sums, with other numbers for classes of different vectors that share one by chance."""
    clash = written(sums.groupBy("_class").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("_class").alias("_was")), f"{base}/clashes")
    if not clash.limit(1).count():
        return rows, sums
    other = lambda df: df.join(F.broadcast(clash), F.col("_class") == F.col("_was"), "left").withColumn("_class", F.when(F.col("_was").isNotNull(), F.xxhash64("_class", "_check")).otherwise(F.col("_class"))).drop("_was")
    return other(rows), written(other(sums), f"{base}/renamed")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row a vector: id_col, n_links, component_id, kept."""
    spark = vectors.sparkSession
    base = scratch(spark, "embeddings")
    v = F.col(vec_col).cast("array<double>")
    sound = F.coalesce(F.col(label_col).isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col), F.col(label_col).alias("_label"), F.when(sound, v).alias("_v"))
    # a class is every row of a label with the same vector; its number names it
    plain = F.transform("_v", lambda x: x + 0.0)
    rows = rows.withColumn("_class", F.when(F.col("_v").isNotNull(), F.xxhash64("_label", plain))).withColumn("_check", F.when(F.col("_v").isNotNull(), F.xxhash64(F.lit(1), "_label", plain)))
    sums = written(rows.filter("_class is not null").groupBy("_class", "_check").agg(F.first("_label").cast("int").alias("label"), F.first("_v").alias("v"), F.count("*").alias("_count"), F.min(id_col).alias("_low")), f"{base}/classes")
    rows, sums = renamed(rows, sums, base)
    rotations = axes(sums)
    # the leading coordinate, by the same scaling
    scaled = F.transform("v", lambda x: x * F.col("_scale"))
    lead = F.lit(None).cast("double")
    for dim, rot in rotations.items():
        lead = F.when(F.size("v") == dim, F.aggregate(F.zip_with(scaled, F.array(*map(F.lit, rot[:, 0].tolist())), lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x) / F.sqrt(F.aggregate(scaled, F.lit(0.0), lambda a, x: a + x * x))).otherwise(lead)
    power = F.greatest(F.lit(-1000.0), F.least(F.lit(1000.0), -F.floor(F.log2(F.array_max(F.transform("v", F.abs)))).cast("double")))
    placed = sums.withColumn("_scale", F.pow(F.lit(2.0), power)).withColumn("_lead", lead).withColumn("_dim", F.size("v")).drop("_scale")
    # tiles: equal shares of a label along the leading axis, by the cut points of its sketch (at most SKETCH of them)
    sizes = placed.groupBy(F.col("label").alias("_l"), F.col("_dim").alias("_d")).agg(F.ceil(F.count("*") / TILE).cast("int").alias("_n"), F.percentile_approx("_lead", [k / SKETCH for k in range(1, SKETCH)], 20 * SKETCH).alias("_q"))
    cuts = F.when(F.col("_n") < 2, F.array().cast("array<double>")).when(F.col("_n") <= SKETCH, F.transform(F.sequence(F.lit(1), F.col("_n") - 1), lambda k: F.get("_q", F.floor(k * SKETCH / F.col("_n")).cast("int") - 1))).otherwise(F.col("_q"))
    placed = placed.join(sizes.withColumn("_cuts", cuts).select("_l", "_d", "_cuts"), (F.col("label") == F.col("_l")) & (F.col("_dim") == F.col("_d")))
    placed = placed.withColumn("_tile", F.size(F.filter("_cuts", lambda c: c <= F.col("_lead"))).cast("long")).drop("_l", "_d", "_cuts")
    # values that tie on the axis, or a label of more tiles than cuts, may overfill a tile: it is split by number
    fill = placed.groupBy("label", "_dim", "_tile").agg(F.count("*").alias("_n"))
    fill = fill.select(F.col("label").alias("_l"), F.col("_dim").alias("_d"), F.col("_tile").alias("_t"), F.ceil(F.col("_n") / (2 * TILE)).alias("_parts"))
    placed = placed.join(fill, (F.col("label") == F.col("_l")) & (F.col("_dim") == F.col("_d")) & (F.col("_tile") == F.col("_t")))
    placed = placed.withColumn("_tile", F.col("_tile") * (1 << 20) + F.pmod("_class", F.col("_parts"))).select("label", "_dim", "_tile", "_lead", "_class", "_count", "v")
    tiles = written(placed.groupBy("label", "_dim", "_tile").applyInArrow(_tile, TILES), f"{base}/tiles")
    # pairs of groups that can link: |x - y|^2 = 2 - 2 cos bounds how far apart the leading coordinates may be
    reach = float(np.sqrt(2 - 2 * threshold)) + SLACK
    order = Window.partitionBy("label", "dim").orderBy("low", "tile")  # a row a tile
    grouped = written(tiles.select("label", "dim", "tile", "low", "high").withColumn("g", F.floor((F.row_number().over(order) - 1) / GROUP).cast("long")), f"{base}/groups")
    heads = grouped.groupBy("label", "dim", "g").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    other = heads.select(F.col("label").alias("l2"), F.col("dim").alias("d2"), F.col("g").alias("g2"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    meet = (F.col("label") == F.col("l2")) & (F.col("dim") == F.col("d2")) & (F.col("g") <= F.col("g2")) & (F.col("low2") <= F.col("high") + reach) & (F.col("low") <= F.col("high2") + reach)
    cells = heads.join(other, meet).select("label", "dim", F.col("g").alias("g1"), "g2")
    sides = cells.select("label", "dim", "g1", "g2", F.col("g1").alias("g"), F.lit(0).alias("side")).unionByName(cells.filter("g1 < g2").select("label", "dim", "g1", "g2", F.col("g2").alias("g"), F.lit(1).alias("side")))
    dealt = sides.join(grouped.select("label", "dim", "g", "tile"), ["label", "dim", "g"]).join(tiles, ["label", "dim", "tile"])
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    work = dealt.repartition(n, "label", "dim", "g1", "g2").sortWithinPartitions("label", "dim", "g1", "g2", "side", "tile")
    work = work.select("label", "dim", "g1", "g2", "side", "tile", "low", "high", "keys", "counts", "vectors")
    found = written(work.mapInArrow(_compare_groups(threshold, reach, rotations), "a long, links long, b long"), f"{base}/links")
    links = found.filter("b is null").groupBy(F.col("a").alias("_c")).agg(F.sum("links").alias("_links"))
    comps = components(found.filter("b is not null").select("a", "b"))
    # components of classes, then the smallest id of each
    named = sums.join(comps, sums["_class"] == comps["node"], "left").withColumn("_root", F.coalesce("component", "_class"))
    lows = named.groupBy(F.col("_root").alias("_r")).agg(F.min("_low").alias("component_id"))
    result = named.join(lows, F.col("_root") == F.col("_r")).join(links, F.col("_class") == F.col("_c"), "left").select(F.col("_class").alias("_k"), "component_id", (F.coalesce("_links", F.lit(0)) + F.col("_count") - 1).alias("n_links"))
    out = rows.join(result, rows["_class"] == result["_k"], "left")
    comp = F.coalesce("component_id", F.col(id_col))
    return out.select(id_col, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), comp.cast("long").alias("component_id"), F.coalesce(comp == F.col(id_col), F.lit(False)).alias("kept"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = {
    "op10_embedding_near_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS n, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.n),
m AS (SELECT n, min(c) AS c FROM r GROUP BY n), k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(k.n, 0) AS n_links, m.c AS component_id, e.vec_id = m.c AS kept
FROM embeddings e JOIN m ON m.n = e.vec_id LEFT JOIN k ON k.a = e.vec_id""",
}
QUERIES = {"op10_embedding_near_dedup": op10_embedding_near_dedup}
