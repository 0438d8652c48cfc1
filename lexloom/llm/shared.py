"""What several operators of this subpackage share: scratch tables, text rules, row identity, connected components."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the contract: ASCII white space, and the letters that are lower-cased.
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_made: list[tuple[SparkSession, str]] = []


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where the session names none (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lexloom-")
        spark.sparkContext.setCheckpointDir(base)
        _made.append((spark, base))
    return base.rstrip("/")


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder for written tables.  It stays while the session runs (results are lazy) and goes at its end."""
    path = f"{shared_dir(spark)}/lexloom-{what}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        try:
            if spark.sparkContext._jsc is not None:
                delete(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone already
            return


def written(df: DataFrame, path: str) -> DataFrame:
    """df as a table in the shared folder: cuts its lineage, and survives the loss of executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of finished stages now; it follows the driver's garbage collection."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Bytes of text that an Arrow function works on at once; a longer text is alone.
PIECE = 1 << 22


def pieces(batch: pa.RecordBatch, column: int, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, of about limit bytes in the string or binary column: only these are held as Python objects."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + limit, "right")))
        yield batch.slice(first, last - first)
        first = last


def trim() -> None:
    """Gives memory that this worker process has freed back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        return


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """An Arrow function after which the worker, which is kept for other stages, holds no more memory than it needs."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            trim()

    return wrapped


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, all else as it is.  lower() does the same, faster, unless other capitals could change."""
    other = (F.octet_length(c) != F.char_length(c)) & c.rlike("[[^\\x00-\\x{24F}][\\x{80}-\\x{24F}&&[\\p{javaUpperCase}\\p{Lt}]]]")
    return F.when(other, F.translate(c, UPPER, LOWER)).otherwise(F.lower(c))


def ascii_trim(c: Column) -> Column:
    """Without ASCII white space at the ends; only what begins or ends with some is trimmed, which walks all of it."""
    edge = F.lit(False)
    for w in WHITE:
        edge = edge | c.startswith(w) | c.endswith(w)
    return F.when(edge, F.btrim(c, F.lit(WHITE))).otherwise(c)


def text_of(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores more as keep it apart from the columns of df."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


#: A key held by more than one row in so many is heavy; so there are at most so many heavy keys.
HEAVY = 1000


def heavy(rows: DataFrame, *keys: str, share: int = HEAVY) -> DataFrame:
    """The keys that more than one row in ``share`` holds, and how many hold them (_held): at most ``share`` rows, so they may
    be broadcast."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_held"))
    total = rows.count()
    return counts.filter(F.col("_held") > F.lit(max(total // share, share)))


def split_join(left: DataFrame, right: DataFrame, keys: list[str], hot: DataFrame, how: str = "left") -> DataFrame:
    """left joined with right, which has a key once at most, on equal non-null keys.

    Rows of the keys in hot (at most HEAVY, see heavy()) meet a broadcast of those keys' rows of right, instead of one task.
    """
    some = F.broadcast(right.join(F.broadcast(hot), keys, "left_semi"))
    return left.join(F.broadcast(hot), keys, "left_semi").join(some, keys, how).unionByName(left.join(F.broadcast(hot), keys, "left_anti").join(right, keys, how))


def row_mark(id_col: str, text_col: str) -> Column:
    """Tells rows of equal id apart by their text; equal rows share it, and so their result."""
    return F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("\0null")))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over undirected edges (a, b), for every node of an edge.

    Each round hooks every label to the smallest one that its members or their neighbours have, and on to the label of
    that one, which doubles the way a label goes: chains of n nodes take about log n rounds.  Rounds go on until no label
    changes; if that takes more than ``rounds`` of them, it's an error.  Aggregates have partial sums, so a node with very
    many edges is no hot task; labels are written to the shared folder each round.
    """
    spark = edges.sparkSession
    base = scratch(spark, "components")
    e = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    e = written(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))), f"{base}/edges")
    labels = written(e.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component")), f"{base}/0")
    for k in range(1, rounds):
        near = e.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        hooked = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("low"))
        # a root learns of the smallest label that any of its members has seen
        roots = hooked.groupBy(F.col("component").alias("was")).agg(F.min("low").alias("low"))
        roots = roots.join(labels.select(F.col("node").alias("low"), F.col("component").alias("label")), "low").select("was", "label")
        new = hooked.select("node", F.col("component").alias("was")).join(roots, "was").select("node", "was", F.col("label").alias("component"))
        new = written(new, f"{base}/{k}")
        if new.filter("was <> component").limit(1).count() == 0:
            return labels.select("node", "component")
        labels = new.select("node", "component")
    raise RuntimeError(f"labels of components still change after {rounds} rounds")
