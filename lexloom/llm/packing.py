"""Cost-balanced packing of token sequences.

A document's ids, with the end id, are cut into full pieces of ``SIZE`` ids, each a sequence of its own, and a rest.  The
rests are dealt by hash into groups of about ``GROUP`` documents and packed there: in descending order, each goes to the
sequence of the lowest estimated cost (linear in its ids plus quadratic attention within each piece) that has room for
all of it.  A rest that fits nowhere whole is cut over the emptiest sequences.  A group opens as many sequences as its ids
fill, so only the last of a group is padded.

Packing needs the rests' ids only for their checksums, and they move as 16-bit integers (32-bit for larger vocabularies).

Defined results: a null text is empty, that is the end id alone; repeated rows are packed as rows of their own with equal
ids, and a row that a thousandth of all rows repeats is dealt over many groups; groups depend on id and text only, so results are the same for any partitioning; an empty table gives an empty
result.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm.shared import documents, heavy, row_mark, scratch, written
from lexloom.llm.tokens import default_path, encode

SIZE = 2048
END_ID = 1
GROUP = 4096
#: Cost of a piece of n ids: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cost(n: int) -> float:
    return LINEAR * n + QUADRATIC * n * n


def place(sizes: list[int], size: int = SIZE) -> list[list[tuple[int, int, int, int]]]:
    """For each rest (longest first) its pieces (start, length, sequence, offset)."""
    n = -(-sum(sizes) // size) if sizes else 0
    room, spent = [size] * n, [0.0] * n
    if n:
        room[-1] = sum(sizes) - size * (n - 1)  # the last sequence is as long as it must be
    limit = list(room)
    # a tree over classes of equal room: each node has the lowest (cost, sequence) of the classes below it
    width = 1 << size.bit_length()
    none = (float("inf"), n)
    heaps: list[list[tuple[float, int]]] = [[] for _ in range(width)]
    tree = [none] * (2 * width)

    def refresh(r: int) -> None:
        h = heaps[r]
        while h and (room[h[0][1]] != r or spent[h[0][1]] != h[0][0]):
            heapq.heappop(h)
        i = width + r
        tree[i] = h[0] if h else none
        while i > 1:
            i >>= 1
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

    def cheapest(least: int) -> int:
        """The sequence of the lowest cost with room for least ids, or n."""
        best, i = none, width + least
        best = tree[i]
        while i > 1:
            if not i & 1:
                best = min(best, tree[i + 1])
            i >>= 1
        return best[1]

    def emptiest() -> int:
        i = 1
        while i < width:
            i = 2 * i + (tree[2 * i + 1] != none)
        return tree[i][1]

    def put(k: int, take: int) -> tuple[int, int]:
        """(sequence, offset) of the next take ids in sequence k."""
        was, at = room[k], limit[k] - room[k]
        room[k] -= take
        spent[k] += cost(take)
        refresh(was)
        if room[k]:
            heapq.heappush(heaps[room[k]], (spent[k], k))
            refresh(room[k])
        return k, at

    for k in range(n):
        heapq.heappush(heaps[room[k]], (0.0, k))
    for r in set(room):
        refresh(r)
    out: list[list[tuple[int, int, int, int]]] = []
    for x in sizes:
        k = cheapest(x) if x else n
        if k < n:
            out.append([(0, x, *put(k, x))])
            continue
        pieces, start = [], 0
        while start < x:  # cut it over the emptiest of all; room is left in total, so this ends
            k = emptiest()
            take = min(x - start, room[k])
            pieces.append((start, take, *put(k, take)))
            start += take
        out.append(pieces)
    return out


def _cut(enc, keys: list[pa.Array], ids: list[bytes]) -> list[pa.Array]:
    """Full pieces' checksums and the rest of every document."""
    crcs, rests, totals = [], [], []
    for raw in ids:
        one = np.append(np.frombuffer(raw, "<u4"), np.uint32(END_ID)).astype("<u4")
        full = len(one) // SIZE
        crcs.append([zlib.crc32(one[k * SIZE : (k + 1) * SIZE].tobytes()) for k in range(full)])
        rest = one[full * SIZE :]
        rests.append(rest.astype("<u2").tobytes() if len(enc.names) <= 65536 else rest.tobytes())
        totals.append(len(one))
    wide = 2 if len(enc.names) <= 65536 else 4
    return [keys[0], keys[1], pa.array(totals, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(rests, pa.binary()), pa.array([wide] * len(ids), pa.int32())]


CUT = pa.schema([("doc_id", pa.int64()), ("_mark", pa.int64()), ("doc_tokens", pa.int64()), ("_crcs", pa.list_(pa.int64())), ("_rest", pa.binary()), ("_wide", pa.int32())])


def _pack(key: tuple, table: pa.Table) -> pa.Table:
    group = key[0].as_py()
    rows = sorted(table.select(["doc_id", "_mark", "doc_tokens", "_crcs", "_rest", "_wide"]).to_pylist(), key=lambda r: (-(len(r["_rest"]) // r["_wide"]), r["doc_id"] is None, r["doc_id"] or 0, r["_mark"]))
    out: list[tuple] = []
    base = group << 32
    rests = [r for r in rows if r["_rest"]]
    placed = place([len(r["_rest"]) // r["_wide"] for r in rests])
    n = 1 + max((p[2] for ps in placed for p in ps), default=-1)
    for r, pieces in zip(rests, placed, strict=True):
        ids = np.frombuffer(r["_rest"], "<u2" if r["_wide"] == 2 else "<u4").astype("<u4")
        first = len(r["_crcs"]) * SIZE
        out += [(r["doc_id"], first + a, m, zlib.crc32(ids[a : a + m].tobytes()), r["doc_tokens"], base + k, at) for a, m, k, at in pieces]
    for r in rows:
        for i, crc in enumerate(r["_crcs"]):
            out.append((r["doc_id"], i * SIZE, SIZE, crc, r["doc_tokens"], base + n, 0))
            n += 1
    names = [c.split()[0] for c in PIECE.split(", ")]
    return pa.table({c: pa.array([x[i] for x in out], pa.int64()) for i, c in enumerate(names)})


def pack_documents(docs: DataFrame, path: str | None = None, text_col: str = "text") -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    coded = lambda rows: encode(rows, "doc_id", _cut, "doc_id long, _mark long, doc_tokens long, _crcs array<long>, _rest binary, _wide int", CUT, path or default_path(), text_col)
    rows = docs.select("doc_id", F.col(text_col).alias(text_col), row_mark("doc_id", text_col).alias("_mark"))
    cut, groups = coded(docs).withColumn("_copy", F.lit(0).cast("long")), max(1, docs.count() // GROUP)
    # a row that one in HEAVY rows equals is encoded once, and its copies are dealt over the groups
    often = written(heavy(rows, "doc_id", "_mark"), f"{scratch(docs.sparkSession, 'packing')}/often")
    if often.limit(1).count():
        known = F.broadcast(often.select(F.col("doc_id").alias("_i"), F.col("_mark").alias("_m"), "_held"))
        same = lambda df: df["doc_id"].eqNullSafe(F.col("_i")) & (df["_mark"] == F.col("_m"))
        cold = coded(rows.join(known, same(rows), "left_anti")).withColumn("_copy", F.lit(0).cast("long"))
        once = coded(rows.join(known, same(rows), "left_semi").dropDuplicates(["doc_id", "_mark"]))
        copies = once.join(known, same(once)).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_held")))).drop("_i", "_m", "_held")
        cut = cold.unionByName(copies)
    return cut.withColumn("_group", F.pmod(F.xxhash64("doc_id", "_mark", "_copy"), F.lit(groups))).groupBy("_group").applyInArrow(_pack, PIECE)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


QUERIES = {"op9_packing": op9_packing}
