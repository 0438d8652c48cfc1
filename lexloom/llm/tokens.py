"""BPE encoding and decoding of tables (op3) by the tree concatenation of ``bpe``.

Texts of up to ``LEAF`` code points are encoded where they lie.  Longer ones are cut into leaves that are dealt over the
cluster, encoded independently, and joined up the tree in the task that gathers the text's leaves; a text's leaves spread
by a hash of text and position, so one very long text doesn't burden one encoder.  One task holds one text, its leaves and
its ids while it joins them, as a row that comes out holds them anyway; equal rows are encoded once.

Defined results as in ``bpe``; the tokenizer's path is a parameter and must be readable on every executor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm import bpe
from lexloom.llm.shared import documents, lean, row_mark, text_of

VOCABULARY = "word_bpe_49k.json"
#: Texts that are encoded at once, in code points: bounds a worker's memory.
BATCH = 1 << 20

_encoders: dict[str, bpe.Encoder] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def encoder(path: str) -> bpe.Encoder:
    """One a worker process: it remembers words from task to task."""
    if path not in _encoders:
        _encoders[path] = bpe.Encoder(path)
    return _encoders[path]


def batches_of(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts of BATCH code points or little more, and where they start: only these are held as Python objects."""
    first = size = 0
    for k, n in enumerate(pc.utf8_length(texts).to_pylist()):
        if size and size + n > BATCH:
            yield first, texts.slice(first, k - first).to_pylist()
            first, size = k, 0
        size += n
    if first < len(texts):
        yield first, texts.slice(first).to_pylist()


def encode_rows(path: str, emit: Callable, schema: pa.Schema) -> Callable:
    """An Arrow function over (key columns..., text): emit gets the encoder, the keys, and packed ids of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for first, texts in batches_of(batch.column(batch.num_columns - 1)):
                ids = enc.encode_batch(texts)
                keys = [c.slice(first, len(texts)) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays(emit(enc, keys, ids), schema=schema)

    return lean(run)


def _leaf(path: str) -> Callable:
    """Ropes of leaves: (keys..., at, text) -> (keys..., at, text, atoms as starts, ends and counts, their ids, number in the head, middle)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            got = []
            for r in (r for _, texts in batches_of(batch.column("_leaf")) for r in bpe.leaves(enc, texts, [0] * len(texts))):
                atoms = r.head + r.tail
                flat = [x for a in atoms for x in (a[0], a[1], len(a[2]))]
                got.append((np.array(flat, "<u4").tobytes(), bpe.pack([i for a in atoms for i in a[2]]), len(r.head), r.middle))
            kinds = (pa.binary(), pa.binary(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([g[i] for g in got], k) for i, k in enumerate(kinds))], names=[*batch.schema.names, "_spans", "_ids", "_heads", "_middle"])

    return lean(run)


def rope_of(row: dict) -> bpe.Rope:
    at, flat, k, atoms = row["_at"] * bpe.LEAF, bpe.unpack(row["_ids"]), 0, []
    for a, b, n in np.frombuffer(row["_spans"], "<u4").reshape(-1, 3).tolist():
        atoms.append((a + at, b + at, flat[k : k + n]))
        k += n
    return bpe.Rope(at, at + len(row["_leaf"]), atoms[: row["_heads"]], row["_middle"], atoms[row["_heads"] :])


def _joined(path: str, key: str, emit: Callable, schema: pa.Schema) -> Callable:
    """Leaves of one text, joined: (key, at, text, rope) -> emit's row, once a copy.  One text is held at a time, by one task."""
    def run(table: pa.Table) -> pa.Table:
        enc, rows = encoder(path), sorted(table.to_pylist(), key=lambda r: r["_at"])
        ids = bpe.tree(enc, "".join(r["_leaf"] for r in rows), [rope_of(r) for r in rows])
        keys = [pa.array([rows[0][key]], table.schema.field(key).type), pa.array([rows[0]["_mark"]], pa.int64())]
        one = pa.Table.from_arrays(emit(enc, keys, [ids]), schema=schema)
        return one.take(pa.array([0] * rows[0]["_copies"]))

    return run


def encode(docs: DataFrame, key: str, emit: Callable, out_schema: str, arrow_schema: pa.Schema, path: str, text_col: str = "text") -> DataFrame:
    """emit's rows for every row of docs, by key and a mark of its text; emit(enc, [key, mark], packed ids) -> columns."""
    rows = docs.select(F.col(key), row_mark(key, text_col).alias("_mark"), text_of(text_col).alias("_text"))
    long = F.char_length("_text") > bpe.LEAF
    short = rows.filter(~long).mapInArrow(encode_rows(path, emit, arrow_schema), out_schema)
    cuts = F.transform(F.sequence(F.lit(0), F.floor((F.char_length("_text") - 1) / bpe.LEAF).cast("int")), lambda k: F.substring("_text", k * bpe.LEAF + 1, F.lit(bpe.LEAF)))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # equal rows are encoded once, and counted
    leaves = rows.filter(long).select(key, "_mark", F.posexplode(cuts).alias("_at", "_leaf")).repartition(n, key, "_mark", "_at")
    leaves = leaves.groupBy(key, "_mark", "_at").agg(F.first("_leaf").alias("_leaf"), F.count("*").alias("_copies"))
    kind = docs.schema[key].dataType.simpleString()
    coded = leaves.mapInArrow(_leaf(path), f"{key} {kind}, _mark long, _at int, _leaf string, _copies long, _spans binary, _ids binary, _heads int, _middle binary")
    whole = coded.groupBy(key, "_mark").applyInArrow(_joined(path, key, emit, arrow_schema), out_schema)
    return short.unionByName(whole)


def digests(enc: bpe.Encoder, keys: list[pa.Array], ids: list[bytes]) -> list[pa.Array]:
    """key, n_tokens, ids_sha256, decoded_sha256.  The vocabulary's decoder joins the tokens' names by blanks."""
    if not hasattr(enc, "shown"):
        enc.shown = [str(i) for i in range(len(enc.names))]
        probe = enc.library.encode("The don't a1é!", add_special_tokens=False).ids
        enc.by_name = enc.library.decode(probe, skip_special_tokens=False) == " ".join(enc.names[i] for i in probe)
    n, a, b = [], [], []
    for raw in ids:
        one = np.frombuffer(raw, "<u4").tolist()
        n.append(len(one))
        a.append(hashlib.sha256(" ".join(map(enc.shown.__getitem__, one)).encode()).hexdigest())
        text = " ".join(map(enc.names.__getitem__, one)) if enc.by_name else enc.decode(one)
        b.append(hashlib.sha256(text.encode()).hexdigest())
    return [keys[0], pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]


def op3_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    return encode(documents(spark, sf_dir), "doc_id", digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", schema, path or default_path())


QUERIES = {"op3_bpe": op3_bpe}
