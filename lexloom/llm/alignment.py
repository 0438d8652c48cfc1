"""Alignment of two tokenizers' tokens over the same bytes.

A text's tokens are cut into groups at the byte offsets where tokens of both end: the ends are running sums of the tokens'
lengths, the cuts their intersection, a token's group the place of its end among the cuts.  Two tokens link when their byte
ranges overlap; a token's first and last partner come from binary searches among the other's ends, and links are written out by
repeating each token as often as it has partners.  No step loops over tokens.

Texts are encoded once, and each text's different id pairs are written with the number of their links.  How many texts hold a pair is counted
over the corpus in two shuffles: each task sums its own texts, then pairs are summed by pair and salt, then by pair, so
no pair is a hot key.  Then each text's pairs meet their counts: pairs that many texts hold are at most ``HOT`` and go to every
task as one sorted array; all others, which only few texts hold, are joined by pair.

A corpus of S different pairs gives S rows of counts; the driver holds at most HOT of them.

Defined results: each row has a result of its own, but rows that share an id are one document when documents are counted, and rows
without an id are one document for each text; a text that is null, empty, or that one of the tokenizers doesn't give back byte for byte has no tokens, and zeros; other columns are ignored;
an empty table gives an empty result.  One task holds one text and its tokens while it aligns them.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm.shared import documents, lean, row_mark, scratch, written

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Pairs whose counts go to every task, at most: 12 bytes each.
HOT = 1 << 19
#: Code points of text, and bytes of pairs, that are worked on at once; different pairs that a task counts before it hands them on.
BATCH, HELD = 1 << 20, 1 << 20
SALTS = 16


def byte_alphabet() -> dict[str, int]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others for the code points from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizers:
    """Both vocabularies in a worker: encoders, the bytes of each token, and ids as written in a digest."""

    def __init__(self, byte_level: str, pieces: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(byte_level, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet, special = byte_alphabet(), {t["content"] for t in spec.get("added_tokens", [])}
        self.a_bytes = {i: bytes(alphabet[c] for c in t) for t, i in spec["model"]["vocab"].items() if t not in special}
        # a rank is an id here: merges are numbered in their order
        self.a = tiktoken.Encoding("byte_level", pat_str=public_tokenizers.PATTERN, mergeable_ranks={b: i for i, b in self.a_bytes.items()}, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        n = self.b.get_piece_size()
        self.b_bytes = {i: bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, self.b.id_to_piece(i)) for i in range(n))}
        self.a_len, self.b_len = self._lengths(self.a_bytes), self._lengths(self.b_bytes)
        self.a_joined, self.a_at = self._flat(self.a_bytes, self.a_len)
        self.b_joined, self.b_at = self._flat(self.b_bytes, self.b_len)
        # an id and what follows it: another of its side, the other side, another group
        self.shown = [f"{i}{end}" for ends, size in ((",|", len(self.a_len)), (",;", len(self.b_len))) for end in ends for i in range(size)]

    @staticmethod
    def _lengths(tokens: dict[int, bytes]) -> np.ndarray:
        out = np.zeros(max(tokens) + 1, np.int64)
        for i, b in tokens.items():
            out[i] = len(b)
        return out

    @staticmethod
    def _flat(tokens: dict[int, bytes], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(tokens.get(i, b"") for i in range(len(lengths))), np.uint8), np.cumsum(lengths) - lengths

    @staticmethod
    def same(ids: np.ndarray, lengths: np.ndarray, joined: np.ndarray, at: np.ndarray, text: bytes) -> bool:
        """Whether the tokens' bytes are the text's."""
        n = lengths[ids]
        if int(n.sum()) != len(text):
            return False
        index = np.repeat(at[ids] - (np.cumsum(n) - n), n) + np.arange(len(text))
        return bool(np.array_equal(joined[index], np.frombuffer(text, np.uint8)))


_made: dict[tuple[str, str], Tokenizers] = {}


def tokenizers(byte_level: str, pieces: str) -> Tokenizers:
    if (byte_level, pieces) not in _made:
        _made[byte_level, pieces] = Tokenizers(byte_level, pieces)
    return _made[byte_level, pieces]


class Aligned:
    """Two tokenizations of the same bytes, by the lengths of their tokens (all above 0)."""

    def __init__(self, a_len: np.ndarray, b_len: np.ndarray):
        self.a_ends, self.b_ends = np.cumsum(a_len), np.cumsum(b_len)
        self.cuts = np.intersect1d(self.a_ends, self.b_ends, assume_unique=True)
        # A token's group is that of the first cut not before its end
        self.a_group, self.b_group = np.searchsorted(self.cuts, self.a_ends), np.searchsorted(self.cuts, self.b_ends)
        first = np.searchsorted(self.b_ends, self.a_ends - a_len, "right")
        last = np.searchsorted(self.b_ends, self.a_ends, "left")
        partners = last - first + 1
        self.link_a = np.repeat(np.arange(len(a_len)), partners)
        self.link_b = np.arange(len(self.link_a)) + np.repeat(first - (np.cumsum(partners) - partners), partners)

    def digest(self, a: np.ndarray, b: np.ndarray, shown: list[str], sizes: tuple[int, int]) -> str:
        """Hash of the groups' ids in order: within a group A's, then B's."""
        na, nb = len(a), len(b)
        place_a = np.arange(na) + np.searchsorted(self.b_group, self.a_group, "left")  # B tokens of earlier groups come before
        place_b = np.arange(nb) + np.searchsorted(self.a_group, self.b_group, "right")
        ends_a = np.append(self.a_group[1:] != self.a_group[:-1], True)
        ends_b = np.append(self.b_group[1:] != self.b_group[:-1], True)
        codes = np.empty(na + nb, np.int64)
        codes[place_a] = a + ends_a * sizes[0]
        codes[place_b] = b + ends_b * sizes[1] + 2 * sizes[0]
        return hashlib.sha256("".join(map(shown.__getitem__, codes.tolist()))[:-1].encode()).hexdigest()


TEXTS = "_row long, _id {kind}, _doc string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, _pairs binary, _times binary"


def _align(byte_level: str, pieces: str):
    """(id, doc, text) -> a row of TEXTS: counts, digest, different pairs (A's id * 2^32 + B's, ascending) and their links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        t, number = tokenizers(byte_level, pieces), TaskContext.get().partitionId() << 40
        sizes = (len(t.a_len), len(t.b_len))
        none = (0, 0, 0, 0, "", b"", b"")
        for batch in batches:
            first = size = 0
            lengths = pc.fill_null(pc.utf8_length(batch.column(2)), 0).to_pylist()
            for k, n in enumerate([*lengths, 0]):
                if k < len(lengths) and (not size or size + n <= BATCH):
                    size += n
                    continue
                texts = [x or "" for x in batch.column(2).slice(first, k - first).to_pylist()]
                out = []
                for text, b in zip(texts, t.b.encode(texts, num_threads=1) if texts else [], strict=True):
                    a, b = np.array(t.a.encode_ordinary(" " + text) if text else [], np.int64), np.array(b, np.int64)
                    whole = (" " + text).encode()
                    if not (text and t.same(a, t.a_len, t.a_joined, t.a_at, whole) and t.same(b, t.b_len, t.b_joined, t.b_at, whole)):
                        out.append(none)
                        continue
                    both = Aligned(t.a_len[a], t.b_len[b])
                    pairs, times = np.unique((a[both.link_a] << 32) | b[both.link_b], return_counts=True)
                    out.append((len(a), len(b), len(both.cuts), len(both.link_a), both.digest(a, b, t.shown, sizes), pairs.astype("<u8").tobytes(), times.astype("<u4").tobytes()))
                if out:
                    kinds = (pa.int64(),) * 4 + (pa.string(), pa.binary(), pa.binary())
                    columns = [pa.array(np.arange(number, number + len(out))), *(batch.column(c).slice(first, k - first) for c in range(2)), *(pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds))]
                    number += len(out)
                    yield pa.RecordBatch.from_arrays(columns, names=["_row", "_id", "_doc", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "_pairs", "_times"])
                first, size = k, n

    return lean(run)


def _count(held: int):
    """Binary pairs of texts -> (pair, docs): sums of the task, handed on whenever held different pairs are at hand."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums, waiting, size = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            new, n = np.unique(np.concatenate(waiting), return_counts=True) if waiting else (np.empty(0, np.int64), np.empty(0, np.int64))
            every, where = np.unique(np.concatenate((keys, new)), return_inverse=True)
            return every, np.bincount(where, np.concatenate((sums, n)), len(every)).astype(np.int64)

        for batch in batches:
            for raw in batch.column(0):
                one = np.frombuffer(raw.as_buffer() or b"", "<i8")
                waiting.append(one)
                size += len(one)
                if size > 4 * held:
                    keys, sums = merged()
                    waiting, size = [], 0
                    if len(keys) > held:
                        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], names=["pair", "docs"])
                        keys, sums = keys[:0], sums[:0]
        keys, sums = merged()
        if len(keys):
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], names=["pair", "docs"])

    return lean(run)


def _meet(hot):
    """Sums over a text's links whose pair is hot, and its other pairs: (row, pairs, times) -> (row, sum, best, cold pairs, cold times)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs, best = (np.frombuffer(x, kind) for x, kind in zip(hot.value, ("<i8", "<i8", "u1"), strict=True))
        for batch in batches:
            columns = ([], [], [], [])
            for pairs, times in zip(batch.column(1), batch.column(2), strict=True):
                p, n = np.frombuffer(pairs.as_buffer(), "<i8"), np.frombuffer(times.as_buffer(), "<u4").astype(np.int64)
                at = np.minimum(np.searchsorted(known, p), max(len(known) - 1, 0))
                found = known[at] == p if len(known) else np.zeros(len(p), bool)
                at, hits = at[found], n[found]
                for c, v in zip(columns, (int((docs[at] * hits).sum()) if len(at) else 0, int(hits[best[at] == 1].sum()) if len(at) else 0, p[~found], n[~found]), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.list_(pa.int64())), pa.array(columns[3], pa.list_(pa.int64()))], names=["_r", "_sum", "_best", "_cold", "_n"])

    return lean(run)


class Alignment:
    """Aligned texts of a table, and what the corpus says of their id pairs."""

    def __init__(self, docs: DataFrame, byte_level: str | None = None, pieces: str | None = None, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text"):
        if byte_level is None or pieces is None:
            import public_tokenizers

            byte_level, pieces = byte_level or public_tokenizers.path(BYTE_LEVEL), pieces or public_tokenizers.path(PIECES)
        self.spark, self.hot, self.base = docs.sparkSession, hot, scratch(docs.sparkSession, "alignment")
        schema = TEXTS.format(kind=docs.schema[id_col].dataType.simpleString())
        self.texts = written(docs.select(F.col(id_col).alias("_id"), F.coalesce(F.concat(F.lit("i"), F.col(id_col).cast("string")), F.concat(F.lit("t"), row_mark(id_col, text_col))).alias("_doc"), F.col(text_col).alias("_text")).mapInArrow(_align(byte_level, pieces), schema), f"{self.base}/texts")
        self.counts = self._counts()

    def _counts(self) -> DataFrame:
        """(pair, docs, best): how many texts hold a pair, and whether no pair of its A id is held by more."""
        linked = self.texts.filter("n_links > 0")
        again = written(linked.groupBy("_doc").count().filter("count > 1").select("_doc"), f"{self.base}/again")
        several = bool(again.limit(1).count())
        own = (linked.join(again, "_doc", "left_anti") if several else linked).select("_pairs").mapInArrow(_count(HELD), "pair long, docs long")
        if several:  # rows of one id are one document
            rows = linked.join(again, "_doc", "left_semi").select("_doc", "_row", "_pairs", "_times").mapInArrow(_exploded, "_id string, _row long, pair long, links long")
            own = own.unionByName(rows.select("_id", "pair").distinct().groupBy("pair").agg(F.count("*").alias("docs")))
        salted = own.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS))).groupBy("pair", "salt").agg(F.sum("docs").alias("docs"))
        counts = written(salted.groupBy("pair").agg(F.sum("docs").alias("docs")), f"{self.base}/counts")
        a = F.shiftright("pair", 32)
        top = counts.groupBy(a.alias("_a")).agg(F.max("docs").alias("_most"))  # at most one row an id of A's vocabulary
        return written(counts.join(F.broadcast(top), a == F.col("_a")).select("pair", "docs", (F.col("docs") == F.col("_most")).alias("best")), f"{self.base}/known")

    def _frequent(self) -> int:
        """The least power of two of texts such that at most ``hot`` pairs are held by as many."""
        level = F.floor(F.log2("docs")).cast("int")
        sizes = dict(self.counts.groupBy(level.alias("level")).count().collect())  # at most 63 rows
        least, n = max(sizes, default=0) + 1, 0
        while least and n + sizes.get(least - 1, 0) <= self.hot:
            least -= 1
            n += sizes.get(least, 0)
        return 1 << least

    def links(self) -> DataFrame:
        """(_id, _row, a, b, links, docs, best): every text's different id pairs, the number of their links, and what the corpus says."""
        pairs = self.texts.select("_id", "_row", "_pairs", "_times").mapInArrow(_exploded, f"_id {self.texts.schema['_id'].dataType.simpleString()}, _row long, pair long, links long")
        return pairs.join(self.counts, "pair").select("_id", "_row", F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"), "links", "docs", "best")

    def rows(self) -> DataFrame:
        """One row a text: _id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
        least = self._frequent()
        frequent = self.counts.filter(F.col("docs") >= least).orderBy("pair").toArrow()
        arrays = [frequent.column(c).to_numpy() for c in ("pair", "docs", "best")]
        hot = self.spark.sparkContext.broadcast([arrays[0].astype("<i8").tobytes(), arrays[1].astype("<i8").tobytes(), arrays[2].astype("u1").tobytes()])
        met = self.texts.filter("n_links > 0").select("_row", "_pairs", "_times").mapInArrow(_meet(hot), "_r long, _sum long, _best long, _cold array<long>, _n array<long>")
        sums = met.select("_r", "_sum", "_best")
        if least > 1:
            met = written(met, f"{self.base}/met")
            cold = met.select("_r", F.explode(F.arrays_zip("_cold", "_n")).alias("x")).select("_r", F.col("x._cold").alias("pair"), F.col("x._n").alias("n"))
            cold = cold.join(self.counts.filter(F.col("docs") < least), "pair").select("_r", (F.col("docs") * F.col("n")).alias("_sum"), F.when(F.col("best"), F.col("n")).otherwise(0).alias("_best"))
            sums = met.select("_r", "_sum", "_best").unionByName(cold).groupBy("_r").agg(F.sum("_sum").alias("_sum"), F.sum("_best").alias("_best"))
        out = self.texts.drop("_pairs", "_times", "_doc").join(sums, F.col("_row") == F.col("_r"), "left")
        return out.select("_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("_best", F.lit(0)).cast("long").alias("n_best"), F.coalesce("_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            pairs, times = np.frombuffer(batch.column(2)[k].as_buffer(), "<i8"), np.frombuffer(batch.column(3)[k].as_buffer(), "<u4")
            same = pa.array(np.zeros(len(pairs), np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1).take(same), batch.column(1).slice(k, 1).take(same), pa.array(pairs), pa.array(times.astype(np.int64))], names=["_id", "_row", "pair", "links"])


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Alignment(documents(spark, sf_dir)).rows().withColumnRenamed("_id", "doc_id")


QUERIES = {"op12_alignment": op12_alignment}
