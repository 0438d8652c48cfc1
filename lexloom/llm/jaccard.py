"""Exact n-gram Jaccard join by a token-group matrix.

A document is its set of distinct word shingles; equal sets are one *class*.  The steps:

1. Every row is sketched: set size, class (a hash of the set), four minima of permuted shingle hashes, and its
   shingles with the lowest hashes (at least as many as the prefix filter needs), as 32-bit tokens.
2. Classes that share a minimum are checked against a few leads of the bucket.  Those that link, and those that come near to
   it (``NEAR``), form the *groups* of similar documents, which links part into *components*.  A group of thousands of near
   copies needs a few checks for each copy and minimum.
3. The token-group matrix holds the tokens that occur more than once, per group (the union over its members), for the
   classes of which enough tokens do; the others can link with nothing.  A class
   opens only groups of which it meets a token by its prefix: two sets of Jaccard similarity t share a token among the
   n - ceil(t n) + 1 first of either, in any common order of tokens, and here frequent tokens come last; the places of the
   first shared token bound the overlap, which parts documents that share little but a common passage.  The overlap of
   the class with the group's union bounds its overlap with every member; groups below ceil(t n) stay closed.  A group's
   own classes outside of its largest component open it too.
4. Members of opened groups are compared: a class that opens a group of several meets its members in blocks, by an index of
   the block's shingles, and one link to each component of a block stays.  Components of all links are the result.

Every link between different components is found in steps 3 and 4; links within a component need no check.  No step emits
the pairs of a group.

Shingles are told apart by hashes of 64 bits (two sets of thousands meet a collision once in 10^12 comparisons); classes
have hashes of 128 bits, and rows whose first halves are equal by chance are renamed.

Defined results: a null or blank text has no shingles and links with nothing; fewer words than ``words`` make one shingle;
repeated rows are copies like any others; a null id counts as none when the smallest id is taken; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm.shared import components, delete, documents, heavy, lean, pieces, release, row_mark, scratch, split_join, text_of, written

WORDS, THRESHOLD = 5, 75
#: Share of the hash space whose tokens are counted, and the count beyond which a token is frequent.
REGION, FREQUENT = 0.4, 32
#: Classes of a bucket that its others are checked against in step 2; members of a group may be no nearer to each other than
#: the threshold, so one lead would leave many out.
LEADS = 8
#: Share of the threshold from which on two classes are in one group, though they don't link.
NEAR = 2 / 3
#: Shingles of the classes that are compared at once, about, on either side.
TILE = 1 << 16
#: Odd multipliers of the permutations of step 2.
MIXES = (1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def shingles(text: str, words: int = WORDS) -> list[bytes]:
    """Shingles in order, repeats included: A-Z lower-cased words (cut at ASCII white space) joined by blanks."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if len(w) < words:
        return [b" ".join(w)] if w else []
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
    starts = (ends - 1 - np.fromiter(map(len, w), np.int64, len(w))).tolist()
    return [joined[a:b] for a, b in zip(starts, (ends[words - 1 :] - 1).tolist(), strict=False)]


def needed(n: int, threshold: int = THRESHOLD) -> int:
    """Least overlap of a set of n with any set that it links with."""
    return -(-threshold * n // 100)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of 64-bit numbers spread over all (a finalizer of public hash functions)."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


SPACE = np.zeros(256, bool)
SPACE[list(b" \t\n\x0b\x0c\r")] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[ord("A") : ord("Z") + 1] += ord("a") - ord("A")


def hashed(texts: pa.Array, words: int) -> Iterator[tuple[np.ndarray, int]]:
    """For each text the sorted distinct 64-bit hashes of its shingles, and how many shingles are distinct.

    The texts are cut into words as one array of bytes, equal words are hashed once, and a shingle's hash sums its words'
    hashes times odd factors of their places.
    """
    from xxhash import xxh3_64_intdigest as hash64

    if texts.null_count:
        texts = pa.array([t or "" for t in texts.to_pylist()], pa.string())
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    edges = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = LOWERED[np.frombuffer(data, np.uint8)[edges[0] : edges[-1]]] if data is not None else np.zeros(0, np.uint8)
    edges = edges - edges[0]
    ink = ~SPACE[raw]
    begins = ink.copy()
    begins[1:] &= ~ink[:-1]
    inner = edges[:-1][edges[:-1] < len(raw)]
    begins[inner] |= ink[inner]
    starts, letters = np.flatnonzero(begins), raw[ink]
    ends = np.append(np.flatnonzero(begins[ink]), len(letters)).astype(np.int32)
    coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(letters)]).dictionary_encode()
    own = np.fromiter(map(hash64, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    which = coded.indices.to_numpy()
    w = own[which] if len(own) else np.zeros(0, np.uint64)
    factors = mixed(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    full = max(0, len(w) - words + 1)
    total = np.zeros(full, np.uint64)
    for j in range(words):
        total += w[j : j + full] * factors[j]
    total = mixed(total)
    at = np.searchsorted(starts, edges)
    for a, b in zip(at.tolist(), at[1:].tolist(), strict=False):
        if b - a < words:
            few = (w[a:b] * factors[: b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a)
            yield (mixed(few), 1) if b > a else (np.zeros(0, np.uint64), 0)
            continue
        h = total[a : b - words + 1]
        order = np.sort(h)
        differ = order[1:] != order[:-1]
        if differ.all():
            yield order, len(order)
            continue
        place = np.argsort(h, kind="stable")
        same, then = a + place[:-1][~differ], a + place[1:][~differ]
        true = all((which[same + j] == which[then + j]).all() for j in range(words))
        n = int(differ.sum()) + 1 if true else len({tuple(which[a + k : a + k + words].tolist()) for k in range(len(h))})
        yield order[np.append(True, differ)], n


def _sketch(words: int, threshold: int):
    schema = pa.schema([("_id", pa.int64()), ("_mark", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("check", pa.int64()), ("mins", pa.list_(pa.int64())), ("toks", pa.list_(pa.int32())), ("inside", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as hash64

        mixes, limit = np.array(MIXES, np.uint64), np.uint64(int(REGION * 2**32) << 32)
        for batch in (p for b in batches for p in pieces(b, 2)):
            n, cls, check, mins, toks, inside = [], [], [], [], [], []
            for h, size in hashed(batch.column(2), words):
                n.append(size)
                if not size:
                    cls.append(None), check.append(None), mins.append(None), toks.append(None), inside.append(0)
                    continue
                cls.append(hash64(h.tobytes()) - 2**63)
                check.append(hash64(h.tobytes(), seed=1) - 2**63)
                mins.append((h[:, None] * mixes).min(0).view(np.int64))
                inside.append(int(np.searchsorted(h, limit)))
                keep = max(inside[-1], size - needed(size, threshold) + 1)
                toks.append((h[:keep] >> np.uint64(32)).astype(np.uint32).view(np.int32))
            longs = [pa.array(x, pa.int64()) for x in (n, cls, check)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *longs, pa.array(mins, pa.list_(pa.int64())), pa.array(toks, pa.list_(pa.int32())), pa.array(inside, pa.int64())], schema=schema)

    return lean(run)


def _prefixes(threshold: int):
    """Rows (cls, n, inside, line of (r, tok, hot) by rank) to the tokens of their prefixes, a batch at a time as flat arrays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, n, inside = (c.to_numpy() for c in batch.columns[:3])
            each = pc.list_value_length(batch.column(3)).to_numpy()
            r, tok, hot = (c.to_numpy(zero_copy_only=False) for c in batch.column(3).flatten().flatten())
            row = np.repeat(np.arange(len(each)), each)
            frequent = hot & (r < inside[row])
            sums = np.concatenate(([0], np.cumsum(frequent)))
            first = np.cumsum(each) - each
            before, total = sums[:-1] - sums[first][row], (sums[first + each] - sums[first])[row]
            place = np.where(frequent, inside[row] - total + before, np.where(r < inside[row], r - before, r))
            keep = place < (n - -(-threshold * n // 100) + 1)[row]
            yield pa.RecordBatch.from_arrays([pa.array(x[keep], t) for x, t in ((cls[row], pa.int64()), (n[row], pa.int64()), (tok, pa.int32()), (place, pa.int64()))], names=["cls", "n", "tok", "place"])

    return lean(run)


def _linked(words: int, threshold: int):
    """Rows sorted by (lo, hi), the texts of a pair of tiles before its pairs; the sets of one pair of tiles are held.

    Pairs that link, and pairs that are at least near, with which of both they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, {}

        def known(cls: int) -> set[int]:
            if isinstance(held[cls], np.ndarray):
                held[cls] = set(held[cls].tolist())
            return held[cls]

        for batch in (p for b in batches for p in pieces(b, 4)):
            found, sets = [], hashed(batch.column(4), words)
            for (lo, hi, a, b), (h, _) in zip(zip(*(c.to_pylist() for c in batch.columns[:4]), strict=True), sets, strict=True):
                if (lo, hi) != last:
                    last, held = (lo, hi), {}
                if b is None:
                    held[a] = h
                    continue
                x, y = known(a), known(b)
                both = len(x & y)
                either = len(x) + len(y) - both
                if 100 * both >= threshold * NEAR * either:
                    found.append((a, b, 100 * both >= threshold * either))
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.bool_()))], names=["a", "b", "links"])

    return lean(run)


class Block:
    """The members of a cell, with an index from shingles to members."""

    def __init__(self, cls: list[int], comps: list[int], sets: list[np.ndarray]):
        self.cls, self.comps, self.sizes = cls, np.array(comps), np.array([len(x) for x in sets])
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.shingles, self.owners = every[order], np.repeat(np.arange(len(sets)), self.sizes)[order]

    def links(self, x: np.ndarray, comp: int, threshold: int) -> Iterator[int]:
        """Members that the set x, of a component, links with: one of every other component."""
        lo, hi = np.searchsorted(self.shingles, x, "left"), np.searchsorted(self.shingles, x, "right")
        count = hi - lo
        stops = np.cumsum(count)
        at = np.repeat(lo - (stops - count), count) + np.arange(stops[-1])
        both = np.bincount(self.owners[at], minlength=len(self.cls))
        hits = np.flatnonzero((100 * both >= threshold * (len(x) + self.sizes - both)) & (self.comps != comp))
        for k in np.unique(self.comps[hits], return_index=True)[1].tolist():
            yield self.cls[hits[k]]


def _asked(words: int, threshold: int):
    """Rows sorted by cell, members before asking classes: links of these with members, one a component of the cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, members, block = None, [], None
        for batch in (p for b in batches for p in pieces(b, 6)):
            found = []
            for (g, i, k, asks, cls, comp), (h, _) in zip(zip(*(c.to_pylist() for c in batch.columns[:6]), strict=True), hashed(batch.column(6), words), strict=True):
                if (g, i, k) != last:
                    last, members, block = (g, i, k), [], None
                if not asks:
                    members.append((cls, comp, h))
                    continue
                if block is None:
                    block = Block([m[0] for m in members], [m[1] for m in members], [m[2] for m in members])
                    members = []
                if len(block.cls):
                    found += [(cls, other) for other in block.links(h, comp, threshold)]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return lean(run)


def lifted(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges between the components of their ends, without loops."""
    for end in ("a", "b"):
        edges = edges.join(labels.select(F.col("node").alias(end), F.col("component").alias(f"c{end}")), end, "left").withColumn(end, F.coalesce(f"c{end}", end)).drop(f"c{end}")
    return edges.select("a", "b").filter("a <> b")


class Join:
    """The join over one table of documents."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: int = THRESHOLD):
        self.spark, self.words, self.threshold = docs.sparkSession, words, threshold
        self.base, self.k = scratch(self.spark, "jaccard"), 0
        self.kept: list[str] = []
        #: sets of n and size are near enough in size to link
        self.alike = (100 * F.col("n") >= threshold * F.col("size")) & (100 * F.col("size") >= threshold * F.col("n"))
        self.rows = docs.select(F.col(id_col).cast("long").alias("_id"), row_mark(id_col, text_col).alias("_mark"), text_of(text_col).alias("_text"))
        self.sketch = self.renamed(self.keep(self.rows.mapInArrow(_sketch(words, threshold), "_id long, _mark long, n long, cls long, check long, mins array<long>, toks array<int>, inside long"), "sketch"))
        best = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_mark")).alias("rep")
        self.classes = self.keep(self.sketch.filter("cls is not null").groupBy("cls").agg(best, F.first("n").alias("n"), F.first("mins").alias("mins"), F.count("*").alias("rows")), "classes")

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """df written; what its stages shuffled may go."""
        self.k += 1
        self.kept.append(f"{self.base}/{self.k}-{name}")
        out = written(df, self.kept[-1])
        release(self.spark)
        return out

    def done(self, *names: str) -> None:
        """Tables that nothing reads any more go, so that disk holds what the next steps need."""
        for path in [p for p in self.kept if p.rsplit("/", 1)[-1].split("-", 1)[-1] in names]:
            delete(self.spark, path)
            self.kept.remove(path)

    def renamed(self, sketch: DataFrame) -> DataFrame:
        """sketch, with other class ids for different sets whose ids are equal by chance (some in 10^11 rows)."""
        clash = self.keep(sketch.groupBy("cls").agg(F.min("check").alias("low"), F.max("check").alias("high")).filter("low <> high").select(F.col("cls").alias("was")), "clashes")
        if not clash.limit(1).count():
            return sketch
        both = sketch.join(F.broadcast(clash), F.col("cls") == F.col("was"), "left")
        return self.keep(both.withColumn("cls", F.when(F.col("was").isNotNull(), F.xxhash64("cls", "check")).otherwise(F.col("cls"))).drop("was"), "renamed")

    def linked(self, pairs: DataFrame, name: str, groups: DataFrame | None = None) -> DataFrame:
        """Those pairs (a, b) of classes whose texts are near, and whether they link.

        Classes are dealt into tiles of about TILE shingles, those of a group or of equal first minimum together, and a text
        travels once for each pair of tiles that needs it, not once for each pair of classes.
        """
        pairs = self.keep(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-pairs")
        texts = self.keep(self.texts(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), groups), f"{name}-texts")
        tiles = max(1, (texts.agg(F.sum("n")).first()[0] or 0) // TILE)
        parts = F.pmod(F.xxhash64("cls"), F.ceil(F.col("load") / TILE))
        dealt = texts.select("cls", "n", "block").join(texts.groupBy("block").agg(F.sum("n").alias("load")), "block")
        dealt = self.keep(dealt.select("cls", F.pmod(F.xxhash64("block", parts), F.lit(tiles)).alias("tile")), f"{name}-tiles")
        at = lambda c: dealt.select(F.col("cls").alias(c), F.col("tile").alias(f"t{c}"))
        both = self.keep(pairs.join(at("a"), "a").join(at("b"), "b").select(F.least("ta", "tb").alias("lo"), F.greatest("ta", "tb").alias("hi"), "a", "b"), f"{name}-dealt")
        need = both.select("lo", "hi", F.explode(F.array("a", "b")).alias("cls")).distinct().join(texts.select("cls", "t"), "cls")
        rows = both.withColumn("t", F.lit(None).cast("string")).unionByName(need.select("lo", "hi", F.col("cls").alias("a"), F.lit(None).cast("long").alias("b"), "t"))
        rows = rows.repartition("lo", "hi").sortWithinPartitions("lo", "hi", F.col("b").isNotNull())
        links = self.keep(rows.mapInArrow(_linked(self.words, self.threshold), "a long, b long, links boolean"), f"{name}-links")
        self.done(*(f"{name}-{x}" for x in ("pairs", "texts", "tiles", "dealt")))
        return links

    def texts(self, wanted: DataFrame, groups: DataFrame | None = None) -> DataFrame:
        """(cls, n, block, t): a text of each wanted class; its block is its group, or else its first minimum."""
        wanted = wanted.join(self.classes, "cls").select("cls", "n", F.col("rep._id").alias("_i"), F.col("rep._mark").alias("_m"), F.get("mins", F.lit(0)).alias("block"))
        if groups is not None:
            wanted = wanted.join(groups.select(F.col("node").alias("cls"), F.col("component").alias("g")), "cls", "left").withColumn("block", F.coalesce("g", "block"))
        texts = wanted.join(self.rows, (F.col("_m") == F.col("_mark")) & F.col("_i").eqNullSafe(F.col("_id")))
        return texts.groupBy("cls").agg(F.first("n").alias("n"), F.first("block").alias("block"), F.first("_text").alias("t"))

    def stars(self) -> DataFrame:
        """Step 2: classes of a bucket against its leads, the least classes in LEADS random orders."""
        each = self.classes.select("cls", "n", F.posexplode("mins").alias("k", "m"))
        leads = F.array_distinct(F.array(*(F.min_by(F.struct("cls", "n"), F.xxhash64("cls", F.lit(i))) for i in range(LEADS))))
        lead = each.groupBy("k", "m").agg(leads.alias("leads"), F.count("*").alias("c")).filter("c > 1").select("k", "m", "leads")
        pairs = each.join(lead, ["k", "m"]).select(F.col("cls").alias("a"), "n", F.explode("leads").alias("x")).select("a", "n", F.col("x.cls").alias("b"), F.col("x.n").alias("size"))
        return self.linked(pairs.filter(F.col("a") != F.col("b")).filter(self.alike).select("a", "b"), "stars")

    def matrix(self) -> DataFrame:
        """(cls, n, m, line): tokens that occur in more than one row, by class, as (rank, token, frequent) in rank order."""
        each = self.sketch.filter("cls is not null").select("cls", "n", "inside", F.size("toks").alias("m"), F.posexplode("toks").alias("r", "tok"))
        shared = self.keep(each.groupBy("tok").agg(F.count("*").alias("c")).filter("c > 1").select("tok", (F.col("c") > FREQUENT).alias("hot")), "tokens")
        line = each.join(shared, "tok").groupBy("cls").agg(F.first("n").alias("n"), F.first("m").alias("m"), F.first("inside").alias("inside"), F.array_sort(F.collect_set(F.struct("r", "tok", "hot"))).alias("line"))
        # a class whose tokens are too few of them shared can't reach the overlap with any set: no group holds it, none opens
        # (others keep all their tokens of the counted region, so only there it shows that a token isn't shared)
        shared_inside = F.size(F.filter("line", lambda x: x["r"] < F.col("inside")))
        return self.keep(line.filter(shared_inside + F.col("n") - F.col("inside") >= F.ceil(F.col("n") * self.threshold / 100)), "matrix")

    def prefixes(self, matrix: DataFrame) -> DataFrame:
        """(cls, n, tok, place): the tokens of each class's prefix that others have too, and their places in the order.

        The order: light tokens of the counted region, its frequent ones, all others, each by hash.  A light token's place is
        its rank less the frequent ones before it, which is how far the filter moved it.
        """
        return matrix.select("cls", "n", "inside", "line").mapInArrow(_prefixes(self.threshold), "cls long, n long, tok int, place long")

    def opened(self, matrix: DataFrame, groups: DataFrame) -> DataFrame:
        """Step 3: (cls, group) of the groups that a class has to open."""
        named = groups.select(F.col("node").alias("cls"), F.col("component").alias("g"))
        prefix = self.keep(self.prefixes(matrix).join(named, "cls", "left").withColumn("g", F.coalesce("g", "cls")), "prefixes")
        several = prefix.groupBy("tok").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).filter("lo <> hi").select("tok")
        prefix = self.keep(prefix.join(several, "tok", "left_semi"), "met")
        # of two groups the smaller one's classes ask, so the members of a large group never ask its stragglers
        prefix = self.keep(split_join(prefix, prefix.groupBy("g").agg(F.count("*").alias("w")), ["g"], heavy(prefix, "g"), "inner"), "weighed")
        # all that two sets share comes at their first common token or later, so their places there bound the overlap: with
        # c of n and d of m tokens before it, it is at most n - c and m - d, and a link takes t (n + m) / (100 + t)
        t = self.threshold
        reach = 100 * F.col("n") - (100 + t) * F.col("place")
        column = prefix.groupBy("tok", "g").agg(F.min("n").alias("least"), F.max(reach).alias("reach"), F.first("w").alias("weight")).withColumnRenamed("g", "group")
        asks = (F.col("w") < F.col("weight")) | ((F.col("w") == F.col("weight")) & (F.col("g") < F.col("group")))
        near = asks & (100 * F.col("n") - (100 + t) * F.col("place") >= t * F.col("least")) & (F.col("reach") >= t * F.col("n"))
        met = self.keep(prefix.join(column, "tok").filter(near).select("cls", "n", "group").distinct(), "candidates")
        # bound the overlap with the group's union; tokens outside the counted region may all be common.  The union of a group
        # of one is its only member, and opening it is the comparison itself
        several = groups.select(F.col("component").alias("group")).distinct()
        wide = self.keep(met.join(several, "group", "left_semi"), "wide")
        lines = matrix.select("cls", "n", "inside", F.explode_outer(F.filter("line", lambda x: x["r"] < F.col("inside"))).alias("x")).select("cls", "n", "inside", "x.tok")
        mine = wide.join(lines.select("cls", "tok"), "cls")
        union = lines.select("cls", "tok").join(named, "cls").select(F.col("g").alias("group"), "tok").join(wide.select("group").distinct(), "group", "left_semi").distinct()
        overlap = mine.join(union, ["group", "tok"], "left_semi").groupBy("cls", "group").agg(F.count("*").alias("o"))
        bound = wide.join(overlap, ["cls", "group"], "left").join(matrix.select("cls", "inside"), "cls")
        bound = bound.filter(F.coalesce("o", F.lit(0)) + F.col("n") - F.col("inside") >= F.ceil(F.col("n") * t / 100)).select("cls", "n", "group")
        return self.keep(bound.unionByName(met.join(several, "group", "left_anti").select("cls", "n", "group")), "opened")

    def rest(self, groups: DataFrame, comps: DataFrame) -> DataFrame:
        """Step 4: links between members of opened groups."""
        opened = self.opened(self.matrix(), groups)
        self.done("tokens", "matrix", "prefixes", "met", "weighed", "candidates", "wide")
        several = groups.select(F.col("component").alias("group")).distinct()
        single = opened.join(several, "group", "left_anti").join(self.classes.select(F.col("cls").alias("group"), F.col("n").alias("size")), "group").filter(self.alike)
        links = self.linked(single.select(F.col("cls").alias("a"), F.col("group").alias("b")), "rest", groups).filter("links").select("a", "b")
        wide = opened.join(several, "group", "left_semi").select("group", "cls").unionByName(self.parted(groups, comps))
        return links.unionByName(self.asked(wide, groups, comps))

    def parted(self, groups: DataFrame, comps: DataFrame) -> DataFrame:
        """(group, cls): classes outside of the largest component of their own group.  Of two classes all is known."""
        part = F.coalesce("component", "cls").alias("part")
        named = self.keep(groups.select(F.col("node").alias("cls"), F.col("component").alias("group")).join(comps.withColumnRenamed("node", "cls"), "cls", "left").select("group", "cls", part), "parts")
        sizes = named.groupBy("group", "part").agg(F.count("*").alias("c"))
        most = sizes.groupBy("group").agg(F.max_by("part", F.struct("c", "part")).alias("most"), F.sum("c").alias("all"), F.count("*").alias("parts")).filter("parts > 1 and all > 2")
        return named.join(most, "group").filter("part <> most").select("group", "cls")

    def asked(self, wide: DataFrame, groups: DataFrame, comps: DataFrame) -> DataFrame:
        """Links of classes with members of the groups of several that they open.

        The members of a group and the classes that open it are dealt into tiles of about TILE shingles; a cell is a tile of
        either, so rows are tiles times texts, never pairs of classes.
        """
        wide = self.keep(wide.join(self.classes.select("cls", "n"), "cls"), "asking")
        members = groups.select(F.col("node").alias("cls"), F.col("component").alias("group")).join(wide.select("group").distinct(), "group", "left_semi").join(self.classes.select("cls", "n"), "cls")
        sides = members.select("group", "cls", "n", F.lit(0).alias("asks")).unionByName(wide.select("group", "cls", "n", F.lit(1).alias("asks")))
        part = F.coalesce("component", "cls").alias("part")
        sides = self.keep(sides.join(comps.withColumnRenamed("node", "cls"), "cls", "left").select("group", "cls", "n", "asks", part), "sides")
        parts = lambda k: F.greatest(F.lit(1), F.ceil(F.sum(F.when(F.col("asks") == k, F.col("n")).otherwise(0)) / TILE)).cast("int")
        cells = sides.groupBy("group").agg(parts(0).alias("p0"), parts(1).alias("p1"))
        own = F.pmod(F.xxhash64("cls"), F.when(F.col("asks") == 0, F.col("p0")).otherwise(F.col("p1"))).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.when(F.col("asks") == 0, F.col("p1")).otherwise(F.col("p0")) - 1))
        dealt = sides.join(cells, "group").select("group", "cls", "part", "asks", own.alias("own"), other.alias("other"))
        dealt = dealt.select("group", F.when(F.col("asks") == 0, F.col("own")).otherwise(F.col("other")).alias("i"), F.when(F.col("asks") == 0, F.col("other")).otherwise(F.col("own")).alias("k"), "asks", "cls", "part")
        texts = self.keep(self.texts(sides.select("cls").distinct()).select("cls", "t"), "asked-texts")
        rows = dealt.join(texts, "cls").select("group", "i", "k", "asks", "cls", "part", "t").repartition("group", "i", "k").sortWithinPartitions("group", "i", "k", "asks", "cls")
        links = self.keep(rows.mapInArrow(_asked(self.words, self.threshold), "a long, b long"), "asked-links")
        self.done("sides", "asking", "asked-texts")
        return links

    @staticmethod
    def outer(nodes: DataFrame, inner: DataFrame, outer: DataFrame) -> DataFrame:
        """(node, component): of every node its label in outer of its label in inner, where it has them."""
        got = nodes.join(inner, "node", "left").select("node", F.coalesce("component", "node").alias("mid"))
        return got.join(outer.select(F.col("node").alias("mid"), "component"), "mid", "left").select("node", F.coalesce("component", "mid").alias("component"))

    def result(self) -> DataFrame:
        """_id, _mark, n_shingles, component_id of every row, and _group: its component, null if it has no words."""
        stars = self.stars()
        comps = components(stars.filter("links").select("a", "b"))
        near = components(lifted(stars, comps))
        ends = stars.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        groups = self.keep(self.outer(ends, comps, near), "groups")
        more = components(lifted(self.rest(groups, comps), comps))
        named = self.outer(self.classes.select(F.col("cls").alias("node")), comps, more).select(F.col("node").alias("cls"), F.col("component").alias("g"))
        roots = self.keep(self.classes.join(named, "cls", "left").select("cls", F.col("rep._id").alias("low"), F.coalesce("g", "cls").alias("g")), "roots")
        lows = roots.groupBy("g").agg(F.min("low").alias("component_id"))
        by_class = roots.join(lows, "g").select(F.col("cls").alias("_c"), "component_id", F.col("g").alias("_group"))
        out = self.sketch.join(by_class, self.sketch["cls"] == by_class["_c"], "left")
        return out.select("_id", "_mark", F.col("n").alias("n_shingles"), F.coalesce("component_id", "_id").alias("component_id"), "_group")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """One row a row of docs: id_col, n_shingles, component_id (the smallest id reachable by links)."""
    return Join(docs, id_col, text_col, words, threshold).result().select(F.col("_id").alias(id_col), "n_shingles", "component_id")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir))


SQL = {
    "op4_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * common >= 75 * (x.n + y.n - common)),
r AS (SELECT doc_id AS n, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.n)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT n, min(c) AS c FROM r GROUP BY n) m ON m.n = d.doc_id""",
}
QUERIES = {"op4_ngram_jaccard_join": op4_ngram_jaccard_join}
