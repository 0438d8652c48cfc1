"""Language identification of mixed texts: script ranges, trigram scores of words, Viterbi with a switching penalty.

Training counts, per language, the hashed character trigrams of all labelled training texts (no sample) and how often
letters of each script occur; both are bounded tables (``BUCKETS`` x languages, scripts x languages), summed on the
executors before they reach the driver.  A word's score for a language is the sum of its trigrams' log-probabilities; its
script leaves only the languages that write in it as candidates: the others lose 10,000, more than any text's trigrams could
make up for within a word.  Viterbi over a text's words, with ``PENALTY`` for every
change of language, labels its spans; the text gets the language of most letters, and the share of those letters as score.

Viterbi runs over whole batches of texts with array operations: one language for the whole text is the best path if no
stretch of words favours another language by the penalty, and the start and the end of the text, together, don't favour
others by it either (a path that never visits the language saves a switch).  Summed scores and their running minima tell;
only the other texts are decoded word by word.

Defined results: a null text, or one without a letter, is ``und`` with score 0; if there is nothing to learn from, every text
is ``und``; a null language teaches nothing; repeated rows get equal results; ties go to the first language by name.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm.shared import documents, lean, pieces

BUCKETS = 1 << 16
PENALTY = 12.0
#: A language may write in a script if at least this share of its training letters does.
LEAST_SCRIPT = 0.01
#: Code points that one array step works on.
STEP = 1 << 18
#: First code points of script ranges; a range reaches to the next (fixed values of the Unicode blocks).
SCRIPTS = (0x0, 0x250, 0x370, 0x400, 0x530, 0x590, 0x600, 0x700, 0x900, 0x980, 0xA00, 0xB80, 0xE00, 0x10A0, 0x1100, 0x1200, 0x1E00, 0x1F00, 0x2000, 0x2E80, 0x3040, 0x3100, 0x3400, 0xA000, 0xAC00, 0xD7B0, 0x10000)
MIX = np.uint64(0x9E3779B97F4A7C15)

_tables: dict[str, np.ndarray] = {}


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if "letter" not in _tables:
        _tables["letter"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _tables["letter"]


def words_of(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of letters."""
    inside = np.concatenate(([False], letters()[points], [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[0::2], edge[1::2]


def grams(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigram of every letter with its neighbours (a word's edges count as blanks), and the words' offsets."""
    inside = letters()[points]
    p = np.where(inside, points, 32).astype(np.uint64)
    before, after = np.concatenate(([np.uint64(32)], p[:-1])), np.concatenate((p[1:], [np.uint64(32)]))
    h = (before * np.uint64(2097152) + p) * np.uint64(2097152) + after
    h = ((h * MIX) >> np.uint64(48)).astype(np.int64)
    sizes = ends - starts
    return h[inside], np.concatenate(([0], np.cumsum(sizes)))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")


def _count(langs: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {x: k for k, x in enumerate(langs)}
        found, scripts = np.zeros((len(langs), BUCKETS), np.int64), np.zeros((len(langs), len(SCRIPTS)), np.int64)
        for batch in (p for b in batches for p in pieces(b, 0)):
            by: dict[int, list[str]] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by.setdefault(index[lang], []).append(text)
            for k, texts in by.items():
                for part in slices(texts):
                    points = code_points(" ".join(texts[i] for i in part))
                    starts, ends = words_of(points)
                    h, _ = grams(points, starts, ends)
                    found[k] += np.bincount(h, minlength=BUCKETS)
                    scripts[k] += np.bincount(np.searchsorted(SCRIPTS, points[letters()[points]], "right") - 1, minlength=len(SCRIPTS))
        for k in range(len(langs)):
            at = np.flatnonzero(found[k])
            s = np.flatnonzero(scripts[k])
            slot = np.concatenate((at, BUCKETS + s))
            if len(slot):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(slot), k)), pa.array(slot), pa.array(np.concatenate((found[k][at], scripts[k][s])))], names=["lang", "slot", "n"])

    return lean(run)


def slices(texts: list[str]) -> Iterator[range]:
    """Ranges of texts of about STEP code points; a longer text is alone."""
    first = size = 0
    for k, t in enumerate(texts):
        if size and size + len(t) > STEP:
            yield range(first, k)
            first, size = k, 0
        size += len(t) + 1
    if first < len(texts):
        yield range(first, len(texts))


class Model:
    """Log-probabilities of trigrams and the scripts of each language."""

    def __init__(self, langs: list[str], found: np.ndarray, scripts: np.ndarray, penalty: float = PENALTY):
        self.langs, self.penalty = langs, penalty
        total = found.sum(1, keepdims=True)
        self.logp = np.log((found + 0.5) / (total + 0.5 * BUCKETS)).T.astype(np.float32).copy()
        share = scripts / np.maximum(1, scripts.sum(1, keepdims=True))
        allowed = share >= LEAST_SCRIPT
        allowed[:, ~allowed.any(0)] = True  # nobody writes in it: all stay candidates
        self.barred = np.where(allowed, 0.0, -1e4).T.astype(np.float64)

    def dumps(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, langs=np.array(self.langs), logp=self.logp, barred=self.barred, penalty=self.penalty)
        return out.getvalue()

    @classmethod
    def loads(cls, raw: bytes) -> Model:
        z, m = np.load(io.BytesIO(raw)), cls.__new__(cls)
        m.langs, m.logp, m.barred, m.penalty = z["langs"].tolist(), z["logp"], z["barred"], float(z["penalty"])
        return m

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, language) of the labelled spans of one text, in code points of its lower-cased form."""
        points = code_points(text)
        starts, ends = words_of(points)
        if not len(starts) or not self.langs:
            return []
        path = viterbi(self._scores(points, starts, ends), self.penalty)
        cut = np.flatnonzero(np.diff(path)) + 1
        return [(int(starts[a]), int(ends[b - 1]), self.langs[path[a]]) for a, b in zip(np.concatenate(([0], cut)), np.concatenate((cut, [len(path)])), strict=True)]

    def _scores(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h, offsets = grams(points, starts, ends)
        rows = np.add.reduceat(self.logp[h], offsets[:-1], axis=0, dtype=np.float64)
        return rows + self.barred[np.searchsorted(SCRIPTS, points[starts], "right") - 1]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        if self.langs:
            for part in slices([t or "" for t in texts]):
                self._predict(texts, part, out)
        return out

    def _predict(self, texts: list[str | None], part: range, out: list[tuple[str, float]]) -> None:
        each = [code_points(texts[k] or "") for k in part]
        blank = np.array([32], "<u4")
        points = np.concatenate([x for e in each for x in (e, blank)])
        stops = np.cumsum([len(e) + 1 for e in each])
        starts, ends = words_of(points)
        if not len(starts):
            return
        scores = self._scores(points, starts, ends)
        sizes = (ends - starts).astype(np.float64)
        first = np.searchsorted(starts, np.concatenate(([0], stops[:-1])))
        last = np.concatenate((first[1:], [len(starts)]))
        for k, a, b in zip(part, first, last, strict=True):
            if a == b:
                continue
            s = scores[a:b]
            best = only(s, self.penalty)
            if best is not None:
                out[k] = (self.langs[best], 1.0)
                continue
            weight = np.bincount(viterbi(s, self.penalty), sizes[a:b], len(self.langs))
            top = int(weight.argmax())
            out[k] = (self.langs[top], float(weight[top] / weight.sum()))


def only(scores: np.ndarray, penalty: float) -> int | None:
    """The language of the best path if it is surely one for all words, else None."""
    best = int(scores.sum(0).argmax())
    gain = np.cumsum(scores - scores[:, best : best + 1], axis=0)
    low = np.minimum.accumulate(np.vstack((np.zeros((1, scores.shape[1])), gain[:-1])), axis=0)
    # a path with the language pays a switch for every stretch of others, one without it a switch less: for all but the last
    ends = gain[:-1].max() + (gain[-1] - gain[:-1]).max() if len(gain) > 1 else -np.inf
    return best if (gain - low).max() < penalty and ends < penalty else None


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """The best path over words, each change of language costing the penalty."""
    n, width = scores.shape
    back = np.empty((n, width), np.int32)
    now, own = scores[0].copy(), np.arange(width)
    for k in range(1, n):
        top = int(now.argmax())
        stay = now >= now[top] - penalty
        back[k] = np.where(stay, own, top)
        now = np.where(stay, now, now[top] - penalty) + scores[k]
    path = np.empty(n, np.int64)
    path[-1] = now.argmax()
    for k in range(n - 1, 0, -1):
        path[k - 1] = back[k, path[k]]
    return path


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", penalty: float = PENALTY) -> Model:
    """A model of all rows of docs with a language and a text."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("text is not null and lang is not null")
    langs = sorted(r.lang for r in rows.select("lang").distinct().collect())  # one row a language
    found, scripts = np.zeros((len(langs), BUCKETS)), np.zeros((len(langs), len(SCRIPTS)))
    if langs:
        sums = rows.mapInArrow(_count(langs), "lang long, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
        t = sums.toArrow()  # at most languages x (BUCKETS + scripts) rows
        lang, slot, n = (t.column(c).to_numpy() for c in ("lang", "slot", "n"))
        gram = slot < BUCKETS
        found[lang[gram], slot[gram]] = n[gram]
        scripts[lang[~gram], slot[~gram] - BUCKETS] = n[~gram]
    return Model(langs, found, scripts, penalty)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score; input columns of these names are replaced."""
    raw = docs.sparkSession.sparkContext.broadcast(model.dumps())  # BUCKETS x languages x 4 bytes
    docs = docs.drop("lang_pred", "score")
    at, schema = docs.columns.index(text_col), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model.loads(raw.value)
        for batch in (p for b in batches for p in pieces(b, at)):
            got = m.predict(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    from pyspark.sql.types import DoubleType, StringType

    return docs.mapInArrow(lean(run), type(schema)([*schema.fields]).add("lang_pred", StringType()).add("score", DoubleType()))


def fold(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = F.coalesce(fold() == 1, F.lit(False))
    model = train(docs.filter(~out))
    return identify(docs.select("doc_id", "text", out.alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {"op8_language_id": op8_language_id}
