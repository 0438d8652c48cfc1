"""Mixing by weighted fair queueing against plain Python."""

import math
import re
from collections import Counter, defaultdict

import pytest

from lexloom.llm import mixing
from tests.llm import brute

WHITE = re.compile(r"[^ \t-\r]+")


def levels(sizes, weights=(1, 2, 3), epochs=3, budget=None):
    """Targets by resharing the excess, round after round."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    budget, open_, out = sum(sizes.values()) if budget is None else budget, set(names), {}
    while open_:
        left, w = budget - sum(out.values()), sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / w > epochs * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / w for s in open_}
        out |= {s: epochs * sizes[s] for s in over}
        open_ -= over
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, _key int, taken string, target int, epoch int")


def odd_rows():
    rows = [(k, t, f"src{k % 3}" if k % 5 else None, 0, 1, "x", 2, 3) for k, t in enumerate(brute.ODD)]
    rows += [(100 + k, "w " * (k % 7), "hot", 0, 1, "x", 2, 3) for k in range(60)]
    rows += [(7, "a b c", "hot", 0, 1, "x", 2, 3)] * 9 + [(None, "a b", "small", 0, 1, "x", 2, 3)] * 2 + [(None, "q", None, 0, 1, "x", 2, 3)]
    return rows + [(500, "only empty words", "", 0, 1, "x", 2, 3), (501, None, "nothing", 0, 1, "x", 2, 3), (502, "z " * 3000, "é", 0, 1, "x", 2, 3)]


def test_a_mix_equals_its_rules(spark):
    rows = odd_rows()
    mix = mixing.Mix(frame(spark, rows))
    got = mix.taken().collect()
    size = lambda t: len(WHITE.findall(t or ""))
    assert Counter((r._id, r._size, r._source) for r in got) == Counter((r[0], size(r[1]), r[2]) for r in rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2]] += size(r[1])
    want = levels(sizes)
    took = Counter()
    for r in got:
        assert r.source_size == sizes[r._source] and r.target == pytest.approx(want[r._source])
        assert 0 <= r.taken <= 3 * r._size
        took[r._source] += r.taken
    for s, t in want.items():
        assert t - 1 - 1e-6 <= took[s] <= t + 1e-6
    # the order: finish times never fall, positions are the words before
    entries = sorted(mix.entries.collect(), key=lambda r: r.position)
    at = 0
    for a, b in zip(entries, entries[1:], strict=False):
        assert a.finish <= b.finish + 1e-12
    for r in entries:
        assert r.position == at
        at += r.taken
    assert at == sum(math.floor(t) for t in want.values()) <= sum(sizes.values())
    # an epoch begins when the one before has ended
    for s in sizes:
        own = [r.epoch for r in entries if r._source == s]
        assert own == sorted(own)


def test_mixed_texts_hold_the_words_taken(spark):
    rows = odd_rows()
    docs = frame(spark, rows)
    mix = mixing.Mix(docs, budget=700, weights=(5, 1), epochs=2)
    texts = mix.mixed_texts().collect()
    assert set(docs.columns) < set(texts[0].asDict()) and all((r._key, r.taken, r.target, r.epoch) == (1, "x", 2, 3) for r in texts)
    entries = mix.entries.collect()
    assert Counter((r.doc_id, len(WHITE.findall(r.text))) for r in texts) == Counter((r._id, r.taken) for r in entries)
    assert sum(r.taken for r in entries) <= 700 and sum(r.taken for r in entries) > 690


def test_a_mix_is_the_same_for_any_partitioning(spark):
    docs = frame(spark, odd_rows())
    taken = lambda d: Counter((r._id, r._source, r._size, r.target, r.taken) for r in mixing.Mix(d).taken().collect())
    assert taken(docs.repartition(1)) == taken(docs.repartition(7, "text"))


def test_sources_beyond_the_broadcast_and_empty_tables(spark):
    rows = [(k, "a b c d", "hot" if k % 3 else f"s{k % 40:02}", 0, 1, "x", 2, 3) for k in range(3000)]
    got = mixing.Mix(frame(spark, rows)).taken().collect()
    want, took = levels(Counter({s: 4 * n for s, n in Counter(r[2] for r in rows).items()})), Counter()
    for r in got:
        took[r._source] += r.taken
    assert len(got) == 3000 and all(abs(took[s] - t) <= 1 for s, t in want.items())
    none = mixing.Mix(frame(spark, []))
    assert none.taken().count() == 0 and none.mixed_texts().count() == 0
    bare = mixing.Mix(frame(spark, [(1, None, None, 0, 1, "x", 2, 3), (2, " \n", "a", 0, 1, "x", 2, 3)])).taken().collect()
    assert [(r.target, r.taken, r.source_size) for r in bare] == [(0.0, 0, 0)] * 2
