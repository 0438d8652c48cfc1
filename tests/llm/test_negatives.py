"""Hard negatives against brute force, on vectors of every kind."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, rank int, x string, uid long, ids int"


def plain(rows, positives=5, most=10, band=(30, 90)):
    """(anchor, positive, rank, negative, positive score, negative score), row by row in whole numbers."""
    def number(v, n):
        limit = math.isqrt((1 << 56) // max(1, n))
        return int(max(-limit, min(limit, math.floor(v) if abs(v) < 1e300 else math.copysign(limit, v))))

    rows = [(k, [number(256 * x, len(v)) for x in v], c) for k, v, c, *_ in rows if c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (a, x, label) in enumerate(rows):
        if a is None or a % 100:
            continue
        scored = [(-sum(p * q for p, q in zip(x, y, strict=True)), b is None, b or 0, c) for m, (b, y, c) in enumerate(rows) if m != n and len(x) == len(y)]
        name = lambda r: None if r[1] else r[2]
        for p in sorted(r for r in scored if r[3] == label)[:positives]:
            fit = sorted(r for r in scored if r[3] != label and band[0] * -p[0] <= 100 * -r[0] <= band[1] * -p[0])[:most]
            out += [(a, name(p), k + 1, name(r), -p[0], -r[0]) for k, r in enumerate(fit)]
    return Counter(out)


def mined(spark, rows, **more):
    vectors = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)
    return Counter(tuple(r) for r in negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0, **more).collect())


def grouped(rng, n, dim=8, groups=6):
    """Vectors around a few centres of several lengths."""
    centres = [[rng.gauss(0, 1 + k) for _ in range(dim)] for k in range(groups)]
    return [(k, [c + rng.gauss(0, 0.2) for c in centres[rng.randrange(groups)]], rng.randrange(4)) for k in range(n)]


@pytest.mark.parametrize("block", [16, 1024])
def test_negatives_equal_brute_force(spark, block):
    rng = random.Random(4)
    rows = grouped(rng, 900)
    rows += [(900 + k, [1.0, 0.5] * 4, 1) for k in range(150)]  # one vector, many times
    rows += [(2000 + k, [0.01 * rng.randrange(-2, 3) for _ in range(8)], rng.randrange(3)) for k in range(150)]  # ties, zeros, negative scores
    rows += [(100, rows[3][1], 2), (100, rows[3][1], 2), (None, rows[5][1], 1), (None, rows[5][1], 1), (-100, rows[7][1], -3)]
    rows += [(7000, None, 1), (7100, rows[1][1], None), (7200, [float("nan")] * 8, 1), (7300, [1.0, None] * 4, 1), (7400, [float("inf")] * 8, 1)]
    rows += [(8000 + 50 * k, [rng.random() for _ in range(3)], k % 2) for k in range(12)] + [(8900, [], 1), (8901, [], 1), (8902, [], 2)]
    got = mined(spark, rows, block=block, segment=2, group=3)
    want = plain(rows)
    assert got == want and len(want) > 300


def test_numbers_near_the_limit(spark):
    rng = random.Random(2)
    rows = [(50 * k, [rng.choice([1e308, -1e308, 3.3e7, 1e5, 0.1, 5e-324]) for _ in range(4)], k % 3) for k in range(60)]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, rows, positives=2, negatives=3, band=(0, 100)) == plain(rows, 2, 3, (0, 100))


def test_no_rows_and_no_anchors(spark):
    assert not mined(spark, []) and not mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) and not mined(spark, [(100, [1.0], 1)])


def test_bounds_spare_work(spark):
    """With vectors of one length in groups, an anchor meets a part of the blocks only."""
    rng = random.Random(9)
    unit = lambda v: [x / math.hypot(*v) for x in v]
    rows = [(k, unit(v), c) for k, v, c in grouped(rng, 4000, dim=6, groups=12)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    index = negatives.Index(vectors, F.col("vec_id") % 100 == 0, block=64, segment=1, group=1)
    everything = index.anchors.select("uid", F.array(F.lit(-negatives.FAR)).alias("lows"), F.array(F.lit(negatives.FAR)).alias("highs"))
    index.search(everything, True, 5, "t")
    met = spark.read.parquet(*(f"{index.base}/t-{k}-cells" for k in range(3))).select("segment", "group").distinct().count()
    assert met < 0.5 * index.ranges.select("segment").distinct().count() * index.anchors.select("group").distinct().count()


def test_products_are_exact_at_every_size():
    rng = np.random.default_rng(1)
    for top in (10, 1 << 10, 1 << 20, 1 << 26):
        a, x = rng.integers(-top, top, (5, 16)), rng.integers(-top, top, (7, 16))
        assert negatives.products(a, x).tolist() == [[sum(int(p) * int(q) for p, q in zip(r, s, strict=True)) for s in x] for r in a]
