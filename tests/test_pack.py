"""Lines packed into pieces: equal to a fold over lines, and linear in the length of a text."""

import time

import pytest
from pyspark.sql import functions as F

from lexloom.operators import silver


def fold(text, target):
    """The rule as a loop: a piece closes before a line that would make it longer than target."""
    if text is None:
        return None
    pieces = []
    for line in text.split("\n"):
        if pieces and len(pieces[-1]) + 1 + len(line) <= target:
            pieces[-1] += "\n" + line
        else:
            pieces.append(line)
    return pieces


ODD = [None, "", "\n", "\n\n\n", "a", "a\n", "\na", "abc\nabcdefghijkl\nabc\nde", "x" * 50, "\U0001f600a\n" * 40, "\U0001f600\n\U0001f600\U0001f600", "a\r\nb\r\n", "a b\nc", "\n" * 30 + "end", "abcde\nabcd"]


@pytest.mark.parametrize("target", [-1, 0, 1, 5, 10, 11, 3200])
def test_odd_texts(spark, target):
    df = spark.createDataFrame(list(enumerate(ODD)), "n int, text string").select("n", silver.pack_lines(F.col("text"), target).alias("p"))
    assert {r.n: r.p for r in df.collect()} == {k: fold(t, target) for k, t in enumerate(ODD)}


@pytest.mark.parametrize("target", [40, 400])
def test_all_documents(spark, sf, target):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("text", silver.pack_lines(F.col("text"), target).alias("p")).collect()
    assert rows and all(r.p == fold(r.text, target) for r in rows)


def test_a_million_lines(spark):
    def took(lines):
        df = spark.range(1).select(silver.pack_lines(F.repeat(F.concat(F.repeat(F.lit("w"), 20), F.lit("\n")), lines), 3200).alias("p"))
        start = time.monotonic()
        assert df.select(F.size("p")).first()[0] == -(-(lines) // 152) + (lines % 152 == 0)
        return time.monotonic() - start

    took(1000)
    assert took(1_000_000) < 20
