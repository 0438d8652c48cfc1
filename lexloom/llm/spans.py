"""Positions of pattern matches as native column expressions, shared by the PII and secret operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,value:string>>"


#: Matches whose places are summed up at once; a text's blocks are joined afterwards.
BLOCK = 64


def find(text: Column, pattern: str, needs: Column | None = None) -> Column:
    """Leftmost non-overlapping matches of a Java pattern with their code points [start, end).

    split() with no limit gives the text between the matches that regexp_extract_all() gives, so the positions are running
    sums of both lengths.  Arrays grow by copying, so sums are formed block by block and then over blocks, which keeps a text
    of very many matches cheap.  Patterns must not match the empty string.  needs, a cheap test of the text, spares texts that
    can hold no match the search.
    """
    hits, none = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.array().cast(SPAN)
    zero = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["value"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value")))).alias("out"))

    once = lambda x, f: F.get(F.transform(F.array(x), f), F.lit(0))
    pairs = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)), hits, lambda g, h: F.struct(g.alias("gap"), h.alias("value")))

    def placed(all_: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int")), lambda k: F.aggregate(F.slice(all_, k * BLOCK + 1, F.lit(BLOCK)), zero, step))
        sums = lambda bs: F.aggregate(bs, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")), lambda acc, b: F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts")), lambda acc: acc["starts"])
        moved = lambda b, at: F.transform(b["out"], lambda s: F.struct((s["start"] + at).alias("start"), (s["end"] + at).alias("end"), s["value"].alias("value")))
        return once(blocks, lambda bs: F.flatten(F.zip_with(bs, sums(bs), moved)))

    few = F.aggregate(pairs, zero, step, lambda acc: acc["out"])
    nothing = F.size(hits) == 0
    nothing = nothing if needs is None else F.when(needs, nothing).otherwise(True)
    return F.when(nothing, none).when(F.size(hits) <= BLOCK, few).otherwise(once(pairs, placed))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.split(F.reverse(number), "")
    total = F.aggregate(
        F.transform(back, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))),
        F.lit(0),
        lambda a, x: a + F.coalesce(x, F.lit(0)),
    )
    return total % 10 == 0


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined, of an array of (start, rank, end, kind, ...) that is sorted."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def ranked(spans: Column, rank: int, kind: str) -> Column:
    """Spans with their kind, in a shape that sorts by start and then by rank."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["value"].alias("value")))
