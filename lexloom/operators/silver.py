"""Versioned units, greedy chunks and their lifecycle, all set-wise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions import ids


def latest(df: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """The last row of each key by order; give enough order columns to make it unique."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


#: Snapshots of a source that one task folds.
STRETCH = 4096


def history(snapshots: DataFrame, rows: DataFrame, source: list[str], key: list[str], at: str = "at", hash_col: str = "text_hash") -> DataFrame:
    """All versions of all keys at once: rows with valid_from, valid_to and is_current, one for each stretch of snapshots of its
    source in which a key has the same hash.

    snapshots (source..., at) are the registered versions of each source, in any order, late ones included; rows (source...,
    key..., at, hash, ...) say what each holds.  A key that a snapshot lacks ends there; one whose hash comes back begins a version of its own.
    Of a key that a snapshot repeats the row of the least hash counts, and of equal ones any.  A version has the other columns of its first row.

    Stretches are folded in pieces of at most STRETCH snapshots, so a key of very many versions is no single task; pieces meet
    at their ends only.
    """
    seen = snapshots.select(*source, at).distinct()
    number = Window.partitionBy(*source).orderBy(at)
    numbered = seen.withColumns({"_n": F.row_number().over(number) - 1, "_next": F.lead(at).over(number)})
    own = rows.join(numbered.select(*(F.col(c).alias(f"_s{i}") for i, c in enumerate([*source, at])), "_n", "_next"), [F.col(c).eqNullSafe(F.col(f"_s{i}")) for i, c in enumerate([*source, at])]).drop(*(f"_s{i}" for i in range(len(source) + 1)))
    whole = list(dict.fromkeys([*source, *key]))
    rest = [c for c in rows.columns if c not in (*whole, at, hash_col)]
    once = own.groupBy(*whole, "_n").agg(F.min_by(F.struct(F.col(hash_col).alias("hash"), F.struct(at, "_next", *rest).alias("row")), F.coalesce(hash_col, F.lit(""))).alias("_r"))
    once = once.select(*whole, "_n", F.col("_r.hash").alias("_h"), F.col("_r.row").alias("_row"), F.floor(F.col("_n") / STRETCH).alias("_p"))
    w = Window.partitionBy(*whole, "_p").orderBy("_n")
    begins = ~F.coalesce((F.lag("_n").over(w) == F.col("_n") - 1) & F.lag("_h").over(w).eqNullSafe(F.col("_h")), F.lit(False))
    island = once.withColumn("_begins", begins.cast("int")).withColumn("_i", F.sum("_begins").over(w))
    pieces = island.groupBy(*whole, "_p", "_i").agg(F.min("_n").alias("_from"), F.max("_n").alias("_to"), F.first("_h").alias("_h"), F.min_by("_row", "_n").alias("_first"), F.max_by("_row", "_n").alias("_last"))
    edge = (F.col("_from") % STRETCH == 0) | (F.col("_to") % STRETCH == STRETCH - 1)
    v = Window.partitionBy(*whole).orderBy("_from")
    goes_on = F.coalesce((F.lag("_to").over(v) == F.col("_from") - 1) & F.lag("_h").over(v).eqNullSafe(F.col("_h")), F.lit(False))
    met = pieces.filter(edge).withColumn("_i", F.when(goes_on, 0).otherwise(1)).withColumn("_i", F.sum("_i").over(v))
    met = met.groupBy(*whole, "_i").agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"), F.first("_h").alias("_h"), F.min_by("_first", "_from").alias("_first"), F.max_by("_last", "_to").alias("_last"))
    both = pieces.filter(~edge).select(*whole, "_h", "_first", "_last").unionByName(met.select(*whole, "_h", "_first", "_last"))
    return both.select(*whole, F.col("_h").alias(hash_col), *(F.col(f"_first.{c}").alias(c) for c in rest), F.col(f"_first.{at}").alias("valid_from"), F.col("_last._next").alias("valid_to"), F.col("_last._next").isNull().alias("is_current"))


def live(units: DataFrame) -> DataFrame:
    return units.filter("is_current AND NOT is_repealed AND in_force")


def scd2_compare(current: DataFrame, parsed: DataFrame, key: list[str], hash_col: str = "text_hash") -> DataFrame:
    """Full-outer comparison of current rows with a new parse: key, old and new hash, change."""
    old = current.select(*(F.col(k).alias(f"o_{k}") for k in key), F.col(hash_col).alias("old_hash"))
    new = parsed.select(*key, F.col(hash_col).alias("new_hash"))
    on = [new[k].eqNullSafe(old[f"o_{k}"]) for k in key]
    both = new.join(old, on, "full_outer")
    change = F.when(F.col("old_hash").isNull(), "added").when(F.col("new_hash").isNull(), "removed").when(F.col("old_hash") == F.col("new_hash"), "unchanged").otherwise("changed")
    return both.select(*(F.coalesce(k, f"o_{k}").alias(k) for k in key), "old_hash", "new_hash", change.alias("change"))


def scd2(existing: DataFrame, parsed: DataFrame, key: list[str], now: Column, id_of: Column | None = None) -> DataFrame:
    """Rows to merge: closed versions of changed and removed keys, open versions of changed and added ones.

    existing and parsed have unit_id, text_hash and key; of a key that a parse repeats the last by unit_order counts.  A text
    that returns to an earlier version takes that version's unit_id, and so replaces its closed row; give id_of to version it.
    """
    if "unit_order" in parsed.columns:
        parsed = latest(parsed, key, F.col("unit_order").desc())
    current = existing.filter("is_current")
    diff = scd2_compare(current, parsed, key)
    closed = current.join(diff.filter("change IN ('changed', 'removed')").select(*key), key, "left_semi").withColumns({"valid_to": now, "is_current": F.lit(False)})
    opened = parsed.join(diff.filter("change IN ('changed', 'added')").select(*key), key, "left_semi")
    opened = opened.withColumns({"valid_from": now, "valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True)})
    if id_of is not None:
        opened = opened.withColumn("unit_id", id_of)
    return closed.unionByName(opened.select(*closed.columns))


def apply_merge(existing: DataFrame, merged: DataFrame, key: list[str]) -> DataFrame:
    """The image after an upsert: existing rows without a counterpart, and all merged rows."""
    return existing.join(merged.select(*key), key, "left_anti").unionByName(merged)


def pack_lines(text: Column, target_chars: int) -> Column:
    """Pieces of whole lines, each as long as target_chars (code points) allows; a longer line is a piece alone.

    One search from left to right: a piece is the longest run that ends with a line, so a text costs its length.
    """
    fits = f"(?s)(.{{0,{max(target_chars, 0)}}}|[^\n]*)\n"
    return F.regexp_extract_all(F.concat(text, F.lit("\n")), F.lit(fits), F.lit(1))


def header(jurisdiction: Column, title: Column, context: Column, ref: Column, heading: Column, part: Column) -> Column:
    """[jurisdiction | title | context | ref heading (part)]: blanks dropped, and a context that the ref repeats."""
    full = F.when(F.coalesce(ref.startswith(F.concat(context, F.lit(","))), F.lit(False)), None).otherwise(context)
    last = F.concat(F.btrim(F.concat_ws(" ", ids.text(ref), F.nullif(ids.text(heading), F.lit("")))), part)
    blank = lambda c: F.nullif(ids.text(c), F.lit(""))
    return F.concat(F.lit("["), F.concat_ws(" | ", blank(jurisdiction), blank(title), blank(full), blank(last)), F.lit("]"))


def build_chunks(units: DataFrame, max_tokens: int = 1200, target_tokens: int = 800, version: str = "1", per_token: int = 4) -> DataFrame:
    """Chunks of live units with text: unit columns, and chunk_index, chunk_id, context_header, text, hashes and flags."""
    rows = live(units).filter(F.char_length(ids.collapse(F.col("text"))) > 0)
    split = ids.estimate_tokens(F.col("text"), per_token) > max_tokens
    rows = rows.withColumn("_parts", F.when(split, pack_lines(F.col("text"), target_tokens * per_token)).otherwise(F.array("text")))
    rows = rows.withColumn("_n", F.size("_parts")).select("*", F.posexplode("_parts").alias("chunk_index", "_body"))
    part = F.when(F.col("_n") > 1, F.concat(F.lit(" (part "), (F.col("chunk_index") + 1).cast("string"), F.lit(" of "), F.col("_n").cast("string"), F.lit(")"))).otherwise(F.lit(""))
    head = header(F.col("jurisdiction"), F.coalesce("title", "source_id"), F.col("context_path"), F.col("unit_ref"), F.col("heading"), part)
    whole = F.concat(head, F.lit("\n"), F.col("_body"))
    return rows.select(
        ids.sha(F.col("unit_id"), F.col("chunk_index"), F.lit(version)).alias("chunk_id"), "unit_id", "doc_id", "source_id", "unit_ref", "chunk_index",
        head.alias("context_header"), whole.alias("text"), ids.estimate_tokens(whole, per_token).alias("token_estimate"),
        ids.normalised_hash(F.col("_body")).alias("text_hash"), ids.has_private_data(F.col("_body")).alias("pii_flag"), F.lit(version).alias("chunker_version"),
    )


def sync(existing: DataFrame, desired: DataFrame, key: str = "chunk_id") -> DataFrame:
    """key and action (inserted, retired, unchanged): active rows against desired ones; a retired row comes back as insert."""
    active = existing.filter("is_active").select(F.col(key).alias("_old")).distinct()
    new = desired.select(F.col(key).alias("_new")).distinct()
    both = new.join(active, F.col("_new") == F.col("_old"), "full_outer")
    action = F.when(F.col("_old").isNull(), "inserted").when(F.col("_new").isNull(), "retired").otherwise("unchanged")
    return both.select(F.coalesce("_new", "_old").alias(key), action.alias("action"))


def wanted(chunks: DataFrame) -> DataFrame:
    """Chunks that must be searchable: active, and without personal data."""
    return chunks.filter("is_active AND NOT pii_flag")


def embed_todo(chunks: DataFrame, vectors: DataFrame, model: str) -> DataFrame:
    """chunk_id and action for wanted chunks (active, without personal data) against active vectors of a model."""
    return sync(vectors.filter(F.col("embedding_model") == model), wanted(chunks))
