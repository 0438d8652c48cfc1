"""Exact routing of questions: section and law names, range lookup, status notes, prompts and citation checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import ids
from lexloom.sources import landing

NOT_FOUND = "NOT_FOUND"


def find_law(questions: DataFrame, laws: DataFrame, question: str = "question") -> DataFrame:
    """questions with law: the source of the longest law name (source_id, name, position) that a question holds as whole words;
    of equal lengths the first in the register.  Repeated questions stay.

    A name stands under the rarest of its words, by the names that have it, and a question meets only names whose word it holds;
    what is met is compared letter by letter.  Names without a letter or digit, hardly any, are tried for every question.
    """
    names = laws.select("source_id", F.lower("name").alias("_name"), "position").filter("_name <> ''").withColumn("_words", F.array_distinct(F.regexp_extract_all("_name", F.lit("[a-z0-9]+"), F.lit(0))))
    common = names.select(F.explode("_words").alias("_word")).groupBy("_word").agg(F.count("*").alias("_n"))
    keyed = names.withColumn("_word", F.explode("_words")).join(common, "_word").groupBy("source_id", "_name", "position").agg(F.min(F.struct("_n", "_word"))["_word"].alias("_word"))
    asked = questions.select(F.col(question).alias("_asked")).distinct().withColumn("_text", F.lower("_asked"))
    each = asked.withColumn("_word", F.explode(F.array_distinct(F.regexp_extract_all("_text", F.lit("[a-z0-9]+"), F.lit(0)))))
    if laws.limit(landing.REGISTER + 1).count() <= landing.REGISTER:  # names go to the questions, whose texts are not dealt by word
        keyed = F.broadcast(keyed)
    met = each.join(keyed, "_word").select("_asked", "_text", "_name", "position", "source_id")
    bare = names.filter(F.size("_words") == 0)
    if bare.limit(1).count():
        met = met.unionByName(asked.join(landing.register(bare, "names without words"), F.col("_text").contains(F.col("_name"))).select(*met.columns))
    # whole words: what stands before and behind is no letter or digit
    quoted = F.concat(F.lit("\\Q"), F.replace(F.col("_name"), F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    held = met.filter(F.col("_text").contains(F.col("_name")) & F.regexp_like("_text", F.concat(F.lit("(?<![a-z0-9])"), quoted, F.lit("(?![a-z0-9])"))))
    best = held.groupBy("_asked").agg(F.min(F.struct((-F.char_length("_name")).alias("n"), "position", "_name", "source_id"))["source_id"].alias("law"))
    return questions.join(best, questions[question] == best["_asked"], "left").select(*questions.columns, "law")


#: A range of sections is spelled out up to this many; a wider one is compared by its ends.
SPELLED = 1000
#: Tasks that the units of one law and number are dealt among; refs, which are narrow, go to all of them.
SLOTS = 8


def lookup(refs: DataFrame, units: DataFrame) -> DataFrame:
    """What ``named`` gives, in order of source and place."""
    return named(refs, units).orderBy("source_id", *(["unit_order"] if "unit_order" in units.columns else ["unit_ref"]))


def named(refs: DataFrame, units: DataFrame, few: bool = False) -> DataFrame:
    """Current main-body units that (number, law) refs name, in no order: exactly, or by a range like "s. 30-31"; any law if none
    is named.

    A unit answers to its own number and, if it is a range, to every number in it, under its law and under none, so units
    and refs meet by equality.  All pairs are asked for, and their number is the product of both sides: only the sides are moved, never pairs.
    Few refs (the caller has counted them) go to the units instead.
    """
    ends = lambda k: F.expr(f"try_cast(regexp_extract(unit_ref, '^s\\\\. ([0-9]{{1,9}})-([0-9]{{1,9}})$', {k}) AS int)")
    u = units.filter("is_current").withColumns({"_lo": ends(1), "_hi": ends(2)})
    own = F.regexp_extract("unit_ref", r"(?s)^s\. (.*)$", 1)
    ranged = F.col("_hi") >= F.col("_lo")
    inside = F.transform(F.sequence("_lo", F.least("_hi", F.col("_lo") + SPELLED - 1)), lambda n: n.cast("string"))
    names = F.array_distinct(F.concat(F.array(own), F.when(ranged, inside).otherwise(F.array().cast("array<string>"))))
    spelled = u.withColumn("_name", F.explode(names)).filter("_name <> ''")
    plain = F.when(F.col("number").rlike("^[0-9]{1,9}$"), F.col("number").cast("int").cast("string"))
    asked = refs.withColumn("_name", F.explode(F.array_distinct(F.array_compact(F.array("number", plain)))))
    # a number with leading zeros names ranges only
    exact = (F.col("_name") == F.col("number")) | (ranged & F.col("_name").rlike("^[0-9]+$"))
    if few:
        both = F.broadcast(asked).join(spelled, "_name").filter((F.col("law").isNull() | (F.col("source_id") == F.col("law"))) & exact)
    else:
        dealt = spelled.withColumn("_slot", F.pmod(F.xxhash64(*units.columns), F.lit(SLOTS)).cast("int")).withColumn("_law", F.explode(F.array_distinct(F.array(F.col("source_id").cast("string"), F.lit(None).cast("string")))))
        sent = asked.withColumn("_slot", F.explode(F.array(*map(F.lit, range(SLOTS))))).withColumn("_for", F.col("law").cast("string"))
        both = sent.join(dealt.withColumnsRenamed({"_name": "_key", "_slot": "_part"}), (F.col("_name") == F.col("_key")) & (F.col("_slot") == F.col("_part")) & F.col("_for").eqNullSafe(F.col("_law")))
        both = both.filter(exact).drop("_key", "_slot", "_part", "_for", "_law")
    wide = u.filter(ranged & (F.col("_hi") - F.col("_lo") >= SPELLED))
    if wide.limit(1).count():  # a register of its own: hardly any unit spans so many
        n = F.when(F.col("number").rlike("^[0-9]{1,9}$"), F.col("number").cast("int"))
        far = refs.join(landing.register(wide, "wide ranges"), n.between(F.col("_lo") + SPELLED, F.col("_hi")) & (F.col("law").isNull() | (F.col("source_id") == F.col("law"))))
        both = both.drop("_name").unionByName(far.select(*both.drop("_name").columns))
    return both.drop("_lo", "_hi", "_name")


def status_of(repealed: Column, in_force: Column) -> Column:
    return F.when(repealed, "repealed").when(~in_force, "not in force").otherwise("in force")


# Fixed sentences of the answer about a section that doesn't apply.
def status_note(law: Column, ref: Column, heading: Column, status: Column, history: Column) -> Column:
    """One sentence that says why a section doesn't apply."""
    head = F.when((ids.text(heading) == "") | (F.lower(heading) == status) | (F.lower(heading) == "repealed"), F.lit("")).otherwise(F.concat(F.lit(" ("), heading, F.lit(")")))
    why = F.when(status == "not in force", "it was enacted but has not been brought into force, so it has no legal effect today").otherwise("it has been repealed and no longer applies")
    more = F.when(ids.text(history) == "", F.lit("")).otherwise(F.concat(F.lit(" History: "), history))
    return F.concat(law, F.lit(", "), ref, head, F.lit(" is "), status, F.lit(": "), why, F.lit("."), more)


def prompt_blocks(blocks: Column, max_chars: int) -> Column:
    """Blocks numbered from 1, each cut to its share of max_chars, with blank lines between."""
    share = F.floor(F.lit(max_chars) / F.greatest(F.size(blocks), F.lit(1))).cast("int")
    return F.array_join(F.transform(blocks, lambda b, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), F.substring(b, F.lit(1), share))), "\n\n")


def answer_route(lookup_hits: Column, inactive_hits: Column, best: Column, reply: Column, n: Column, least: float = 0.55) -> Column:
    """lookup, status, search, not_found or ungrounded, in the order in which a question is decided."""
    grounded = F.size(ids.citations(reply, n)) > 0
    silent = reply.contains(NOT_FOUND)
    end = F.when(silent, "not_found").when(~grounded, "ungrounded")
    return (
        F.when((lookup_hits > 0) & (inactive_hits == lookup_hits), "status")
        .when(lookup_hits > 0, F.coalesce(end, F.lit("lookup")))
        .when(F.coalesce(best, F.lit(0.0)) < least, "not_found")
        .otherwise(F.coalesce(end, F.lit("search")))
    )


def refusals(answers: DataFrame) -> DataFrame:
    """One row: the share of answers (route) that gave nothing, and their number."""
    return answers.agg(F.avg(F.when(F.col("route").isin("not_found", "ungrounded"), F.lit(1.0)).otherwise(F.lit(0.0))).alias("refused"), F.count("*").alias("answers"))
