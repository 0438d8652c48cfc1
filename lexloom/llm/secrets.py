"""Secret scan with corpus-wide ownership frequency (native DataFrame operations only).

Base spans (assignments, access keys, long hex) follow fixed rules and always stay.  Further candidates have the shapes of
well-known tokens.  The hash of every candidate's secret is counted over the whole corpus by distinct repositories and by
distinct owners.  A value that many owners hold is a copied example, unless nearly all the repositories that hold it are one owner's
(OWN_SHARE of at least OWN_LEAST: a credential of one owner that some others copied).  One that stays with at most
``max_owners`` owners, or is one owner's in this way, and is varied enough looks live.  Further candidates become spans only if they look live;
they have no limit of length but their own format's.

Each (hash, owner, repository) is made distinct before it is counted, so a value that fills a third of the corpus reaches
the last count as a few partial sums; where candidates meet the counts again, values that a thousandth of them equal meet a broadcast.

A document is a repository of its own unless a column names its repository, so ``n_repos`` then counts different documents.

Defined results: a null text counts as empty; a null owner or repository is one of its own; equal rows get equal
results; extra columns are ignored, or stay as they are where texts are redacted; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm.shared import documents, fresh, heavy, row_mark, scratch, split_join, text_of, written
from lexloom.llm.spans import find, joined, ranked

KINDS = ("assign", "access", "hex")
# Fixed patterns of the contract; long runs are taken possessively.  The keywords match in either case of A-Z.
KEYWORDS = "(?i:password|passwd|secret|token|api_?key)"
ASSIGN = f"{KEYWORDS}[\"']?\\x20*+[:=]\\x20*+[\"']?[A-Za-z0-9+/_.=-]++"
ACCESS = "AKIA[A-Z0-9]++"
# Only runs of 24 and more, as the contract drops the others: short words would otherwise make an entry each.
HEX = "(?<![0-9a-f])[0-9a-f]{24}[0-9a-f]*+"
#: Further shapes of well-known tokens.
MORE = {
    "token": "(?<![A-Za-z0-9_])(?:gh[pousr]_[A-Za-z0-9]{36,}+|glpat-[A-Za-z0-9_-]{20,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|sk-[A-Za-z0-9]{20,}+|sk_live_[A-Za-z0-9]{16,}+|AIza[A-Za-z0-9_-]{35})",
    "jwt": "(?<![A-Za-z0-9_])eyJ[A-Za-z0-9_-]{8,}+\\.eyJ[A-Za-z0-9_-]{8,}+\\.[A-Za-z0-9_-]{8,}+",
    "private_key": "-----BEGIN (?:(?!PRIVATE KEY-)[A-Z]++ )*+PRIVATE KEY-----",
}
#: A value held by more owners than this is a copied example.
MAX_OWNERS = 2
#: A value is one owner's if so large a share of at least so many repositories that hold it are.
OWN_SHARE, OWN_LEAST = 0.9, 10
#: Distinct characters that a live-looking value has at least.
MIN_VARIETY = 6
#: Values that are plainly place holders.
DUMMY = "(?i)example|changeme|your[_-]?|dummy|placeholder|xxxx|0123456789|abcdef|123456"


def assigned(value: Column) -> Column:
    """Group 2 of an assignment: all after its first : or = that its rule allows, without blanks and one quote."""
    return F.regexp_extract(value, f"^{KEYWORDS}[\"']?\\x20*+[:=]\\x20*+[\"']?([A-Za-z0-9+/_.=-]++)$", 1)


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with _base (sorted base spans) and _more (further candidates), both (start, rank, end, kind, value)."""
    text = text_of(text_col)
    raw = {
        "assign": F.filter(find(text, ASSIGN), lambda s: F.length(assigned(s["value"])) >= 6),
        "access": F.filter(find(text, ACCESS), lambda s: F.length(s["value"]) >= 20),
        "hex": find(text, HEX),
    }
    base = F.array_sort(F.concat(*(ranked(raw[k], r, k) for r, k in enumerate(KINDS))))
    more = F.array_sort(F.concat(*(ranked(find(text, p), len(KINDS) + r, k) for r, (k, p) in enumerate(MORE.items()))))
    return docs.withColumn("_base", base).withColumn("_more", more)


def with_value(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"], F.when(s["kind"] == "assign", assigned(s["value"])).otherwise(s["value"]).alias("value")))


def ownership(found: DataFrame, max_owners: int = MAX_OWNERS) -> DataFrame:
    """(hash, n_owners, n_repos, live) of every candidate value in found (_spans, _owner, _repo)."""
    each = found.select(F.explode("_spans").alias("s"), "_owner", "_repo").select(F.sha2(F.col("s.value").cast("binary"), 256).alias("hash"), F.col("s.value").alias("value"), "_owner", "_repo")
    each = each.withColumn("_fine", ~F.col("value").rlike(DUMMY) & (F.size(F.array_distinct(F.split("value", ""))) >= MIN_VARIETY))
    repos = each.groupBy("hash", "_owner", "_repo").agg(F.first("_fine").alias("_fine"))
    owners = repos.groupBy("hash", "_owner").agg(F.count("*").alias("repos"), F.first("_fine").alias("_fine"))
    total = owners.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"), F.max("repos").alias("_most"), F.first("_fine").alias("_fine"))
    own = (F.col("n_owners") <= max_owners) | ((F.col("n_repos") >= OWN_LEAST) & (F.col("_most") >= OWN_SHARE * F.col("n_repos")))
    return total.select("hash", "n_owners", "n_repos", (own & F.col("_fine")).alias("live"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str | None = None, max_owners: int = MAX_OWNERS) -> DataFrame:
    """One row per row of docs: id_col, _mark, _base, _spans (sorted), _live, the spans whose value looks live, and _spread: every
    candidate with the owners and repositories that hold its value.

    repo_col defaults to the row itself: every document is a repository of its owner.
    """
    base = scratch(docs.sparkSession, "secrets")
    rows = docs.select(F.col(id_col), row_mark(id_col, text_col).alias("_mark"), F.col(owner_col).alias("_owner"), (F.col(repo_col) if repo_col else row_mark(id_col, text_col)).alias("_repo"), F.col(text_col).alias("_text"))
    found = written(scan(rows, "_text").drop("_text"), f"{base}/found")
    some = found.filter((F.size("_base") > 0) | (F.size("_more") > 0)).withColumn("_spans", with_value(F.concat("_base", "_more")))
    known = ownership(some, max_owners)
    each = some.select(F.col(id_col).alias("_id"), "_mark", F.explode("_spans").alias("s")).distinct()
    each = written(each.withColumn("hash", F.sha2(F.col("s.value").cast("binary"), 256)), f"{base}/each")
    each = split_join(each, written(known, f"{base}/known"), ["hash"], heavy(each, "hash").select("hash"), "inner")
    one = F.struct("s.start", "s.rank", "s.end", "s.kind", "s.value", "n_owners", "n_repos", "live")
    live = each.groupBy("_id", "_mark").agg(F.array_sort(F.collect_list(one)).alias("_spread")).withColumnRenamed("_mark", "_hit")
    plain = lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"], s["value"])
    live = live.withColumn("_live", F.transform(F.filter("_spread", lambda s: s["live"]), plain))
    out = found.join(live, (found["_mark"] == live["_hit"]) & found[id_col].eqNullSafe(live["_id"]), "left")
    live_col = F.coalesce("_live", F.from_json(F.lit("[]"), found.schema["_base"].dataType))
    out = out.withColumns({"_live": live_col, "_spread": F.coalesce("_spread", F.from_json(F.lit("[]"), live.schema["_spread"].dataType))})
    added = F.filter("_live", lambda s: (s["rank"] >= len(KINDS)) & ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return out.withColumn("_spans", F.array_sort(F.concat("_base", added))).select(id_col, "_mark", "_base", "_spans", "_live", "_spread")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_secrets(documents(spark, sf_dir))
    counts = [F.size(F.filter(F.transform("_base", lambda s: s["kind"]), lambda x: x == kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]  # noqa: B023
    spread = F.array_join(F.transform("_spread", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["n_owners"].cast("string"), s["n_repos"].cast("string"))), ",")
    return out.select("doc_id", *counts, F.sha2(joined(F.col("_base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("_spans")).alias("spans"), F.size("_live").cast("long").alias("n_live"), spread.alias("spread"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", mark: str = "[SECRET]") -> DataFrame:
    """docs with the live-looking values in text_col replaced by mark; copied examples stay."""
    live = find_secrets(docs, id_col, text_col, owner_col).filter(F.size("_live") > 0).groupBy(F.col(id_col).alias("_id"), F.col("_mark").alias("_hit")).agg(F.first("_live").alias("_live"))
    mark_, id_, hit_, live_ = fresh(docs, "_mark", "_id", "_hit", "_live")
    live = live.toDF(id_, hit_, live_)
    base = docs.withColumn(mark_, row_mark(id_col, text_col))
    both = base.join(live, (base[mark_] == live[hit_]) & base[id_col].eqNullSafe(live[id_]), "left")
    # the pieces between the secrets; overlapping spans (an assigned hex value) merge because a later start never goes back
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        begin = F.greatest(s["end"] - F.char_length(s["value"]), acc["at"])
        gap = F.substring(text_col, acc["at"] + 1, begin - acc["at"])
        return F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, F.when((begin == acc["at"]) & (begin > 0), F.lit("")).otherwise(F.lit(mark))).alias("out")))

    done = F.aggregate(live_, zero, step, lambda acc: F.concat(acc["out"], F.substring(text_col, acc["at"] + 1, F.char_length(text_col))))
    return both.withColumn(text_col, F.when(F.col(live_).isNull(), F.col(text_col)).otherwise(done)).select(*docs.columns)


QUERIES = {"op7_secrets": op7_secrets}
