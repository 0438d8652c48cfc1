"""Personal data by weak supervision (native DataFrame operations only).

Base spans (e-mail, IP, card and phone numbers) follow fixed rules and always stay.  Further candidates (obfuscated
e-mails, national phone numbers, account and identity numbers, names after a salutation) get votes of three labelers: a
strict pattern, a gazetteer and the words before them.  Expectation-maximisation over the counts of their vote patterns estimates
how reliable each labeler is; its posteriors train a naive Bayes span classifier over votes and shape, which decides about them.
Base spans take no part, as their rule is certain.  What the corpus never showed counts neither way, and a vote for a span never
counts against it, nor the other way round.  The counts that reach the driver are bounded by the number of vote and shape patterns
(fewer than 3,000), whatever the input.  Further candidates have no limit of length but an account number's own (15 to 34 characters).

Defined results: a null text counts as empty; equal rows get equal results; input columns named like the results (_base, _spans,
_n_<kind>) or what leads to them (_f_<kind>, _more) are replaced, all others stay; an accepted candidate that overlaps a base
span is left out; with no candidates the classifier accepts nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lexloom.llm.shared import documents, scratch, text_of, written
from lexloom.llm.spans import digits, find, joined, luhn, ranked

KINDS = ("email", "ip", "card", "phone")

# Fixed patterns of the contract, in forms that neither backtrack over long runs nor recurse: an address can only start
# where the last match ended or a run of its characters starts; only runs of 14 to 19 digits can be cards.
LOCAL = "A-Za-z0-9._%+-"
EMAIL = f"(?:(?<![{LOCAL}])|\\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++"
IP = "[0-9](?<![0-9]{2})[0-9]*+\\.[0-9]++\\.[0-9]++\\.[0-9]++"
CARD = "[0-9](?<![0-9]{2})(?<![0-9][ -][0-9])(?:[ -]?[0-9]){13,18}(?![ -]?[0-9])"
PHONE = "\\+[0-9][ ().0-9-]+[0-9]"
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

#: Further candidates by kind, with the labeler that knows their strict form.
MORE = {
    "email_like": (f"(?:(?<![{LOCAL}])|\\G)[{LOCAL}]++ ?(?i:\\[at\\]|\\(at\\)) ?[A-Za-z0-9-]++(?: ?(?:\\.|(?i:\\[dot\\]|\\(dot\\))) ?[A-Za-z0-9-]++)++", "(?i).*(?:at\\]|at\\)) ?[a-z0-9-]+ ?(?:\\[dot\\]|\\(dot\\)|\\.) ?[a-z]{2,}"),
    "phone_like": ("(?:\\([0-9]|[0-9])(?<![0-9+.-]\\(?[0-9])[0-9]{2}\\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])", "\\([2-9][0-9]{2}\\) [2-9][0-9]{2}-[0-9]{4}|[2-9][0-9]{2}-[2-9][0-9]{2}-[0-9]{4}"),
    "id_like": ("[0-9](?<![0-9-][0-9])[0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9-])", "(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}"),
    "account_like": ("[A-Z]{2}[0-9]{2}(?<![A-Z0-9][A-Z0-9]{4})(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])", "(?:DE|FR|ES|GB|IT|NL|BE|AT|CH|PT|IE|PL)[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}.*"),
    "name_like": ("\\b(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Mlle|Sr|Sra)\\.? [A-Z][a-z]++(?: [A-Z][a-z]++)?+", "(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Mlle|Sr|Sra)\\.? [A-Z][a-z]+ [A-Z][a-z]+"),
}
# The gazetteers, as lists of what a labeler knows.
DOMAINS = ("com", "org", "net", "edu", "gov", "info", "biz", "io", "co", "eu", "uk", "de", "fr", "es", "it", "nl", "be", "at", "ch", "pt", "pl", "ie", "se", "no", "dk", "fi", "ca", "au", "us", "mx", "br", "ar", "jp", "cn", "in")
PROVIDERS = ("gmail", "googlemail", "yahoo", "hotmail", "outlook", "live", "icloud", "proton", "protonmail", "aol", "gmx", "web", "orange", "laposte", "free", "telefonica")
#: Bank countries and the length of their account numbers.
ACCOUNTS = {"AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HU": 28, "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24}
NAMES = (
    "Alice", "Andrea", "Andrew", "Anna", "Anne", "Antonio", "Barbara", "Carlos", "Carmen", "Charles", "Christian", "Claire", "Claudia", "Daniel", "David", "Elena", "Elizabeth", "Emily", "Emma", "Eric", "Eva",
    "Francisco", "Frank", "George", "Hans", "Helen", "Henry", "Isabel", "Jack", "James", "Jan", "Jane", "Javier", "Jean", "John", "Jose", "Juan", "Julia", "Julie", "Karl", "Katharina", "Klaus", "Laura", "Linda", "Louis",
    "Lucas", "Lucia", "Luis", "Manuel", "Maria", "Marie", "Mark", "Martin", "Mary", "Max", "Michael", "Miguel", "Monika", "Nicolas", "Nina", "Olivia", "Patrick", "Paul", "Pedro", "Peter", "Petra", "Philippe", "Pierre",
    "Richard", "Robert", "Rosa", "Sabine", "Sandra", "Sarah", "Sofia", "Sophie", "Stefan", "Stephen", "Susan", "Thomas", "Ursula", "Victoria", "William", "Wolfgang",
)
#: Words before a candidate that speak for it, and words that speak against it.
CONTEXT = "(?i)(?:phone|tel|call|mobile|fax|contact|mail|write|reach|ssn|social|iban|account|konto|name|dear|sincerely|telefon|correo|courriel)[^\\n]{0,16}$"
AGAINST = "(?i)(?:version|isbn|order|invoice|part|page|figure|table|section|serial)[^\\n]{0,8}$"
VOTES = ("strict", "gazetteer", "context")
SHAPE = ("length", "separators", "share")
PRIOR = 0.5


def known(s: Column) -> Column:
    """Whether a span's gazetteer has it: a domain or mail provider, an area code that a numbering plan may give, an issued
    identity number's area, a bank country and its length, a given name."""
    value, number = s["value"], digits(s["value"])
    flat = F.regexp_replace(value, "[ -]", "")
    domain, provider = F.lower(F.regexp_extract(value, "([A-Za-z]+)[^A-Za-z]*$", 1)), F.lower(F.regexp_extract(value, "(?i)(?:@|\\bat[\\])]) ?([a-z0-9-]+)", 1))
    area = F.regexp_extract(number, "^1?([2-9][0-8][0-9])[2-9][0-9]{6}$", 1)
    length = F.lit(None).cast("int")
    for country, n in ACCOUNTS.items():
        length = F.when(F.left(flat, F.lit(2)) == country, F.lit(n)).otherwise(length)
    names = F.split(value, "[^\\p{L}]+")
    return F.coalesce(
        F.when(s["kind"].isin("email", "email_like"), domain.isin(*DOMAINS) | provider.isin(*PROVIDERS))
        .when(s["kind"].isin("phone", "phone_like"), (area != "") & ~area.rlike("11$"))
        .when(s["kind"] == "id_like", ~F.left(number, F.lit(3)).isin("000", "666") & ~number.startswith("9"))
        .when(s["kind"] == "account_like", F.char_length(flat) == length)
        .when(s["kind"] == "name_like", F.arrays_overlap(names, F.array(*map(F.lit, NAMES))))
        .when(s["kind"] == "card", F.left(number, F.lit(1)).isin("2", "3", "4", "5", "6")),
        F.lit(False),
    )


def base_spans(text: Column) -> dict[str, Column]:
    """The fixed kinds: leftmost matches, those that fail their test dropped without another try."""
    ok = {
        "email": lambda s: F.lit(True),
        "ip": lambda s: s["value"].rlike(f"^{PART}(?:\\.{PART}){{3}}$"),
        "card": lambda s: luhn(digits(s["value"])),
        "phone": lambda s: F.length(digits(s["value"])).between(10, 15),
    }
    patterns = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True))
    needs = {"email": text.contains("@"), "phone": text.contains("+")}
    return {k: F.filter(find(text, patterns[k], needs.get(k)), ok[k]) for k in KINDS}


def _voted(text: Column, spans: Column, strict: str) -> Column:
    """Votes (1 for, 0 none, -1 against) and shape of each span."""
    def one(s: Column) -> Column:
        before = F.substring(text, F.greatest(s["start"] - 31, F.lit(1)), F.least(s["start"], F.lit(32)))
        n_digits = F.length(digits(s["value"]))
        return F.struct(
            s["start"], s["rank"], s["end"], s["kind"],
            F.when(s["value"].rlike(f"^(?:{strict})$"), 1).otherwise(-1).alias("strict"),
            F.when(known(s), 1).otherwise(0).alias("gazetteer"),
            F.when(before.rlike(AGAINST), -1).when(before.rlike(CONTEXT), 1).otherwise(0).alias("context"),
            F.least(F.length(s["value"]) / 8, F.lit(4)).cast("int").alias("length"),
            F.least(F.length(F.regexp_replace(s["value"], "[A-Za-z0-9]", "")), F.lit(4)).alias("separators"),
            (n_digits * 3 / F.length(s["value"])).cast("int").alias("share"),
        )

    return F.transform(spans, one)


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with _base (sorted base spans), _n_<kind> and _more (voted further candidates that overlap no base span)."""
    text = text_of(text_col)
    found = base_spans(text)
    out = docs.withColumns({f"_f_{k}": v for k, v in found.items()})
    out = out.withColumns({f"_n_{k}": F.size(f"_f_{k}").cast("long") for k in KINDS})
    out = out.withColumn("_base", F.array_sort(F.concat(*(ranked(F.col(f"_f_{k}"), r, k) for r, k in enumerate(KINDS)))))
    more = [_voted(text, ranked(find(text, p, text.rlike("(?i)[\\[(]at[\\])]") if k == "email_like" else None), len(KINDS) + r, k), strict) for r, (k, (p, strict)) in enumerate(MORE.items())]
    apart = F.filter(F.concat(*more), lambda s: ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return out.withColumn("_more", apart).drop(*(f"_f_{k}" for k in KINDS))


def fit(counts: list[Row], rounds: int = 40) -> dict[str, dict[int, float]]:
    """EM over vote patterns, then naive Bayes: log-odds of every value of every vote and shape feature, and the bias.

    Each labeler votes with probabilities of its own given the hidden truth (private or not), as counted with add-one
    smoothing; the start trusts a vote for and doubts a vote against.
    """
    values = (-1, 0, 1)
    yes = {v: {x: p for x, p in zip(values, (0.1, 0.3, 0.6), strict=True)} for v in VOTES}
    no = {v: {x: p for x, p in zip(values, (0.6, 0.3, 0.1), strict=True)} for v in VOTES}
    prior, post = PRIOR, [PRIOR] * len(counts)
    for _ in range(rounds):
        for k, r in enumerate(counts):
            odds = math.log(prior / (1 - prior)) + sum(math.log(yes[v][r[v]] / no[v][r[v]]) for v in VOTES)
            post[k] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        a, b = sum(p * r["n"] for p, r in zip(post, counts, strict=True)), sum((1 - p) * r["n"] for p, r in zip(post, counts, strict=True))
        prior = (a + 1) / (a + b + 2)
        for v in VOTES:
            for x in values:
                yes[v][x] = (1 + sum(p * r["n"] for p, r in zip(post, counts, strict=True) if r[v] == x)) / (a + 3)
                no[v][x] = (1 + sum((1 - p) * r["n"] for p, r in zip(post, counts, strict=True) if r[v] == x)) / (b + 3)
    a, b = sum(p * r["n"] for p, r in zip(post, counts, strict=True)), sum((1 - p) * r["n"] for p, r in zip(post, counts, strict=True))
    model: dict[str, dict[int, float]] = {"bias": {0: math.log((a + 1) / (b + 1))}}
    for f in (*VOTES, *SHAPE):
        seen = sorted({r[f] for r in counts})
        model[f] = {
            x: math.log((1 + sum(p * r["n"] for p, r in zip(post, counts, strict=True) if r[f] == x)) / (a + len(seen)))
            - math.log((1 + sum((1 - p) * r["n"] for p, r in zip(post, counts, strict=True) if r[f] == x)) / (b + len(seen)))
            for x in seen
        }
        if f in VOTES:  # a vote for never counts against
            model[f] = {x: max(w, 0.0) if x > 0 else min(w, 0.0) if x < 0 else w for x, w in model[f].items()}
    return model


def score(span: Column, model: dict[str, dict[int, float]]) -> Column:
    """Log-odds of a voted span under the span classifier."""
    total = F.lit(model["bias"][0])
    for f in (*VOTES, *SHAPE):
        part = F.lit(0.0)
        for x, w in model[f].items():
            part = F.when(span[f] == x, F.lit(w)).otherwise(part)
        total = total + part
    return total


def find_private(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs without their text, with _n_<kind>, _base and _spans: arrays of (start, rank, end, kind, value), code points,
    end exclusive.  The texts are scanned once; what was found is written to the shared folder and read twice."""
    cand = written(candidates(docs, text_col).drop(text_col), f"{scratch(docs.sparkSession, 'pii')}/found")
    votes = cand.select(F.explode("_more").alias("s")).select(*(F.col(f"s.{f}").alias(f) for f in (*VOTES, *SHAPE)))
    model = fit(votes.groupBy(*VOTES, *SHAPE).agg(F.count("*").alias("n")).collect())  # at most 3^3 * 5 * 5 * 4 rows
    extra = F.filter("_more", lambda s: score(s, model) > 0)
    plain = F.transform(extra, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"], F.lit(None).cast("string").alias("value")))
    return cand.withColumn("_spans", F.array_sort(F.concat("_base", plain))).drop("_more")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_private(documents(spark, sf_dir).select("doc_id", "text"))
    counts = [F.col(f"_n_{k}").alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *counts, F.sha2(joined(F.col("_base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("_spans")).alias("spans"))


QUERIES = {"op2_pii": op2_pii}
