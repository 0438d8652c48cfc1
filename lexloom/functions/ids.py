"""Identity, text and estimate functions as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "\x1f"
# The keyword index's stop words, and the patterns of e-mail addresses, phone and identity numbers.
STOP = (
    "a", "an", "and", "are", "as", "at", "be", "by", "can", "do", "does", "for", "from", "how", "i",
    "if", "in", "is", "it", "must", "of", "on", "or", "the", "to", "what", "when", "which", "who",
    "with", "under", "there", "any", "my", "we", "you", "should", "shall", "may", "this", "that",
)
EMAIL = r"(?U)[\w.+-]+@[\w-]+\.[\w.]+"
PHONE = r"(?U)\b\d{3}[-.\s]\d{3}[-.\s]\d{4}\b"
IDENTITY = r"(?U)\b\d{3}[ -]\d{3}[ -]\d{3}\b"


def text(c: Column) -> Column:
    """NULL as the empty string: concat_ws would skip it."""
    return F.coalesce(c.cast("string"), F.lit(""))


def sha(*parts: Column) -> Column:
    """SHA-256, in hex, of the parts joined by the unit separator."""
    return F.sha2(F.concat_ws(SEPARATOR, *map(text, parts)), 256)


def content_hash(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def collapse(c: Column) -> Column:
    """Runs of (Unicode) white space as one blank, without blanks at the ends."""
    return F.btrim(F.regexp_replace(text(c), r"(?U)\s+", " "))


def normalised_hash(c: Column) -> Column:
    return sha(F.lower(collapse(c)))


def estimate_tokens(c: Column, per_token: int = 4) -> Column:
    return F.when(text(c) == "", F.lit(0)).otherwise(F.greatest(F.lit(1), F.floor(F.char_length(c) / per_token).cast("int")))


def has_private_data(c: Column) -> Column:
    return F.coalesce(c.rlike(EMAIL) | c.rlike(PHONE) | c.rlike(IDENTITY), F.lit(False))


def words(c: Column) -> Column:
    """Lower-case ASCII words without stop words, repeats kept."""
    return F.filter(F.regexp_extract_all(F.lower(text(c)), F.lit("[a-z0-9]+"), F.lit(0)), lambda w: ~w.isin(*STOP))


def idf(n: Column, df: Column) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def bm25(weight: Column, tf: Column, length: Column, mean: Column, k1: float = 1.5, b: float = 0.75) -> Column:
    return weight * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    """Euclidean length; a zero vector counts as length one."""
    n = F.sqrt(dot(a, a))
    return F.when(n == 0, F.lit(1.0)).otherwise(n)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def section_number(q: Column) -> Column:
    """The first section that a question names, or NULL."""
    found = F.regexp_extract(q, r"(?i)\b(?:section|sec\.?|s\.)\s*([0-9]+(?:\.[0-9]+)?(?:-[0-9]+)?)", 1)
    return F.when(found == "", F.lit(None).cast("string")).otherwise(found)


def citations(answer: Column, n: Column) -> Column:
    """Distinct cited numbers from 1 to n, ascending."""
    found = F.transform(F.regexp_extract_all(text(answer), F.lit(r"\[([0-9]{1,9})\]"), F.lit(1)), lambda x: x.cast("int"))
    return F.array_sort(F.array_distinct(F.filter(found, lambda x: (x >= 1) & (x <= n))))


def target_document(href: Column) -> Column:
    return F.nullif(F.regexp_extract(href, "/legislation/([^/?#]+)", 1), F.lit(""))


def cost_usd(prompt: Column, completion: Column, price_in: Column, price_out: Column) -> Column:
    part = lambda n, p: F.coalesce(n, F.lit(0)) / 1e6 * F.coalesce(p, F.lit(0.0))
    return F.round(part(prompt, price_in) + part(completion, price_out), 8)


MIME = {
    "xml": "application/xml", "html": "text/html", "htm": "text/html", "pdf": "application/pdf", "txt": "text/plain", "json": "application/json", "csv": "text/csv", "md": "text/markdown",
    "png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif", "svg": "image/svg+xml", "zip": "application/zip", "doc": "application/msword", "rtf": "application/rtf",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", "css": "text/css", "js": "text/javascript",
}


def mime_type(name: Column) -> Column:
    suffix, out = F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1)), F.lit("application/octet-stream")
    for k, v in MIME.items():
        out = F.when(suffix == k, F.lit(v)).otherwise(out)
    return out


# Statuses of a spent rate limit, statuses worth another try, and the longest wait for a limit's reset.
LIMITED, BUSY = (403, 429), (429, 500, 502, 503, 504)
LONGEST_WAIT = 900
#: What is decided about a failed attempt: the first row that fits tells what the next one waits for (None: there is none).  A row
#: has the statuses it is for (None among them: no reply), what else it needs, and the wait: the limit's reset and a
#: second, what the reply asks for, or a backoff.
WAITS: tuple[tuple[tuple, str, str | None], ...] = (
    (LIMITED, "spent", "reset"),
    (LIMITED, "spent for long", None),
    (BUSY, "after", "after"),
    ((None, *BUSY), "", "backoff"),
)


def retry_wait(status: Column, attempt: Column, retry_after: Column, remaining: Column, reset_in: Column, base: float = 1.0, longest: float = LONGEST_WAIT) -> Column:
    """Seconds that a client waits before the next attempt, without jitter, by WAITS; NULL: it doesn't try again."""
    seconds = F.regexp_extract(text(retry_after), "^[0-9]+$", 0)
    reset = F.greatest(F.coalesce(reset_in, F.lit(0)), F.lit(0)).cast("double") + 1
    spent = F.coalesce(remaining == 0, F.lit(False))
    needs = {"": F.lit(True), "spent": spent & (reset <= longest), "spent for long": spent, "after": seconds != ""}
    waits = {"reset": reset, "after": seconds.try_cast("double"), "backoff": base * F.pow(F.lit(2.0), attempt - 1), None: F.lit(None).cast("double")}
    out = F.lit(None).cast("double")
    for statuses, need, wait in reversed(WAITS):
        of = F.coalesce(status.isin(*(s for s in statuses if s is not None)), F.lit(False)) | (status.isNull() if None in statuses else F.lit(False))
        out = F.when(of & needs[need], waits[wait]).otherwise(out)
    return out
