"""Registration, versions, chunks and markup over the test tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from lexloom.functions import ids
from lexloom.operators import bronze, runs, silver
from lexloom.plans.common import Registry, Tables
from lexloom.sources import landing, markup
from lexloom.streaming import ingest, registration
from lexloom.tables import TableStore

R = Registry()


@R.add("bronze_register", "SELECT doc_id, sha256(text) AS content_hash, octet_length(encode(text)) AS file_size_bytes, 'text/plain' AS mime_type, source AS source_id FROM documents")
def bronze_register(t: Tables):
    return t.documents.select("doc_id", ids.content_hash(F.col("text")).alias("content_hash"), F.octet_length("text").cast("long").alias("file_size_bytes"), ids.mime_type(F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias("mime_type"), F.col("source").alias("source_id"))


DEDUP = """WITH k AS (SELECT DISTINCT sha256(text) AS h FROM benchmark),
x AS (SELECT doc_id, sha256(text) AS h, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS rn FROM documents),
r AS (SELECT doc_id, CASE WHEN k.h IS NULL AND rn = 1 THEN 'loaded' ELSE 'duplicate_content' END AS reason FROM x LEFT JOIN k ON x.h = k.h)
"""


def _reasons(t: Tables):
    rows = t.documents.select("doc_id", ids.content_hash(F.col("text")).alias("h"))
    return landing.first_wins(rows, t.benchmark.select(ids.content_hash(F.col("text")).alias("h")), "h", F.col("doc_id")).select("doc_id", "reason")


R.add("bronze_dedup_first_wins", DEDUP + "SELECT * FROM r")(_reasons)
R.add("bronze_duplicate_counts", DEDUP + "SELECT reason, count(*) AS n FROM r GROUP BY reason")(lambda t: _reasons(t).groupBy("reason").agg(F.count("*").alias("n")))


@R.add("gate_skip_reasons", """WITH d AS (SELECT d.*, l.quality, CASE WHEN d.doc_id % 11 = 0 THEN 'README.md' WHEN d.doc_id % 7 = 0 THEN '.hidden' ELSE d.doc_id || '.' || d.lang END AS name,
 count(*) OVER (PARTITION BY text) AS copies FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT reason, count(*) AS n FROM (SELECT CASE WHEN name LIKE '.%' OR lower(name) = 'readme.md' THEN 'housekeeping' WHEN source = 'src0' THEN 'unregistered_path'
 WHEN coalesce(quality, 0) <> 1 THEN 'source_not_approved' WHEN lang NOT IN ('en', 'fr') THEN 'extension_not_allowed' WHEN n_chars > 5000 THEN 'too_large' WHEN copies > 1 THEN 'unchanged' ELSE 'take' END AS reason FROM d) GROUP BY reason""")
def gate_skip_reasons(t: Tables):
    copies = t.documents.groupBy("text").agg(F.count("*").alias("copies"))
    d = t.documents.join(t.labels, "doc_id", "left").join(copies, "text", "left")
    name = F.when(F.col("doc_id") % 11 == 0, "README.md").when(F.col("doc_id") % 7 == 0, ".hidden").otherwise(F.concat(F.col("doc_id").cast("string"), F.lit("."), F.col("lang")))
    reason = landing.skip_reason(F.concat(F.col("source"), F.lit("/"), name), F.col("source") != "src0", F.col("quality") == 1, F.col("n_chars"), F.col("copies") > 1, (".en", ".fr"), 5000)
    return d.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@R.add("approved_sources", "SELECT source AS source_id, avg(quality) >= 0.5 AS approved FROM documents JOIN labels USING (doc_id) GROUP BY source")
def approved_sources(t: Tables):
    s = t.documents.join(t.labels, "doc_id").groupBy(F.col("source").alias("source_id")).agg(F.avg("quality").alias("q"))
    s = s.select("source_id", F.lit("files").alias("connector"), F.when(F.col("q") >= 0.5, "approved").otherwise("pending").alias("status"))
    return landing.gate(s, "files").select("source_id", "approved")


@R.add("longest_prefix_source", """WITH s AS (SELECT DISTINCT source AS p FROM documents), f AS (SELECT doc_id, source || '/' || doc_id AS path FROM documents)
SELECT doc_id, path, (SELECT p FROM s WHERE starts_with(path, p) ORDER BY length(p) DESC, p LIMIT 1) AS repo_path FROM f""")
def longest_prefix_source(t: Tables):
    files = t.documents.select("doc_id", F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("path"))
    return landing.longest_prefix(files, t.documents.select(F.col("source").alias("repo_path")).distinct())


@R.add("manifest_integrity", """SELECT doc_id::VARCHAR AS file, CASE WHEN doc_id % 13 <> 0 THEN sha256(text) END AS doc_id, doc_id % 13 <> 0 AND doc_id % 7 <> 0 AS intact FROM documents""")
def manifest_integrity(t: Tables):
    """Documents as files of a manifest: every seventh hash is a wrong one, and every thirteenth file is missing."""
    listed = t.documents.select(F.col("doc_id").cast("string").alias("file"), F.when(F.col("doc_id") % 13 != 0, F.col("text").cast("binary")).alias("content"), F.when(F.col("doc_id") % 7 == 0, F.lit("none")).otherwise(F.sha2("text", 256)).alias("sha256"))
    return landing.checked(listed, F.col("content")).select("file", "doc_id", "intact")


@R.add("latest_per_key", "SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def latest_per_key(t: Tables):
    return silver.latest(t.events, ["user_id"], F.col("ts").desc(), F.col("event_id").desc()).select("user_id", "event_id", "value")


@R.add("watermark_upsert", """WITH o AS (SELECT event_type AS scope, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS v FROM events WHERE ts < TIMESTAMP '2024-01-15' AND event_type <> 'error' GROUP BY 1),
n AS (SELECT event_type AS scope, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS v FROM events WHERE event_type IN (SELECT event_type FROM events WHERE value > 0) GROUP BY 1)
SELECT scope, v AS watermark_value FROM n UNION ALL SELECT scope, v FROM o WHERE scope NOT IN (SELECT scope FROM n)""")
def watermark_upsert(t: Tables):
    mark = F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("watermark_value")
    old = t.events.filter("ts < TIMESTAMP_NTZ '2024-01-15' AND event_type <> 'error'").groupBy(F.col("event_type").alias("scope")).agg(mark)
    new = t.events.join(t.events.filter("value > 0").select("event_type").distinct(), "event_type", "left_semi").groupBy(F.col("event_type").alias("scope")).agg(mark)
    return silver.apply_merge(old, new, ["scope"])


@R.add("incremental_after_mark", """WITH m AS (SELECT user_id, max(ts) AS wm FROM events WHERE event_type = 'error' GROUP BY user_id)
SELECT event_id, e.user_id FROM events e LEFT JOIN m ON e.user_id = m.user_id WHERE wm IS NULL OR ts > wm""")
def incremental_after_mark(t: Tables):
    marks = t.events.filter("event_type = 'error'").groupBy("user_id").agg(F.max("ts").alias("wm"))
    return t.events.join(marks, "user_id", "left").filter("wm IS NULL OR ts > wm").select("event_id", "user_id")


SCD2 = """WITH old AS (SELECT c_custkey AS k, sha256(c_mktsegment) AS h FROM customer),
new AS (SELECT c_custkey AS k, sha256(CASE WHEN c_nationkey % 5 = 0 THEN 'MOVED' ELSE c_mktsegment END) AS h FROM customer WHERE c_acctbal >= 0 UNION ALL SELECT -s_suppkey - 1, sha256(s_name) FROM supplier),
c AS (SELECT coalesce(new.k, old.k) AS k, old.h AS old_hash, new.h AS new_hash, CASE WHEN old.h IS NULL THEN 'added' WHEN new.h IS NULL THEN 'removed' WHEN old.h = new.h THEN 'unchanged' ELSE 'changed' END AS change
      FROM new FULL JOIN old ON new.k = old.k)
"""


def _versions(t: Tables):
    h = lambda c: F.sha2(c.cast("binary"), 256).alias("text_hash")
    old = t.customer.select(F.col("c_custkey").alias("k"), h(F.col("c_mktsegment")))
    new = t.customer.filter("c_acctbal >= 0").select(F.col("c_custkey").alias("k"), h(F.when(F.col("c_nationkey") % 5 == 0, F.lit("MOVED")).otherwise(F.col("c_mktsegment"))))
    return old, new.unionByName(t.supplier.select((-F.col("s_suppkey") - 1).alias("k"), h(F.col("s_name"))))


def _merged(t: Tables):
    old, new = _versions(t)
    opened = F.lit("2024-01-01 00:00:00").cast("timestamp")
    existing = old.withColumns({"unit_id": ids.sha(F.col("k"), F.col("text_hash")), "valid_from": opened, "valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True)})
    merged = silver.scd2(existing, new.withColumn("unit_id", ids.sha(F.col("k"), F.col("text_hash"))), ["k"], F.lit("2024-02-01 00:00:00").cast("timestamp"))
    return existing, merged


R.add("scd2_counts", SCD2 + "SELECT change, count(*) AS n FROM c GROUP BY change")(lambda t: silver.scd2_compare(*_versions(t), ["k"]).groupBy("change").agg(F.count("*").alias("n")))
R.add("scd2_rows", SCD2 + """SELECT k, old_hash AS text_hash, false AS is_current, true AS closed FROM c WHERE change IN ('changed', 'removed')
UNION ALL SELECT k, new_hash, true, false FROM c WHERE change IN ('changed', 'added')""")(lambda t: _merged(t)[1].select("k", "text_hash", "is_current", F.col("valid_to").isNotNull().alias("closed")))
R.add("scd2_current", SCD2 + "SELECT k, new_hash AS text_hash FROM c WHERE new_hash IS NOT NULL")(lambda t: silver.apply_merge(*_merged(t), ["unit_id"]).filter("is_current").select("k", "text_hash"))

@R.add("versions_of_history", """WITH e AS (SELECT user_id % 7 AS source, user_id AS k, ts::DATE AS day, arg_max(event_type, event_id) AS h FROM events GROUP BY ALL),
s AS (SELECT source, day, row_number() OVER (PARTITION BY source ORDER BY day) AS n, lead(day) OVER (PARTITION BY source ORDER BY day) AS nxt FROM (SELECT DISTINCT source, day FROM e)),
r AS (SELECT e.*, n, nxt, n - row_number() OVER (PARTITION BY e.source, k, h ORDER BY n) AS g FROM e JOIN s ON s.source = e.source AND s.day = e.day)
SELECT source, k, h, min(day)::VARCHAR AS valid_from, CASE WHEN count(*) FILTER (WHERE nxt IS NULL) = 0 THEN max(nxt)::VARCHAR END AS valid_to, count(*) FILTER (WHERE nxt IS NULL) > 0 AS is_current FROM r GROUP BY source, k, h, g""")
def versions_of_history(t: Tables):
    """Each user's last event type of every day of a group of users: all intervals at once, days without a user are gaps."""
    days = t.events.groupBy((F.col("user_id") % 7).alias("source"), F.col("user_id").alias("k"), F.to_date("ts").alias("day")).agg(F.max_by("event_type", "event_id").alias("h"))
    return silver.history(days, days, ["source"], ["k"], "day", "h").withColumns({c: F.col(c).cast("string") for c in ("valid_from", "valid_to")})


R.add("unit_ids", "SELECT doc_id, sha256(source || chr(31) || doc_id || chr(31) || sha256(text)) AS unit_id FROM documents")(lambda t: t.documents.select("doc_id", ids.sha(F.col("source"), F.col("doc_id"), ids.content_hash(F.col("text"))).alias("unit_id")))
R.add("text_hashes", "SELECT doc_id, sha256(text) AS text_hash FROM documents")(lambda t: t.documents.select("doc_id", ids.sha(F.col("text")).alias("text_hash")))
R.add("token_estimates", "SELECT doc_id, CASE WHEN text = '' THEN 0 ELSE greatest(1, length(text) // 4) END AS tokens FROM documents")(lambda t: t.documents.select("doc_id", ids.estimate_tokens(F.col("text")).alias("tokens")))
R.add("pii_flags", r"SELECT doc_id, regexp_matches(text, '[\w.+-]+@[\w-]+\.[\w.]+') OR regexp_matches(text, '\b\d{3}[-.\s]\d{3}[-.\s]\d{4}\b') OR regexp_matches(text, '\b\d{3}[ -]\d{3}[ -]\d{3}\b') AS pii FROM documents")(lambda t: t.documents.select("doc_id", ids.has_private_data(F.col("text")).alias("pii")))
R.add("normalised_hash", r"SELECT doc_id, sha256(lower(trim(regexp_replace(text, '\s+', ' ', 'g')))) AS h FROM documents")(lambda t: t.documents.select("doc_id", ids.normalised_hash(F.col("text")).alias("h")))
R.add("chunk_pack", """SELECT doc_id, list_reduce(list_prepend({'n': 0, 'size': 0}, list_transform(string_split(text, chr(10)), lambda l: {'n': 0, 'size': length(l)::INT})),
 lambda a, x: CASE WHEN a.n = 0 OR a.size + x.size > 400 THEN {'n': a.n + 1, 'size': x.size + 1} ELSE {'n': a.n, 'size': a.size + x.size + 1} END).n AS pieces FROM documents""")(lambda t: t.documents.select("doc_id", F.size(silver.pack_lines(F.col("text"), 400)).alias("pieces")))
R.add("chunk_headers", "SELECT doc_id, '[' || lang || ' | ' || source || ' | s. ' || doc_id || CASE WHEN doc_id % 2 = 0 THEN ' (part 1 of 2)' ELSE '' END || ']' AS header FROM documents")(
    lambda t: t.documents.select("doc_id", silver.header(F.col("lang"), F.col("source"), F.lit(None).cast("string"), F.concat(F.lit("s. "), F.col("doc_id").cast("string")), F.lit(""), F.when(F.col("doc_id") % 2 == 0, " (part 1 of 2)").otherwise("")).alias("header")))


def _chunks(t: Tables):
    units = t.documents.select(F.col("doc_id").cast("string").alias("unit_id"), F.col("doc_id").cast("string").alias("doc_id"), F.col("source").alias("source_id"), F.concat(F.lit("s. "), F.col("doc_id").cast("string")).alias("unit_ref"), F.lit(None).cast("string").alias("context_path"), F.lit(None).cast("string").alias("heading"), "text", F.lit(True).alias("is_current"), F.lit(False).alias("is_repealed"), F.lit(True).alias("in_force"), F.col("lang").alias("jurisdiction"), F.lit(None).cast("string").alias("title"))
    return silver.build_chunks(units, 10**9)


R.add("chunk_ids", r"SELECT doc_id::VARCHAR AS doc_id, sha256(doc_id || chr(31) || '0' || chr(31) || '1') AS chunk_id, '[' || lang || ' | ' || source || ' | s. ' || doc_id || ']' AS context_header FROM documents WHERE trim(regexp_replace(text, '\s+', ' ', 'g')) <> ''")(lambda t: _chunks(t).select("doc_id", "chunk_id", "context_header"))

SYNC = """WITH e AS (SELECT DISTINCT doc_id::VARCHAR AS c FROM labels), d AS (SELECT doc_id::VARCHAR AS c FROM documents WHERE lang = 'en'),
r AS (SELECT coalesce(d.c, e.c) AS chunk_id, CASE WHEN e.c IS NULL THEN 'inserted' WHEN d.c IS NULL THEN 'retired' ELSE 'unchanged' END AS action FROM d FULL JOIN e ON d.c = e.c)
"""


def _sync(t: Tables):
    existing = t.labels.select(F.col("doc_id").cast("string").alias("chunk_id"), F.lit(True).alias("is_active"))
    return silver.sync(existing, t.documents.filter("lang = 'en'").select(F.col("doc_id").cast("string").alias("chunk_id")))


R.add("chunk_sync_rows", SYNC + "SELECT * FROM r")(_sync)
R.add("chunk_sync_counts", SYNC + "SELECT action, count(*) AS n FROM r GROUP BY action")(lambda t: _sync(t).groupBy("action").agg(F.count("*").alias("n")))
R.add("html_title", "SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title FROM pages")(lambda t: t.pages.select("page_id", markup.html_title(F.col("html")).alias("title")))
R.add("html_links", """SELECT page_id, i - 1 AS pos, l[i] AS href FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?i)href="([^"]*)"', 1) AS l FROM pages))""")(lambda t: t.pages.select("page_id", F.posexplode(markup.html_links(F.col("html"))).alias("pos", "href")).withColumn("pos", F.col("pos").cast("long")))
R.add("link_targets", """SELECT page_id, nullif(regexp_extract('/legislation' || regexp_extract(url, '//[^/]*(/[^?#]*)', 1), '/legislation/([^/?#]+)', 1), '') AS target FROM pages""")(lambda t: t.pages.select("page_id", ids.target_document(F.concat(F.lit("/legislation"), F.regexp_extract("url", "//[^/]*(/[^?#]*)", 1))).alias("target")))


@R.add("stream_available_now", "SELECT event_id, user_id FROM events")
def stream_available_now(t: Tables):
    """All events, delivered by a stream and merged by key, twice over: what comes again changes nothing."""
    base = f"{t.shared()}/stream-{os.urandom(8).hex()}"
    store, schema = TableStore(t.spark, f"{base}/lake"), t.events.schema
    sink = lambda df, k: ingest.into(store, "ops.watermarks")(df.select(F.lit("events").alias("source_system"), F.col("event_id").cast("string").alias("scope"), F.col("user_id").cast("string").alias("watermark_value"), F.lit("2024-01-01").cast("timestamp").alias("updated_at"), F.lit("stream").alias("load_id")), k)
    for position in ("first", "again"):
        ingest.available_now(t.spark, f"{t.sf_dir}/events.parquet*", schema, f"{base}/{position}", ["event_id"], sink)
    return store.read("ops.watermarks").select(F.col("scope").cast("long").alias("event_id"), F.col("watermark_value").cast("long").alias("user_id"))


@R.add("stream_register", DEDUP + "SELECT * FROM r")
def stream_register(t: Tables):
    """Documents arrive shuffled, in four batches; the first of each content by id is loaded, as one look at all of them would say."""
    base = f"{t.shared()}/register-{uuid.uuid4().hex}"
    rows = t.documents.select("doc_id", ids.content_hash(F.col("text")).alias("h"))
    files = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    rows.repartition(files, F.xxhash64("doc_id")).write.parquet(f"{base}/landed")
    arriving = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", -(-files // 4)).parquet(f"{base}/landed")
    known = t.benchmark.select(ids.content_hash(F.col("text")).alias("h"))
    registration.deliver(registration.outcomes(arriving, known, "h", "doc_id", "doc_id"), f"{base}/outcomes", f"{base}/position")
    return registration.settled(t.spark, f"{base}/outcomes", "long").select(F.col("id").alias("doc_id"), "reason")


MARKUP = b"""<r:act xmlns:r="urn:r" xmlns:x="urn:x"><part><num>2</num><text>Care</text><division><num>1</num><title>Safety</title>
<section><marginalnote>Drills</marginalnote><num>13</num><text>Held <link x:href="/legislation/a_01?x">once</link> a month.</text><hnote>[en. 2022]</hnote></section>
<section><marginalnote>Access</marginalnote><num>12</num><subsection><num>1</num><text>Repealed. [2001]</text></subsection><subsection><num>2</num><text>A person must</text><paragraph><num>a</num><text>give access</text></paragraph></subsection></section>
</division></part><section><marginalnote>Not in force</marginalnote><num>15</num><text>[Not in force.]</text></section><section><num>30-31</num><hnote>[rep. 2001]</hnote></section>
<conseqhead><section><num>99</num></section></conseqhead><schedule><scheduletitle>Schedule A</scheduletitle><section><num>1</num>
<table><trow><entry>Item</entry><entry>Persons</entry></trow><trow><entry>1</entry><entry/></trow></table></section></schedule></r:act>"""


@R.add("parsed_units", """SELECT * FROM (VALUES
(1, 's. 13', 'Part 2 Care > Division 1 Safety', 'Drills', 'Held once a month.', '[en. 2022]', false, true, 'a_01'),
(2, 's. 12', 'Part 2 Care > Division 1 Safety', 'Access', '(2) A person must' || chr(10) || '(a) give access', '(1) Repealed. [2001]', false, true, NULL),
(3, 's. 15', NULL, 'Not in force', '[Not in force.]', NULL, false, false, NULL), (4, 's. 30-31', NULL, NULL, '', '[rep. 2001]', true, true, NULL),
(5, 'Sch. A, s. 1', 'Sch. A', NULL, 'Item: 1 | Persons: ', NULL, false, true, NULL)) v(unit_order, unit_ref, context_path, heading, text, history_note, is_repealed, in_force, target)""")
def parsed_units(t: Tables):
    """The markup's rules on a document that uses them."""
    u = markup.units(t.values([("a", "1", bytearray(MARKUP))], "source_id string, doc_id string, content binary"))
    return u.select("unit_order", "unit_ref", "context_path", "heading", "text", "history_note", "is_repealed", "in_force", ids.target_document(F.get("links.href", F.lit(0))).alias("target"))


@R.add("parsed_documents", r"""WITH l AS (SELECT doc_id, lang, string_split(regexp_replace(text, '[^A-Za-z0-9 \n]+', ' ', 'g'), chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, lang, i, trim(regexp_replace(ls[i], ' +', ' ', 'g')) AS x FROM (SELECT doc_id, lang, ls, unnest(range(1, len(ls) + 1)) AS i FROM l))
SELECT doc_id, i::INT AS unit_order, 's. ' || i AS unit_ref, 'Part ' || doc_id || ' Docs' AS context_path, lang AS heading, x AS text, regexp_matches(x, '(?i)^repealed\b') AS is_repealed FROM s""")
def parsed_documents(t: Tables):
    """Documents as markup, a section for each line, cut into pieces of 4,096 bytes and parsed by the table function from SQL."""
    lines = F.split(F.regexp_replace("text", "[^A-Za-z0-9 \n]+", " "), "\n", -1)
    section = lambda x, i: F.concat(F.lit("<section><num>"), i + 1, F.lit("</num><marginalnote>"), F.coalesce("lang", F.lit("")), F.lit("</marginalnote><text>"), x, F.lit("</text></section>"))
    body = F.concat(F.lit("<act><part><num>"), F.col("doc_id"), F.lit("</num><title>Docs</title>"), F.array_join(F.transform(lines, section), ""), F.lit("</part></act>"))
    docs = t.documents.filter("text is not null").select(F.lit("d").alias("source_id"), F.col("doc_id").cast("string").alias("doc_id"), body.cast("binary").alias("content"))
    markup.register_functions(t.spark)
    found = t.spark.sql("SELECT * FROM sections(TABLE({pieces}) PARTITION BY (source_id, doc_id) ORDER BY piece)", pieces=markup.in_pieces(docs, 4096))
    return markup.meaning(found).select(F.col("doc_id").cast("long").alias("doc_id"), "unit_order", "unit_ref", "context_path", "heading", "text", "is_repealed")


def _store(t: Tables) -> TableStore:
    return TableStore(t.spark, f"{t.shared()}/lake-{uuid.uuid4().hex}")


@R.add("silver_load", """SELECT * FROM (VALUES ('unit', 's. 12', 'open', 1), ('unit', 's. 13', 'closed', 1), ('unit', 's. 13', 'open', 1), ('unit', 's. 15', 'open', 1), ('unit', 's. 30-31', 'open', 1), ('unit', 'Sch. A, s. 1', 'open', 1),
('chunk', 's. 12', 'open', 1), ('chunk', 's. 13', 'closed', 1), ('chunk', 's. 13', 'open', 1), ('chunk', 'Sch. A, s. 1', 'open', 1), ('vector', 'm', 'open', 3), ('vector', 'm', 'closed', 1), ('link', 's. 13', 'a_01', 2),
('mark', 'a', 'second', 1), ('run', 'silver', 'SUCCEEDED', 2), ('run', 'gold_embeddings', 'SUCCEEDED', 2)) v(kind, name, state, n)""")
def silver_load(t: Tables):
    """A document, then the same with one section changed: versions, chunks, vectors, links, positions and receipts."""
    store, sources = _store(t), t.values([("a", "Act", "XX")], "source_id string, title string, jurisdiction string")
    for version, doc in (("first", MARKUP), ("second", MARKUP.replace(b"a month", b"a week"))):
        runs.build_silver(store, t.values([("a", version, bytearray(doc))], "source_id string, doc_id string, content binary"), sources)
        runs.embed_chunks(store, runs.hash_embedder(32), "m", 32)
    state = lambda is_open: F.when(F.col(is_open), "open").otherwise("closed")
    rows = [
        store.read("silver.document_units").select(F.lit("unit").alias("kind"), F.col("unit_ref").alias("name"), state("is_current").alias("state")),
        store.read("silver.chunks").select(F.lit("chunk"), "unit_ref", state("is_active")),
        store.read("gold.chunk_embeddings").select(F.lit("vector"), "embedding_model", state("is_active")),
        store.read("silver.cross_references").select(F.lit("link"), "unit_ref", "target_doc_id"),
        store.read("ops.watermarks").select(F.lit("mark"), "scope", "watermark_value"),
        store.read("ops.run_log").select(F.lit("run"), "pipeline", "status"),
    ]
    total = rows[0]
    for r in rows[1:]:
        total = total.union(r)
    return total.groupBy("kind", "name", "state").agg(F.count("*").alias("n"))


@R.add("register_run", """SELECT item_id::VARCHAR || '.xml' AS file_name, sha256(text) AS doc_id, octet_length(encode(text)) AS file_size_bytes, 'application/xml' AS mime_type, 'act' AS doc_type, 'landing' AS scope
FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY item_id) AS rn FROM benchmark) WHERE rn = 1""")
def register_run(t: Tables):
    """The benchmark's items, landed as one batch twice and registered: content that is known doesn't come again."""
    store, source = _store(t), {"source_id": "s", "connector": "bclaws", "status": "approved", "doc_type": "act", "jurisdiction": "BC"}
    root = f"{store.root}/landing"
    for load in ("one", "two"):
        files = [{"source_id": "s", "file_name": f"{r.item_id}.xml", "source_ref": str(r.item_id), "source_url": "u", "source_version": load, "content": r.text.encode()} for r in t.benchmark.orderBy("item_id").collect()]  # some dozen items
        landing.write_batch(root, "bclaws", load, files, spark=t.spark)
        bronze.register(store, "bclaws", [source], root)
    mark = store.read("ops.watermarks").select("scope")  # one row
    return store.read("bronze.raw_documents").select("file_name", "doc_id", "file_size_bytes", "mime_type", "doc_type").join(F.broadcast(mark))
