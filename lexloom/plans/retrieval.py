"""Search, routing, answers and call-log analytics over the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexloom import config
from lexloom.functions import ids
from lexloom.operators import answer, gateway, route, runs, search
from lexloom.plans.common import Registry, Tables

R = Registry()
STOPS = ", ".join(f"'{w}'" for w in ids.STOP)
WORDS = f"""w AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda x: NOT list_contains([{STOPS}], x)) AS ws FROM documents),
q AS (SELECT item_id, list_distinct(list_filter(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda x: NOT list_contains([{STOPS}], x))) AS qs FROM benchmark)"""
#: Documents that have a vector are the searchable ones.
BM25 = f"""WITH RECURSIVE {WORDS}, c AS (SELECT w.doc_id, ws, len(ws) AS dl FROM w JOIN embeddings ON doc_id = vec_id), s AS (SELECT count(*) AS n, avg(dl) AS mean FROM c),
tf AS (SELECT doc_id, dl, word, count(*) AS tf FROM (SELECT doc_id, dl, unnest(ws) AS word FROM c) GROUP BY ALL), df AS (SELECT word, count(*) AS df FROM tf GROUP BY word),
k AS (SELECT item_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / mean))), 9) AS kw
      FROM (SELECT item_id, unnest(qs) AS word FROM q) JOIN df USING (word) JOIN tf USING (word), s GROUP BY item_id, doc_id),
v AS (SELECT b.item_id, e.vec_id AS doc_id, round(list_dot_product(e.embedding::DOUBLE[], x.embedding::DOUBLE[]) / (sqrt(list_dot_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[])) * sqrt(list_dot_product(x.embedding::DOUBLE[], x.embedding::DOUBLE[]))), 9) AS vec
      FROM benchmark b JOIN embeddings x ON x.vec_id = b.item_id, embeddings e WHERE e.vec_id IN (SELECT doc_id FROM documents)),
kr AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY kw DESC, doc_id) AS r FROM k WHERE kw > 0), vr AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY vec DESC, doc_id) AS r FROM v),
f AS (SELECT coalesce(a.item_id, b.item_id) AS item_id, coalesce(a.doc_id, b.doc_id) AS doc_id, round(coalesce(1 / (60 + a.r), 0) + coalesce(1 / (60 + b.r), 0), 12) AS fused, vec, a.r AS ar, b.r AS br
      FROM (SELECT * FROM vr WHERE r <= 20) a FULL JOIN (SELECT * FROM kr WHERE r <= 20) b ON a.item_id = b.item_id AND a.doc_id = b.doc_id),
h AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY fused DESC, ar NULLS LAST, br NULLS LAST, doc_id) AS rank FROM f)
"""


def search_index(t: Tables) -> search.SearchIndex:
    """The index of the searchable documents, written once for each state of their files."""
    corpus = t.documents.join(t.embeddings.select(F.col("vec_id").alias("doc_id"), "embedding"), "doc_id")
    return search.SearchIndex.open(corpus, t.shared(), "doc_id", "text", "embedding", t.state("documents", "embeddings"))


def _asked(t: Tables):
    return t.benchmark.join(t.embeddings, F.col("item_id") == F.col("vec_id")).select("item_id", F.col("embedding").alias("q"))


def _hybrid(t: Tables):
    return search_index(t).search(t.benchmark, _asked(t), "item_id", "text", "q").drop("kw")


R.add("tokens", f"WITH {WORDS} SELECT doc_id, len(ws) AS n, sha256(array_to_string(ws, ' ')) AS h FROM w")(lambda t: t.documents.select("doc_id", ids.words(F.col("text")).alias("w")).select("doc_id", F.size("w").cast("long").alias("n"), F.sha2(F.array_join("w", " "), 256).alias("h")))
R.add("term_freq", f"WITH {WORDS} SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest(ws) AS word FROM w) GROUP BY ALL")(lambda t: search.term_frequencies(t.documents, "doc_id", "text"))


@R.add("doc_freq_idf", f"WITH {WORDS}, d AS (SELECT word, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest(ws) AS word FROM w) GROUP BY word) SELECT word, df, round(ln(1 + ((SELECT count(*) FROM documents) - df + 0.5) / (df + 0.5)), 9) AS idf FROM d")
def doc_freq_idf(t: Tables):
    return search.document_frequencies(t.documents, "doc_id", "text").select("word", "df", F.round(ids.idf(F.col("n"), F.col("df")), 9).alias("idf"))


R.add("bm25_topk", BM25 + "SELECT item_id, doc_id, kw, r AS rank FROM kr WHERE r <= 10")(lambda t: search_index(t).keyword_top(t.benchmark, "item_id", "text", 10))
R.add("vector_topk", BM25 + "SELECT item_id, doc_id, vec, r AS rank FROM vr WHERE r <= 10")(lambda t: search_index(t).vector_top(_asked(t), "item_id", "q", 10))
R.add("rrf_hybrid", BM25 + "SELECT item_id, doc_id, fused, vec, rank FROM h WHERE rank <= 5")(_hybrid)
R.add("offtopic_gate", BM25 + "SELECT item_id, max(vec) AS best, coalesce(max(vec), 0) < 0.55 AS off_topic FROM h WHERE rank <= 5 GROUP BY item_id")(lambda t: _hybrid(t).groupBy("item_id").agg(F.max("vec").alias("best")).withColumn("off_topic", F.coalesce("best", F.lit(0.0)) < 0.55))
R.add("batch_hybrid", BM25 + "SELECT doc_id, count(*) AS questions, max(fused) AS best FROM h WHERE rank <= 5 GROUP BY doc_id")(lambda t: _hybrid(t).groupBy("doc_id").agg(F.count("*").alias("questions"), F.max("fused").alias("best")))

def _quoted(x) -> str:
    return "NULL" if x is None else str(x).lower() if isinstance(x, bool) else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"


def _values(rows: list[tuple], columns: str) -> str:
    return f"(VALUES {', '.join('(' + ', '.join(map(_quoted, r)) + ')' for r in rows)}) v({columns})"


SECTION = r"nullif(regexp_extract(question, '(?i)\b(?:section|sec\.?|s\.)\s*([0-9]+(?:\.[0-9]+)?(?:-[0-9]+)?)', 1), '')"
#: Turns of conversations ask for sections of the laws that the documents' sources are; documents are the sections.
ROUTED = rf"""WITH q AS (SELECT id, question, {SECTION} AS number FROM (SELECT conv_id * 100 + turn AS id, CASE WHEN turn % 4 = 3 THEN text ELSE 'what does ' || (CASE conv_id % 3 WHEN 0 THEN 'Section ' WHEN 1 THEN 'sec. ' ELSE 's.' END) || (conv_id % 40)
    || (CASE turn % 3 WHEN 0 THEN '' WHEN 1 THEN '-' || (conv_id % 40 + 2) ELSE '.' || (conv_id % 2) END) || ' of the src' || (conv_id % 20) || ' say? ' || text END AS question FROM conversations)),
l AS (SELECT source AS source_id, source AS name, min(doc_id) AS position FROM documents WHERE source IS NOT NULL GROUP BY source),
u AS (SELECT doc_id, source AS source_id, (CASE doc_id % 7 WHEN 6 THEN 'Sch. A, s. ' ELSE 's. ' END) || (doc_id // 20 % 40) || (CASE doc_id // 800 % 3 WHEN 0 THEN '' WHEN 1 THEN '-' || (doc_id // 20 % 40 + 2) ELSE '.' || (doc_id % 2) END) AS unit_ref,
  doc_id % 5 = 0 AS is_repealed, doc_id % 3 <> 0 AS in_force, CASE doc_id % 4 WHEN 0 THEN 'Repealed' WHEN 1 THEN 'Not in force' ELSE lang END AS heading, CASE WHEN doc_id % 2 = 0 THEN '[am. ' || (1990 + doc_id % 30) || ']' END AS history_note FROM documents),
r AS (SELECT q.*, (SELECT source_id FROM l WHERE regexp_matches(lower(q.question), '(^|[^a-z0-9])' || name || '($|[^a-z0-9])') ORDER BY length(name) DESC, position LIMIT 1) AS law FROM q),
h AS (SELECT r.id, u.*, CASE WHEN is_repealed THEN 'repealed' WHEN NOT in_force THEN 'not in force' ELSE 'in force' END AS status FROM r JOIN u ON (r.law IS NULL OR r.law = u.source_id) AND (u.unit_ref = 's. ' || r.number
  OR (regexp_matches(u.unit_ref, '^s\. [0-9]+-[0-9]+$') AND CASE WHEN regexp_full_match(r.number, '[0-9]+') THEN TRY_CAST(r.number AS INT) END BETWEEN TRY_CAST(regexp_extract(u.unit_ref, '([0-9]+)-', 1) AS INT) AND TRY_CAST(regexp_extract(u.unit_ref, '-([0-9]+)', 1) AS INT))))
"""


def _refs(t: Tables):
    n = F.col("conv_id") % 40
    kind = F.when(F.col("conv_id") % 3 == 0, "Section ").when(F.col("conv_id") % 3 == 1, "sec. ").otherwise("s.")
    end = F.when(F.col("turn") % 3 == 0, "").when(F.col("turn") % 3 == 1, F.concat(F.lit("-"), n + 2)).otherwise(F.concat(F.lit("."), F.col("conv_id") % 2))
    question = F.when(F.col("turn") % 4 == 3, F.col("text")).otherwise(F.concat(F.lit("what does "), kind, n, end, F.lit(" of the src"), F.col("conv_id") % 20, F.lit(" say? "), "text"))
    q = t.conversations.select((F.col("conv_id") * 100 + F.col("turn")).alias("id"), question.alias("question")).withColumn("number", ids.section_number(F.col("question")))
    laws = t.documents.filter("source IS NOT NULL").groupBy(F.col("source").alias("source_id")).agg(F.min("doc_id").alias("position")).withColumn("name", F.col("source_id"))
    return route.find_law(q, laws)


def _sections(t: Tables):
    n, d = F.floor(F.col("doc_id") / 20) % 40, F.col("doc_id")
    which = F.floor(d / 800) % 3
    ref = F.concat(F.when(d % 7 == 6, "Sch. A, s. ").otherwise("s. "), n, F.when(which == 0, "").when(which == 1, F.concat(F.lit("-"), n + 2)).otherwise(F.concat(F.lit("."), d % 2)))
    heading = F.when(d % 4 == 0, "Repealed").when(d % 4 == 1, "Not in force").otherwise(F.col("lang"))
    return t.documents.select("doc_id", F.col("source").alias("source_id"), ref.alias("unit_ref"), (d % 5 == 0).alias("is_repealed"), (d % 3 != 0).alias("in_force"), heading.alias("heading"), F.when(d % 2 == 0, F.concat(F.lit("[am. "), 1990 + d % 30, F.lit("]"))).alias("history_note"), F.lit(True).alias("is_current"))


def _hits(t: Tables):
    return route.named(_refs(t).filter("number IS NOT NULL"), _sections(t)).withColumn("status", route.status_of(F.col("is_repealed"), F.col("in_force")))


R.add("route_section", ROUTED + "SELECT id, number FROM q")(lambda t: _refs(t).select("id", "number"))
R.add("route_law", ROUTED + "SELECT id, law FROM r")(lambda t: _refs(t).select("id", "law"))
R.add("section_lookup_range", ROUTED + "SELECT id, doc_id, source_id, unit_ref FROM h")(lambda t: _hits(t).select("id", "doc_id", "source_id", "unit_ref"))
R.add("section_status", ROUTED + "SELECT id, doc_id, unit_ref, status FROM h")(lambda t: _hits(t).select("id", "doc_id", "unit_ref", "status"))
R.add("status_note", ROUTED + """SELECT id, doc_id, source_id || ', ' || unit_ref || CASE WHEN lower(heading) IN (status, 'repealed') THEN '' ELSE ' (' || heading || ')' END || ' is ' || status || ': ' ||
CASE WHEN status = 'not in force' THEN 'it was enacted but has not been brought into force, so it has no legal effect today' ELSE 'it has been repealed and no longer applies' END || '.' || coalesce(' History: ' || history_note, '') AS note
FROM h WHERE status <> 'in force'""")(lambda t: _hits(t).filter("status <> 'in force'").select("id", "doc_id", route.status_note(F.col("source_id"), F.col("unit_ref"), F.col("heading"), F.col("status"), F.col("history_note")).alias("note")))

#: Turns of conversations as replies: what they cite, of how many sources, and how their question was decided.
REPLY = """(SELECT conv_id * 100 + turn AS id, CASE WHEN conv_id % 7 = 0 THEN 'NOT_FOUND' WHEN conv_id % 7 = 1 THEN text ELSE text || ' See [' || (conv_id % 9) || '] and [' || turn || '], [' || turn || '].' END AS reply,
(conv_id % 6)::INT AS n, (turn % 3)::INT AS hits, (turn % 2)::INT AS inactive, conv_id % 100 / 100.0::DOUBLE AS best FROM conversations)"""


def _replies(t: Tables):
    c = F.col("conv_id")
    reply = F.when(c % 7 == 0, "NOT_FOUND").when(c % 7 == 1, F.col("text")).otherwise(F.concat("text", F.lit(" See ["), c % 9, F.lit("] and ["), "turn", F.lit("], ["), "turn", F.lit("].")))
    return t.conversations.select((c * 100 + F.col("turn")).alias("id"), reply.alias("reply"), (c % 6).cast("int").alias("n"), (F.col("turn") % 3).cast("int").alias("hits"), (F.col("turn") % 2).cast("int").alias("inactive"), (c % 100 / 100.0).alias("best"))


CITED = "list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(reply, '\\[([0-9]+)\\]', 1), lambda x: x::INT), lambda x: x >= 1 AND x <= n)))"
R.add("citations_valid", f"SELECT id, array_to_string({CITED}, ',') AS cited FROM {REPLY}")(lambda t: _replies(t).select("id", F.array_join(F.transform(ids.citations(F.col("reply"), F.col("n")), lambda x: x.cast("string")), ",").alias("cited")))
R.add("answer_route", f"""SELECT id, CASE WHEN hits > 0 AND inactive = hits THEN 'status' WHEN hits > 0 THEN coalesce(e, 'lookup') WHEN best::DOUBLE < 0.55 THEN 'not_found' ELSE coalesce(e, 'search') END AS route
FROM (SELECT *, CASE WHEN contains(reply, 'NOT_FOUND') THEN 'not_found' WHEN len({CITED}) = 0 THEN 'ungrounded' END AS e FROM {REPLY})""")(lambda t: _replies(t).select("id", route.answer_route(F.col("hits"), F.col("inactive"), F.col("best"), F.col("reply"), F.col("n")).alias("route")))
R.add("refusal_rate", f"""SELECT avg(CASE WHEN route IN ('not_found', 'ungrounded') THEN 1.0::DOUBLE ELSE 0 END) AS refused, count(*) AS answers FROM (SELECT CASE WHEN hits > 0 AND inactive = hits THEN 'status' WHEN hits > 0 THEN coalesce(e, 'lookup') WHEN best::DOUBLE < 0.55 THEN 'not_found' ELSE coalesce(e, 'search') END AS route
FROM (SELECT *, CASE WHEN contains(reply, 'NOT_FOUND') THEN 'not_found' WHEN len({CITED}) = 0 THEN 'ungrounded' END AS e FROM {REPLY}))""")(lambda t: route.refusals(_replies(t).select(route.answer_route(F.col("hits"), F.col("inactive"), F.col("best"), F.col("reply"), F.col("n")).alias("route"))))
R.add("prompt_blocks", "SELECT conv_id, array_to_string(list_transform(range(1, len(b) + 1), lambda i: '[' || i || '] ' || substring(b[i], 1, 2000 // len(b))), chr(10) || chr(10)) AS prompt FROM (SELECT conv_id, list(text ORDER BY turn, text) AS b FROM conversations GROUP BY conv_id)")(
    lambda t: t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("b")).select("conv_id", route.prompt_blocks(F.transform("b", lambda x: x["text"]), 2000).alias("prompt")))
R.add("request_hash", "SELECT conv_id, sha256(string_agg(role || chr(31) || text, chr(31) ORDER BY turn, text)) AS h FROM conversations GROUP BY conv_id")(
    lambda t: t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text", "role"))).alias("m")).select("conv_id", ids.sha(F.array_join(F.transform("m", lambda x: F.concat_ws(ids.SEPARATOR, x["role"], x["text"])), ids.SEPARATOR)).alias("h")))

PRICES = [("view", 0.5, 1.5), ("click", 0.1, 0.4), ("purchase", 3.0, 15.0)]
COST = "round(coalesce(event_id, 0) / 1e6 * coalesce(pin::DOUBLE, 0) + coalesce(user_id, 0) / 1e6 * coalesce(pout::DOUBLE, 0), 8)"
PRICED = f"FROM events LEFT JOIN {_values([(a, str(b), str(c)) for a, b, c in PRICES], 'model, pin, pout')} ON event_type = model"


def _priced(t: Tables):
    p = t.values(PRICES, "model string, pin double, pout double")
    return t.events.join(F.broadcast(p), F.col("event_type") == F.col("model"), "left").withColumn("cost", ids.cost_usd(F.col("event_id"), F.col("user_id"), F.col("pin"), F.col("pout")))


R.add("cost_by_model", f"SELECT event_type, round(sum({COST}), 4) AS cost, count(*) AS calls {PRICED} GROUP BY event_type")(lambda t: _priced(t).groupBy("event_type").agg(F.round(F.sum("cost"), 4).alias("cost"), F.count("*").alias("calls")))
R.add("cost_per_1000", f"SELECT ts::DATE AS day, round(1000 * sum({COST}) / count(*), 4) AS cost {PRICED} GROUP BY 1")(lambda t: _priced(t).groupBy(F.to_date("ts").alias("day")).agg(F.round(1000 * F.sum("cost") / F.count("*"), 4).alias("cost")))
R.add("tokens_today", "SELECT coalesce(sum(coalesce(event_id, 0) + coalesce(user_id, 0)), 0) AS used FROM events WHERE ts::DATE = DATE '2024-01-10'")(lambda t: gateway.used_on(t.events, F.lit("2024-01-10").cast("date"), "event_id", "user_id", "ts"))



#: Documents with a vector are chunks and sections of their sources; benchmark items are questions, every third of them about a section.
ASKED = """, qn AS (SELECT item_id, CASE WHEN item_id % 3 = 0 THEN 'Section ' || item_id || ': ' || text ELSE text END AS question, item_id % 3 = 0 AS numbered FROM benchmark WHERE item_id IN (SELECT vec_id FROM embeddings)),
un AS (SELECT doc_id, doc_id % 5 = 0 AS repealed, doc_id % 7 <> 6 AS in_force, text FROM documents), ex AS (SELECT item_id, u.* FROM qn JOIN un u ON numbered AND doc_id = item_id),
b AS (SELECT item_id, [CASE WHEN NOT repealed AND in_force THEN '[src | s. ' || doc_id || ']' || chr(10) || text END] AS bs, CASE WHEN NOT repealed AND in_force THEN 'lookup' ELSE 'status' END AS way, NULL::DOUBLE AS best FROM ex
  UNION ALL SELECT h.item_id, list(d.text ORDER BY rank), 'search', coalesce(max(vec), 0) FROM hx h JOIN documents d ON d.doc_id = h.doc_id WHERE rank <= 5 AND h.item_id NOT IN (SELECT item_id FROM ex) GROUP BY h.item_id),
m AS (SELECT item_id, CASE WHEN way = 'search' AND best < 0.9 THEN 'not_found' ELSE way END AS way, len(bs) AS n, 'Sources:' || chr(10) || chr(10) || array_to_string(list_transform(range(1, len(bs) + 1), lambda i: '[' || i || '] ' || substring(bs[i], 1, 3000 // len(bs))), chr(10) || chr(10)) || chr(10) || chr(10) || 'Question: ' || question AS asked
  FROM b JOIN qn USING (item_id)),
p AS (SELECT *, way IN ('lookup', 'search') AS sent, length(asked) % 5 AS k FROM m),
z AS (SELECT *, CASE WHEN NOT sent THEN way WHEN k = 0 THEN 'not_found' WHEN k > n THEN 'ungrounded' ELSE way END AS route FROM p)
"""


def stand_in(m, messages: list[dict]) -> tuple:
    """A provider that runs anywhere: a fifth of the texts get no answer, the others cite a block that their length names.  The
    first model times out on every second text."""
    said = messages[1]["content"]
    if m.name == "first" and len(said) % 2:
        raise TimeoutError
    return ("NOT_FOUND" if len(said) % 5 == 0 else f"It is so [{len(said) % 5}]."), len(said), 5


def _answers(t: Tables):
    n = F.col("item_id")
    number = F.when(n % 3 == 0, F.concat(F.lit("Section "), n, F.lit(": "), "text")).otherwise(F.col("text"))
    q = t.benchmark.join(t.embeddings, n == F.col("vec_id")).select(n.alias("qid"), number.alias("question"), F.col("embedding").alias("q"))
    d = F.col("doc_id")
    sections = t.documents.select(d.alias("chunk_id"), F.lit("src").alias("source_id"), F.concat(F.lit("s. "), d).alias("unit_ref"), (d % 5 == 0).alias("is_repealed"), (d % 7 != 6).alias("in_force"), "text", F.col("lang").alias("heading"), F.lit(None).cast("string").alias("history_note"), F.lit(True).alias("is_current"))
    index = search_index(t)
    library = answer.Library(sections.select("chunk_id", "source_id", "unit_ref", "text"), sections.drop("chunk_id"), _Named(index))
    settings = config.Config(over={"rag": config.SETTINGS["rag"] | {"min_vector_score": 0.9, "max_context_chars": 3000, "top_k": 5, "candidates": 20, "rrf_k": 60, "laws": {}}})
    models = [gateway.Model("first", "p", ("confidential",)), gateway.Model("second", "q", ("confidential",), 1.0, 2.0)]
    return answer.answers(q, library, models, stand_in, "run", 10**12, settings)


class _Named:
    """An index of documents as one of chunks."""

    def __init__(self, index: search.SearchIndex):
        self.index = index

    def search(self, *args):
        return self.index.search(*args).withColumnRenamed("doc_id", "chunk_id")


R.add("answers_batch", BM25 + ", hx AS (SELECT h.* FROM h)" + ASKED + "SELECT item_id AS qid, route, sent, CASE WHEN sent AND route = way THEN k END AS cited, CASE WHEN sent THEN length(asked) + 5 ELSE 0 END AS tokens FROM z")(
    lambda t: _answers(t).select("qid", "route", (F.size("calls") > 0).alias("sent"), F.get("sources", F.lit(0))["n"].cast("long").alias("cited"), F.coalesce(F.aggregate("calls", F.lit(0).cast("long"), lambda a, c: a + F.coalesce(c["prompt_tokens"], F.lit(0)) + F.coalesce(c["completion_tokens"], F.lit(0))), F.lit(0)).cast("long").alias("tokens")))
R.add("failover_chain", BM25 + ", hx AS (SELECT h.* FROM h)" + ASKED + """, a AS (SELECT item_id AS qid, 1 AS step, 'first' AS model, CASE WHEN length(asked) % 2 = 1 THEN 'error' ELSE 'ok' END AS status, CASE WHEN length(asked) % 2 = 1 THEN 'TimeoutError' END AS error_type, false AS fallback_used FROM z WHERE sent
UNION ALL SELECT item_id, 2, 'second', 'ok', NULL, true FROM z WHERE sent AND length(asked) % 2 = 1) SELECT * FROM a""")(
    lambda t: _answers(t).select("qid", F.posexplode("calls").alias("p", "c")).select("qid", (F.col("p") + 1).alias("step"), "c.model", "c.status", "c.error_type", "c.fallback_used"))

R.add("api_error_ratio", "SELECT user_id, avg(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0 END) AS ratio FROM events GROUP BY user_id")(lambda t: t.events.groupBy("user_id").agg(F.avg(F.when(F.col("event_type") == "error", F.lit(1.0)).otherwise(F.lit(0.0))).alias("ratio")))

#: Events as failed attempts: status, number, the answer's Retry-After, calls left and seconds to the limit's reset.
TRIED = """WITH e AS (SELECT event_id, CASE event_id % 9 WHEN 0 THEN NULL WHEN 1 THEN 403 WHEN 2 THEN 429 WHEN 3 THEN 500 WHEN 4 THEN 502 WHEN 5 THEN 503 WHEN 6 THEN 504 WHEN 7 THEN 404 ELSE 501 END AS status, 1 + user_id % 4 AS attempt,
CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN (user_id % 60)::VARCHAR WHEN 2 THEN 'soon' ELSE '1.5' END AS retry_after, CASE WHEN event_id % 5 < 3 THEN user_id % 2 END AS remaining, CASE WHEN event_id % 7 < 5 THEN user_id * 13 - 40 END AS reset_in FROM events)"""


@R.add("retry_waits", TRIED + """ SELECT event_id, (CASE WHEN status IS NULL THEN 2 ** (attempt - 1) WHEN remaining = 0 AND status IN (403, 429) THEN CASE WHEN greatest(coalesce(reset_in, 0), 0) + 1 <= 900 THEN greatest(coalesce(reset_in, 0), 0) + 1 END
WHEN status IN (429, 500, 502, 503, 504) THEN CASE WHEN regexp_full_match(coalesce(retry_after, ''), '[0-9]+') THEN retry_after::DOUBLE ELSE 2 ** (attempt - 1) END END)::DOUBLE AS wait FROM e""")
def retry_waits(t: Tables):
    e, u = F.col("event_id"), F.col("user_id")
    status = F.get(F.array(*(F.lit(x).cast("int") for x in (None, 403, 429, 500, 502, 503, 504, 404, 501))), (e % 9).cast("int"))
    after = F.when(e % 4 == 1, (u % 60).cast("string")).when(e % 4 == 2, "soon").when(e % 4 == 3, "1.5")
    return t.events.select(e, ids.retry_wait(status, 1 + u % 4, after, F.when(e % 5 < 3, u % 2), F.when(e % 7 < 5, u * 13 - 40)).alias("wait"))


R.add("lineage_trace", """SELECT l_orderkey, l_linenumber, o_custkey, c_name, n_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderpriority = '1-URGENT'""")(
    lambda t: t.lineitem.join(t.orders.filter("o_orderpriority = '1-URGENT'"), F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).select("l_orderkey", "l_linenumber", "o_custkey", "c_name", "n_name"))


@R.add("scorecard_30", """SELECT user_id, avg(CASE WHEN event_type <> 'error' THEN 1.0::DOUBLE ELSE 0 END) AS pass_rate, count(*) AS runs FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 30 GROUP BY user_id""")
def scorecard_30(t: Tables):
    w = Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    return t.events.withColumn("rn", F.row_number().over(w)).filter("rn <= 30").groupBy("user_id").agg(F.avg(F.when(F.col("event_type") != "error", F.lit(1.0)).otherwise(F.lit(0.0))).alias("pass_rate"), F.count("*").alias("runs"))


@R.add("recall_at_k", BM25 + """, e AS (SELECT item_id, list(doc_id) AS expected FROM kr WHERE r <= 3 GROUP BY item_id), g AS (SELECT item_id, list(doc_id) AS got FROM h WHERE rank <= 5 GROUP BY item_id)
SELECT item_id, len(list_intersect(expected, got)) / len(expected) AS recall FROM e JOIN g USING (item_id)""")
def recall_at_k(t: Tables):
    index = search_index(t)
    kw = index.keyword_top(t.benchmark, "item_id", "text", 20)  # its first three are what is expected
    e = kw.filter("rank <= 3").groupBy("item_id").agg(F.collect_set("doc_id").alias("e"))
    found = search.fuse(index.vector_top(_asked(t), "item_id", "q", 20).withColumnRenamed("rank", "vr"), kw.withColumnRenamed("rank", "kr"), "item_id", "doc_id")
    g = found.groupBy("item_id").agg(F.collect_set("doc_id").alias("g"))
    return e.join(g, "item_id").select("item_id", (F.size(F.array_intersect("e", "g")) / F.size("e")).alias("recall"))


R.add("judge_agreement", "SELECT avg(CASE WHEN abs(quality - toxic) <= 0 THEN 1.0::DOUBLE ELSE 0 END) AS exact, avg(CASE WHEN abs(quality - toxic) <= 1 THEN 1.0::DOUBLE ELSE 0 END) AS within_one FROM labels")(
    lambda t: t.labels.agg(F.avg(F.when(F.abs(F.col("quality") - F.col("toxic")) <= 0, F.lit(1.0)).otherwise(F.lit(0.0))).alias("exact"), F.avg(F.when(F.abs(F.col("quality") - F.col("toxic")) <= 1, F.lit(1.0)).otherwise(F.lit(0.0))).alias("within_one")))
R.add("retention_expired", "SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' - INTERVAL 1825 DAY")(lambda t: t.orders.filter("o_orderdate < TIMESTAMP_NTZ '1998-01-01' - INTERVAL '1825' DAY").select("o_orderkey"))
R.add("failed_rules_for_run", "SELECT event_id, value FROM events WHERE user_id = 7 AND event_type = 'error' ORDER BY event_id")(lambda t: t.spark.sql("SELECT event_id, value FROM {e} WHERE user_id = :run AND event_type = :status ORDER BY event_id", args={"run": 7, "status": "error"}, e=t.events))
R.add("calls_by_status", "SELECT event_type, user_id, count(*) AS calls FROM events GROUP BY ALL")(lambda t: t.events.groupBy("event_type", "user_id").agg(F.count("*").alias("calls")))
R.add("newest_runs", "SELECT event_id, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 50")(lambda t: t.events.orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(50).select("event_id", "user_id"))
R.add("embed_batches", "SELECT doc_id::VARCHAR AS chunk_id, (row_number() OVER (ORDER BY doc_id::VARCHAR) - 1) // 8 AS batch FROM documents WHERE lang = 'de'")(
    lambda t: runs.batches(t.documents.filter("lang = 'de'").select(F.col("doc_id").cast("string").alias("chunk_id")), 8).select("chunk_id", "batch"))
R.add("loaded_on", "SELECT source, strftime(max(TIMESTAMP '2024-01-01' + to_days((doc_id % 300)::INT)), '%Y-%m-%d') AS day FROM documents GROUP BY source")(
    lambda t: t.documents.groupBy("source").agg(F.date_format(F.max(F.expr("DATE '2024-01-01' + CAST(doc_id % 300 AS INT)")), "yyyy-MM-dd").alias("day")))
