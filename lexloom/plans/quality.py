"""Data-quality outcomes over the test tables."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import functions as F

from lexloom import catalog, governance, rules, scratch, tables
from lexloom.operators import carried, dq, silver
from lexloom.operators.dq import Rule
from lexloom.plans.common import Registry, Tables
from lexloom.sources import landing

R = Registry()


def _sql(rule: str, table: str, passed: str, observed: str, threshold: str, failed: str) -> str:
    return f"SELECT '{rule}' AS rule_id, ({passed}) AS passed, ({observed})::DOUBLE AS observed_value, ({threshold})::DOUBLE AS threshold, ({failed})::BIGINT AS failed_rows FROM {table}"


def _dup(table: str, key: str) -> str:
    return f"(SELECT coalesce(sum(CASE WHEN c > 1 THEN c END), 0) AS n, coalesce(sum(c), 0) AS total FROM (SELECT count(*) AS c FROM {table} GROUP BY {key}))"


#: name: (table, rule, SQL of the outcome)
SIMPLE = {
    "dq_unique": ("orders", Rule("dq_unique", "unique", "o_custkey"), _sql("dq_unique", _dup("orders", "o_custkey"), "n = 0", "n", "0", "n")),
    "dq_not_null": ("documents", Rule("dq_not_null", "not_null", "text"), _sql("dq_not_null", "documents", "count(*) FILTER (text IS NULL OR trim(text) = '') = 0", "count(*) FILTER (text IS NULL OR trim(text) = '')", "0", "count(*) FILTER (text IS NULL OR trim(text) = '')")),
    "dq_min": ("customer", Rule("dq_min", "min_value", "c_acctbal", 0), _sql("dq_min", "customer", "count(*) FILTER (c_acctbal < 0) = 0", "min(c_acctbal)", "0", "count(*) FILTER (c_acctbal < 0)")),
    "dq_max": ("part", Rule("dq_max", "max_value", "p_size", 45), _sql("dq_max", "part", "count(*) FILTER (p_size > 45) = 0", "max(p_size)", "45", "count(*) FILTER (p_size > 45)")),
    "dq_allowed": ("documents", Rule("dq_allowed", "allowed_values", "lang", values=("en", "fr", None)), _sql("dq_allowed", "documents", "count(*) FILTER (lang NOT IN ('en', 'fr')) = 0", "count(*) FILTER (lang NOT IN ('en', 'fr'))", "0", "count(*) FILTER (lang NOT IN ('en', 'fr'))")),
    "dq_row_count": ("orders", Rule("dq_row_count", "row_count_min", threshold=100), _sql("dq_row_count", "orders", "count(*) >= 100", "count(*)", "100", "NULL")),
    "dq_ratio_min": ("labels", Rule("dq_ratio_min", "ratio_min", threshold=0.5, expression="quality = 1"), _sql("dq_ratio_min", "labels", "coalesce(avg(CASE WHEN quality = 1 THEN 1.0::DOUBLE ELSE 0 END), 1) >= 0.5", "coalesce(avg(CASE WHEN quality = 1 THEN 1.0::DOUBLE ELSE 0 END), 1)", "0.5", "NULL")),
    "dq_ratio_max": ("events", Rule("dq_ratio_max", "ratio_max", threshold=0.1, expression="event_type = 'error'"), _sql("dq_ratio_max", "events", "avg(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0 END) <= 0.1", "avg(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0 END)", "0.1", "NULL")),
    "dq_fk": ("embeddings", Rule("dq_fk", "foreign_key", "vec_id", references="documents.doc_id"), _sql("dq_fk", "(SELECT count(*) AS n FROM embeddings WHERE NOT EXISTS (SELECT 1 FROM documents WHERE doc_id = vec_id))", "n = 0", "n", "0", "n")),
}
for _name, (_table, _rule, _query) in SIMPLE.items():
    R.add(_name, _query)(lambda t, table=_table, rule=_rule: dq.check_rules(getattr(t, table), [rule], lambda n: getattr(t, n)))


def _checked(name: str, check: str, sql: str, threshold: float | None = None, observed: str = "n", passed: str = "n = 0", failed: str = "n"):
    """Registers the outcome of a shipped rule's own check; the function gives its frame and what else it may look at."""
    def add(f):
        rule = Rule(name, "custom", threshold=threshold, expression=check)
        shown = 0 if threshold is None else threshold

        def run(t: Tables):
            df, context = f(t)
            return dq.check_rules(df, [rule], context=context)

        R.add(name, _sql(name, f"({sql})", passed, observed, str(shown), failed))(run)
        return f

    return add


def _chunks(t: Tables):
    """Documents as chunks, toxic ones private."""
    toxic = t.labels.filter("toxic = 1").select("doc_id", F.lit(True).alias("_toxic")).distinct()
    return t.documents.join(toxic, "doc_id", "left").select(F.col("doc_id").alias("chunk_id"), F.lit(True).alias("is_active"), F.coalesce("_toxic", F.lit(False)).alias("pii_flag"))


@_checked("dq_source_approved", "DQ-B-004", "SELECT count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def _approved(t: Tables):
    sources = t.labels.select(F.col("doc_id").alias("source_id"), F.when(F.col("quality") == 1, "approved").otherwise("pending").alias("status"))
    return t.documents.select(F.col("doc_id").alias("source_id")), dq.Context(sources=sources)


@_checked("dq_landed_intact", "DQ-B-005", "SELECT count(*) AS n FROM benchmark WHERE item_id % 3 = 0 OR item_id % 5 = 0")
def _landed(t: Tables):
    """The benchmark's items as landed files: every third holds other bytes, every fifth is missing."""
    root = f"{t.shared()}/landed-{uuid.uuid4().hex}"
    for r in t.benchmark.collect():  # some dozen items
        if r.item_id % 5:
            landing.write_bytes(t.spark, f"{root}/bench/{r.item_id}.txt", r.text.encode() if r.item_id % 3 else b"other")
    files = t.benchmark.select(F.concat(F.lit("bench/"), F.col("item_id").cast("string"), F.lit(".txt")).alias("landing_path"), F.sha2("text", 256).alias("doc_id"))
    return files, dq.Context(landing_root=root)


@_checked("dq_stuck_runs", "DQ-O-001", "SELECT count(*) AS n FROM events WHERE event_type = 'view' AND ts < TIMESTAMP '2024-01-20' - INTERVAL 2 HOUR")
def _stuck(t: Tables):
    at = F.expr("CAST(convert_timezone('UTC', current_timezone(), ts) AS TIMESTAMP)")
    return t.events.select(F.when(F.col("event_type") == "view", "RUNNING").otherwise("SUCCEEDED").alias("status"), at.alias("started_at")), dq.Context(now=datetime(2024, 1, 20, tzinfo=UTC))


@_checked("dq_rule_known", "DQ-O-002", "SELECT count(*) AS n FROM events WHERE event_type NOT IN ('view', 'click')")
def _known(t: Tables):
    return t.events.select(F.col("event_type").alias("rule_id")), dq.Context(rule_ids=("view", "click"))


@_checked("dq_dup_share", "DQ-S-005", "SELECT *, coalesce(n / nullif(total, 0), 0) AS share FROM " + _dup("documents", "sha256(text)"), 0.05, "round(share, 4)", "share <= 0.05")
def _repeats(t: Tables):
    return t.documents.select(F.sha2(F.col("text").cast("binary"), 256).alias("text_hash")), None


@_checked("dq_one_current", "DQ-S-007", "SELECT * FROM " + _dup("(SELECT * FROM lineitem WHERE l_returnflag <> 'R') x", "l_orderkey, l_linestatus"))
def _current(t: Tables):
    return t.lineitem.select(F.col("l_orderkey").alias("source_id"), F.col("l_linestatus").alias("unit_ref"), (F.col("l_returnflag") != "R").alias("is_current")), None


@_checked("dq_live_units", "DQ-S-008", "SELECT count(*) AS n FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents WHERE lang IN ('en', 'fr'))")
def _live(t: Tables):
    units = t.documents.select(F.col("doc_id").alias("unit_id"), F.lit(True).alias("is_current"), (F.col("lang") == "de").alias("is_repealed"), (F.col("lang") != "es").alias("in_force"))
    return t.embeddings.select(F.col("vec_id").alias("unit_id")), dq.Context({"silver.document_units": units}.__getitem__)


@_checked("dq_version", "DQ-S-010", "SELECT count(*) AS n FROM part WHERE p_brand <> 'Brand#11'")
def _version(t: Tables):
    return t.part.select(F.col("p_brand").alias("chunker_version")), dq.Context(chunker_version="Brand#11")


@_checked("dq_coverage", "DQ-G-001", "SELECT count(*) AS n, count(*) FILTER (doc_id NOT IN (SELECT vec_id FROM embeddings)) AS miss FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)", 1.0, "round(1 - miss / n, 4)", "miss = 0", "miss")
def _coverage(t: Tables):
    return t.embeddings.select(F.col("vec_id").alias("chunk_id")), dq.Context({"silver.chunks": _chunks(t)}.__getitem__)


@_checked("dq_vector_len", "DQ-G-002", "SELECT count(*) AS n FROM embeddings WHERE len(embedding) <> 64 OR vec_id % 5 = 0", 64)
def _length(t: Tables):
    declared = F.when(F.col("vec_id") % 5 == 0, 32).otherwise(64).alias("embedding_dim")
    return t.embeddings.select(declared, F.col("embedding").alias("vector")), dq.Context(vector_length=64)


@_checked("dq_has_source", "DQ-G-007", "SELECT count(*) AS n FROM conversations WHERE role = 'user' OR text IS NULL")
def _sourced(t: Tables):
    return t.conversations.select(F.when(F.col("role") != "user", F.array("text")).when(F.col("text").isNotNull(), F.array().cast("array<string>")).alias("expected_sources")).select(F.when(F.get("expected_sources", F.lit(0)).isNotNull(), F.col("expected_sources")).alias("expected_sources")), None


@_checked("dq_no_orphan_vector", "DQ-G-010", "SELECT count(*) AS n FROM embeddings WHERE vec_id IN (SELECT doc_id FROM labels WHERE toxic = 1) OR vec_id NOT IN (SELECT doc_id FROM documents)")
def _orphan(t: Tables):
    return t.embeddings.select(F.col("vec_id").alias("chunk_id")), dq.Context({"silver.chunks": _chunks(t)}.__getitem__)


@_checked("dq_class_allowed", "DQ-G-011", "SELECT count(*) AS n FROM events e LEFT JOIN (VALUES ('view', ['public', 'internal']), ('click', ['public', 'internal', 'confidential']), ('error', ['public'])) m(model, allowed) ON event_type = model WHERE NOT coalesce(list_contains(allowed, ['public', 'internal', 'confidential', 'restricted'][user_id % 4 + 1]), false)")
def _classes(t: Tables):
    level = F.get(F.array(*map(F.lit, ("public", "internal", "confidential", "restricted"))), (F.col("user_id") % 4).cast("int"))
    models = {"view": ("public", "internal"), "click": ("public", "internal", "confidential", "restricted"), "error": ("public",)}
    return t.events.select(F.col("event_type").alias("model"), level.alias("data_classification")), dq.Context(models=models)


RULES = [
    Rule("r1", "unique", "c_custkey", severity="critical", dimension="uniqueness"),
    Rule("r2", "min_value", "c_acctbal", 0, severity="warning"),
    Rule("r3", "not_null", "c_name", severity="critical", dimension="completeness"),
    Rule("r4", "ratio_min", threshold=0.9, expression="c_acctbal > 0", severity="critical"),
    Rule("r5", "foreign_key", "c_nationkey", references="nation.n_nationkey", severity="critical", dimension="consistency"),
]
REPORT = """WITH o AS (SELECT 'r1' AS rule_id, 'critical' AS severity, count(*) = count(DISTINCT c_custkey) AS ok FROM customer
UNION ALL SELECT 'r2', 'warning', count(*) FILTER (c_acctbal < 0) = 0 FROM customer UNION ALL SELECT 'r3', 'critical', count(*) FILTER (c_name IS NULL OR trim(c_name) = '') = 0 FROM customer
UNION ALL SELECT 'r4', 'critical', avg(CASE WHEN c_acctbal > 0 THEN 1.0::DOUBLE ELSE 0 END) >= 0.9 FROM customer
UNION ALL SELECT 'r5', 'critical', count(*) = 0 FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation))
"""


def _report(t: Tables):
    return dq.results(dq.check_rules(t.customer, RULES, lambda n: getattr(t, n)), RULES, "customer", "run")


R.add("dq_report", REPORT + "SELECT rule_id, severity, CASE WHEN ok THEN 'pass' ELSE 'fail' END AS status FROM o")(lambda t: _report(t).select("rule_id", "severity", "status"))


@R.add("dq_gate", REPORT + """SELECT count(*) FILTER (NOT ok AND severity = 'critical') AS critical, count(*) FILTER (NOT ok AND severity <> 'critical') AS warnings, count(*) FILTER (ok) AS passed,
CASE WHEN count(*) FILTER (NOT ok AND severity = 'critical') > 0 THEN 'FAIL' WHEN count(*) FILTER (NOT ok) > 0 THEN 'WARN' ELSE 'PASS' END AS summary FROM o""")
def dq_gate(t: Tables):
    bad, crit = F.col("status") == "fail", F.col("severity") == "critical"
    a = _report(t).agg(F.count_if(bad & crit).alias("critical"), F.count_if(bad & ~crit).alias("warnings"), F.count_if(~bad).alias("passed"))
    return a.withColumn("summary", F.when(F.col("critical") > 0, "FAIL").when(F.col("warnings") > 0, "WARN").otherwise("PASS"))


@R.add("table_counts", "SELECT 'documents' AS table_name, count(*) AS rows FROM documents UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'events', count(*) FROM events")
def table_counts(t: Tables):
    return tables.counted(t.spark, {n: getattr(t, n) for n in ("documents", "orders", "events")})


@R.add("adhoc_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def adhoc_limit(t: Tables):
    t.orders.createOrReplaceTempView("adhoc_orders")
    return t.spark.sql("SELECT o_orderkey, o_totalprice FROM adhoc_orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")


@R.add("catalog_rule_counts", """SELECT table_name, rules, critical FROM (VALUES ('bronze.raw_documents', 8, 8), ('silver.document_units', 2, 2), ('silver.chunks', 7, 4), ('silver.cross_references', 1, 1), ('gold.chunk_embeddings', 3, 3),
('gold.entities', 1, 1), ('gold.relationships', 2, 2), ('gold.llm_call_log', 2, 1), ('gold.eval_questions', 1, 1), ('gold.eval_results', 2, 2), ('ops.run_log', 1, 0), ('ops.dq_results', 1, 1), ('ops.api_call_log', 1, 0), ('ops.watermarks', 1, 1)) v(table_name, rules, critical)""")
def catalog_rule_counts(t: Tables):
    names = t.values([(n,) for n in catalog.TABLES], "table_name string")
    each = t.values([(table, r.rule_id, r.severity) for table, r in rules.SHIPPED], "table_name string, rule_id string, severity string")
    return names.join(each, "table_name", "left").groupBy("table_name").agg(F.count("rule_id").alias("rules"), F.count_if(F.col("severity") == "critical").alias("critical"))


@R.add("layer_classification", "SELECT * FROM (VALUES ('bronze', 'Public'), ('silver', 'Public'), ('gold', 'Mixed'), ('ops', 'Internal')) v(layer, classification)")
def layer_classification(t: Tables):
    return t.values(list(governance.layer_classes(list(catalog.TABLES.values())).items()), "layer string, classification string")


@R.add("embed_todo_retire", """WITH w AS (SELECT doc_id::VARCHAR AS c FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)), v AS (SELECT vec_id::VARCHAR AS c FROM embeddings)
SELECT coalesce(w.c, v.c) AS chunk_id, CASE WHEN v.c IS NULL THEN 'inserted' WHEN w.c IS NULL THEN 'retired' ELSE 'unchanged' END AS action FROM w FULL JOIN v ON w.c = v.c""")
def embed_todo_retire(t: Tables):
    toxic = t.labels.filter("toxic = 1").select("doc_id", F.lit(True).alias("pii_flag"))
    chunks = t.documents.join(toxic, "doc_id", "left").select(F.col("doc_id").cast("string").alias("chunk_id"), F.lit(True).alias("is_active"), F.coalesce("pii_flag", F.lit(False)).alias("pii_flag"))
    vectors = t.embeddings.select(F.col("vec_id").cast("string").alias("chunk_id"), F.lit("m").alias("embedding_model"), F.lit(True).alias("is_active"))
    return silver.embed_todo(chunks, vectors, "m")


#: Orders arrive in four loads, customers in three (the last brings none); the rules are looked at after each load.
CARRIED_RULES = [
    dq.Rule("R1", "unique", "o_orderkey"), dq.Rule("R2", "unique", columns=("o_custkey", "o_orderpriority")), dq.Rule("R3", "foreign_key", "o_custkey", references="customer.c_custkey"), dq.Rule("R4", "min_value", "o_totalprice", 2000.0),
    dq.Rule("R5", "max_value", "o_totalprice", 300000.0), dq.Rule("R6", "allowed_values", "o_orderstatus", values=("F", "O")), dq.Rule("R7", "row_count_min", threshold=100.0), dq.Rule("R8", "ratio_min", expression="o_totalprice > 50000", threshold=0.8), dq.Rule("R9", "not_null", "o_orderpriority"),
]
CARRIED = """WITH n AS (SELECT unnest(range(4)) AS load), o AS (SELECT n.load, orders.* FROM n, orders WHERE o_orderkey % 4 <= load), c AS (SELECT n.load, c_custkey FROM n, customer WHERE c_custkey % 3 <= load),
k AS (SELECT load, o_custkey, o_orderpriority, count(*) AS c FROM o GROUP BY ALL), u AS (SELECT load, o_orderkey, count(*) AS c FROM o GROUP BY ALL), s AS (SELECT load, count(*) AS n, min(o_totalprice)::DOUBLE AS low, max(o_totalprice)::DOUBLE AS high, count(*) FILTER (WHERE o_totalprice < 2000) AS b4,
  count(*) FILTER (WHERE o_totalprice > 300000) AS b5, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O') OR o_orderstatus IS NULL) AS b6, avg(CASE WHEN o_totalprice > 50000 THEN 1.0::DOUBLE ELSE 0 END) AS r, count(*) FILTER (WHERE trim(coalesce(o_orderpriority, '')) = '') AS b9 FROM o GROUP BY load),
f AS (SELECT 'R1' AS rule_id, load, coalesce(sum(c) FILTER (WHERE c > 1), 0)::BIGINT AS b FROM u GROUP BY load UNION ALL SELECT 'R2', load, coalesce(sum(c) FILTER (WHERE c > 1), 0)::BIGINT FROM k GROUP BY load
  UNION ALL SELECT 'R3', o.load, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.load = o.load AND c.c_custkey = o.o_custkey)) FROM o GROUP BY o.load)
SELECT load, rule_id, b = 0 AS passed, b::DOUBLE AS observed_value, b AS failed_rows FROM f UNION ALL SELECT load, 'R4', b4 = 0, low, b4 FROM s UNION ALL SELECT load, 'R5', b5 = 0, high, b5 FROM s UNION ALL SELECT load, 'R6', b6 = 0, b6::DOUBLE, b6 FROM s
UNION ALL SELECT load, 'R7', n >= 100, n::DOUBLE, NULL FROM s UNION ALL SELECT load, 'R8', r >= 0.8, r, NULL FROM s UNION ALL SELECT load, 'R9', b9 = 0, b9::DOUBLE, b9 FROM s"""


@R.add("dq_carried", CARRIED)
def dq_carried(t: Tables):
    """Outcomes after each of four loads of orders, each from the load and what the loads before have left."""
    state, total = carried.Carried(t.spark, scratch.folder(t.spark, "rules"), CARRIED_RULES, buckets=64), None
    for k in range(4):
        new = t.customer.filter(F.col("c_custkey") % 3 == k) if k < 3 else t.customer.limit(0)
        draft = state.draft(t.orders.filter(F.col("o_orderkey") % 4 == k), parents={"customer": (new, None)})
        one = draft.outcomes.select(F.lit(k).cast("long").alias("load"), "rule_id", "passed", F.col("observed_value"), "failed_rows")
        draft.commit()
        total = one if total is None else total.unionByName(one)
    return total
