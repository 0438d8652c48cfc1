"""Governance as code: what is wrong with a catalog, its rules and its sources, and what the metastore is told of them.

What is declared becomes frames (tables, columns, keys, rules, needs, sources, fields), and what must hold of them is a list of
constraints: a key is unique, a value is a member of a register, a condition holds.  Each constraint is a query for its
violations; all of a list run as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexloom import catalog, rules
from lexloom.catalog import CLASSIFICATIONS, LAYERS, NO_LOAD_ID, TYPES, Table
from lexloom.operators.dq import Rule

#: Owner and steward of each domain.
OWNERS = {"regulations": ("data owner", "data steward"), "ai_operations": ("ai owner", "ai steward"), "evaluation": ("ai owner", "ai steward"), "platform": ("platform owner", "platform steward")}
# Fixed values of the source register.
SOURCE_FIELDS = ("source_id", "connector", "title", "publisher", "url", "doc_type", "jurisdiction", "classification", "license_note", "redistribute_raw", "status")
TEXTS = ("source_id", "jurisdiction", "doc_type", "repo_path", "document_id", "status")
PLACE = {"github": "repo_path", "bclaws": "document_id"}
KINDS, JURISDICTIONS = ("act", "regulation", "inspection_report"), ("ON", "BC")


def unique(frame: str, key: str, what: str, subject: str = "") -> str:
    """Violations: keys that more than one row has."""
    return f"SELECT concat({subject or key}, ': {what}') AS problem FROM {{{frame}}} WHERE {key} IS NOT NULL GROUP BY {subject + ', ' if subject and subject != key else ''}{key} HAVING count(*) > 1"


def member(frame: str, column: str, register: str, what: str, subject: str = "name") -> str:
    """Violations: rows whose column a register lacks; NULLs are no concern of it."""
    return f"SELECT concat({subject}, ': {what} ', {column}) FROM {{{frame}}} x WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {{registers}} r WHERE r.register = '{register}' AND r.value = x.{column})"


def holds(frame: str, condition: str, what: str, subject: str = "name") -> str:
    """Violations: rows that don't meet a condition; NULL is unmet.  what is an SQL expression."""
    return f"SELECT concat({subject}, ': ', {what}) FROM {{{frame}}} WHERE NOT coalesce({condition}, false)"


CATALOG = (
    unique("tables", "name", "defined twice"),
    unique("columns", "concat(name, ': column ', column)", "is declared twice"),
    member("tables", "layer", "layer", "unknown layer"),
    member("tables", "classification", "classification", "unknown classification"),
    holds("tables", "domain IN (SELECT value FROM {registers} WHERE register = 'domain')", "concat('domain ', domain, ' has no owner')"),
    holds("tables", "retention_days > 0", "'retention_days must be a positive number'"),
    member("tables", "mode", "mode", "unknown write mode"),
    holds("tables", "keys > 0", "'no key'"),
    "SELECT concat(k.name, ': key column ', k.column, ' is not declared') FROM {keys} k LEFT ANTI JOIN {columns} c ON k.name = c.name AND k.column = c.column",
    "SELECT concat(name, ': type ', type, ' of ', column, ' is unknown') FROM {columns} LEFT ANTI JOIN {registers} r ON r.register = 'type' AND r.value = type",
    "SELECT concat(t.name, ': load_id is missing') FROM {tables} t LEFT ANTI JOIN {columns} c ON t.name = c.name AND c.column = 'load_id' WHERE layer IN ('bronze', 'silver', 'gold') AND t.name NOT IN (SELECT value FROM {registers} WHERE register = 'no load_id')",
)
RULES = (
    unique("rules", "rule_id", "declared twice"),
    member("rules", "check", "check", "unknown check", "rule_id"),
    member("rules", "severity", "severity", "unknown severity", "rule_id"),
    member("rules", "dimension", "dimension", "unknown dimension", "rule_id"),
    "SELECT concat(rule_id, ': unknown table ', r.name) FROM {rules} r LEFT ANTI JOIN {tables} t ON t.name = r.name",
    "SELECT concat(rule_id, ': unknown column ', r.column) FROM {rules} r LEFT SEMI JOIN {tables} t ON t.name = r.name LEFT ANTI JOIN {columns} c ON c.name = r.name AND c.column = r.column WHERE r.column IS NOT NULL",
    "SELECT concat(rule_id, ': unknown reference ', coalesce(target, ''), '.', coalesce(target_column, '')) FROM {rules} r LEFT ANTI JOIN {columns} c ON c.name = r.target AND c.column = r.target_column WHERE r.check = 'foreign_key'",
    "SELECT concat(rule_id, ': check ', check, ' needs ', need) FROM {needs} WHERE NOT given",
    "SELECT concat(t.name, ': no rule') FROM {tables} t LEFT ANTI JOIN {rules} r ON r.name = t.name",
)
SOURCES = (
    unique("sources", "name", "duplicate source_id"),
    unique("sources", "place", "used by more than one source"),
    "SELECT concat(name, ': missing ', value) FROM {sources} s JOIN {registers} r ON r.register = 'field' LEFT ANTI JOIN {fields} f ON f.k = s.k AND f.field = r.value",
    "SELECT concat(name, ': ', field, ' must be a string, not ', shown) FROM {fields} JOIN {registers} r ON r.register = 'text' AND r.value = field WHERE NOT is_text",
    holds("sources", "connector IN (SELECT value FROM {registers} WHERE register = 'connector')", "concat('unknown connector ', coalesce(connector, ''))"),
    "SELECT concat(name, ': connector ', connector, ' needs ', r.other) FROM {sources} s JOIN {registers} r ON r.register = 'connector' AND r.value = s.connector LEFT ANTI JOIN {fields} f ON f.k = s.k AND f.field = r.other AND f.given",
    holds("sources", "connector <> 'github' OR connector IS NULL OR startswith(repo_path, {root}) AND endswith(repo_path, '/')", "concat('repo_path must be below ', {root}, ' and end with /')"),
    holds("sources", "doc_type IN (SELECT value FROM {registers} WHERE register = 'doc_type')", "concat('doc_type ', coalesce(doc_type, ''), ' is not allowed')"),
    holds("sources", "jurisdiction IN (SELECT value FROM {registers} WHERE register = 'jurisdiction')", "concat('jurisdiction ', coalesce(jurisdiction, ''), ' is not allowed')"),
    holds("sources", "classification = 'Public'", "'only public sources may be loaded'"),
    holds("sources", "status <> 'approved' OR status IS NULL OR approved", "'an approval needs approved_by and approved_on'"),
)
REGISTERS: dict[str, tuple] = {
    "layer": LAYERS, "classification": CLASSIFICATIONS, "domain": tuple(OWNERS), "mode": ("append", "merge"), "type": tuple(TYPES), "no load_id": NO_LOAD_ID, "check": tuple(rules.NEEDS), "severity": rules.SEVERITIES, "dimension": rules.DIMENSIONS,
    "field": SOURCE_FIELDS, "text": TEXTS, "doc_type": KINDS, "jurisdiction": JURISDICTIONS,
}


def violations(spark: SparkSession, constraints: tuple[str, ...], **frames: DataFrame | str) -> list[str]:
    """The problems that constraints find in frames, sorted."""
    known = [(name, str(v), None) for name, values in REGISTERS.items() for v in values] + [("connector", k, v) for k, v in PLACE.items()]
    registers = spark.createDataFrame(known, "register string, value string, other string")
    found = spark.sql("\nUNION ALL\n".join(f"({c})" for c in constraints), registers=registers, **frames)
    return sorted(r[0] for r in found.collect())  # what is declared is small


def declared(spark: SparkSession, tables: list[Table]) -> dict[str, DataFrame]:
    rows = [(t.name, t.layer, t.classification, t.domain, t.retention_days if isinstance(t.retention_days, int) else 0, t.mode, len(t.key)) for t in tables]
    first = {t.name: t for t in tables}.values()
    return {
        "tables": spark.createDataFrame(rows, "name string, layer string, classification string, domain string, retention_days long, mode string, keys int"),
        "columns": spark.createDataFrame([(t.name, n, ty) for t in first for n, ty, _ in t.fields()], "name string, column string, type string"),
        "keys": spark.createDataFrame([(t.name, k) for t in first for k in t.key], "name string, column string"),
    }


def catalog_problems(spark: SparkSession, tables: list[Table]) -> list[str]:
    return violations(spark, CATALOG, **declared(spark, tables))


def rule_problems(spark: SparkSession, ruled: list[tuple[str, Rule]], tables: list[Table]) -> list[str]:
    rows = [(t, r.rule_id, r.check, r.column, r.severity, r.dimension, *(r.references or "").rpartition(".")[::2]) for t, r in ruled]
    needs = [(r.rule_id, r.check, n, getattr(r, n) not in (None, ()) or n == "column" and bool(r.columns)) for _, r in ruled for n in rules.NEEDS.get(r.check, ())]
    frames = declared(spark, tables)
    return violations(
        spark, RULES, tables=frames["tables"], columns=frames["columns"], needs=spark.createDataFrame(needs, "rule_id string, check string, need string, given boolean"),
        rules=spark.createDataFrame(rows, "name string, rule_id string, check string, column string, severity string, dimension string, target string, target_column string"),
    )


def source_problems(spark: SparkSession, sources: list[dict], root: str = "regulations/") -> list[str]:
    """A bare ON is a boolean in YAML, so every text has to be one."""
    text = lambda s, f: s[f] if isinstance(s.get(f), str) else None
    named = [text(s, "source_id") or "a source without id" for s in sources]
    own = ("connector", "repo_path", "doc_type", "jurisdiction", "classification", "status")
    rows = [(k, named[k], *(text(s, f) for f in own), text(s, "repo_path") or text(s, "document_id"), bool(s.get("approved_by") and s.get("approved_on"))) for k, s in enumerate(sources)]
    fields = [(k, named[k], f, isinstance(v, str), bool(v), repr(v)) for k, s in enumerate(sources) for f, v in s.items()]
    return violations(
        spark, SOURCES, root=root, fields=spark.createDataFrame(fields, "k int, name string, field string, is_text boolean, given boolean, shown string"),
        sources=spark.createDataFrame(rows, "k int, name string, " + ", ".join(f"{f} string" for f in own) + ", place string, approved boolean"),
    )


def quote_name(name: str) -> str:
    """A dotted name with every part quoted."""
    return ".".join(f"`{p.replace('`', '``')}`" for p in name.split("."))


def quote_text(text: object) -> str:
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def tags(t: Table) -> dict[str, str]:
    owner, steward = OWNERS[t.domain]
    return {"layer": t.layer, "domain": t.domain, "classification": t.classification, "retention_days": str(t.retention_days), "data_owner": owner, "data_steward": steward}


def statements(t: Table, prefix: str = "") -> list[str]:
    """SQL that tells a metastore a table's description, its columns' and its tags."""
    full = quote_name(prefix + t.name)
    pairs = ", ".join(f"{quote_text(k)} = {quote_text(v)}" for k, v in tags(t).items())
    columns = [f"ALTER TABLE {full} ALTER COLUMN {quote_name(n)} COMMENT {quote_text(f'{n} ({ty}{', may be null' if null else ''})')}" for n, ty, null in t.fields()]
    return [f"COMMENT ON TABLE {full} IS {quote_text(f'{t.name}: one row for each {", ".join(t.key)}')}", *columns, f"ALTER TABLE {full} SET TBLPROPERTIES ({pairs})"]


def layer_classes(tables: list[Table]) -> dict[str, str]:
    """The class that all tables of a layer share, or Mixed."""
    classes = {layer: {t.classification for t in tables if t.layer == layer} for layer in LAYERS}
    return {layer: next(iter(c)) if len(c) == 1 else "Mixed" for layer, c in classes.items()}


def create(spark: SparkSession, name: str, prefix: str = "") -> None:
    """A managed table of the declared columns, if there is none."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote_name((prefix + name).rpartition('.')[0])}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quote_name(prefix + name)} ({catalog.spec(name).ddl()}) USING parquet")


def publish(spark: SparkSession, prefix: str = "") -> dict[str, int]:
    """Describes every table that the metastore has; what it refuses is counted, not fatal."""
    done = {"schemas_tagged": 0, "tables_published": 0, "refused": 0}

    def tell(sql: str) -> bool:
        try:
            spark.sql(sql)
            return True
        except Exception:  # noqa: BLE001  a metastore may not know a statement
            done["refused"] += 1
            return False

    for layer, c in layer_classes(list(catalog.TABLES.values())).items():
        if spark.catalog.databaseExists(prefix + layer):
            done["schemas_tagged"] += tell(f"ALTER DATABASE {quote_name(prefix + layer)} SET DBPROPERTIES ('layer' = {quote_text(layer)}, 'classification' = {quote_text(c)})")
    for t in catalog.TABLES.values():
        if spark.catalog.tableExists(prefix + t.name):
            done["tables_published"] += all([tell(s) for s in statements(t, prefix)])
    return done
