"""The shipped data-quality rules, and a loader for rules of one's own."""

from __future__ import annotations

from lexloom.operators import checks  # noqa: F401  registers the checks that custom rules name
from lexloom.operators.dq import Rule

SEVERITIES = ("critical", "warning")
DIMENSIONS = ("completeness", "validity", "uniqueness", "consistency", "timeliness", "accuracy")
#: What a rule of each check has to say.
NEEDS = {
    "unique": ("column",), "not_null": ("column",), "min_value": ("column", "threshold"), "max_value": ("column", "threshold"), "allowed_values": ("column", "values"),
    "foreign_key": ("column", "references"), "row_count_min": ("threshold",), "ratio_min": ("expression", "threshold"), "ratio_max": ("expression", "threshold"), "custom": (),
}

# The rules that are checked on each table, with their ids, thresholds and allowed values.
SHIPPED = (
    ("bronze.raw_documents", Rule("DQ-B-001", "unique", "doc_id", dimension="uniqueness")),
    ("bronze.raw_documents", Rule("DQ-B-002", "min_value", "file_size_bytes", 1)),
    ("bronze.raw_documents", Rule("DQ-B-003", "allowed_values", "doc_type", values=("act", "regulation", "inspection_report"))),
    ("bronze.raw_documents", Rule("DQ-B-004", "custom", "source_id", dimension="consistency")),
    ("bronze.raw_documents", Rule("DQ-B-005", "custom", "landing_path", dimension="accuracy")),
    ("bronze.raw_documents", Rule("DQ-B-006", "not_null", "source_ref", dimension="completeness")),
    ("bronze.raw_documents", Rule("DQ-B-007", "allowed_values", "jurisdiction", values=("ON", "BC"))),
    ("bronze.raw_documents", Rule("DQ-B-008", "allowed_values", "source_system", values=("bclaws", "github"))),
    ("silver.document_units", Rule("DQ-S-001", "ratio_min", threshold=1.0, expression="is_repealed OR char_count > 0", dimension="completeness")),
    ("silver.chunks", Rule("DQ-S-002", "not_null", "text", dimension="completeness")),
    ("silver.chunks", Rule("DQ-S-003", "ratio_min", threshold=0.98, expression="token_estimate BETWEEN 20 AND 1200", severity="warning")),
    ("silver.chunks", Rule("DQ-S-004", "foreign_key", "doc_id", references="bronze.raw_documents.doc_id", dimension="consistency")),
    ("silver.chunks", Rule("DQ-S-005", "custom", "text_hash", 0.05, severity="warning", dimension="uniqueness")),
    ("silver.chunks", Rule("DQ-S-006", "ratio_max", threshold=0.01, expression="pii_flag = true", severity="warning")),
    ("silver.document_units", Rule("DQ-S-007", "custom", "is_current", dimension="uniqueness")),
    ("silver.chunks", Rule("DQ-S-008", "custom", "unit_id", dimension="consistency")),
    ("silver.cross_references", Rule("DQ-S-009", "foreign_key", "unit_id", references="silver.document_units.unit_id", dimension="consistency")),
    ("silver.chunks", Rule("DQ-S-010", "custom", "chunker_version", dimension="consistency")),
    ("gold.chunk_embeddings", Rule("DQ-G-001", "custom", "chunk_id", 1.0, dimension="completeness")),
    ("gold.chunk_embeddings", Rule("DQ-G-002", "custom", "embedding_dim")),
    ("gold.entities", Rule("DQ-G-003", "allowed_values", "entity_type", values=("Regulation", "Section", "Requirement", "HomeType", "CareService", "Role", "Penalty", "Authority"))),
    ("gold.relationships", Rule("DQ-G-004", "foreign_key", "src_entity_id", references="gold.entities.entity_id", dimension="consistency")),
    ("gold.relationships", Rule("DQ-G-005", "allowed_values", "rel_type", values=("CONTAINS", "REQUIRES", "APPLIES_TO", "REFERENCES", "ENFORCED_BY", "PENALIZED_BY", "RESPONSIBLE_FOR"))),
    ("gold.llm_call_log", Rule("DQ-G-006", "min_value", "cost_usd", 0, severity="warning")),
    ("gold.eval_questions", Rule("DQ-G-007", "custom", "expected_sources", dimension="completeness")),
    ("gold.eval_results", Rule("DQ-G-008", "allowed_values", "judge_score", values=(1, 2, 3, 4, 5, None))),
    ("gold.eval_results", Rule("DQ-G-009", "foreign_key", "question_id", references="gold.eval_questions.question_id", dimension="consistency")),
    ("gold.chunk_embeddings", Rule("DQ-G-010", "custom", "chunk_id", dimension="consistency")),
    ("gold.llm_call_log", Rule("DQ-G-011", "custom", "data_classification")),
    ("ops.run_log", Rule("DQ-O-001", "custom", "status", severity="warning", dimension="timeliness")),
    ("ops.dq_results", Rule("DQ-O-002", "custom", "rule_id", dimension="consistency")),
    ("ops.api_call_log", Rule("DQ-O-003", "ratio_max", threshold=0.10, expression="status_code IS NULL OR status_code >= 500", severity="warning")),
    ("ops.watermarks", Rule("DQ-O-004", "not_null", "watermark_value", dimension="completeness")),
)


def by_table(rules) -> dict[str, list[Rule]]:
    """(table, rule) pairs as a list of rules for each table, in their order."""
    out: dict[str, list[Rule]] = {}
    for table, rule in rules:
        out.setdefault(table, []).append(rule)
    return out


def parsed(entries: list[dict]) -> list[tuple[str, Rule]]:
    """Rules from the entries of a rule file."""
    keys = ("column", "threshold", "expression", "references", "severity", "dimension")
    return [(e["table"], Rule(e["id"], e["check"], values=tuple(e.get("values", ())), **{k: e[k] for k in keys if k in e})) for e in entries]
