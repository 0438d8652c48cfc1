"""The declared tables: schema, keys, write modes and governance fields, and conforming frames to them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Declared types and their Spark names.
TYPES = {"string": "STRING", "int": "INT", "long": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "array<string>": "ARRAY<STRING>", "array<float>": "ARRAY<FLOAT>"}
CLASSIFICATIONS, LAYERS = ("Public", "Internal", "Confidential", "Restricted"), ("bronze", "silver", "gold", "ops")
#: Tables that need no load_id.
NO_LOAD_ID = ("gold.llm_call_log", "gold.eval_questions", "gold.eval_results")


@dataclass(frozen=True)
class Table:
    name: str
    key: tuple[str, ...]
    mode: str
    columns: str  # "name type[?], ...": ? marks a nullable column
    classification: str = "Internal"
    domain: str = "platform"
    retention_days: int = 1825

    @property
    def layer(self) -> str:
        return self.name.split(".")[0]

    def fields(self) -> list[tuple[str, str, bool]]:
        parts = [c.strip().split(" ", 1) for c in self.columns.split(", ")]
        return [(n, t.rstrip("?"), t.endswith("?")) for n, t in parts]

    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl())

    def ddl(self) -> str:
        return ", ".join(f"{n} {TYPES[t]}{'' if null else ' NOT NULL'}" for n, t, null in self.fields())


# Names, types and keys of the declared tables.
TABLES = {t.name: t for t in (
    Table("bronze.raw_documents", ("doc_id",), "append", "doc_id string, source_id string, source_system string, file_name string, source_ref string, source_version string?, remote_hash string?, landing_path string, source_url string, doc_type string, jurisdiction string, mime_type string, file_size_bytes long, ingested_at timestamp, load_id string", "Public", "regulations"),
    Table("silver.document_units", ("unit_id",), "merge", "unit_id string, source_id string, doc_id string, unit_type string, unit_ref string, unit_order int, context_path string?, heading string?, text string?, char_count int, token_estimate int, text_hash string, history_note string?, is_repealed boolean, in_force boolean, extraction_method string, valid_from timestamp, valid_to timestamp?, is_current boolean, load_id string", "Public", "regulations"),
    Table("silver.chunks", ("chunk_id",), "merge", "chunk_id string, unit_id string, doc_id string, source_id string, unit_ref string, chunk_index int, context_header string, text string, token_estimate int, text_hash string, pii_flag boolean, chunker_version string, is_active boolean, retired_at timestamp?, load_id string", "Public", "regulations"),
    Table("silver.cross_references", ("ref_id",), "merge", "ref_id string, unit_id string, source_id string, unit_ref string, target_href string, target_doc_id string?, target_text string, load_id string", "Public", "regulations"),
    Table("gold.chunk_embeddings", ("chunk_id", "embedding_model"), "merge", "chunk_id string, embedding_model string, embedding_dim int, vector array<float>, is_active boolean, retired_at timestamp?, load_id string", "Public", "ai_operations"),
    Table("gold.entities", ("entity_id", "source_chunk_id"), "merge", "entity_id string, entity_type string, name string, normalized_name string, source_chunk_id string, extraction_model string, prompt_version string, load_id string", "Public", "ai_operations"),
    Table("gold.relationships", ("rel_id",), "merge", "rel_id string, src_entity_id string, rel_type string, dst_entity_id string, source_chunk_id string, prompt_version string, load_id string", "Public", "ai_operations"),
    Table("gold.llm_call_log", ("call_id",), "append", "call_id string, called_at timestamp, run_id string, purpose string, provider string, model string, prompt_version string, data_classification string, prompt_tokens int?, completion_tokens int?, latency_ms int, status string, error_type string?, retry_count int, fallback_used boolean, cost_usd double, request_hash string", "Internal", "ai_operations"),
    Table("gold.eval_questions", ("question_id", "version"), "append", "question_id string, version int, question string, expected_answer string, expected_sources array<string>, category string, author string, created_at timestamp", "Internal", "evaluation"),
    Table("gold.eval_results", ("eval_run_id", "question_id", "variant"), "append", "eval_run_id string, question_id string, variant string, answer string, retrieved_chunk_ids array<string>, judge_score int?, judge_model string?, judge_prompt_version string?, human_label int?, latency_ms int, cost_usd double", "Internal", "evaluation"),
    Table("ops.run_log", ("run_id",), "append", "run_id string, pipeline string, started_at timestamp, ended_at timestamp?, status string, rows_in long?, rows_out long?, git_commit string?, config_hash string, error_message string?"),
    Table("ops.dq_results", ("run_id", "rule_id"), "append", "run_id string, rule_id string, table_name string, dimension string, severity string, status string, observed_value double?, threshold double?, failed_rows long?, checked_at timestamp"),
    Table("ops.api_call_log", ("call_id",), "append", "call_id string, run_id string, connector string, method string, endpoint string, status_code int?, attempt int, latency_ms int, response_bytes long?, rate_limit_remaining int?, error_type string?, called_at timestamp"),
    Table("ops.watermarks", ("source_system", "scope"), "merge", "source_system string, scope string, watermark_value string, updated_at timestamp, load_id string"),
)}


def spec(name: str) -> Table:
    if name not in TABLES:
        raise KeyError(f"{name} isn't in the catalog")
    return TABLES[name]


def conform(name: str, df: DataFrame) -> DataFrame:
    """df in the declared columns, order and types; extra or missing columns raise ValueError, NULL keys on read of the result."""
    fields = spec(name).fields()
    names = [n for n, _, _ in fields]
    if extra := [c for c in df.columns if c not in names]:
        raise ValueError(f"{name}: columns not in catalog: {extra}")
    if missing := [c for c in names if c not in df.columns]:
        raise ValueError(f"{name}: columns missing from data: {missing}")
    def col(n: str, t: str, null: bool):
        c = F.col(n).cast(TYPES[t])
        return (c if null else F.when(c.isNotNull(), c).otherwise(F.raise_error(F.lit(f"{name}.{n} must not be null")).cast(TYPES[t]))).alias(n)

    return df.select(*(col(*f) for f in fields))


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], spec(name).schema())


def markdown(tables: dict[str, Table], rules: list) -> str:
    """The catalog as Markdown, with the number of rules of each table."""
    lines = ["# Data catalog", ""]
    for t in tables.values():
        n = sum(x == t.name for x, _ in rules)
        lines += [f"## {t.name}", "", f"Key: {', '.join(t.key)}. Mode: {t.mode}. Classification: {t.classification}. Rules: {n}.", "", "| column | type | nullable |", "|-|-|-|"]
        lines += [f"| {c} | {ty} | {'yes' if null else 'no'} |" for c, ty, null in t.fields()] + [""]
    return "\n".join(lines)


def described(tables: list[dict]) -> dict[str, Table]:
    """Tables from the entries of a catalog file: name, primary_key, write_mode, columns and governance fields."""
    out = {}
    for e in tables:
        columns = ", ".join(f"{c['name']} {c['type']}{'?' if c['nullable'] else ''}" for c in e["columns"])
        out[e["name"]] = Table(e["name"], tuple(e["primary_key"]), e["write_mode"], columns, e["classification"], e["domain"], e["retention_days"])
    return out
