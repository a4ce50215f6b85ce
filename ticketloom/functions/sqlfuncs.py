"""Scoring functions for SQL users: ``SELECT ai_classify(ticket_text) FROM tickets``."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ticketloom import schemas
from ticketloom.functions import scoring


def _struct(fields: str) -> str:
    return "STRUCT<" + ", ".join(f.strip().replace(" ", ": ", 1) for f in fields.split(", ")) + ">"


def register_functions(spark: SparkSession) -> list[str]:
    """Create the four session functions and return their names."""
    generated = scoring.generate_sql("ticket_text", "context", scoring.score_sql("ticket_text"))
    quick = (
        "category STRING, priority STRING, assigned_team STRING, urgency_level STRING, "
        "priority_score DOUBLE, affected_systems ARRAY<STRING>, summary STRING, "
        "recommendations ARRAY<STRING>"
    )
    functions = {
        "ai_classify(ticket_text STRING)": (
            _struct(schemas.CLASSIFICATION), scoring.classification_sql("ticket_text")),
        "ai_extract(ticket_text STRING)": (
            _struct(schemas.METADATA), scoring.metadata_sql("ticket_text")),
        "ai_gen(ticket_text STRING, context STRING)": ("STRING", f"to_json({generated})"),
        "quick_classify_ticket(ticket_text STRING)": (
            _struct(quick), scoring.quick_sql("ticket_text")),
    }
    for signature, (returns, body) in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {returns} RETURN {body}")
    return [signature.split("(")[0] for signature in functions]
