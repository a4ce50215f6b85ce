"""Fixed table schemas."""

from pyspark.sql import types as T

TICKETS = T.StructType([
    T.StructField("ticket_id", T.StringType(), False),
    T.StructField("subject", T.StringType(), False),
    T.StructField("description", T.StringType(), False),
    T.StructField("ticket_text", T.StringType(), False),
    T.StructField("submitted_by", T.StringType(), True),
    T.StructField("submitted_date", T.TimestampType(), True),
    T.StructField("expected_category", T.StringType(), True),
    T.StructField("expected_priority", T.StringType(), True),
    T.StructField("expected_team", T.StringType(), True),
])

KNOWLEDGE_BASE = T.StructType([
    T.StructField("doc_id", T.StringType(), False),
    T.StructField("doc_type", T.StringType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("content", T.StringType(), False),
    T.StructField("keywords", T.ArrayType(T.StringType()), False),
    T.StructField("chunk_index", T.IntegerType(), False),
    T.StructField("total_chunks", T.IntegerType(), False),
    T.StructField("char_count", T.IntegerType(), False),
    T.StructField("created_at", T.TimestampType(), False),
])

TICKET_HISTORY = T.StructType([
    T.StructField("ticket_id", T.StringType(), False),
    T.StructField("ticket_text", T.StringType(), False),
    T.StructField("root_cause", T.StringType(), True),
    T.StructField("resolution", T.StringType(), True),
    T.StructField("resolution_time_hours", T.DoubleType(), True),
    T.StructField("resolved_at", T.TimestampType(), True),
])

CLASSIFICATION = "category STRING, priority STRING, assigned_team STRING, confidence DOUBLE"
METADATA = (
    "priority_score DOUBLE, urgency_level STRING, affected_systems ARRAY<STRING>, "
    "technical_keywords ARRAY<STRING>, user_impact STRING, requires_escalation BOOLEAN"
)
GENERATION = (
    "summary STRING, recommendations ARRAY<STRING>, resolution_steps ARRAY<STRING>, "
    "estimated_resolution_time STRING"
)
