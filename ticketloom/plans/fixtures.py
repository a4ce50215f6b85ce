"""Ticket, history and knowledge-base views over the given tables.

Each view is one SQL text used by Spark and, for checking, by DuckDB. Templates give
the wording; every row comes from a table row, all rows are used, and names, numbers
and codes in the texts come from the row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticketloom.sources.readers import spread_small

# Own-authored ticket templates: subject, description, expected category, priority, team.
TEMPLATES = (
    ("Production down for the order site", "The order site is unreachable and production down was confirmed by monitoring. Revenue impact is growing.", "Infrastructure", "P1", "Infrastructure"),
    ("Odd sign-in mail", "A phishing mail asks staff to confirm their sign-in. It looks suspicious and two people opened the link.", "Security", "P2", "Security"),
    ("Depot tunnel loses packets", "The VPN tunnel of the depot loses packets since noon for everyone on shift. 12 people cannot scan parcels.", "Infrastructure", "P2", "Infrastructure"),
    ("Forgot password", "I forgot password for my mailbox and need a password reset. No hurry.", "Service Request", "P3", "End User Support"),
    ("New hire next month", "A new hire starts on the first and needs access to payroll and the intranet.", "Service Request", "P3", "Identity & Access Management"),
    ("Offboarding", "Termination effective today. Please disable account and group membership immediately.", "Service Request", "P1", "Identity & Access Management"),
    ("Leaver at quarter end", "Resignation received, last day is the end of the quarter. Contractor access must close then.", "Service Request", "P2", "Identity & Access Management"),
    ("Query timeout in reports", "The nightly report hits a query timeout and the log shows a deadlock on the ledger index.", "Infrastructure", "P3", "Database"),
    ("Kubernetes nodes", "Two Kubernetes nodes in AWS are not ready and the container image will not start.", "Infrastructure", "P3", "Cloud"),
    ("Feature request: dark theme", "It would be nice to have a dark theme. Just a suggestion for the next release.", "Software", "P4", "Applications"),
    ("Printer jam", "I cannot print from my laptop. The printer on floor two blinks red.", "Hardware", "P3", "End User Support"),
    ("Password reset for several people", "Multiple users ask for a password reset after the migration. They are locked out.", "Software", "P2", "End User Support"),
    ("Hello", "Something feels off since Monday. Please have a look.", "Software", "P3", "Applications"),
    ("CRM session expired", "The CRM says session expired after each click and the report not loading message appears.", "Software", "P3", "Applications"),
    ("Disk space", "Server storage is low on disk space and the backup failed last night. HTTP 503 is returned.", "Infrastructure", "P3", "Infrastructure"),
    ("Virus alert", "The scanner found a virus and malware on one desktop. Unauthorized access was not seen.", "Security", "P2", "Security"),
    ("MFA phone lost", "I lost the phone with my MFA app and need a two-factor change in Active Directory.", "Service Request", "P3", "Identity & Access Management"),
    ("Entire department offline", "The entire department lost the network and nobody can work. This is an emergency.", "Infrastructure", "P2", "Infrastructure"),
    ("Replication lag", "Replication lag on the reporting copy keeps growing. Restore database from last week if needed.", "Infrastructure", "P3", "Database"),
    ("Question about documentation", "I have a question: where is the documentation for the expense tool?", "Software", "P4", "Applications"),
    ("S3 bucket and IAM role", "The IAM role for the S3 bucket was changed and the Lambda can no longer write.", "Infrastructure", "P3", "Cloud"),
    ("Prod error in checkout", "A prod error shows on the customer-facing checkout page. Integration failed with an API error.", "Software", "P1", "Applications"),
    ("Outlook issue", "Outlook issue since the update: the calendar is empty. Deadline is Friday, please treat as urgent.", "Software", "P3", "End User Support"),
    ("Certificate renewal", "The certificate for the audit portal expires soon. Compliance asks for proof of encryption.", "Security", "P3", "Security"),
    ("Checkout gone", "The checkout is completely down for shoppers. An outage page is shown instead.", "Software", "P1", "Applications"),
)
TEAM_LIST = (
    "Infrastructure", "Applications", "Security", "End User Support",
    "Identity & Access Management", "Database", "Cloud",
)
FILE_PATTERNS = (
    "infrastructure_runbook", "security_playbook", "access_policies", "ticket_rules",
    "cloud_guide", "email_troubleshooting", "db_support", "misc_notes",
)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join(
        "(" + ", ".join(_q(v) if isinstance(v, str) else str(v) for v in row) + ")" for row in rows
    )


TPL = (
    "(SELECT * FROM (VALUES "
    + _values([(i, *t) for i, t in enumerate(TEMPLATES)])
    + ") AS t(tpl_id, subject, description, expected_category, expected_priority, expected_team))"
)
TEAMS = "(SELECT * FROM (VALUES " + _values(list(enumerate(TEAM_LIST))) + ") AS t(team_no, team))"
PATTERNS = "(SELECT * FROM (VALUES " + _values(list(enumerate(FILE_PATTERNS))) + ") AS t(pattern_no, pattern))"
N_TPL, N_TEAMS, N_PATTERNS = len(TEMPLATES), len(TEAM_LIST), len(FILE_PATTERNS)

# <nl> is a newline, <1> the first regular-expression group, <g> DuckDB's global flag.
V_TICKETS = f"""
SELECT concat('EVT-', lpad(CAST(e.event_id AS VARCHAR(20)), 12, '0')) AS ticket_id,
       t.subject AS subject,
       concat(t.description, ' Logged on NODE-', upper(e.event_type), '-', CAST(e.user_id AS VARCHAR(20)),
              ' with code ERR_', regexp_extract(e.props, '([0-9]+)', 1), '.') AS description,
       CASE WHEN e.event_type = 'purchase' AND e.value > 100 THEN 'ceo@example.com'
            ELSE concat('user', CAST(e.user_id AS VARCHAR(20)), '@example.com') END AS submitted_by,
       e.ts AS submitted_date,
       t.expected_category, t.expected_priority, t.expected_team
FROM {{events}} e JOIN {TPL} t ON t.tpl_id = e.event_id % {N_TPL}
"""

# Every order is a ticket; those with status F are resolved, the others open.
V_HISTORY = f"""
SELECT concat('HIST-', CAST(o.o_orderkey AS VARCHAR(20))) AS ticket_id,
       concat(t.description, ' Seen by customer ', CAST(o.o_custkey AS VARCHAR(20)), '.') AS ticket_text,
       CASE WHEN o.o_orderstatus = 'F' THEN concat('Cause of ', lower(t.subject)) END AS root_cause,
       CASE WHEN o.o_orderstatus = 'F' THEN concat('Fixed by the ', m.team, ' team') END AS resolution,
       CASE WHEN o.o_orderstatus = 'F' THEN CAST(o.o_orderkey % 120 AS DOUBLE) END AS resolution_time_hours,
       CASE substring(o.o_orderpriority, 1, 1) WHEN '1' THEN 'P1' WHEN '2' THEN 'P2' WHEN '3' THEN 'P3' ELSE 'P4' END AS priority,
       CASE substring(o.o_orderpriority, 1, 1) WHEN '1' THEN 'Critical' WHEN '2' THEN 'High' WHEN '3' THEN 'Medium' ELSE 'Low' END AS urgency,
       m.team AS team,
       o.o_orderdate AS submitted_at,
       CASE WHEN o.o_orderstatus = 'F' THEN o.o_orderdate + (o.o_orderkey % 120) * INTERVAL '1' HOUR END AS resolved_at
FROM {{orders}} o
JOIN {TPL} t ON t.tpl_id = o.o_orderkey % {N_TPL}
JOIN {TEAMS} m ON m.team_no = o.o_custkey % {N_TEAMS}
"""

V_KB_DOCS = f"""
SELECT d.doc_id AS source_id, d.source AS source, d.lang AS lang,
       concat(p.pattern, '_', CAST(d.doc_id AS VARCHAR(20)), '.txt') AS filename,
       concat('DOCUMENT ', CAST(d.doc_id AS VARCHAR(20)), ' FROM ', upper(d.source), '<nl>====<nl><nl>',
              regexp_replace(regexp_replace(replace(d.text, '<nl>', '<nl><nl>'),
                  '<nl><nl>([ON])', '<nl><nl>SECTION OF NOTES<nl>Overview of topic<nl>-----<nl><nl><1>'<g>),
                  '<nl><nl>([IW])', '<nl><nl>Topic notes<nl>=====<nl><nl><1>'<g>)) AS content
FROM {{documents}} d JOIN {PATTERNS} p ON p.pattern_no = d.doc_id % {N_PATTERNS}
"""

V_RUNBOOKS = f"""
SELECT concat('vendor_runbook_', CAST(s.s_suppkey AS VARCHAR(20)), '.txt') AS filename,
       concat('RUNBOOK OF ', upper(s.s_name), '<nl>=====<nl><nl>',
              t.subject, ' at ', s.s_name, '<nl>Priority: ', t.expected_priority, ' (agreed with ', t.expected_team, ')<nl>',
              'Affected Systems: NODE-', CAST(s.s_nationkey AS VARCHAR(20)), ', ', lower(t.expected_team), ' systems<nl>',
              'Resolution Steps:<nl>- Read the note: ', t.description, '<nl>- Call ', s.s_name, '<nl>',
              '- Average resolution time: ', CAST(10 + s.s_nationkey * 15 AS VARCHAR(20)), ' minutes<nl>',
              'Escalation: ', t.expected_team, ' team<nl><nl>',
              'Follow-up of ', t.subject, ' (Priority P3):<nl>- Review the outcome with ', s.s_name, '<nl>',
              '- Average resolution time: ', CAST(1 + s.s_nationkey % 4 AS VARCHAR(20)), ' hours<nl><nl>',
              'Plain closing words.') AS content
FROM {{supplier}} s JOIN {TPL} t ON t.tpl_id = s.s_suppkey % {N_TPL}
"""

# What an earlier load left behind: every labelled document, some since changed.
V_KB_LOADED = """
SELECT k.filename AS filename,
       CASE WHEN l.quality = 0 THEN md5(concat(k.content, ' earlier')) ELSE md5(k.content) END AS content_hash
FROM {kb_docs} k JOIN {labels} l ON l.doc_id = k.source_id
"""

V_LINES = "SELECT conv_id, turn, text FROM {conversations} WHERE role = 'user'"

VIEWS = {
    "v_tickets": V_TICKETS,
    "v_history": V_HISTORY,
    "v_kb_docs": V_KB_DOCS,
    "v_runbooks": V_RUNBOOKS,
    "v_lines": V_LINES,
}


def for_spark(sql: str) -> str:
    return sql.replace("<nl>", "\\n").replace("<1>", "$1").replace("<g>", "")


def for_duckdb(sql: str) -> str:
    return sql.replace("<nl>", "' || chr(10) || '").replace("<1>", "\\1").replace("<g>", ", 'g'")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, sql: str, name: str) -> DataFrame:
    source = table(spark, sf_dir, name)
    return spark.sql(for_spark(sql), **{name: spread_small(source, source)})


def v_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, V_TICKETS, "events")


def v_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, V_HISTORY, "orders")


def v_kb_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, V_KB_DOCS, "documents")


def v_runbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, V_RUNBOOKS, "supplier")


def v_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, V_LINES, "conversations")


def v_kb_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        for_spark(V_KB_LOADED), kb_docs=v_kb_docs(spark, sf_dir), labels=table(spark, sf_dir, "labels")
    )
