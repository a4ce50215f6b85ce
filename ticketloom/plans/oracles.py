"""The same results as plain SQL joins, windows and recursion, for DuckDB.

Written from the operator definitions, independently of the Spark expressions:
rules are joined as tables here, packing is a recursive query, top-k is a full sort.
"""

from __future__ import annotations

from ticketloom import policy
from ticketloom.functions.text import WHITESPACE, padded
from ticketloom.operators import routing
from ticketloom.operators.sla import sla_rows
from ticketloom.plans import fixtures as fx
from ticketloom.operators.scoring import PROMPT_TEMPLATE
from ticketloom.plans.queries import CALENDAR, LOADED_AT

NL = "chr(10)"
WS = "'" + WHITESPACE + "'"


def q(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def values(name: str, columns: str, rows) -> str:
    body = ", ".join("(" + ", ".join(q(v) for v in row) + ")" for row in rows)
    return f"{name} AS (SELECT * FROM (VALUES {body}) AS t({columns}))"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def norm(x: str) -> str:
    return f"' ' || trim(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g')) || ' '"


def case(column: str, pairs, default: str = "NULL") -> str:
    return f"CASE {column} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in pairs) + f" ELSE {default} END"


BASES = {
    "v_tickets": fx.for_duckdb(fx.V_TICKETS).replace("{events}", "events"),
    "v_history": fx.for_duckdb(fx.V_HISTORY).replace("{orders}", "orders"),
    "v_kb_docs": fx.for_duckdb(fx.V_KB_DOCS).replace("{documents}", "documents"),
    "v_runbooks": fx.for_duckdb(fx.V_RUNBOOKS).replace("{supplier}", "supplier"),
    "v_lines": fx.V_LINES.replace("{conversations}", "conversations"),
    "v_kb_loaded": fx.V_KB_LOADED.replace("{kb_docs}", "v_kb_docs").replace("{labels}", "labels"),
}
CTES: dict[str, str] = {name: f"{name} AS ({sql})" for name, sql in BASES.items()}
NEEDS: dict[str, tuple[str, ...]] = {"v_kb_loaded": ("v_kb_docs",)}


def cte(name: str, sql: str, *needs: str) -> None:
    CTES[name] = sql if sql.startswith(f"{name} AS") else f"{name} AS ({sql})"
    NEEDS[name] = needs


def with_ctes(select: str, *needs: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for dep in NEEDS.get(name, ()):
            add(dep)
        if name in CTES and name not in ordered:
            ordered.append(name)

    for n in needs:
        add(n)
    head = "WITH RECURSIVE " + ",\n".join(CTES[n] for n in ordered) + "\n" if ordered else ""
    return head + select


# --- tickets and policy -------------------------------------------------------------

cte("tk", f"""
SELECT ticket_id, subject, description,
       concat('Subject: ', subject, {NL}, {NL}, 'Description: ', description) AS ticket_text,
       submitted_by, submitted_date, expected_category, expected_priority, expected_team
FROM v_tickets""", "v_tickets")

for table, rules in (("rule_phrases", policy.RULES), ("extended_phrases", policy.EXTENDED_RULES)):
    cte(table, values(table, "rule_id, kind, phrase", [
        (r.rule_id, kind, padded(p))
        for r in rules
        for kind, phrases in (("if", r.phrases), ("unless", r.unless), ("soon", r.soon_phrases))
        for p in phrases
    ]))
cte("rule_effects", values(
    "rule_effects", "rule_id, set_priority, soon_priority, min_priority, urgency, category, team, raise_urgency, notify, action",
    [(r.rule_id, r.set_priority, r.soon_priority, r.min_priority, r.urgency, r.category, r.team,
      r.raise_urgency, r.notify, r.action) for r in policy.RULES]))
cte("team_words", values("team_words", "ord, team, phrase", [
    (i, t, padded(p)) for i, (t, ps) in enumerate(policy.TEAM_KEYWORDS.items()) for p in ps
]))
cte("cues", values("cues", "kind, phrase", [
    *(("info", padded(p)) for p in policy.INFO_CUES),
    *(("device", padded(p)) for p in policy.DEVICE_WORDS),
    *((level, padded(p)) for level, ps in policy.IMPACT_PHRASES.items() for p in ps),
]))
cte("terms", values("terms", "kind, ord, phrase", [
    *(("system", 1000 + i, padded(p)) for i, p in enumerate(policy.SYSTEM_WORDS)),
    *(("tech", 2000 + i, padded(p)) for i, p in enumerate(policy.TECH_WORDS)),
]))


def policy_ctes(prefix: str, source: str, sender: str, phrases: str = "rule_phrases") -> None:
    """CTE chain ``<prefix>scored`` over (ticket_id, ticket_text) of ``source``."""
    p = prefix
    cte(f"{p}norm", f"""
SELECT ticket_id, ticket_text, {sender} AS sender, {norm("coalesce(ticket_text, '')")} AS norm FROM {source}""", source)
    cte(f"{p}matched", f"""
SELECT DISTINCT n.ticket_id, r.rule_id, r.kind FROM {p}norm n JOIN {phrases} r ON contains(n.norm, r.phrase)""",
        f"{p}norm", phrases)
    cte(f"{p}fired", f"""
SELECT ticket_id, rule_id FROM {p}matched WHERE kind = 'if'
UNION
SELECT ticket_id, 4 FROM {p}norm WHERE regexp_matches(lower(sender), {q(policy.SENDER_PATTERN)})
EXCEPT
SELECT ticket_id, rule_id FROM {p}matched WHERE kind = 'unless'""", f"{p}matched", f"{p}norm")
    cte(f"{p}effects", f"""
SELECT f.ticket_id,
       string_agg(CAST(f.rule_id AS VARCHAR), '|' ORDER BY f.rule_id) AS fired_rules,
       min(CASE WHEN s.rule_id IS NOT NULL THEN e.soon_priority ELSE e.set_priority END) AS set_priority,
       min(e.min_priority) AS min_priority,
       CASE min({case("e.urgency", [(u, i) for i, u in enumerate(policy.URGENCIES)])})
            WHEN 0 THEN 'Critical' WHEN 1 THEN 'High' END AS rule_urgency,
       arg_min(e.category, f.rule_id) FILTER (e.category IS NOT NULL) AS rule_category,
       arg_min(e.team, f.rule_id) FILTER (e.team IS NOT NULL) AS rule_team,
       bool_or(e.raise_urgency) AS raised,
       string_agg(e.notify, '|' ORDER BY f.rule_id) AS notify,
       string_agg(e.action, '|' ORDER BY f.rule_id) AS actions
FROM {p}fired f JOIN rule_effects e USING (rule_id)
LEFT JOIN {p}matched s ON s.ticket_id = f.ticket_id AND s.rule_id = f.rule_id AND s.kind = 'soon'
GROUP BY f.ticket_id""", f"{p}fired", f"{p}matched", "rule_effects")
    cte(f"{p}team_scores", f"""
SELECT n.ticket_id, w.ord, w.team, count(*) FILTER (contains(n.norm, w.phrase)) AS score
FROM {p}norm n CROSS JOIN team_words w GROUP BY ALL""", f"{p}norm", "team_words")
    cte(f"{p}teams", f"""
SELECT ticket_id, arg_min(team, -score * 100 + ord) AS top_team, max(score) AS best, sum(score) AS total,
       string_agg(team || '=' || score, '|' ORDER BY ord) AS scores
FROM {p}team_scores GROUP BY ticket_id""", f"{p}team_scores")
    levels = list(policy.IMPACT_PHRASES)
    cte(f"{p}cue_hits", f"""
SELECT n.ticket_id,
       coalesce(bool_or(c.kind = 'info'), false) AS info,
       coalesce(bool_or(c.kind = 'device'), false) AS device,
       CASE WHEN bool_or(c.kind = {q(levels[0])}) THEN {q(levels[0])}
            WHEN bool_or(c.kind = {q(levels[1])}) THEN {q(levels[1])}
            WHEN bool_or(c.kind = {q(levels[2])}) THEN {q(levels[2])}
            WHEN list_bool_or(list_transform(regexp_extract_all(replace(any_value(n.norm), ' ', '  '), ' ([0-9]+)  (people|users|employees) ', 1),
                              lambda x: length(ltrim(x, '0')) > 1 OR ltrim(x, '0') > '1'))
            THEN 'Multiple Users' ELSE 'Single User' END AS user_impact
FROM {p}norm n LEFT JOIN cues c ON contains(n.norm, c.phrase) GROUP BY n.ticket_id""", f"{p}norm", "cues")
    by_team = case("team", [(t, c) for t, c in policy.CATEGORY_BY_TEAM.items() if t != "End User Support"])
    cte(f"{p}chosen", f"""
SELECT n.ticket_id, n.ticket_text, e.fired_rules, e.set_priority, e.min_priority, e.rule_urgency,
       e.rule_category, e.rule_team, e.notify, e.actions, coalesce(e.raised, false) AS raised,
       t.scores, CASE WHEN t.best > 0 THEN t.top_team END AS best_team,
       coalesce(least(e.set_priority, e.min_priority), CASE WHEN c.info THEN 'P4' ELSE 'P3' END) AS priority,
       coalesce(e.rule_team, CASE WHEN t.best > 0 THEN t.top_team END, 'Applications') AS team,
       CASE WHEN t.total = 0 THEN 0.0 ELSE round(t.best / t.total, 2) END AS confidence,
       c.device, c.user_impact
FROM {p}norm n JOIN {p}teams t USING (ticket_id) JOIN {p}cue_hits c USING (ticket_id)
LEFT JOIN {p}effects e USING (ticket_id)""", f"{p}norm", f"{p}teams", f"{p}cue_hits", f"{p}effects")
    cte(f"{p}scored", f"""
SELECT *, {case("priority", policy.PRIORITY_SCORE.items())}::DOUBLE AS priority_score,
       priority IN ('P1', 'P2') OR user_impact <> 'Single User' AS requires_escalation,
       coalesce(rule_category, CASE WHEN team = 'End User Support' THEN CASE WHEN device THEN 'Hardware' ELSE 'Software' END
                ELSE {by_team} END) AS category,
       CASE WHEN raised THEN {case("base_urgency", [("Low", "Medium"), ("Medium", "High"), ("High", "Critical"), ("Critical", "Critical")])}
            ELSE base_urgency END AS urgency_level
FROM (SELECT *, coalesce(rule_urgency, {case("priority", policy.URGENCY_BY_PRIORITY.items())}) AS base_urgency FROM {p}chosen)""",
        f"{p}chosen")
    cte(f"{p}found", f"""
SELECT ticket_id, 'host' AS kind, generate_subscripts(l, 1) AS ord, unnest(l) AS term
FROM (SELECT ticket_id, regexp_extract_all(ticket_text, {q(policy.HOST_PATTERN)}) AS l FROM {p}norm)
UNION ALL
SELECT ticket_id, 'code', generate_subscripts(l, 1) - 500, unnest(l)
FROM (SELECT ticket_id, regexp_extract_all(ticket_text, {q(policy.CODE_PATTERN)}) AS l FROM {p}norm)
UNION ALL
SELECT n.ticket_id, t.kind, t.ord, trim(t.phrase) FROM {p}norm n JOIN terms t ON contains(n.norm, t.phrase)""",
        f"{p}norm", "terms")
    cte(f"{p}entities", f"""
SELECT n.ticket_id, coalesce(s.systems, '') AS affected_systems, coalesce(k.words, '') AS technical_keywords
FROM {p}norm n
LEFT JOIN (SELECT ticket_id, string_agg(term, '|' ORDER BY o) AS systems FROM (
    SELECT ticket_id, term, min(ord) AS o FROM {p}found WHERE kind IN ('host', 'system') GROUP BY ALL) GROUP BY ticket_id) s USING (ticket_id)
LEFT JOIN (SELECT ticket_id, string_agg(term, '|' ORDER BY o) AS words FROM (
    SELECT ticket_id, term, min(ord) AS o FROM {p}found WHERE kind IN ('host', 'code', 'tech') GROUP BY ALL) GROUP BY ticket_id) k USING (ticket_id)""",
        f"{p}norm", f"{p}found")
    cte(f"{p}summaries", f"""
SELECT ticket_id, CASE WHEN first = '' THEN body ELSE first END AS summary
FROM (SELECT ticket_id, body, regexp_extract(body, '(?s)^(.+?[.!?])(\\s|$)', 1) AS first
      FROM (SELECT ticket_id, trim(regexp_replace(ticket_text, '(?s)^Subject: .*?\\n\\nDescription: ', ''), ' ' || chr(9) || chr(10) || chr(13)) AS body FROM {p}norm))""",
        f"{p}norm")


policy_ctes("", "tk", "submitted_by")
policy_ctes("anon_", "tk", "CAST(NULL AS VARCHAR)")
policy_ctes("ext_", "tk", "submitted_by", "extended_phrases")

# --- knowledge base ---------------------------------------------------------------------

cte("lines", f"""
SELECT filename, i - 1 AS line_no, l[i] AS line, {strip("l[i]")} AS s
FROM (SELECT filename, string_split(content, {NL}) AS l FROM v_kb_docs), unnest(range(1, len(l) + 1)) AS u(i)""", "v_kb_docs")
cte("candidates", """
SELECT *, s <> '' AND (
    (regexp_matches(s, '\\p{Lu}') AND NOT regexp_matches(s, '[\\p{Ll}\\p{Lt}]') AND length(s) > 5
     AND NOT starts_with(s, 'P1') AND NOT starts_with(s, 'P2'))
    OR coalesce(starts_with(after, '---') OR starts_with(after, '==='), false)) AS is_header
FROM (SELECT *, lead(s) OVER (PARTITION BY filename ORDER BY line_no) AS after FROM lines)""", "lines")
cte("runs", """
SELECT filename, line_no, is_header, n, n - row_number() OVER (PARTITION BY filename, is_header ORDER BY line_no) AS run
FROM (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY line_no) AS n FROM candidates WHERE s <> '')""", "candidates")
cte("openers", """
SELECT filename, line_no,
       is_header AND row_number() OVER (PARTITION BY filename, is_header, run ORDER BY line_no) % 2
           = CASE WHEN min(n) OVER (PARTITION BY filename, is_header, run) = 1 THEN 0 ELSE 1 END AS opens
FROM runs""", "runs")
cte("marked", """
SELECT c.filename, c.line_no, c.line, c.s, c.is_header, coalesce(o.opens, false) AS opens_section
FROM candidates c LEFT JOIN openers o USING (filename, line_no)""", "candidates", "openers")
cte("sections", f"""
SELECT filename, sec AS section_no,
       coalesce(title, CASE WHEN max(sec) OVER (PARTITION BY filename) > 0 THEN 'Introduction' ELSE 'Content' END) AS section_title,
       section
FROM (SELECT filename, sec, max(s) FILTER (opens_section) AS title,
             {strip("coalesce(string_agg(line, " + NL + " ORDER BY line_no) FILTER (NOT opens_section), '')")} AS section
      FROM (SELECT *, sum(opens_section::INT) OVER (PARTITION BY filename ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS sec FROM marked)
      GROUP BY filename, sec)
QUALIFY section <> ''""", "marked")
cte("paras", f"""
SELECT filename, section_no, row_number() OVER (PARTITION BY filename, section_no ORDER BY i) - 1 AS para_no, p AS paragraph
FROM (SELECT filename, section_no, i, {strip("l[i]")} AS p
      FROM (SELECT filename, section_no, string_split(section, {NL} || {NL}) AS l FROM sections WHERE length(section) >= {policy.MIN_SECTION}),
           unnest(range(1, len(l) + 1)) AS u(i))
WHERE p <> ''""", "sections")
cte("packed", f"""packed AS (
SELECT filename, section_no, para_no, length(paragraph) + 2 AS size, 0 AS chunk FROM paras WHERE para_no = 0
UNION ALL
SELECT f.filename, f.section_no, p.para_no,
       CASE WHEN f.size + length(p.paragraph) > {policy.MAX_CHUNK} AND f.size >= {policy.MIN_CHUNK} THEN length(p.paragraph) + 2
            ELSE f.size + length(p.paragraph) + 2 END,
       CASE WHEN f.size + length(p.paragraph) > {policy.MAX_CHUNK} AND f.size >= {policy.MIN_CHUNK} THEN f.chunk + 1 ELSE f.chunk END
FROM packed f JOIN paras p ON p.filename = f.filename AND p.section_no = f.section_no AND p.para_no = f.para_no + 1)""", "paras")
cte("tails", """
SELECT filename, section_no, arg_max(size, para_no) AS tail, max(chunk) AS last FROM packed GROUP BY ALL""", "packed")
cte("packs", f"""
SELECT p.filename, p.section_no,
       CASE WHEN p.chunk = t.last AND t.last > 0 AND t.tail < {policy.MIN_CHUNK} THEN p.chunk - 1 ELSE p.chunk END AS chunk_no,
       string_agg(a.paragraph, {NL} || {NL} ORDER BY p.para_no) AS chunk
FROM packed p JOIN tails t USING (filename, section_no) JOIN paras a USING (filename, section_no, para_no)
GROUP BY ALL""", "packed", "tails", "paras")


def keyword_ctes(name: str, source: str, key: str, text: str) -> None:
    stop = ", ".join(q(w) for w in policy.STOP_WORDS)
    cte(f"{name}_tokens", f"""
SELECT id, i, l[i] AS word
FROM (SELECT {key} AS id, string_split(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'), ' ') AS l FROM {source}),
     unnest(range(1, len(l) + 1)) AS u(i)
WHERE regexp_full_match(l[i], '[a-z]{{4,}}') AND l[i] NOT IN ({stop})""", source)
    cte(f"{name}_counts", f"""
SELECT id, word, count(*) AS n, min(i) AS first FROM {name}_tokens GROUP BY ALL""", f"{name}_tokens")
    cte(f"{name}_keywords", f"""
SELECT id, string_agg(word, '|' ORDER BY rn) AS keywords
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, first) AS rn FROM {name}_counts)
WHERE rn <= 10 GROUP BY id""", f"{name}_counts")
    cte(f"{name}_found", f"""
SELECT id, word, count(*) AS n
FROM (SELECT {key} AS id, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]+')) AS word FROM {source}) GROUP BY ALL""", source)


DOC_TYPE = "CASE " + " ".join(
    f"WHEN {' OR '.join(f'contains(lower(filename), {q(n)})' for n in ns)} THEN {q(v)}" for v, ns in policy.DOC_TYPE_PATTERNS
) + f" ELSE {q(policy.DEFAULT_DOC_TYPE)} END"
KB_CATEGORY = "CASE " + " ".join(
    f"WHEN {' OR '.join(f'contains(lower(filename), {q(n)})' for n in ns)} THEN {q(v)}" for v, ns in policy.KB_CATEGORY_PATTERNS
) + f" ELSE {q(policy.DEFAULT_KB_CATEGORY)} END"
FILE_ID = "upper(replace(replace(filename, '.txt', ''), ' ', '_'))"


def title_sql(source: str) -> str:
    return f"""
SELECT filename, coalesce(arg_min(s, i), 'Untitled') AS doc_title FROM (
  SELECT d.filename, u.i, {strip("d.l[u.i]")} AS s
  FROM (SELECT filename, string_split(content, {NL})[1:10] AS l FROM {source}) d, unnest(range(1, len(d.l) + 1)) AS u(i))
WHERE length(s) > 3 AND NOT starts_with(s, '===') AND NOT starts_with(s, '---') GROUP BY filename"""


cte("doc_titles", title_sql("v_kb_docs"), "v_kb_docs")
cte("numbered", f"""
SELECT p.*, row_number() OVER (PARTITION BY p.filename ORDER BY p.section_no, p.chunk_no) AS chunk_index,
       count(*) OVER (PARTITION BY p.filename, p.section_no) AS total_chunks,
       count(*) OVER (PARTITION BY p.filename) AS doc_total_chunks, s.section_title
FROM packs p JOIN sections s USING (filename, section_no)""", "packs", "sections")
cte("chunk_rows", f"""
SELECT {DOC_TYPE} || '_' || {FILE_ID} || '_' || CASE WHEN chunk_index < 1000 THEN lpad(CAST(chunk_index AS VARCHAR), 3, '0') ELSE CAST(chunk_index AS VARCHAR) END AS doc_id,
       {DOC_TYPE} AS doc_type,
       coalesce(t.doc_title, 'Untitled') || ' - ' || section_title || CASE WHEN total_chunks = 1 THEN '' ELSE ' (Part ' || chunk_index || ')' END AS title,
       chunk AS content, CAST(chunk_index AS INT) AS chunk_index, CAST(total_chunks AS INT) AS total_chunks,
       CAST(length(chunk) AS INT) AS char_count, TIMESTAMP '{LOADED_AT}' AS created_at, {KB_CATEGORY} AS category,
       filename, md5(d.content) AS content_hash, CAST(doc_total_chunks AS INT) AS doc_total_chunks
FROM numbered n LEFT JOIN doc_titles t USING (filename) JOIN v_kb_docs d USING (filename)""", "numbered", "doc_titles", "v_kb_docs")
keyword_ctes("chunk", "chunk_rows", "doc_id", "content")
keyword_ctes("doc", "documents", "doc_id", "text")
cte("blocks", f"""
SELECT filename, i - 1 AS block_no, l[i] AS block,
       list_filter(list_transform(string_split(l[i], {NL}), lambda x: {strip("x")}), lambda x: x <> '') AS ls
FROM (SELECT filename, string_split(content, {NL} || {NL}) AS l FROM v_runbooks), unnest(range(1, len(l) + 1)) AS u(i)""", "v_runbooks")
cte("block_lines", """
SELECT filename, block_no, i, ls[i] AS s, regexp_matches(ls[i], '^Priority: P[1-4]') AS labelled,
       regexp_matches(ls[i], '^.*\\S \\(Priority P[1-4]\\):$') AS titled
FROM blocks, unnest(range(1, len(ls) + 1)) AS u(i)""", "blocks")
MINUTES = (
    "try_cast(regexp_extract({0}, 'Average resolution time: ([0-9]+)(-[0-9]+)? (minute|hour|day)', 1) AS INT) * "
    "CASE regexp_extract({0}, 'Average resolution time: ([0-9]+)(-[0-9]+)? (minute|hour|day)', 3) "
    "WHEN 'minute' THEN 1 WHEN 'hour' THEN 60 WHEN 'day' THEN 1440 END"
)
cte("entry_rows", f"""
SELECT b.filename, b.block_no, b.block,
       coalesce(regexp_extract(min(l.s) FILTER (l.titled), '^(.*\\S) \\(Priority', 1),
                any_value(b.ls[x.at - 1])) AS entry_title,
       coalesce(regexp_extract(min(l.s) FILTER (l.titled), 'Priority (P[1-4])', 1),
                regexp_extract(min(l.s) FILTER (l.labelled), 'Priority: (P[1-4])', 1)) AS priority,
       coalesce(array_to_string(list_transform(string_split(regexp_extract(min(l.s) FILTER (starts_with(l.s, 'Affected Systems:')), 'Affected Systems:(.*)', 1), ','),
                lambda x: trim(x)), '|'), '') AS affected_systems,
       coalesce(string_agg(trim(substring(l.s, 3)), '|' ORDER BY l.i) FILTER (starts_with(l.s, '- ') AND NOT starts_with(l.s, '- Average resolution time')), '') AS steps,
       {MINUTES.format("b.block")} AS avg_resolution_minutes,
       trim(regexp_extract(min(l.s) FILTER (starts_with(l.s, 'Escalation:')), 'Escalation:(.*)', 1)) AS escalation
FROM blocks b JOIN block_lines l USING (filename, block_no)
LEFT JOIN (SELECT filename, block_no, min(i) AS at FROM block_lines WHERE labelled GROUP BY ALL) x USING (filename, block_no)
GROUP BY b.filename, b.block_no, b.block
HAVING bool_or(l.titled) OR any_value(x.at) > 1""", "blocks", "block_lines")
cte("articles", """
SELECT filename || '#' || block_no AS doc_id, entry_title AS title, block AS content FROM entry_rows""", "entry_rows")
keyword_ctes("article", "articles", "doc_id", "content")
keyword_ctes("ticket", "tk", "ticket_id", "ticket_text")
cte("ask_lines", "SELECT conv_id || ':' || turn AS query_id, text FROM v_lines", "v_lines")
keyword_ctes("line", "ask_lines", "query_id", "text")
cte("v_resolved", "SELECT * FROM v_history WHERE resolved_at IS NOT NULL", "v_history")
keyword_ctes("history", "v_resolved", "ticket_id", "ticket_text")


def bm25_ctes(name: str, asked: str, corpus: str, source: str, k: int = 3) -> None:
    cte(f"{name}_len", f"SELECT id, sum(n) AS dl FROM {corpus}_found GROUP BY id", f"{corpus}_found")
    cte(f"{name}_stats", f"""
SELECT (SELECT count(*) FROM {source}) AS n_docs,
       (SELECT sum(n) FROM {corpus}_found) / (SELECT count(*) FROM {source}) AS mean_len""", f"{corpus}_found", source)
    cte(f"{name}_idf", f"""
SELECT word, ln(1 + (any_value(n_docs) - count(*) + 0.5) / (count(*) + 0.5)) AS idf
FROM {corpus}_found, {name}_stats GROUP BY word""", f"{corpus}_found", f"{name}_stats")
    cte(f"{name}_hits", f"""
SELECT query_id, corpus_id, round(total / 68719476736, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY total DESC, corpus_id) AS rank
FROM (SELECT a.id AS query_id, c.id AS corpus_id,
             sum(CAST(floor(i.idf * (c.n * 2.2::DOUBLE / (c.n + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * l.dl / s.mean_len))) * 68719476736) AS BIGINT)) AS total
      FROM {asked}_found a JOIN {name}_idf i USING (word) JOIN {corpus}_found c USING (word)
      JOIN {name}_len l ON l.id = c.id, {name}_stats s
      GROUP BY a.id, c.id)
QUALIFY rank <= {k}""", f"{asked}_found", f"{name}_idf", f"{corpus}_found", f"{name}_len", f"{name}_stats")


bm25_ctes("line_chunk", "line", "chunk", "chunk_rows")
bm25_ctes("ticket_article", "ticket", "article", "articles")
bm25_ctes("ticket_history", "ticket", "history", "v_resolved")

# --- SLA -----------------------------------------------------------------------------------

cte("sla", values(
    "sla", "priority, urgency, response_minutes, resolution_minutes, after_hours, tier1, tier2, tier3, management",
    sla_rows()))
cte("latest", """
SELECT *, row_number() OVER (PARTITION BY team ORDER BY resolved_at DESC, ticket_id) AS rank FROM v_resolved QUALIFY rank <= 3""", "v_resolved")
cte("latest_any", """
SELECT *, row_number() OVER (ORDER BY resolved_at DESC, ticket_id) AS rank FROM v_resolved QUALIFY rank <= 3""", "v_resolved")


def snap(minutes: str) -> str:
    return "CASE " + " ".join(f"WHEN {minutes} <= {m} THEN {q(t)}" for m, t in policy.TIME_STEPS) + " ELSE '1 day' END"


def generic_recs(s: str, systems: str) -> str:
    first = f"coalesce(nullif(split_part({systems}, '|', 1), ''), 'the affected service')"
    return (
        f"['Route to the ' || {s}.team || ' team', 'Handle as ' || {s}.priority || ' with ' || {s}.urgency_level || ' urgency', "
        f"'Check recent changes to ' || {first}]"
    )


def actions(priority: str, team: str, articles: str, history: str) -> str:
    p1, p2, other = ("|".join(a) for a in (routing.P1_ACTIONS, routing.P2_ACTIONS, routing.OTHER_ACTIONS))
    return (
        f"CASE {priority} WHEN 'P1' THEN {q(p1)} WHEN 'P2' THEN {q(p2)} ELSE {q(other)} END"
        f" || CASE WHEN {articles} > 0 THEN '|Review ' || {articles} || ' relevant documentation articles' ELSE '' END"
        f" || CASE WHEN {history} THEN '|{routing.HISTORY_ACTION}' ELSE '' END"
        f" || '|Route to ' || {team} || ' team'"
    )


TOOLS = policy.TOOLS
ALL_TOOLS, THREE_TOOLS, TWO_TOOLS = "|".join(TOOLS), "|".join(TOOLS[:3]), "|".join(TOOLS[:2])
ORACLES: dict[str, str] = {}


def oracle(name: str, select: str, *needs: str) -> None:
    ORACLES[name] = with_ctes(select, *needs)


# --- sources and sinks -------------------------------------------------------------------------

oracle("read_text_docs", f"""
SELECT true AS named, CAST(length(text) + 1 AS INT) AS chars, md5(text || {NL}) AS content_hash FROM documents""")
oracle("read_tickets_csv", "SELECT ticket_id, ticket_text, submitted_by FROM tk", "tk")
oracle("read_ticket_lines", f"""
SELECT conv_id, turn, CAST(i - 1 AS INT) AS line_no, {strip("l[i]")} AS ticket_text
FROM (SELECT conv_id, turn, string_split(text, {NL}) AS l FROM v_lines), unnest(range(1, len(l) + 1)) AS u(i)
WHERE {strip("l[i]")} <> ''""", "v_lines")
oracle("build_tickets", "SELECT * FROM tk", "tk")
oracle("write_table", "SELECT ticket_id, ticket_text FROM v_history UNION ALL SELECT ticket_id, ticket_text FROM tk", "v_history", "tk")
for name in ("upsert", "upsert_table"):
    oracle(name, "SELECT filename, md5(content) AS content_hash FROM v_kb_docs", "v_kb_docs")
oracle("export_results_csv", """
SELECT category, priority, team, urgency_level AS urgency, count(*) AS tickets, sum(length(substring(ticket_text, 1, 100)) + 3)::BIGINT AS preview_chars
FROM scored GROUP BY ALL""", "scored")
EXPORT = f"""
SELECT s.ticket_id, substring(s.ticket_text, 1, 200) AS ticket, s.category, s.priority, s.team AS assigned_team, s.confidence,
       s.priority_score, s.urgency_level, e.affected_systems, e.technical_keywords, s.user_impact, s.requires_escalation,
       CAST(coalesce(a.n, 0) AS INT) AS knowledge_articles, coalesce(a.articles, '') AS articles, coalesce(h.history, '') AS history,
       {actions("s.priority", "s.team", "coalesce(a.n, 0)", "h.history IS NOT NULL")} AS recommendations
FROM scored s JOIN entities e USING (ticket_id)
LEFT JOIN (SELECT query_id, count(*) AS n, string_agg(corpus_id || ':' || title, '|' ORDER BY rank) AS articles
           FROM ticket_article_hits JOIN articles ON doc_id = corpus_id GROUP BY query_id) a ON a.query_id = s.ticket_id
LEFT JOIN (SELECT team, string_agg(ticket_id || ':' || resolution, '|' ORDER BY rank) AS history FROM latest GROUP BY team) h ON h.team = s.team"""
oracle("export_analysis_json", EXPORT, "scored", "entities", "ticket_article_hits", "articles", "latest")
oracle("reload_kb", """
SELECT k.filename, md5(k.content) AS content_hash, c.chunks, c.ids, c.chars
FROM v_kb_docs k LEFT JOIN (
  SELECT filename, count(*) AS chunks, count(DISTINCT doc_id) AS ids, sum(char_count)::BIGINT AS chars FROM chunk_rows GROUP BY filename
) c USING (filename) WHERE k.lang IS DISTINCT FROM 'es'""", "v_kb_docs", "chunk_rows")
oracle("select_new_docs", """
SELECT d.filename, md5(d.content) AS content_hash, CAST(length(d.content) AS INT) AS chars FROM v_kb_docs d
WHERE NOT EXISTS (SELECT 1 FROM v_kb_loaded l WHERE l.filename = d.filename AND l.content_hash = md5(d.content))""", "v_kb_docs", "v_kb_loaded")

# --- projections and filters --------------------------------------------------------------------

oracle("ticket_listing", "SELECT ticket_id, subject, expected_priority, expected_team FROM tk ORDER BY ticket_id", "tk")
oracle("ticket_listing_first", "SELECT ticket_id, subject FROM tk ORDER BY ticket_id LIMIT 15", "tk")
oracle("ticket_by_id", "SELECT ticket_id, ticket_text, submitted_by FROM tk WHERE ticket_id = 'EVT-000000000001'", "tk")
oracle("drop_blank_tickets", "SELECT filename, count(*) AS lines, sum(length(line))::BIGINT AS chars FROM lines WHERE s <> '' GROUP BY filename", "lines")


def cut(n: int, dots: str) -> str:
    head = f"substring(text, 1, {n})"
    if dots == "always":
        return f"{head} || '...'"
    return head if dots == "never" else f"CASE WHEN length(text) > {n} THEN {head} || '...' ELSE text END"


oracle("preview", f"""
SELECT doc_id, {cut(100, "always")} AS preview_100, {cut(80, "longer")} AS preview_80, {cut(60, "longer")} AS preview_60,
       {cut(200, "longer")} AS preview_200, {cut(500, "never")} AS preview_500, {cut(1000, "never")} AS preview_1000 FROM documents""")
oracle("display_values", """
SELECT event_id, CASE WHEN event_type = 'view' THEN 'N/A' ELSE event_type END AS kind,
       printf('%.2f', value) AS score, printf('%.2f', regexp_extract(props, '([0-9]+)', 1)::DOUBLE) AS code, event_type AS word,
       CASE WHEN event_type = 'click' THEN '0.00' ELSE printf('%.2f', value) END AS gap
FROM events""")
oracle("match_doc_ids", f"""
SELECT count(*) FILTER (starts_with(doc_id, 'Guide_CLOUD_GUIDE_4_')) AS new_format,
       count(*) FILTER (regexp_full_match(doc_id, 'Guide_[0-9]{{3}}')) AS old_format
FROM (SELECT doc_id FROM chunk_rows UNION ALL SELECT {DOC_TYPE} || '_' || lpad(CAST(source_id AS VARCHAR), 3, '0') FROM v_kb_docs)""",
       "chunk_rows", "v_kb_docs")

# --- knowledge base -------------------------------------------------------------------------------

oracle("infer_doc_type", f"SELECT filename, {DOC_TYPE} AS doc_type FROM v_kb_docs", "v_kb_docs")
oracle("infer_kb_category", f"SELECT filename, {KB_CATEGORY} AS category FROM v_kb_docs", "v_kb_docs")
cte("notes", "SELECT 'note ' || source || ' ' || doc_id || '.txt' AS filename, text AS content FROM documents")
cte("note_titles", title_sql("notes"), "notes")
oracle("doc_identity", f"""
SELECT filename, {FILE_ID} AS file_id, coalesce(t.doc_title, 'Untitled') AS doc_title, {DOC_TYPE} AS doc_type, {KB_CATEGORY} AS category
FROM notes LEFT JOIN note_titles t USING (filename)""", "notes", "note_titles")
oracle("detect_headers", "SELECT filename, CAST(line_no AS INT) AS line_no, is_header, opens_section FROM marked", "marked")
oracle("split_sections", "SELECT filename, CAST(section_no AS INT) AS section_no, section_title, section FROM sections", "sections")
oracle("split_paragraphs", "SELECT filename, CAST(section_no AS INT) AS section_no, CAST(para_no AS INT) AS para_no, paragraph FROM paras", "paras")
oracle("pack_chunks", """
SELECT filename, CAST(section_no AS INT) AS section_no, CAST(chunk_no AS INT) AS chunk_no, chunk, CAST(length(chunk) AS INT) AS char_count FROM packs""", "packs")
oracle("extract_keywords", "SELECT d.doc_id, coalesce(k.keywords, '') AS keywords FROM documents d LEFT JOIN doc_keywords k ON k.id = d.doc_id", "doc_keywords")
oracle("chunk_documents", """
SELECT c.doc_id, c.doc_type, c.title, c.content, coalesce(k.keywords, '') AS keywords, c.chunk_index, c.total_chunks, c.char_count,
       c.created_at, c.category, c.filename, c.content_hash, c.doc_total_chunks
FROM chunk_rows c LEFT JOIN chunk_keywords k ON k.id = c.doc_id""", "chunk_rows", "chunk_keywords")
oracle("extract_kb_entries", """
SELECT filename, CAST(block_no AS INT) AS block_no, entry_title, priority, affected_systems, steps, avg_resolution_minutes, escalation FROM entry_rows""", "entry_rows")

# --- scoring ------------------------------------------------------------------------------------------

for name in ("match_rules", "match_rule_table"):
    oracle(name, """
SELECT ticket_id, coalesce(fired_rules, '') AS fired_rules, set_priority, min_priority, rule_urgency, rule_category, rule_team,
       coalesce(notify, '') AS notify, coalesce(actions, '') AS actions FROM scored""", "scored")
oracle("score_teams", "SELECT ticket_id, scores, best_team FROM scored", "scored")
oracle("score_team_table", "SELECT ticket_id, best_team FROM scored WHERE best_team IS NOT NULL", "scored")
oracle("classify_tickets", "SELECT ticket_id, category, priority, team AS assigned_team, confidence FROM scored", "scored")
oracle("priority_from_score", """
SELECT event_id, priority, CASE priority WHEN 'P1' THEN 0.95 WHEN 'P2' THEN 0.8 WHEN 'P3' THEN 0.55 ELSE 0.2 END::DOUBLE AS band_score
FROM (SELECT event_id, CASE WHEN value >= 90 THEN 'P1' WHEN value >= 70 THEN 'P2' WHEN value >= 40 THEN 'P3' ELSE 'P4' END AS priority FROM events)""")
oracle("extract_entities", "SELECT ticket_id, affected_systems, technical_keywords FROM entities", "entities")
oracle("user_impact", "SELECT ticket_id, user_impact FROM scored", "scored")
oracle("urgency_and_escalation", f"""
SELECT ticket_id, CASE WHEN vip THEN {case("base", [("Low", "Medium"), ("Medium", "High"), ("High", "Critical"), ("Critical", "Critical")])} ELSE base END AS urgency_level,
       expected_priority IN ('P1', 'P2') OR user_impact <> 'Single User' AS requires_escalation
FROM (SELECT t.ticket_id, t.expected_priority, s.user_impact, contains(t.submitted_by, 'ceo') AS vip,
             {case("t.expected_priority", policy.URGENCY_BY_PRIORITY.items())} AS base FROM tk t JOIN scored s USING (ticket_id))""", "tk", "scored")
oracle("extract_metadata", """
SELECT ticket_id, priority_score, urgency_level, affected_systems, technical_keywords, user_impact, requires_escalation
FROM scored JOIN entities USING (ticket_id)""", "scored", "entities")
oracle("parse_model_response", """
SELECT event_id,
       CASE WHEN event_type IN ('click', 'view', 'error') THEN event_type ELSE 'Software' END AS category,
       CASE event_type WHEN 'click' THEN 'P2' WHEN 'error' THEN 'P1' ELSE 'P3' END AS priority,
       CASE event_type WHEN 'click' THEN value WHEN 'view' THEN 0.5 WHEN 'error' THEN 0.5 ELSE 0.0 END AS confidence,
       CASE WHEN event_type = 'signup' THEN 'Sorry, no. ' || props END AS raw_response
FROM events""")
oracle("apply_model", """
SELECT ticket_id, CASE WHEN contains(ticket_text, 'virus') THEN 'failed' WHEN length(ticket_text) > 150 THEN 'long' ELSE 'short' END AS label,
       CASE WHEN contains(ticket_text, 'virus') THEN 0 ELSE length(ticket_text) END AS n,
       CASE WHEN contains(ticket_text, 'virus') THEN 'RuntimeError: refused' END AS error FROM tk""", "tk")
cte("best_article", """
SELECT h.query_id AS ticket_id, a.title, a.content FROM ticket_article_hits h JOIN articles a ON a.doc_id = h.corpus_id WHERE h.rank = 1""",
    "ticket_article_hits", "articles")
PROMPT = q(PROMPT_TEMPLATE).replace("{ticket}", "' || t.ticket_text || '").replace(
    "{context}", f"' || coalesce(b.title || {NL} || substring(b.content, 1, 1000), '{policy.NO_CONTEXT}') || '")
oracle("build_prompt", f"SELECT t.ticket_id, {PROMPT} AS prompt FROM tk t LEFT JOIN best_article b USING (ticket_id)", "tk", "best_article")
cte("generated", f"""
SELECT s.ticket_id, m.summary, b.content,
       coalesce(list_transform(list_filter(string_split(b.content, {NL}), lambda l: starts_with(l, '- ') AND NOT starts_with(l, '- Average resolution time')),
                lambda l: trim(substring(l, 3))), []::VARCHAR[]) AS steps,
       coalesce({MINUTES.format("b.content")}, x.resolution_minutes) AS minutes, {generic_recs("s", "e.affected_systems")} AS generic
FROM scored s JOIN summaries m USING (ticket_id) JOIN entities e USING (ticket_id)
LEFT JOIN best_article b USING (ticket_id)
LEFT JOIN sla x ON x.priority = s.priority AND x.urgency = s.urgency_level""", "scored", "summaries", "entities", "best_article", "sla")
oracle("generate_summary", f"""
SELECT ticket_id, summary, array_to_string(list_concat(steps, generic)[1:greatest(3, least(5, len(steps)))], '|') AS recommendations,
       array_to_string(steps, '|') AS resolution_steps, {snap("minutes")} AS estimated_resolution_time FROM generated""", "generated")
oracle("quick_classify", f"""
SELECT s.ticket_id, s.category, s.priority, s.team AS assigned_team, s.urgency_level, s.priority_score, e.affected_systems, m.summary,
       array_to_string({generic_recs("s", "e.affected_systems")}, '|') AS recommendations
FROM scored s JOIN entities e USING (ticket_id) JOIN summaries m USING (ticket_id)""", "scored", "entities", "summaries")
cte("mixed", f"""
SELECT ticket_id, ticket_text, submitted_by FROM tk
UNION ALL
SELECT 'L' || row_number() OVER (), s, NULL FROM (SELECT {strip("unnest(string_split(text, " + NL + "))")} AS s FROM v_lines) WHERE s <> ''""", "tk", "v_lines")
policy_ctes("mix_", "mixed", "submitted_by")
oracle("batch_classify", """
SELECT substring(ticket_text, 1, 100) || '...' AS ticket_text, category, priority, team, urgency_level AS urgency FROM mix_scored""", "mix_scored")
oracle("recommend_actions", f"""
SELECT ticket_id, {actions("priority", "team", "(CAST(substring(priority, 2, 1) AS INT) - 1)", "confidence > 0.5")} AS recommendations FROM scored""", "scored")
oracle("route_tools", f"""
SELECT ticket_id, CASE WHEN priority IN ('P1', 'P2') THEN {q(ALL_TOOLS)} ELSE {q(THREE_TOOLS)} END AS prompt_tools,
       CASE WHEN priority IN ('P1', 'P2') THEN {q(ALL_TOOLS)} ELSE {q(TWO_TOOLS)} END AS observed_tools FROM scored""", "scored")
oracle("estimate_cost", """
SELECT ticket_id, CASE WHEN priority = 'P4' THEN 0.0009 ELSE 0.0013 END::DOUBLE AS stage_cost,
       CASE WHEN priority IN ('P1', 'P2') THEN 0.0020 ELSE 0.0015 END::DOUBLE AS tool_cost FROM scored""", "scored")
oracle("analyze_tickets", f"""
SELECT s.ticket_id, substring(s.ticket_text, 1, 200) AS ticket, s.category, s.priority, s.team AS assigned_team, s.urgency_level,
       s.requires_escalation, CAST(coalesce(a.n, 0) AS INT) AS knowledge_articles, a.articles, h.history,
       {actions("s.priority", "s.team", "coalesce(a.n, 0)", "h.history IS NOT NULL")} AS recommendations
FROM scored s
LEFT JOIN (SELECT query_id, count(*) AS n, string_agg(corpus_id, '|' ORDER BY rank) AS articles FROM ticket_article_hits GROUP BY query_id) a ON a.query_id = s.ticket_id
LEFT JOIN (SELECT team, string_agg(ticket_id, '|' ORDER BY rank) AS history FROM latest GROUP BY team) h ON h.team = s.team""",
       "scored", "ticket_article_hits", "latest")
oracle("compare_approaches", """
SELECT approach, count(*) AS tickets, sum(tools)::BIGINT AS tools_used, round(avg(tools), 4) AS avg_tools, (sum(tools) * 0.0005)::DOUBLE AS total_cost
FROM (SELECT 'Quick Classify' AS approach, 1 AS tools FROM scored UNION ALL SELECT 'Six-Phase', 4 FROM scored
      UNION ALL SELECT 'Sequential Agents', 4 FROM scored
      UNION ALL SELECT 'Adaptive Agent', CASE WHEN priority IN ('P1', 'P2') THEN 4 ELSE 3 END FROM scored)
GROUP BY approach""", "scored")

# --- retrieval --------------------------------------------------------------------------------------------

oracle("vector_topk", """
SELECT query_id, corpus_id, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM (
  SELECT query_id, corpus_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, corpus_id) AS rank
  FROM (SELECT a.vec_id AS query_id, b.vec_id AS corpus_id,
               list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS score
        FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id))
WHERE rank <= 3""")
oracle("vector_recall", "SELECT count(*) * 3 AS pairs, 0::BIGINT AS wrong_scores, true AS found FROM embeddings")
oracle("embed_text", r"""
SELECT doc_id, 256 AS dims, CASE WHEN regexp_matches(content, '[\p{L}\p{N}_]') THEN 1.0 ELSE 0.0 END::DOUBLE AS squared_norm FROM chunk_rows""", "chunk_rows")
oracle("text_topk", "SELECT query_id, corpus_id, score, CAST(rank AS INT) AS rank FROM line_chunk_hits", "line_chunk_hits")
oracle("build_context", f"""
SELECT a.query_id, coalesce(string_agg(c.title || {NL} || substring(c.content, 1, 1000), {NL} || {NL} ORDER BY h.rank), '{policy.NO_CONTEXT}') AS context
FROM ask_lines a LEFT JOIN line_chunk_hits h USING (query_id) LEFT JOIN chunk_rows c ON c.doc_id = h.corpus_id GROUP BY a.query_id""",
       "ask_lines", "line_chunk_hits", "chunk_rows")
oracle("recent_history", """
SELECT t.ticket_id, t.team AS assigned_team, CAST(h.rank AS INT) AS rank, h.ticket_id AS history_ticket_id, h.resolution, h.resolved_at
FROM (SELECT ticket_id, CASE WHEN expected_team = 'Cloud' THEN 'Platform' ELSE expected_team END AS team FROM tk) t
JOIN (SELECT team AS key, rank, ticket_id, resolution, resolved_at FROM latest
      UNION ALL SELECT '*', rank, ticket_id, resolution, resolved_at FROM latest_any) h
  ON h.key = CASE WHEN t.team IN (SELECT team FROM v_resolved) THEN t.team ELSE '*' END""", "tk", "latest", "latest_any", "v_resolved")
oracle("similar_history", """
SELECT h.query_id AS ticket_id, h.corpus_id AS similar_ticket_id, h.score, CAST(h.rank AS INT) AS rank, v.resolution
FROM ticket_history_hits h JOIN v_resolved v ON v.ticket_id = h.corpus_id""", "ticket_history_hits", "v_resolved")
oracle("assign_sla", """
SELECT s.ticket_id, s.priority, s.urgency_level, t.submitted_date + x.response_minutes * INTERVAL '1' MINUTE AS response_due,
       t.submitted_date + x.resolution_minutes * INTERVAL '1' MINUTE AS resolution_due, x.after_hours,
       t.submitted_date + x.tier1 * INTERVAL '1' MINUTE AS escalate_at,
       t.submitted_date + x.tier2 * INTERVAL '1' MINUTE AS tier2_until, t.submitted_date + x.tier3 * INTERVAL '1' MINUTE AS tier3_until,
       t.submitted_date + x.management * INTERVAL '1' MINUTE AS management_at
FROM scored s JOIN tk t USING (ticket_id) LEFT JOIN sla x ON x.priority = s.priority AND x.urgency = s.urgency_level""", "scored", "tk", "sla")
# working time by a table of days: what has been worked before each, and a search in it for due times
OFF = ", ".join(f"DATE '{h}'" for h in CALENDAR.holidays)
cte("days", f"""
SELECT d, m, sum(m) OVER (ORDER BY d) - m AS before, sum(m) OVER (ORDER BY d) AS upto
FROM (SELECT d, CASE WHEN isodow(d) <= 5 AND d NOT IN ({OFF}) THEN 28800000000 ELSE 0 END AS m
      FROM (SELECT CAST(unnest(generate_series(DATE '1994-12-01', DATE '2024-06-30', INTERVAL 1 DAY)) AS DATE) AS d))""")


def worked(t: str, day: str) -> str:
    """Working microseconds up to t, which is on the given row of days."""
    return f"({day}.before + greatest(0, least({day}.m, date_diff('microsecond', CAST({day}.d AS TIMESTAMP) + INTERVAL 9 HOUR, {t}))))"


def business(name: str, source: str, start: str) -> None:
    """(key, what, due): a row for each of the source's times in minutes, in business time where after_hours says so."""
    cte(name, f"""
SELECT w.key, w.what, CASE WHEN w.minutes IS NULL THEN NULL WHEN w.after_hours <> 'Next day' THEN w.start + w.minutes * INTERVAL 1 MINUTE
       ELSE CAST(e.d AS TIMESTAMP) + INTERVAL 9 HOUR + to_microseconds(CAST(w.target - e.before AS BIGINT)) END AS due
FROM (SELECT s.key, s.what, s.minutes, s.after_hours, s.start,
             {worked("s.start", "b")} + CASE WHEN s.minutes >= 1440 THEN (s.minutes // 1440) * 480 + s.minutes % 1440 ELSE s.minutes END * 60000000::BIGINT AS target
      FROM (SELECT key, start, after_hours, unnest(['response', 'resolution', 'escalate', 'management']) AS what,
                   unnest([response_minutes, resolution_minutes, tier1, management]) AS minutes FROM {source}) s
      JOIN days b ON b.d = CAST(s.start AS DATE)) w
ASOF LEFT JOIN (SELECT * FROM days WHERE m > 0) e ON w.target <= e.upto""", "days", source)


cte("sla_tickets", """
SELECT s.ticket_id AS key, t.submitted_date AS start, x.* FROM scored s JOIN tk t USING (ticket_id) JOIN sla x ON x.priority = s.priority AND x.urgency = s.urgency_level""",
    "scored", "tk", "sla")
cte("sla_history", "SELECT v.ticket_id AS key, v.submitted_at AS start, x.* FROM v_resolved v JOIN sla x ON x.priority = v.priority AND x.urgency = v.urgency", "v_resolved", "sla")
business("ticket_due", "sla_tickets", "submitted_date")
business("history_due", "sla_history", "submitted_at")
oracle("assign_sla_business", f"""
SELECT p.key AS ticket_id, p.priority, p.urgency AS urgency_level, d.response_due, d.resolution_due, d.escalate_at, d.management_at,
       ({worked("d.resolution_due", "e")} - {worked("p.start", "b")}) / 60000000 AS working_minutes
FROM sla_tickets p JOIN (SELECT key, max(due) FILTER (what = 'response') AS response_due, max(due) FILTER (what = 'resolution') AS resolution_due,
                                max(due) FILTER (what = 'escalate') AS escalate_at, max(due) FILTER (what = 'management') AS management_at
                         FROM ticket_due GROUP BY key) d USING (key)
JOIN days b ON b.d = CAST(p.start AS DATE) JOIN days e ON e.d = CAST(d.resolution_due AS DATE)""", "sla_tickets", "ticket_due", "days")
oracle("sla_compliance_business", f"""
SELECT v.priority, count(*) AS tickets, count(*) FILTER (v.resolved_at <= d.resolution) AS on_time, round(avg((v.resolved_at <= d.resolution)::INT), 4) AS compliance,
       avg((v.resolved_at <= d.resolution)::INT) >= {policy.LEVEL1_TARGET} AS meets_target, count(*) FILTER (v.resolved_at > d.management) AS management_escalations
FROM v_resolved v JOIN (SELECT key, max(due) FILTER (what = 'resolution') AS resolution, max(due) FILTER (what = 'management') AS management
                        FROM history_due GROUP BY key) d ON d.key = v.ticket_id GROUP BY v.priority""", "v_resolved", "history_due")
cte("indexed", "SELECT 'doc-' || doc_id AS doc_id FROM labels UNION SELECT 'item-' || item_id FROM benchmark")
oracle("index_gap", """
SELECT doc_id, 'missing' AS status FROM (SELECT 'doc-' || doc_id AS doc_id FROM documents EXCEPT SELECT doc_id FROM indexed)
UNION ALL SELECT doc_id, 'orphaned' FROM (SELECT doc_id FROM indexed EXCEPT SELECT 'doc-' || doc_id FROM documents)""", "indexed")
oracle("index_gap_counts", """
SELECT (SELECT count(*) FROM documents) AS source_rows, (SELECT count(DISTINCT doc_id) FROM labels) AS index_rows,
       (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS missing,
       (SELECT count(DISTINCT doc_id) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS orphaned""")

# --- reports and checks --------------------------------------------------------------------------------------

oracle("tickets_by_priority", """
SELECT expected_priority AS priority, any_value(total)::BIGINT AS tickets, page, count(*) AS page_tickets, string_agg(ticket_id, '|' ORDER BY ticket_id) AS ticket_ids
FROM (SELECT expected_priority, ticket_id, count(*) OVER (PARTITION BY expected_priority) AS total,
             (row_number() OVER (PARTITION BY expected_priority ORDER BY ticket_id) - 1) // 1000 AS page FROM tk)
GROUP BY expected_priority, page""", "tk")
oracle("tickets_by_team", "SELECT expected_team AS team, count(*) AS tickets FROM tk GROUP BY ALL ORDER BY tickets DESC, team", "tk")
oracle("chunk_stats", """
SELECT doc_type, count(*) AS chunks, CAST(floor(avg(char_count)) AS INT) AS avg_length, min(char_count) AS min_length, max(char_count) AS max_length
FROM chunk_rows GROUP BY doc_type ORDER BY doc_type""", "chunk_rows")
oracle("kb_inventory", """
SELECT doc_type, count(*) AS chunks, (sum(count(*)) OVER ())::BIGINT AS total_chunks FROM chunk_rows GROUP BY doc_type ORDER BY doc_type""", "chunk_rows")
for judged, scores in (("judged", "scored"), ("judged_extended", "ext_scored")):
    cte(judged, f"""
SELECT ticket_id, t.expected_category, t.expected_priority, t.expected_team, s.category, s.priority, s.team
FROM tk t JOIN {scores} s USING (ticket_id)""", "tk", scores)


def accuracy_sql(judged: str) -> str:
    return f"""
SELECT field, count(*) AS tickets, count(*) FILTER (ok) AS correct, round(avg(ok::INT), 5) AS accuracy FROM (
  SELECT 'category' AS field, expected_category = category AS ok FROM {judged}
  UNION ALL SELECT 'priority', expected_priority = priority FROM {judged}
  UNION ALL SELECT 'team', expected_team = team FROM {judged}
  UNION ALL SELECT 'all', expected_category = category AND expected_priority = priority AND expected_team = team FROM {judged})
GROUP BY field"""


oracle("evaluate", accuracy_sql("judged"), "judged")
oracle("evaluate_extended", accuracy_sql("judged_extended"), "judged_extended")


def class_score_sql(pairs: str) -> str:
    return f"""
SELECT field, label, expected, predicted, correct,
       CASE WHEN predicted > 0 THEN round(correct / predicted, 5) ELSE 0.0 END AS "precision",
       CASE WHEN expected > 0 THEN round(correct / expected, 5) ELSE 0.0 END AS recall,
       round(2 * correct / (expected + predicted), 5) AS f1
FROM (SELECT field, label, count(*) FILTER (side = 'e') AS expected, count(*) FILTER (side = 'p') AS predicted,
             count(*) FILTER (side = 'e' AND same) AS correct
      FROM (SELECT field, e AS label, 'e' AS side, e = p AS same FROM ({pairs}) UNION ALL SELECT field, p, 'p', false FROM ({pairs}))
      GROUP BY field, label)"""


oracle("class_scores", class_score_sql("""
SELECT 'category' AS field, expected_category AS e, category AS p FROM judged
UNION ALL SELECT 'priority', expected_priority, priority FROM judged UNION ALL SELECT 'team', expected_team, team FROM judged"""), "judged")
oracle("evaluate_quality", class_score_sql("""
SELECT 'quality' AS field, l.quality AS e, CAST(d.n_chars >= 1000 AS INT) AS p FROM documents d JOIN labels l USING (doc_id)"""))
oracle("confusion_matrix", "SELECT expected_priority AS expected, count(*) AS total, " + ", ".join(
    f"count(*) FILTER (priority = '{p}') AS pred_{p}" for p in policy.PRIORITIES) + " FROM judged GROUP BY ALL", "judged")
oracle("audit_sample", """
SELECT week, CAST(n AS INT) AS draw_no, ticket_id FROM (
  SELECT CAST(date_trunc('week', submitted_date) AS DATE) AS week, ticket_id,
         row_number() OVER (PARTITION BY date_trunc('week', submitted_date) ORDER BY md5('audit-1' || ticket_id), ticket_id) AS n FROM tk)
WHERE n <= 20""", "tk")
oracle("resolution_metrics", """
SELECT month, team, resolved, round(mean_hours, 4) AS mean_hours, round(median_hours, 4) AS median_hours, round(p90_hours, 4) AS p90_hours,
       CASE WHEN lag(month) OVER (PARTITION BY team ORDER BY month) = month - INTERVAL 1 MONTH
            THEN round(mean_hours - lag(mean_hours) OVER (PARTITION BY team ORDER BY month), 4) END AS change_hours
FROM (SELECT CAST(date_trunc('month', resolved_at) AS DATE) AS month, team, count(*) AS resolved, avg(resolution_time_hours) AS mean_hours,
             quantile_cont(resolution_time_hours, 0.5) AS median_hours, quantile_cont(resolution_time_hours, 0.9) AS p90_hours
      FROM v_resolved GROUP BY ALL)""", "v_resolved")
oracle("sla_compliance", f"""
SELECT h.priority, count(*) AS tickets, count(*) FILTER (ok) AS on_time, round(avg(ok::INT), 4) AS compliance, avg(ok::INT) >= {policy.LEVEL1_TARGET} AS meets_target,
       count(*) FILTER (late) AS management_escalations
FROM (SELECT v.priority, v.resolved_at <= v.submitted_at + x.resolution_minutes * INTERVAL '1' MINUTE AS ok,
             v.resolved_at > v.submitted_at + x.management * INTERVAL '1' MINUTE AS late
      FROM v_resolved v JOIN sla x ON x.priority = v.priority AND x.urgency = v.urgency) h
GROUP BY h.priority""", "v_resolved", "sla")
oracle("run_summary", """
SELECT count(*) AS tickets, count(*) AS processed, 0::BIGINT AS failed, sum(tools)::BIGINT AS tools_used, count(*) * 4 AS tools_available,
       (sum(tools) * 0.0005)::DOUBLE AS total_cost, round(avg(tools * 0.0005), 6)::DOUBLE AS avg_cost
FROM (SELECT CASE WHEN priority IN ('P1', 'P2') THEN 4 ELSE 3 END AS tools FROM scored)""", "scored")
oracle("check_ticket_table", """
SELECT 'not_null:ticket_id' AS "check", count(*) FILTER (ticket_id IS NULL) AS violations FROM tk
UNION ALL SELECT 'not_null:subject', count(*) FILTER (subject IS NULL) FROM tk
UNION ALL SELECT 'not_null:description', count(*) FILTER (description IS NULL) FROM tk
UNION ALL SELECT 'not_null:ticket_text', count(*) FILTER (ticket_text IS NULL) FROM tk
UNION ALL SELECT 'domain:expected_category', count(*) FILTER (expected_category NOT IN ('Hardware', 'Software', 'Security')) FROM tk
UNION ALL SELECT 'domain:expected_priority', count(*) FILTER (expected_priority NOT IN ('P1', 'P2', 'P3', 'P4')) FROM tk
UNION ALL SELECT 'domain:expected_team', 0 FROM (SELECT 1)
UNION ALL SELECT 'unique:ticket_id', count(*) FROM (SELECT ticket_id FROM tk GROUP BY ticket_id HAVING count(*) > 1)""", "tk")
oracle("backlog_by_priority", """
SELECT s.priority, count(*) AS tickets, min(t.submitted_date + x.response_minutes * INTERVAL '1' MINUTE) AS first_response_due,
       max(t.submitted_date + x.resolution_minutes * INTERVAL '1' MINUTE) AS last_resolution_due
FROM scored s JOIN tk t USING (ticket_id) JOIN sla x ON x.priority = s.priority AND x.urgency = s.urgency_level GROUP BY s.priority""", "scored", "tk", "sla")

# --- streaming and SQL functions ---------------------------------------------------------------------------------

oracle("sync_index", "SELECT doc_id, md5(content) AS content_hash, 256 AS dims FROM chunk_rows WHERE doc_type <> 'Policy'", "chunk_rows")
for name in ("classify_stream", "classify_stream_once"):
    oracle(name, "SELECT ticket_id, category, priority, team AS assigned_team, urgency_level, user_impact FROM scored", "scored")
oracle("register_functions", f"""
SELECT s.ticket_id, s.category, s.priority, s.team AS assigned_team, s.urgency_level, e.technical_keywords,
       {snap("x.resolution_minutes")} AS estimate, m.summary
FROM anon_scored s JOIN anon_entities e USING (ticket_id) JOIN anon_summaries m USING (ticket_id)
LEFT JOIN sla x ON x.priority = s.priority AND x.urgency = s.urgency_level""", "anon_scored", "anon_entities", "anon_summaries", "sla")
