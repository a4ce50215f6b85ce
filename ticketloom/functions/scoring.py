"""The classification policy as one Spark SQL expression.

The policy is written as SQL text so that the same expression serves DataFrames,
streams and SQL functions. Rule tables are embedded as literals: scoring is a
map-only job with no join, shuffle, Python worker or state, however many tickets
there are.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from ticketloom import policy
from ticketloom.functions.text import padded
from ticketloom.policy import Rule

NO_SENDER = "CAST(NULL AS STRING)"
NULL = "CAST(NULL AS STRING)"


def quote(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_array(values: Iterable[str]) -> str:
    items = ", ".join(quote(v) for v in values)
    return f"array({items})" if items else "CAST(array() AS ARRAY<STRING>)"


def plain_phrases(phrases: Iterable[str]) -> list[str]:
    """Phrases in the form of a normalised text, each once."""
    return list(dict.fromkeys(padded(p).strip() for p in phrases))


def phrase_array(phrases: Iterable[str]) -> str:
    return sql_array(plain_phrases(phrases))


def chain_sql(start: str, *steps: str) -> str:
    """Evaluate steps one after another within the row; each sees the last as ``v``.

    Every step is a one-element transform over the one before, so an intermediate is
    evaluated once however often it is used, and only the structs that steps name are
    carried on.
    """
    out = f"array({start})"
    for step in steps:
        out = f"transform({out}, v -> {step})"
    return f"{out}[0]"


def record(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in fields.items()) + ")"


def used(fields: Mapping[str, str], *later: Mapping[str, str]) -> dict[str, str]:
    """The fields that later steps read as ``v.<field>``."""
    names = {name for step in later for sql in step.values() for name in re.findall(r"\bv\.(\w+)", sql)}
    return {name: sql for name, sql in fields.items() if name in names}


def normalise_sql(text: str) -> str:
    return f"concat(' ', btrim(regexp_replace(lower({text}), '[^a-z0-9_[\\\\p{{L}}\\\\p{{N}}]]+', ' ')), ' ')"


LONGEST_GRAM = 4


def in_sql(value: str, options: Iterable[str]) -> str:
    """Whether a value is one of some phrases: one look-up in a set that is built once, not per row."""
    items = ", ".join(quote(o) for o in options)
    return f"{value} IN ({items})" if items else "false"


def hits_steps(text: str, phrases: Iterable[str]) -> list[str]:
    """Start and steps giving (norm, words, hits): the phrases that occur as whole words, each once.

    Every word of the ticket is looked up in the set of phrases, and so are the runs of
    words that begin with the first word of a longer phrase; the cost does not grow with
    the number of phrases. Phrases of more words than ``LONGEST_GRAM`` are searched for as text.
    """
    plain = plain_phrases(phrases)
    short = [p for p in plain if len(p.split()) <= LONGEST_GRAM]
    long = [p for p in plain if len(p.split()) > LONGEST_GRAM]
    steps = [normalise_sql(f"coalesce({text}, '')"), record(norm="v", words="split(btrim(v), ' ')")]
    found = [f"filter(v.words, w -> {in_sql('w', [p for p in short if len(p.split()) <= 1])})"]
    runs = {n: [p for p in short if len(p.split()) == n] for n in range(2, LONGEST_GRAM + 1)}
    if any(runs.values()):
        heads = dict.fromkeys(p.split()[0] for of_n in runs.values() for p in of_n)
        places = f"filter(transform(v.words, (w, i) -> CASE WHEN {in_sql('w', heads)} THEN i END), i -> i IS NOT NULL)"
        steps.append(record(norm="v.norm", words="v.words", places=places))
        for n, of_n in runs.items():
            if of_n:
                run = ", ".join(f"get(v.words, i + {j})" for j in range(n))
                found.append(f"filter(transform(v.places, i -> concat_ws(' ', {run})), w -> {in_sql('w', of_n)})")
    found += [f"filter({sql_array(long)}, p -> contains(v.norm, concat(' ', p, ' ')))"] if long else []
    return [*steps, record(norm="v.norm", words="v.words", hits=f"array_distinct(concat({', '.join(found)}))")]


def _any(phrases: Iterable[str]) -> str:
    return f"exists(v.hits, h -> {in_sql('h', plain_phrases(phrases))})"


def _case(pairs: Iterable[tuple[str, str]], default: str) -> str:
    whens = " ".join(f"WHEN {cond} THEN {value}" for cond, value in pairs)
    return f"CASE {whens} ELSE {default} END" if whens else default


def _compact(items: Sequence[str]) -> str:
    if not items:
        return "CAST(array() AS ARRAY<STRING>)"
    return f"array_compact(array({', '.join(items)}))"


def _least(items: Sequence[str]) -> str:
    return f"least({', '.join([*items, NULL, NULL])})"


def snap_minutes_sql(minutes: str) -> str:
    """Round minutes up to the allowed list of estimates; null stays null."""
    steps = [(f"{minutes} <= {limit}", quote(label)) for limit, label in policy.TIME_STEPS]
    return f"CASE WHEN {minutes} IS NULL THEN NULL ELSE {_case(steps, quote('1 day'))} END"


def sla_minutes_sql(priority: str, urgency: str, field: int) -> str:
    """Response (2) or resolution (3) target minutes of a (priority, urgency) pair."""
    pairs = []
    for row in policy.SLA_MATRIX:
        if row[1] is None:
            pairs.append((f"{priority} = {quote(row[0])}", str(row[field])))
            continue
        near = [u for (p, u), use in policy.SLA_NEAREST.items() if p == row[0] and use == row[1]]
        names = ", ".join(quote(u) for u in [row[1], *near])
        pairs.append((f"{priority} = {quote(row[0])} AND {urgency} IN ({names})", str(row[field])))
    return _case(pairs, "CAST(NULL AS INT)")


def first_sentence_sql(text: str) -> str:
    """First sentence of the ticket body, without a leading subject block."""
    body = (
        f"btrim(regexp_replace({text}, '^(?s)Subject: .*?\\n\\nDescription: ', ''), "
        "' \\t\\n\\r')"
    )
    first = "regexp_extract(v, '^(?s)(.+?[.!?])(\\\\s|$)', 1)"
    return chain_sql(body, record(body="v", first=first), "CASE WHEN v.first = '' THEN v.body ELSE v.first END")


def urgency_sql(base: str, raised: str) -> str:
    up = {"Low": "Medium", "Medium": "High", "High": "Critical", "Critical": "Critical"}
    raised_to = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in up.items())
    return f"CASE WHEN {raised} THEN CASE {base} {raised_to} END ELSE {base} END"


def priority_score_sql(priority: str) -> str:
    cases = [(f"{priority} = {quote(p)}", f"CAST({s} AS DOUBLE)") for p, s in policy.PRIORITY_SCORE.items()]
    return _case(cases, "CAST(NULL AS DOUBLE)")


def _rule_condition(rule: Rule, sender: str) -> str:
    parts = []
    if rule.phrases:
        parts.append(_any(rule.phrases))
    if rule.sender_pattern:
        parts.append(f"coalesce(lower({sender}) RLIKE {quote(rule.sender_pattern)}, false)")
    condition = "(" + " OR ".join(parts) + ")"
    if rule.unless:
        condition += f" AND NOT {_any(rule.unless)}"
    return condition


def score_steps(
    text: str,
    sender: str = NO_SENDER,
    rules: Sequence[Rule] = policy.RULES,
    team_keywords: Mapping[str, Sequence[str]] = policy.TEAM_KEYWORDS,
    extract: bool = True,
    fields: Sequence[str] | None = None,
) -> list[str]:
    """Start and steps giving one struct with everything the policy says of a ticket.

    ``extract=False`` leaves out systems, technical terms and impact, and the
    phrases only they need. With ``fields`` only these are worked out, of which
    ``words``, all words of the ticket, is given only if it is asked for.
    """
    phrases: list[str] = [*policy.INFO_CUES, *policy.DEVICE_WORDS]
    for rule in rules:
        phrases += [*rule.phrases, *rule.unless, *rule.soon_phrases]
    for words in team_keywords.values():
        phrases += words
    if extract:
        phrases += [*policy.SYSTEM_WORDS, *policy.TECH_WORDS]
        for words in policy.IMPACT_PHRASES.values():
            phrases += words

    def fired(rule: Rule) -> str:
        return f"array_contains(v.fired, {rule.rule_id})"

    fired_ids = "array_compact(array({}))".format(
        ", ".join(f"CASE WHEN {_rule_condition(r, sender)} THEN {r.rule_id} END" for r in rules)
    )
    counts = "array({})".format(
        ", ".join(f"size(filter(v.hits, h -> {in_sql('h', plain_phrases(words))}))" for words in team_keywords.values())
    ) if team_keywords else "CAST(array() AS ARRAY<INT>)"
    found = {"words": "v.words", "hits": "v.hits", "fired": fired_ids, "counts": counts}
    if extract:
        found |= {"impact": impact_sql(), "hosts": hosts_sql(text)}
    carried = {name: f"v.{name}" for name in found}

    set_priority = _least([
        f"CASE WHEN {fired(r)} THEN "
        + (
            f"CASE WHEN {_any(r.soon_phrases)} THEN {quote(r.soon_priority)} ELSE {quote(r.set_priority)} END"
            if r.soon_phrases
            else quote(r.set_priority)
        )
        + " END"
        for r in rules
        if r.set_priority
    ])
    min_priority = _least(
        [f"CASE WHEN {fired(r)} THEN {quote(r.min_priority)} END" for r in rules if r.min_priority]
    )
    effects = {
        "set_priority": set_priority,
        "min_priority": min_priority,
        "rule_urgency": _case(
            [(fired(r), quote(u)) for u in policy.URGENCIES for r in rules if r.urgency == u], NULL
        ),
        "rule_category": _case([(fired(r), quote(r.category)) for r in rules if r.category], NULL),
        "rule_team": _case([(fired(r), quote(r.team)) for r in rules if r.team], NULL),
        "notify": _compact([f"CASE WHEN {fired(r)} THEN {quote(r.notify)} END" for r in rules if r.notify]),
        "action": _compact([f"CASE WHEN {fired(r)} THEN {quote(r.action)} END" for r in rules if r.action]),
        "raised": " OR ".join([fired(r) for r in rules if r.raise_urgency]) or "false",
        "most": "array_max(v.counts)",
        "total": "aggregate(v.counts, 0, (a, x) -> a + x)",
    }
    known = carried | {name: f"v.{name}" for name in effects}

    cue = f"CASE WHEN {_any(policy.INFO_CUES)} THEN 'P4' ELSE {quote(policy.DEFAULT_PRIORITY)} END"
    best = f"get({sql_array(team_keywords)}, CAST(array_position(v.counts, v.most) AS INT) - 1)"
    chosen = {
        "best_team": f"CASE WHEN v.most > 0 THEN {best} END",
        "priority": f"coalesce(least(v.set_priority, v.min_priority), {cue})",
        "team": f"coalesce(v.rule_team, CASE WHEN v.most > 0 THEN {best} END, {quote(policy.DEFAULT_TEAM)})",
    }

    by_team = " ".join(
        f"WHEN {quote(t)} THEN "
        + (f"CASE WHEN {_any(policy.DEVICE_WORDS)} THEN 'Hardware' ELSE {quote(c)} END"
           if t == "End User Support" else quote(c))
        for t, c in policy.CATEGORY_BY_TEAM.items()
    )
    by_priority = " ".join(f"WHEN {quote(p)} THEN {quote(u)}" for p, u in policy.URGENCY_BY_PRIORITY.items())
    scores = "array({})".format(
        ", ".join(record(team=quote(team), score=f"get(v.counts, {i})") for i, team in enumerate(team_keywords))
    )
    result = {
        "fired": "v.fired",
        "set_priority": "v.set_priority",
        "min_priority": "v.min_priority",
        "rule_urgency": "v.rule_urgency",
        "rule_category": "v.rule_category",
        "rule_team": "v.rule_team",
        "notify": "v.notify",
        "action": "v.action",
        "scores": scores,
        "best_team": "v.best_team",
        "category": f"coalesce(v.rule_category, CASE v.team {by_team} ELSE {quote(policy.DEFAULT_CATEGORY)} END)",
        "priority": "v.priority",
        "assigned_team": "v.team",
        "confidence": "CASE WHEN v.total = 0 THEN CAST(0 AS DOUBLE) ELSE round(v.most / v.total, 2) END",
        "priority_score": priority_score_sql("v.priority"),
        "urgency_level": urgency_sql(f"coalesce(v.rule_urgency, CASE v.priority {by_priority} END)", "v.raised"),
    }
    if extract:
        result |= {
            "affected_systems": systems_sql(),
            "technical_keywords": technical_sql(text),
            "user_impact": "v.impact",
            "requires_escalation": "v.priority IN ('P1', 'P2') OR v.impact <> 'Single User'",
        }
    if fields is not None:
        result = {name: (result | {"words": "filter(v.words, w -> w <> '')"})[name] for name in fields}
    chosen = used(chosen, result)
    known = used(known, chosen, result)
    effects = used(effects, known)
    carried = used(carried, effects, known)
    return [
        *hits_steps(text, phrases),
        record(**used(found, carried)),
        record(**carried, **effects),
        record(**known, **chosen),
        record(**result),
    ]


def score_sql(
    text: str,
    sender: str = NO_SENDER,
    rules: Sequence[Rule] = policy.RULES,
    team_keywords: Mapping[str, Sequence[str]] = policy.TEAM_KEYWORDS,
    extract: bool = True,
    fields: Sequence[str] | None = None,
) -> str:
    """``score_steps`` as one SQL expression."""
    return chain_sql(*score_steps(text, sender, rules, team_keywords, extract, fields))


def impact_sql() -> str:
    """User impact from ``v.norm`` and ``v.hits``."""
    pairs = [(_any(words), quote(level)) for level, words in policy.IMPACT_PHRASES.items()]
    pairs.append((f"v.norm RLIKE {quote(policy.HEADCOUNT_PATTERN)}", quote("Multiple Users")))
    return _case(pairs, quote("Single User"))


def _dictionary_hits(words: Sequence[str]) -> str:
    """The hits among some words, in the order of these words."""
    return f"CASE WHEN {_any(words)} THEN array_intersect({phrase_array(words)}, v.hits) ELSE CAST(array() AS ARRAY<STRING>) END"


def hosts_sql(text: str) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), {quote(policy.HOST_PATTERN)}, 0)"


def systems_sql() -> str:
    """Host names, then known systems, from ``v.hosts`` and ``v.hits``."""
    return f"array_distinct(concat(v.hosts, {_dictionary_hits(policy.SYSTEM_WORDS)}))"


# Every code begins with one of three characters; the others are passed without trying the pattern.
CODES = f"(?=[EH0])(?:{policy.CODE_PATTERN})"


def technical_sql(text: str) -> str:
    """Error codes, host names and technologies, from the text, ``v.hosts`` and ``v.hits``."""
    codes = f"regexp_extract_all(coalesce({text}, ''), {quote(CODES)}, 0)"
    return f"array_distinct(concat({codes}, v.hosts, {_dictionary_hits(policy.TECH_WORDS)}))"


def entities_sql(text: str) -> str:
    """Struct of affected systems and technical keywords alone."""
    return chain_sql(
        *hits_steps(text, [*policy.SYSTEM_WORDS, *policy.TECH_WORDS]),
        record(hits="v.hits", hosts=hosts_sql(text)),
        record(affected_systems=systems_sql(), technical_keywords=technical_sql(text)),
    )


def user_impact_sql(text: str) -> str:
    phrases = [p for words in policy.IMPACT_PHRASES.values() for p in words]
    return chain_sql(*hits_steps(text, phrases), impact_sql())


def generate_sql(text: str, context: str, scored: str) -> str:
    """Extractive summary, steps and time estimate.

    ``context`` is knowledge-base text; its "- " lines are the steps. ``scored`` is
    the struct of ``score_sql``. Nothing is written by a model.
    """
    steps = (
        f"transform(filter(split({context}, '\\n'), l -> startswith(l, '- ') "
        "AND NOT startswith(l, '- Average resolution time')), l -> btrim(substring(l, 3)))"
    )
    minutes = context_minutes_sql(context)
    fallback = sla_minutes_sql("v.priority", "v.urgency_level", 3)
    generic = (
        "array(concat('Route to the ', v.assigned_team, ' team'), "
        "concat('Handle as ', v.priority, ' with ', v.urgency_level, ' urgency'), "
        "concat('Check recent changes to ', coalesce(get(v.affected_systems, 0), 'the affected service')))"
    )
    return chain_sql(
        scored,
        record(
            steps=f"coalesce({steps}, CAST(array() AS ARRAY<STRING>))",
            generic=generic,
            minutes=f"coalesce({minutes}, {fallback})",
        ),
        record(
            summary=first_sentence_sql(text),
            recommendations="slice(concat(v.steps, v.generic), 1, greatest(3, least(5, size(v.steps))))",
            resolution_steps="v.steps",
            estimated_resolution_time=snap_minutes_sql("v.minutes"),
        ),
    )


def context_minutes_sql(context: str) -> str:
    """Minutes of the first "Average resolution time" in a text, else null."""
    pattern = "Average resolution time: ([0-9]+)(-[0-9]+)? (minute|hour|day)"
    number = f"try_cast(regexp_extract({context}, {quote(pattern)}, 1) AS INT)"
    unit = f"regexp_extract({context}, {quote(pattern)}, 3)"
    return f"{number} * CASE {unit} WHEN 'minute' THEN 1 WHEN 'hour' THEN 60 WHEN 'day' THEN 1440 END"


def fields_of(*names: str, source: str = "v") -> dict[str, str]:
    return {name: f"{source}.{name}" for name in names}


def classification_sql(
    text: str, sender: str = NO_SENDER, rules: Sequence[Rule] = policy.RULES
) -> str:
    return score_sql(text, sender, rules, extract=False, fields=("category", "priority", "assigned_team", "confidence"))


def metadata_sql(text: str, sender: str = NO_SENDER) -> str:
    return score_sql(text, sender, fields=(
        "priority_score", "urgency_level", "affected_systems", "technical_keywords", "user_impact", "requires_escalation"))


QUICK_FIELDS = ("category", "priority", "assigned_team", "urgency_level", "priority_score", "affected_systems")
# What ``generate_sql`` reads of the scored struct.
GENERATE_FIELDS = ("priority", "urgency_level", "assigned_team", "affected_systems")


def quick_sql(text: str, sender: str = NO_SENDER) -> str:
    """The eight fields of quick classification, with the fixed short context."""
    return chain_sql(
        score_sql(text, sender, fields=QUICK_FIELDS),
        record(s="v", g=generate_sql(text, quote(policy.QUICK_CONTEXT), "v")),
        record(
            **fields_of(*QUICK_FIELDS, source="v.s"),
            **fields_of("summary", "recommendations", source="v.g"),
        ),
    )
