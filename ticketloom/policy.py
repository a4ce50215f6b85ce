"""The written classification policy, as data.

Fixed values: closed vocabularies, rule phrases, team keywords, SLA targets and
prices. Results depend on them being exactly these; callers may pass their own
rule, keyword, SLA and price tables to the operators instead.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

# --- fixed values: closed vocabularies -------------------------------------
CATEGORIES = ("Hardware", "Software", "Security", "Infrastructure", "Service Request")
PRIORITIES = ("P1", "P2", "P3", "P4")
TEAMS = (
    "Infrastructure",
    "Applications",
    "Security",
    "End User Support",
    "Identity & Access Management",
    "Database",
    "Cloud",
)
URGENCIES = ("Critical", "High", "Medium", "Low")

DEFAULT_CATEGORY = "Software"
DEFAULT_PRIORITY = "P3"
DEFAULT_TEAM = "Applications"

# --- fixed values: automatic classification rules ---------------------------


@dataclass(frozen=True)
class Rule:
    """One IF-contains-THEN rule. Unset effects are None."""

    rule_id: int
    phrases: tuple[str, ...] = ()
    unless: tuple[str, ...] = ()
    sender_pattern: str | None = None
    category: str | None = None
    team: str | None = None
    set_priority: str | None = None
    min_priority: str | None = None
    soon_phrases: tuple[str, ...] = ()
    soon_priority: str | None = None
    urgency: str | None = None
    raise_urgency: bool = False
    notify: str | None = None
    action: str | None = None


SENDER_PATTERN = "(^|[^a-z])(ceo|cfo|cto|cio|coo|ciso|chief|executive|exec|board|vip)([^a-z]|$)"

RULES = (
    Rule(
        1,
        phrases=("hack", "breach", "ransomware", "malware", "phishing", "suspicious",
                 "unauthorized", "security", "virus"),
        category="Security",
        team="Security",
        min_priority="P2",
        notify="Security operations center",
    ),
    Rule(
        2,
        phrases=("production down", "prod error", "customer-facing", "revenue impact"),
        set_priority="P1",
        urgency="Critical",
        notify="On-call engineer and management",
    ),
    Rule(
        3,
        phrases=("all users", "everyone", "entire department", "company-wide", "nobody can"),
        min_priority="P2",
        urgency="High",
        action="Check whether the issue is widespread",
    ),
    Rule(
        4,
        sender_pattern=SENDER_PATTERN,
        raise_urgency=True,
        notify="IT management",
        action="Assign a senior engineer",
    ),
    Rule(
        5,
        phrases=("urgent", "ASAP", "immediately", "deadline", "emergency", "critical"),
        action="Review urgency with the user",
    ),
    Rule(
        6,
        phrases=("password reset", "forgot password", "locked out", "cannot login"),
        unless=("multiple users", "application"),
        category="Service Request",
        team="End User Support",
        set_priority="P3",
        action="Offer the self-service portal",
    ),
    Rule(
        7,
        phrases=("new user", "new hire", "onboarding", "needs access", "add user"),
        category="Service Request",
        team="Identity & Access Management",
        set_priority="P3",
        action="Require manager approval",
    ),
    Rule(
        8,
        phrases=("termination", "last day", "disable account", "offboarding", "resignation"),
        category="Service Request",
        team="Identity & Access Management",
        set_priority="P2",
        soon_phrases=("today", "immediate", "immediately"),
        soon_priority="P1",
        notify="Security team",
        action="Disable access by the given date",
    ),
)

# Optional wider phrasing of rule 2; the literal table above is the default.
EXTENDED_RULES = tuple(
    Rule(
        2,
        phrases=r.phrases + ("completely down", "outage", "nobody can place"),
        set_priority=r.set_priority,
        urgency=r.urgency,
        notify=r.notify,
    )
    if r.rule_id == 2
    else r
    for r in RULES
)

TEAM_KEYWORDS = {
    "Infrastructure": (
        "server", "network", "firewall", "VPN", "backup", "storage", "disk space", "CPU",
        "memory", "database server", "virtual machine", "VM", "ESXi", "vCenter",
        "load balancer", "switch", "router",
    ),
    "Applications": (
        "application slow", "cannot login", "application error", "feature not working",
        "ERP", "CRM", "report not loading", "data incorrect", "integration failed",
        "API error", "timeout", "session expired",
    ),
    "Security": (
        "security", "breach", "phishing", "malware", "ransomware", "suspicious activity",
        "unauthorized access", "hacked", "virus", "data leak", "vulnerability",
        "compliance", "audit", "encryption", "certificate",
    ),
    "End User Support": (
        "password reset", "cannot print", "laptop issue", "screen problem", "keyboard",
        "mouse", "install software", "Outlook issue", "Teams not working",
        "mobile device", "iPhone", "Android", "home office", "remote work",
    ),
    "Identity & Access Management": (
        "new user", "new hire", "access request", "permissions", "role change",
        "termination", "disable account", "MFA", "two-factor", "SSO", "Active Directory",
        "user account", "group membership", "contractor access",
    ),
    "Database": (
        "database slow", "query timeout", "SQL error", "database connection", "deadlock",
        "table lock", "index", "database backup", "restore database", "replication lag",
        "database space",
    ),
    "Cloud": (
        "AWS", "Azure", "GCP", "cloud", "EC2", "S3", "Lambda", "Kubernetes", "Docker",
        "container", "cloud storage", "cloud database", "API gateway", "cloud function",
        "serverless", "IAM role",
    ),
}

# Cues for informational requests, which default to the lowest priority.
INFO_CUES = ("feature request", "question", "nice to have", "suggestion", "documentation")

# Device words turn an End User Support ticket into a Hardware one.
DEVICE_WORDS = (
    "laptop", "desktop", "printer", "print", "keyboard", "mouse", "screen", "monitor",
    "phone", "iphone", "android", "mobile device", "headset", "docking station",
)

CATEGORY_BY_TEAM = {
    "Infrastructure": "Infrastructure",
    "Database": "Infrastructure",
    "Cloud": "Infrastructure",
    "Identity & Access Management": "Service Request",
    "Security": "Security",
    "End User Support": "Software",
    "Applications": "Software",
}

# Who is affected, widest first; any head count of two or more is Multiple Users.
IMPACT_PHRASES = {
    "Organization": ("company-wide", "all users", "everyone", "entire company", "organization"),
    "Department": ("entire department", "whole department", "department"),
    "Multiple Users": ("multiple users", "several users", "many users", "nobody can", "team"),
}
HEADCOUNT_PATTERN = " 0*([2-9]|[1-9][0-9]+) (people|users|employees) "

# --- fixed values: scores, SLA, prices --------------------------------------
SCORE_BANDS = (("P1", 0.9), ("P2", 0.7), ("P3", 0.4))
PRIORITY_SCORE = {"P1": 0.95, "P2": 0.80, "P3": 0.55, "P4": 0.20}
URGENCY_BY_PRIORITY = {"P1": "Critical", "P2": "High", "P3": "Medium", "P4": "Low"}

# priority, urgency (None: any), response minutes, resolution minutes, after hours
SLA_MATRIX = (
    ("P1", "Critical", 15, 240, "Page on-call"),
    ("P1", "High", 15, 360, "Page on-call"),
    ("P2", "Critical", 20, 360, "Email on-call"),
    ("P2", "High", 30, 480, "Email on-call"),
    ("P2", "Medium", 60, 720, "Next day"),
    ("P3", "High", 60, 1440, "Next day"),
    ("P3", "Medium", 120, 2880, "Next day"),
    ("P3", "Low", 240, 4320, "Next day"),
    ("P4", None, 1440, 7200, "Next day"),
)
# Combinations the matrix leaves out use the nearest listed row.
SLA_NEAREST = {
    ("P1", "Medium"): "High",
    ("P1", "Low"): "High",
    ("P2", "Low"): "Medium",
    ("P3", "Critical"): "High",
}
# Minutes before each tier hands over, by priority, and before management is told.
TIER_ESCALATION = {
    "P1": (30, 120, 240),
    "P2": (120, 240, None),
    "P3": (1440, None, None),
    "P4": (4320, None, None),
}
MANAGEMENT_ESCALATION = {"P1": 240, "P2": 720}
LEVEL1_TARGET = 0.80

STAGE_PRICES = {
    "classify": Decimal("0.0004"),
    "extract": Decimal("0.0005"),
    "search": Decimal("0.0001"),
    "generate": Decimal("0.0003"),
}
TOOL_PRICE = Decimal("0.0005")
TOOLS = ("classify_ticket", "extract_metadata", "search_knowledge", "query_historical")
QUICK_CONTEXT = "Quick analysis without full context"
NO_CONTEXT = "No relevant context found."
TIME_STEPS = ((30, "30 minutes"), (60, "1 hour"), (120, "2 hours"), (240, "4 hours"), (1440, "1 day"))

# --- fixed values: extraction -------------------------------------------------
HOST_PATTERN = "[A-Z][A-Z0-9]*(?:-[A-Z0-9]+)*-[0-9]+"
CODE_PATTERN = "ERR_[A-Z0-9_]+|HTTP [1-5][0-9][0-9]|0x[0-9A-Fa-f]+"
SYSTEM_WORDS = (
    "active directory", "backup", "crm", "database", "email", "erp", "file server",
    "firewall", "intranet", "jira", "load balancer", "mail server", "network", "outlook",
    "printer", "salesforce", "sap", "sharepoint", "slack", "sso", "storage", "teams",
    "vpn", "web server", "website", "wifi",
)
TECH_WORDS = (
    "android", "api", "aws", "azure", "certificate", "cpu", "deadlock", "dhcp", "dns",
    "docker", "ec2", "encryption", "esxi", "gcp", "iphone", "java", "kubernetes",
    "lambda", "ldap", "linux", "memory", "mfa", "oracle", "postgresql", "python",
    "replication", "s3", "smtp", "sql", "ssl", "sso", "timeout", "tls", "vcenter",
    "vpn", "windows",
)

# --- fixed values: knowledge base ---------------------------------------------
STOP_WORDS = (
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with",
    "by", "from", "is", "are", "was", "were", "be", "been", "being", "have", "has",
    "had", "do", "does", "did", "will", "would", "should", "could", "may", "might",
    "must", "can", "this", "that", "these", "those", "not", "what", "which", "who",
    "when", "where", "why", "how",
)
# First pattern found in the lower-cased file name decides.
DOC_TYPE_PATTERNS = (
    ("Runbook", ("runbook",)),
    ("Playbook", ("playbook",)),
    ("Policy", ("policy", "policies")),
    ("Rules", ("rules", "classification")),
    ("Guide", ("guide", "troubleshooting")),
    ("Support_Guide", ("support",)),
)
DEFAULT_DOC_TYPE = "Guide"
KB_CATEGORY_PATTERNS = (
    ("Infrastructure", ("infrastructure", "server")),
    ("Applications", ("application", "app")),
    ("Security", ("security",)),
    ("Access_Management", ("access", "user", "identity")),
    ("Classification", ("classification", "ticket")),
    ("Cloud_Resources", ("cloud", "aws", "azure", "ec2")),
    ("Email_Systems", ("email", "mail")),
    ("Database_Administration", ("database", "db", "sql")),
    ("Network_Troubleshooting", ("network", "vpn", "dns")),
)
DEFAULT_KB_CATEGORY = "General"
MIN_SECTION = 100
MIN_CHUNK = 800
MAX_CHUNK = 1500
