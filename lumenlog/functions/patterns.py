"""Extraction patterns and rule constants.

These must equal the behaviour being reproduced, so they are stated plainly
and kept together.  Java regex syntax (Spark); the same text is valid RE2.
"""

# --- fixed values: field extraction from the free-text message -------------
INCIDENT_ID_PATTERN = r"(INC-\w+)"
SERVICE_PATTERN = r"Service: (\S+?)(?:[.,]|$)"
CATEGORY_PATTERN = r"Category: ([\w\s]+?)(?:[.,]|$)"

# --- fixed values: alert rule and windows ------------------------------------
ALERT_LEVEL = "ERROR"
ALERT_MIN_COUNT = 3
ALERT_WINDOW = "5 minutes"
WATERMARK_DELAY = "10 seconds"
CORRELATION_HALF_WIDTH_MINUTES = 30

# --- fixed values: wire frame -----------------------------------------------
FRAME_MAGIC_HEX = "00"      # first byte of a framed value
FRAME_HEADER_BYTES = 5      # magic byte + 4-byte big-endian schema id

# --- legacy columns recovered from message text ------------------------------
AFFECTED_USERS_PATTERN = r"Affected users: (\d+)"
DURATION_PATTERN = r"(?:Duration|Recovery time): (\d+) minutes"
SYSTEM_ID_PATTERN = r"(SYS-\d+)"

# --- remaining template fields (opt-in extension) ----------------------------
TEMPLATE_FIELD_PATTERNS = {
    "severity": r"Severity: (\w+)",
    "assignee": r"Assigned to: (\S+?)(?:[.,]?\s|[.,]?$)",
    "resolver": r"Resolved by: (\S+?)(?:[.,]?\s|[.,]?$)",
    "escalation_team": r"Escalated to: (\S+?)(?:[.,]?\s|[.,]?$)",
    "attack_type": r"Attack type: ([^.,]+)",
    "source_ip": r"Source IP: (\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})",
    "database": r"Database: (\w+)",
    "affected_records": r"Records affected: (\d+)",
    "impact_pct": r"increased by (\d+)%",
    "cpu_pct": r"CPU: (\d+)%",
    "memory_pct": r"Memory: (\d+)%",
    "disk_pct": r"Disk: (\d+)%",
    "service_lenient": r"Service: ([\w-]+)",
}
# Fields of TEMPLATE_FIELD_PATTERNS that are whole numbers.
TEMPLATE_INT_FIELDS = ("affected_records", "impact_pct", "cpu_pct", "memory_pct", "disk_pct")
