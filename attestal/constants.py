"""Value domains shared by every operator.

Everything under a "fixed values" heading is part of the data contract: the
messages exchanged with other systems carry exactly these strings.
"""

from __future__ import annotations

# --- fixed values: provider expiry status -----------------------------------
EXPIRY_EXPIRED = "EXPIRY_STATUS_EXPIRED"
EXPIRY_EXPIRING = "EXPIRY_STATUS_EXPIRING_SOON"
EXPIRY_VALID = "EXPIRY_STATUS_VALID"
EXPIRY_UNKNOWN = "EXPIRY_STATUS_UNKNOWN"

# --- fixed values: document approval ----------------------------------------
APPROVAL_APPROVED = "DOCUMENT_APPROVAL_STATUS_APPROVED"
APPROVAL_PENDING = "DOCUMENT_APPROVAL_STATUS_PENDING"
APPROVAL_UNKNOWN = "DOCUMENT_APPROVAL_STATUS_UNKNOWN"

# --- fixed values: compliance status ----------------------------------------
COMPLIANT = "COMPLIANT"
EXPIRED = "EXPIRED"
EXPIRING = "EXPIRING"
NOT_APPROVED = "NOT_APPROVED"
MISSING = "MISSING"
NOT_STARTED = "NOT_STARTED"
UNEXPECTED = "UNEXPECTED"

NOTIFIABLE = (EXPIRED, EXPIRING, MISSING, NOT_APPROVED)

# --- fixed values: flags -----------------------------------------------------
FLAG_BY_STATUS = {
    UNEXPECTED: "NOT_IN_REQUIRED_LIST",
    NOT_APPROVED: "APPROVAL_PENDING",
    NOT_STARTED: "NOT_YET_STARTED",
    EXPIRED: "WWCC_EXPIRED",
    EXPIRING: "EXPIRING_WITHIN_30_DAYS",
}
FLAG_NO_NUMBER = "NO_CREDENTIAL_NUMBER"
MISSING_FLAGS = ("NO_CREDENTIAL_FOUND", "MISSING_REQUIRED_WWCC")

# --- fixed values: notification routing -------------------------------------
PRIORITY_HIGH = "HIGH"
PRIORITY_MEDIUM = "MEDIUM"
DIGEST_ISSUE = "DIGEST"
DIGEST_USER = "system"
ALERT_TEMPLATE = "wwcc-individual-alert.html"
DIGEST_TEMPLATE = "manager-digest.html"
DOCUMENT_TYPE_WORD = "children"
ALERT_SUBJECT = "WWCC Compliance Alert: "
DIGEST_SUBJECT = "Weekly WWCC Compliance Digest - "

# --- fixed values: state lifetimes in seconds -------------------------------
CREDENTIAL_TTL_S = 7 * 86400
STATUS_TTL_S = 86400
MISSING_TTL_S = 86400
COOLDOWN_TTL_S = 30 * 86400
COMMAND_TTL_S = 86400

# --- fixed values: topic names (overridable wherever a topic is opened) -----
TOPIC_REQUIRED = "reference.wwcc.required"
TOPIC_STATUS = "processed.wwcc.status"
TOPIC_ISSUES = "events.compliance.issues"
TOPIC_COMMANDS = "commands.notifications"
TOPIC_SENT = "events.notifications.sent"

# --- fixed values: alert wording per issue type -----------------------------
# issue type -> (message, action required, status background, status text)
ISSUE_TEXT = {
    EXPIRED: (
        "Your Working With Children Check (WWCC) has expired. You must renew your WWCC "
        "immediately to continue working in child-related roles.",
        "Please apply for a new WWCC through Service NSW as soon as possible and upload "
        "your new clearance to SafetyCulture once approved.",
        "#dc3545",
        "#ffffff",
    ),
    EXPIRING: (
        "Your Working With Children Check (WWCC) will expire soon. Please renew before the "
        "expiry date to maintain compliance.",
        "Apply for renewal through Service NSW and upload your new clearance to "
        "SafetyCulture once approved.",
        "#fd7e14",
        "#ffffff",
    ),
    MISSING: (
        "Our records indicate that you require a Working With Children Check (WWCC) for "
        "your role, but we don't have one on file.",
        "Please upload your current WWCC clearance to SafetyCulture. If you don't have a "
        "WWCC, apply through Service NSW immediately.",
        "#dc3545",
        "#ffffff",
    ),
    NOT_APPROVED: (
        "Your WWCC document has been uploaded but is pending approval in our system.",
        "No action required from you at this time. HR will review and approve your "
        "document shortly.",
        "#ffc107",
        "#212529",
    ),
}
ISSUE_TEXT_DEFAULT = (
    "There is an issue with your WWCC compliance status that requires attention.",
    "Please contact HR for more information.",
    "#6c757d",
    "#ffffff",
)

# --- fixed values: colour of the days-until-expiry figure -------------------
# (exclusive upper bound in days, colour), tested in order
DAYS_COLOURS = ((0, "#dc3545"), (14, "#fd7e14"), (30, "#ffc107"))
DAYS_COLOUR_DEFAULT = "#28a745"

# --- fixed values: plain-text alert -----------------------------------------
BODY_INTRO = "This is an automated notification regarding your WWCC compliance status."
BODY_ACTION = "Please take appropriate action to ensure compliance."
BODY_FOOTER = "This is an automated message. Please do not reply."

# --- fixed values: lag thresholds in records --------------------------------
LAG_WARN = 10
LAG_FAIL = 100

UNKNOWN_DEPARTMENT = "Unknown"
WEEKDAYS = ("MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY")
