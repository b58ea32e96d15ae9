"""The registered queries in SQL, written independently of the operators.

Ordered keyed state is a recursive walk over the numbered rows of each key.
"""

from __future__ import annotations

# --- shared table expressions --------------------------------------------------

REQ = """req AS (
  SELECT 'u'||c_custkey||'@example.org' AS email, split_part(c_name,'#',1) AS "firstName",
         split_part(c_name,'#',2) AS "lastName", c_mktsegment AS department, 'P'||c_nationkey AS position,
         c_nationkey <> 3 AS "requiresWwcc",
         strftime(DATE '1995-01-01' + (c_custkey % 2200)::INT, '%Y-%m-%d') AS "startDate"
  FROM customer)"""

CRED = """cred AS (
  SELECT o_custkey::VARCHAR AS "userId", o_orderkey::VARCHAR AS "documentId", o_orderkey||'-1' AS "versionId",
         '  CUSTOMER ' AS "firstName",
         lpad(o_custkey::VARCHAR, 9, '0')||CASE WHEN o_totalprice > 400000 THEN 'X' ELSE ' ' END AS "lastName",
         CASE WHEN o_orderpriority='1-URGENT' AND o_orderstatus='F' THEN 'Working With Children Check'
              WHEN o_orderpriority='2-HIGH' AND o_orderstatus='P' THEN 'Children''s Services Credential'
              WHEN o_orderpriority='5-LOW' THEN 'First Aid Certificate' ELSE 'Driver License' END AS "typeName",
         CASE WHEN o_totalprice < 20000 THEN NULL
              WHEN o_totalprice < 40000 THEN year(o_orderdate)||'-02-30'
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "expiryDate",
         CASE WHEN o_totalprice >= 40000 THEN date_diff('day', DATE '1998-07-01', o_orderdate::DATE) END AS "daysUntilExpiry",
         CASE WHEN o_totalprice >= 60000 THEN 'WWC'||o_orderkey END AS "wwccNumber",
         CASE WHEN o_orderdate < DATE '1998-07-01' THEN 'EXPIRY_STATUS_EXPIRED'
              WHEN o_orderdate < DATE '1998-07-31' THEN 'EXPIRY_STATUS_EXPIRING_SOON'
              ELSE 'EXPIRY_STATUS_VALID' END AS "expiryStatus",
         CASE WHEN o_orderstatus='P' AND o_totalprice < 250000 THEN 'DOCUMENT_APPROVAL_STATUS_PENDING'
              ELSE 'DOCUMENT_APPROVAL_STATUS_APPROVED' END AS "approvalStatus"
  FROM orders)"""

CHECKS = """checks AS (SELECT * FROM cred WHERE lower("typeName") LIKE '%children%')"""


def _matched(source: str) -> str:
    return f"""matched AS (
  SELECT c.*, p.email, p.department, p.position, p."startDate", p.email IS NOT NULL AS matched
  FROM {source} c LEFT JOIN (
    SELECT *, row_number() OVER (PARTITION BY lower(trim("firstName")), lower(trim("lastName")) ORDER BY email) AS rn
    FROM req) p
  ON p.rn = 1 AND lower(trim(p."firstName")) = lower(trim(c."firstName"))
     AND lower(trim(p."lastName")) = lower(trim(c."lastName")))"""


JUDGED = """judged AS (
  SELECT *, date_diff('day', "startDate"::DATE, DATE '1998-07-01') AS "daysSinceStart",
         CASE WHEN NOT matched THEN 'UNEXPECTED'
              WHEN "approvalStatus" <> 'DOCUMENT_APPROVAL_STATUS_APPROVED' THEN 'NOT_APPROVED'
              WHEN "startDate"::DATE > DATE '1998-07-01' THEN 'NOT_STARTED'
              WHEN "expiryStatus" = 'EXPIRY_STATUS_EXPIRED' THEN 'EXPIRED'
              WHEN "expiryStatus" = 'EXPIRY_STATUS_EXPIRING_SOON' THEN 'EXPIRING'
              ELSE 'COMPLIANT' END AS status
  FROM matched)"""

_FLAGS = """concat_ws(',', CASE {status} WHEN 'UNEXPECTED' THEN 'NOT_IN_REQUIRED_LIST' WHEN 'NOT_APPROVED' THEN 'APPROVAL_PENDING'
   WHEN 'NOT_STARTED' THEN 'NOT_YET_STARTED' WHEN 'EXPIRED' THEN 'WWCC_EXPIRED'
   WHEN 'EXPIRING' THEN 'EXPIRING_WITHIN_30_DAYS' END, CASE WHEN {number} IS NULL THEN 'NO_CREDENTIAL_NUMBER' END)"""

_JUDGED_FLAGS = _FLAGS.format(status="status", number='"wwccNumber"')

FOUND = f"""found AS (
  SELECT "userId", "firstName", "lastName", email, department, position, "startDate", "wwccNumber", "expiryDate",
         "daysUntilExpiry", "daysSinceStart", "expiryStatus" AS safetyculture_status,
         "approvalStatus" AS approval_status, status AS compliance_status, {_JUDGED_FLAGS} AS flags,
         '1998-07-01T00:00:00Z' AS "processedAt"
  FROM judged)"""

ABSENT = """absent AS (
  SELECT substr(md5(email), 1, 16) AS "userId", "firstName", "lastName", email, department, position, "startDate",
         NULL::VARCHAR AS "wwccNumber", NULL::VARCHAR AS "expiryDate", NULL::BIGINT AS "daysUntilExpiry",
         date_diff('day', "startDate"::DATE, DATE '1998-07-01') AS "daysSinceStart",
         'EXPIRY_STATUS_UNKNOWN' AS safetyculture_status, 'DOCUMENT_APPROVAL_STATUS_UNKNOWN' AS approval_status,
         'MISSING' AS compliance_status, 'NO_CREDENTIAL_FOUND,MISSING_REQUIRED_WWCC' AS flags,
         '1998-07-01T00:00:00Z' AS "processedAt"
  FROM req WHERE "requiresWwcc" AND NOT EXISTS (
    SELECT 1 FROM checks c WHERE lower(trim(c."firstName")) = lower(trim(req."firstName"))
      AND lower(trim(c."lastName")) = lower(trim(req."lastName"))))"""

STATUSES = "statuses AS (SELECT * FROM found UNION ALL SELECT * FROM absent)"


def _with(*parts: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"


_JUDGE = _with(REQ, CRED, CHECKS, _matched("checks"), JUDGED)
_ALL = _with(REQ, CRED, CHECKS, _matched("checks"), JUDGED, FOUND, ABSENT, STATUSES)

# Status rows of events.
EV = """ev AS (
  SELECT user_id::VARCHAR AS "userId", 'User' AS "firstName", lpad(user_id::VARCHAR, 4, '0') AS "lastName",
         CASE WHEN user_id % 11 <> 0 THEN 'u'||user_id||'@example.org' END AS email,
         CASE WHEN user_id % 7 <> 0 THEN c_mktsegment END AS department, 'P'||c_nationkey AS position,
         '2023-06-01' AS "startDate",
         CASE WHEN event_type <> 'signup' AND user_id % 5 <> 0 THEN 'W'||user_id END AS "wwccNumber",
         CASE WHEN event_type <> 'signup'
              THEN strftime(DATE '2024-02-01' + (floor(value)::INT - 30), '%Y-%m-%d') END AS "expiryDate",
         CASE WHEN event_type <> 'signup' THEN floor(value)::BIGINT - 30 END AS "daysUntilExpiry",
         245::BIGINT AS "daysSinceStart",
         CASE event_type WHEN 'error' THEN 'EXPIRY_STATUS_EXPIRED' WHEN 'view' THEN 'EXPIRY_STATUS_EXPIRING_SOON'
              WHEN 'signup' THEN 'EXPIRY_STATUS_UNKNOWN' ELSE 'EXPIRY_STATUS_VALID' END AS safetyculture_status,
         CASE event_type WHEN 'click' THEN 'DOCUMENT_APPROVAL_STATUS_PENDING'
              WHEN 'signup' THEN 'DOCUMENT_APPROVAL_STATUS_UNKNOWN'
              ELSE 'DOCUMENT_APPROVAL_STATUS_APPROVED' END AS approval_status,
         CASE event_type WHEN 'error' THEN 'EXPIRED' WHEN 'view' THEN 'EXPIRING' WHEN 'click' THEN 'NOT_APPROVED'
              WHEN 'signup' THEN 'MISSING' WHEN 'purchase' THEN 'COMPLIANT' END AS compliance_status,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS "processedAt", event_id, ts, epoch_us(ts) AS ts_us, event_type, user_id
  FROM events LEFT JOIN customer ON c_custkey = user_id)"""
_EV = _with(EV)
_NOTIFY = "compliance_status IN ('EXPIRED','EXPIRING','MISSING','NOT_APPROVED')"
_PRIORITY = "CASE WHEN {0} IN ('EXPIRED','MISSING') THEN 'HIGH' ELSE 'MEDIUM' END"
_MANAGER = """CASE department WHEN 'AUTOMOBILE' THEN 'auto.lead@example.org' WHEN 'BUILDING' THEN 'site.lead@example.org'
   WHEN 'FURNITURE' THEN 'site.lead@example.org' ELSE 'hr@example.org' END"""
_HOURS = """CASE WHEN "daysUntilExpiry" > 365 THEN 2160 WHEN "daysUntilExpiry" >= 120 THEN 600
   WHEN "daysUntilExpiry" < -45 THEN 96 WHEN "daysUntilExpiry" <= 5 THEN 18 WHEN "daysUntilExpiry" < 45 THEN 120 ELSE 480 END"""

LATEST = """latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "userId" ORDER BY ts DESC, event_id DESC) AS rn FROM ev)
  WHERE rn = 1)"""


def _id(*parts: str) -> str:
    return "md5(to_json([" + ", ".join(f"({p})::VARCHAR" for p in parts) + "])::VARCHAR)"


_ALERT = f"""SELECT {_id('"userId"', "compliance_status", '"processedAt"')} AS "notificationId", "userId",
  "firstName"||' '||"lastName" AS "userName", coalesce(email, '') AS "to", 'compliance@example.org' AS cc,
  'WWCC Compliance Alert: '||compliance_status||' - '||"firstName"||' '||"lastName" AS subject,
  compliance_status AS "issueType", {_PRIORITY.format("compliance_status")} AS priority,
  'wwcc-individual-alert.html' AS template, true AS "isHtml", "wwccNumber", "expiryDate", "daysUntilExpiry",
  "processedAt" AS "createdAt" """

LOG = """log AS (
  SELECT event_type AS topic, (user_id % 3)::INT AS partition, user_id::VARCHAR AS key,
         to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type, 'props': props})::VARCHAR AS value,
         ts, event_id,
         row_number() OVER (PARTITION BY event_type, user_id % 3 ORDER BY ts, event_id) - 1 AS "offset"
  FROM events)"""

POLLS = """polls AS (
  SELECT event_id, user_id, event_type, ts, epoch_us(ts) AS t,
         md5(to_json({'bucket': floor(value/100)::BIGINT::VARCHAR})::VARCHAR) AS fingerprint FROM events)"""


def _walk(base: str, key: str, wait: str, strict: bool, columns: str) -> str:
    """Rows kept by the greedy rule: compare with the last kept row of the key."""
    later = f"n.t {'>' if strict else '>='} w.last + n.wait"
    return (
        _with(
            f"base AS ({base})",
            f"""numbered AS (SELECT *, {key} AS k, {wait} AS wait,
               row_number() OVER (PARTITION BY {key} ORDER BY t, event_id) AS rn FROM base)""",
            f"""walk AS (
               SELECT k, rn, event_id, t AS last, true AS kept FROM numbered WHERE rn = 1
               UNION ALL
               SELECT n.k, n.rn, n.event_id, CASE WHEN {later} THEN n.t ELSE w.last END, {later}
               FROM walk w JOIN numbered n ON n.k = w.k AND n.rn = w.rn + 1)""",
            recursive=True,
        )
        + f"SELECT {columns} FROM base JOIN walk USING (event_id) WHERE kept"
    )


_HOUR_US = "3600000000"
_DAY_US = "86400000000"

_COMMAND_BASE = "SELECT user_id||'-'||event_type AS \"notificationId\", event_id, epoch_us(ts) AS t FROM events"
_COOL_BASE = (
    _EV
    + f'SELECT event_id, "userId", compliance_status, "daysUntilExpiry", ts_us AS t FROM ev WHERE {_NOTIFY}'
)
_COOL_WAIT = f"least(({_HOURS}) * {_HOUR_US}, 30 * {_DAY_US} - 1)"

_SUMMARY = """SELECT coalesce(department, 'Unknown') AS department, count(*) AS "totalCount",
  count(*) FILTER (compliance_status='EXPIRED') AS "expiredCount",
  count(*) FILTER (compliance_status='EXPIRING') AS "expiringCount",
  count(*) FILTER (compliance_status='MISSING') AS "missingCount",
  count(*) FILTER (compliance_status='NOT_APPROVED') AS "notApprovedCount"
  FROM {source} WHERE compliance_status <> 'COMPLIANT' GROUP BY 1"""


def _digest(source: str) -> str:
    return f"""SELECT manager, min(department) AS department, count(*) AS "departmentCount",
  sum("totalCount")::BIGINT AS "totalIssues", sum("expiredCount")::BIGINT AS "totalExpired",
  sum("expiringCount")::BIGINT AS "totalExpiring", sum("missingCount")::BIGINT AS "totalMissing",
  sum("notApprovedCount")::BIGINT AS "totalNotApproved",
  split_part(manager, '@', 1) AS "managerName", '2024-02-01' AS "summaryDate",
  CASE WHEN sum("expiredCount") > 0 THEN 'HIGH' ELSE 'MEDIUM' END AS priority
  FROM (SELECT *, {_MANAGER} AS manager FROM ({_SUMMARY.format(source=source)})) GROUP BY manager"""


_RULES = """hits AS (
  SELECT s.*, r.* FROM statuses s JOIN (VALUES
    ('long-lapsed','LOW','LONG_LAPSED',false,false,true),
    ('ten-days-left','HIGH','LAST_DAYS',true,false,true),
    ('plan-renewal','LOW','PLAN_RENEWAL',true,false,false),
    ('settled-in','HIGH','STILL_MISSING',false,true,false),
    ('unnumbered-lapse','MEDIUM','LAPSED_UNNUMBERED',false,true,true),
    ('odd-one-out','LOW','LIST_MISMATCH',false,false,true),
    ('waiting-newcomer','MEDIUM','APPROVAL_WAITS',true,true,false)
  ) r("ruleId","rulePriority","ruleIssueType",e,m,c) ON CASE "ruleId"
    WHEN 'long-lapsed' THEN compliance_status IN ('EXPIRED', 'NOT_APPROVED') AND "daysUntilExpiry" < -180
    WHEN 'ten-days-left' THEN compliance_status='EXPIRING' AND "daysUntilExpiry" < 11
    WHEN 'plan-renewal' THEN compliance_status IN ('EXPIRING', 'COMPLIANT') AND "daysUntilExpiry" < 75
    WHEN 'settled-in' THEN compliance_status='MISSING' AND "daysSinceStart" > 21
    WHEN 'unnumbered-lapse' THEN flags LIKE '%WWCC_EXPIRED%' AND flags LIKE '%NO_CREDENTIAL_NUMBER%'
    WHEN 'odd-one-out' THEN flags LIKE '%NOT_IN_REQUIRED_LIST%' OR flags LIKE '%NOT_YET_STARTED%'
    WHEN 'waiting-newcomer' THEN compliance_status='NOT_APPROVED' AND flags LIKE '%APPROVAL_PENDING%' AND "daysSinceStart" > 0
  END)"""

_MESSAGE = """CASE compliance_status
  WHEN 'EXPIRED' THEN 'Your Working With Children Check (WWCC) has expired. You must renew your WWCC immediately to continue working in child-related roles.'
  WHEN 'EXPIRING' THEN 'Your Working With Children Check (WWCC) will expire soon. Please renew before the expiry date to maintain compliance.'
  WHEN 'MISSING' THEN 'Our records indicate that you require a Working With Children Check (WWCC) for your role, but we don''t have one on file.'
  WHEN 'NOT_APPROVED' THEN 'Your WWCC document has been uploaded but is pending approval in our system.'
  ELSE 'There is an issue with your WWCC compliance status that requires attention.' END"""
_ACTION = """CASE compliance_status
  WHEN 'EXPIRED' THEN 'Please apply for a new WWCC through Service NSW as soon as possible and upload your new clearance to SafetyCulture once approved.'
  WHEN 'EXPIRING' THEN 'Apply for renewal through Service NSW and upload your new clearance to SafetyCulture once approved.'
  WHEN 'MISSING' THEN 'Please upload your current WWCC clearance to SafetyCulture. If you don''t have a WWCC, apply through Service NSW immediately.'
  WHEN 'NOT_APPROVED' THEN 'No action required from you at this time. HR will review and approve your document shortly.'
  ELSE 'Please contact HR for more information.' END"""
_BACK = """CASE compliance_status WHEN 'EXPIRED' THEN '#dc3545' WHEN 'EXPIRING' THEN '#fd7e14'
  WHEN 'MISSING' THEN '#dc3545' WHEN 'NOT_APPROVED' THEN '#ffc107' ELSE '#6c757d' END"""
_FORE = "CASE compliance_status WHEN 'NOT_APPROVED' THEN '#212529' ELSE '#ffffff' END"
_DAYS_COLOUR = """CASE WHEN "daysUntilExpiry" < 0 THEN '#dc3545' WHEN "daysUntilExpiry" < 14 THEN '#fd7e14'
  WHEN "daysUntilExpiry" < 30 THEN '#ffc107' ELSE '#28a745' END"""

_BODY = f"""'Dear '||"firstName"||' '||"lastName"||','||chr(10)||chr(10)
  ||'This is an automated notification regarding your WWCC compliance status.'||chr(10)||chr(10)
  ||'Issue Type: '||compliance_status||chr(10)||'Priority: '||{_PRIORITY.format("compliance_status")}||chr(10)||chr(10)
  ||'WWCC Number: '||coalesce("wwccNumber", 'Not provided')||chr(10)
  ||'Expiry Date: '||coalesce("expiryDate", 'Not provided')||chr(10)
  ||coalesce('Days until expiry: '||"daysUntilExpiry", '')||chr(10)||chr(10)
  ||'Please take appropriate action to ensure compliance.'||chr(10)||chr(10)
  ||'This is an automated message. Please do not reply.'"""


def _esc(expr: str) -> str:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#39;"), ("`", "&#96;"), ("=", "&#61;")):
        expr = f"replace({expr}, '{raw}', '{safe}')"
    return expr


def _banner() -> str:
    words = {
        "EXPIRED": "EXPIRED - Immediate Action Required",
        "EXPIRING": "EXPIRING SOON - Action Required",
        "MISSING": "MISSING - No WWCC On File",
        "NOT_APPROVED": "PENDING APPROVAL",
    }
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in words.items())
    strip = f"""'<div class="banner" style="background: '||{_BACK}||'; color: '||{_FORE}||'">'||CASE compliance_status {cases} END||'</div>'"""
    return f"coalesce({strip}, '')"


_HTML = f"""'<!DOCTYPE html><html><head><meta charset="UTF-8"></head><body><h1>WWCC Compliance Alert</h1><p>Example Council</p>'
  ||{_banner()}||'<p>Dear '||{_esc('''"firstName"||' '||"lastName"''')}||',</p><p>'||{_esc(_MESSAGE)}||'</p><table>'
  ||coalesce('<tr><th>WWCC Number:</th><td>'||{_esc('"wwccNumber"')}||'</td></tr>', '')
  ||coalesce('<tr><th>Expiry Date:</th><td>'||{_esc('"expiryDate"')}||'</td></tr>', '')
  ||coalesce('<tr><th>Days Until Expiry:</th><td style="color: '||{_DAYS_COLOUR}||'">'||"daysUntilExpiry"||'</td></tr>', '')
  ||'<tr><th>Status:</th><td><span style="background: '||{_BACK}||'; color: '||{_FORE}||'">'||compliance_status
  ||'</span></td></tr></table><h4>What You Need To Do</h4><p>'||{_esc(_ACTION)}
  ||'</p><footer>Sent: '||{_esc('"processedAt"')}||'</footer></body></html>'"""

_DUE = """due AS (
  SELECT event_id, ts + INTERVAL 11 HOUR AS local_ts FROM events
  WHERE isodow(ts + INTERVAL 11 HOUR) = 1
    AND (ts + INTERVAL 11 HOUR)::TIME BETWEEN TIME '08:58:00' AND TIME '09:03:00')"""

_EVENT_JSON = "to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type, 'props': props})::VARCHAR"

_LINES = """lines AS (
  SELECT event_id, event_type, floor(value)::BIGINT AS n, floor(value)::BIGINT % 4 AS k FROM events)"""

_STATUS_JSON = """to_json({'userId': "userId", 'firstName': "firstName", 'lastName': "lastName", 'email': email,
  'department': department, 'position': position, 'startDate': "startDate", 'wwccNumber': "wwccNumber",
  'expiryDate': "expiryDate", 'daysUntilExpiry': "daysUntilExpiry", 'daysSinceStart': "daysSinceStart",
  'safetyculture_status': safetyculture_status, 'approval_status': approval_status,
  'compliance_status': compliance_status,
  'flags': CASE WHEN compliance_status = 'MISSING' THEN ['NO_CREDENTIAL_FOUND','MISSING_REQUIRED_WWCC'] ELSE
     list_filter([CASE compliance_status WHEN 'NOT_APPROVED' THEN 'APPROVAL_PENDING' WHEN 'EXPIRED' THEN 'WWCC_EXPIRED'
       WHEN 'EXPIRING' THEN 'EXPIRING_WITHIN_30_DAYS' END, CASE WHEN "wwccNumber" IS NULL THEN 'NO_CREDENTIAL_NUMBER' END],
       lambda x: x IS NOT NULL) END,
  'processedAt': "processedAt"})::VARCHAR"""

_PAGES = """paged AS (
  SELECT *, 1 + ('0x'||substr(md5("userId"), 1, 8))::BIGINT % pages AS page FROM (
    SELECT * REPLACE (coalesce(department, 'Unknown') AS department),
      ceil(count(*) OVER (PARTITION BY coalesce(department, 'Unknown')) / {size})::BIGINT AS pages
    FROM latest WHERE compliance_status <> 'COMPLIANT'))"""


# Digest sections: issues of one manager, page and department.
_S = "CASE WHEN {} = 1 THEN '' ELSE 's' END"
_ISSUE_ROW = f"""'<tr><td><strong>'||"firstName"||' '||"lastName"||'</strong><br><small>'||position||'</small></td><td>'
  ||'<span style="background: '||{_BACK}||'; color: '||{_FORE}||'">'||compliance_status||'</span></td><td>'
  ||coalesce("wwccNumber", '—')||'</td><td>'||coalesce("expiryDate", '—')
  ||'</td><td style="color: '||{_DAYS_COLOUR}||'">'||coalesce("daysUntilExpiry"::VARCHAR, '—')||'</td></tr>'"""
_DIGEST_PAGES = f"""issue_rows AS (
  SELECT *, coalesce(department, 'Unknown') AS dept, {_MANAGER} AS manager FROM latest WHERE compliance_status <> 'COMPLIANT'),
paged AS (
  SELECT *, 1 + ('0x'||substr(md5("userId"), 1, 8))::BIGINT % pages AS page FROM (
    SELECT *, ceil(count(*) OVER (PARTITION BY manager) / 500)::BIGINT AS pages FROM issue_rows)),
whole AS (
  SELECT dept, count(*) AS n, count(*) FILTER (compliance_status='EXPIRED') AS expired,
    count(*) FILTER (compliance_status='EXPIRING') AS expiring, count(*) FILTER (compliance_status='MISSING') AS missing,
    count(*) FILTER (compliance_status='NOT_APPROVED') AS not_approved FROM issue_rows GROUP BY dept),
sections AS (
  SELECT manager, page, any_value(pages) AS pages, dept AS department,
    '<section><h3>'||dept||'</h3><p>'||any_value(n)||' Issue'||{_S.format("any_value(n)")}||' • '||concat_ws(' • ',
      nullif(any_value(expired), 0)||' Expired', nullif(any_value(expiring), 0)||' Expiring',
      nullif(any_value(missing), 0)||' Missing', nullif(any_value(not_approved), 0)||' Not Approved')
    ||'</p><table><tr><th>Name</th><th>Status</th><th>WWCC Number</th><th>Expiry</th><th>Days</th></tr>'
    ||string_agg({_ISSUE_ROW}, '' ORDER BY "firstName"||' '||"lastName", "userId")||'</table></section>' AS section
  FROM paged JOIN whole USING (dept) GROUP BY manager, page, dept)"""

ORACLE: dict[str, str] = {}

# --- sources, decoding, sinks ---------------------------------------------------

ORACLE["snapshot_explode"] = _with(CRED) + """
SELECT "userId", "documentId", "documentId"||'-'||v AS "versionId", "firstName", "lastName", "typeName",
  "expiryDate" AS expiry, "wwccNumber", "expiryStatus", "approvalStatus", '1998-07-01T00:00:00Z' AS "polledAt"
FROM cred CROSS JOIN (VALUES (1), (2)) t(v) WHERE lower("typeName") LIKE '%children%'"""

ORACLE["topic_scan"] = _with(LOG) + 'SELECT topic, partition, "offset", key, value FROM log'
ORACLE["topic_read_on"] = _with(LOG) + """SELECT topic, partition, "offset", key, value FROM log WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'"""
ORACLE["topic_end_offsets"] = "SELECT event_type AS topic, (user_id % 3)::INT AS partition, count(*) AS end_offset FROM events GROUP BY 1, 2"
ORACLE["decode_valid"] = "SELECT event_id, user_id, event_type, props FROM events WHERE value >= 4"
ORACLE["decode_quarantine"] = f"""
SELECT CASE WHEN value < 2 THEN substr({_EVENT_JSON}, 1, length({_EVENT_JSON}) - 3)
  ELSE to_json({{'event_id': event_id, 'user_id': user_id, 'props': props}})::VARCHAR END AS value
FROM events WHERE value < 4"""
ORACLE["reference_latest"] = _with(REQ) + """
SELECT 2::BIGINT AS list_version, CASE WHEN position = 'P5' THEN 'new.'||email ELSE email END AS email,
  "firstName", "lastName", department, position, "requiresWwcc", "startDate" FROM req"""
ORACLE["directory_scan"] = """
SELECT md5(c_custkey::VARCHAR) AS uuid, 'u'||c_custkey||'@example.org' AS email,
  split_part(c_name,'#',1) AS first_name, split_part(c_name,'#',2) AS last_name FROM customer"""
ORACLE["config_lookup"] = _EV + f"""
SELECT compliance_status AS "issueType", {_PRIORITY.format("compliance_status")} AS priority,
  'wwcc-individual-alert.html' AS template, count(*) AS records FROM ev GROUP BY 1, 2, 3"""
ORACLE["keyed_json_sink"] = _EV + f'SELECT "userId" AS key, {_STATUS_JSON} AS value FROM ev'
ORACLE["delivery_events"] = _EV + f"""
SELECT {_id('"userId"', "compliance_status", '"processedAt"')} AS "notificationId", "userId",
  coalesce(email, '') AS email, compliance_status AS "issueType", "processedAt" AS "sentAt",
  email IS NOT NULL AS success, CASE WHEN email IS NULL THEN 'no recipient' END AS "errorMessage" FROM ev"""

ORACLE["failed_deliveries"] = _EV + f"""
SELECT {_id('"userId"', "compliance_status", '"processedAt"')} AS "notificationId", "userId", compliance_status AS "issueType"
FROM ev WHERE email IS NULL"""

# --- filters -----------------------------------------------------------------------

ORACLE["filter_doc_type"] = _with(CRED, CHECKS) + 'SELECT "userId", "documentId", "typeName" FROM checks'
ORACLE["filter_notify_status"] = _EV + f'SELECT event_id, "userId", compliance_status FROM ev WHERE {_NOTIFY}'
ORACLE["frequency_condition"] = _EV + """
SELECT event_id, "daysUntilExpiry", true AS is_always, coalesce("daysUntilExpiry" < 0, false) AS lt_0,
  coalesce("daysUntilExpiry" <= 7, false) AS le_7, coalesce("daysUntilExpiry" > 30, false) AS gt_30,
  coalesce("daysUntilExpiry" >= 60, false) AS ge_60, false AS unknown_op, false AS bad_bound, false AS other_field
FROM ev"""
ORACLE["digest_due"] = _with(_DUE) + "SELECT event_id, strftime(local_ts, '%Y-%m-%d %H:%M:%S.%f') AS local_ts FROM due"
ORACLE["digest_once_per_day"] = _with(_DUE) + """
SELECT strftime(local_ts, '%Y-%m-%d') AS local_date, arg_min(event_id, local_ts) AS event_id FROM due GROUP BY 1"""
_LOGS = """logs AS (
  SELECT event_id, ts, CASE user_id % 4 WHEN 0 THEN 'poller' WHEN 1 THEN 'transformer' WHEN 2 THEN 'router' ELSE 'sender' END AS container,
  CASE event_type WHEN 'error' THEN '[ERROR]' WHEN 'signup' THEN '[WARN]' ELSE '[INFO]' END||' '||event_type||' of '||user_id AS line
  FROM events)"""
ORACLE["log_errors"] = _with(_LOGS) + """
SELECT event_id, container, line FROM logs
WHERE container <> 'sender' AND (line LIKE '%ERROR%' OR line LIKE '%WARN%')"""

# --- projections -------------------------------------------------------------------

ORACLE["expiry_text"] = _with(CRED) + 'SELECT "documentId", "expiryDate" FROM cred'
ORACLE["days_until_expiry"] = _with(CRED) + 'SELECT "documentId", "daysUntilExpiry" AS days FROM cred'
ORACLE["days_since_start"] = _with(REQ) + """
SELECT email, date_diff('day', "startDate"::DATE, DATE '1998-07-01') AS days FROM req"""
ORACLE["compliance_status"] = _JUDGE + 'SELECT "documentId", status FROM judged'
ORACLE["compliance_flags"] = _JUDGE + f'SELECT "documentId", {_JUDGED_FLAGS} AS flags FROM judged'
ORACLE["content_hash"] = _with(CRED) + """
SELECT "documentId" AS document_id, md5(to_json({'user_id': "userId", 'document_id': "documentId", 'version_id': "versionId",
  'expiry_status': "expiryStatus", 'approval_status': "approvalStatus", 'credential_number': coalesce("wwccNumber", ''),
  'expiry_date': coalesce("expiryDate", '')})::VARCHAR) AS hash FROM cred"""
ORACLE["missing_people"] = _with(REQ, CRED, CHECKS, ABSENT) + "SELECT * FROM absent"
ORACLE["notification_commands"] = _EV + _ALERT + f"FROM ev WHERE {_NOTIFY}"
ORACLE["priority_lookup"] = _EV + f"""
SELECT event_id, {_PRIORITY.format("compliance_status")} AS priority, 'wwcc-individual-alert.html' AS template FROM ev"""
ORACLE["recipients"] = _EV + """
SELECT event_id, coalesce(email, '') AS "to", 'test@example.org' AS to_override,
  'a@example.org,b@example.org' AS cc, NULL::VARCHAR AS cc_none FROM ev"""
ORACLE["plain_body"] = _EV + f"SELECT event_id, {_BODY} AS body FROM ev"
ORACLE["message_fields"] = _EV + f"""
SELECT event_id, {_MESSAGE} AS message, {_ACTION} AS action, {_BACK} AS background, {_FORE} AS foreground,
  {_DAYS_COLOUR} AS "daysColor", compliance_status = 'EXPIRED' AS "isExpired", compliance_status = 'EXPIRING' AS "isExpiring",
  compliance_status = 'MISSING' AS "isMissing", compliance_status = 'NOT_APPROVED' AS "isNotApproved" FROM ev"""
ORACLE["html_body"] = _EV + f"SELECT event_id, {_HTML} AS html FROM ev"
ORACLE["message_body"] = _EV + f"""
SELECT {_id('"userId"', "compliance_status", '"processedAt"')} AS "notificationId", compliance_status <> 'NOT_APPROVED' AS "isHtml",
  md5(CASE WHEN compliance_status <> 'NOT_APPROVED' THEN {_HTML} ELSE {_BODY} END) AS body_md5 FROM ev"""
ORACLE["schedule_parse"] = """
SELECT event_id, CASE WHEN event_id % 9 < 7 THEN event_id % 9 ELSE 0 END::INT AS weekday,
  CASE WHEN event_type = 'error' OR event_id % 27 > 23 THEN 32400
       ELSE (event_id % 27) * 3600 + (user_id % 60) * 60 END::INT AS second_of_day FROM events"""
ORACLE["notify_interval"] = _EV + f"SELECT event_id, (({_HOURS}) * 3600)::BIGINT AS interval_s FROM ev"
ORACLE["dedup_keys"] = _EV + """
SELECT event_id, 'notification:last:'||"userId"||':'||compliance_status AS cooldown_key,
  'notification:sent:'||event_id AS sent_key, 'sc:credential:'||"userId"||':'||event_id AS credential_key,
  'wwcc:compliance:'||"userId" AS compliance_key, 'wwcc:missing:'||coalesce(email, 'none') AS missing_key FROM ev"""

# --- joins -------------------------------------------------------------------------

ORACLE["name_match"] = _with(REQ, CRED, _matched("cred")) + """
SELECT "documentId", email, department, position, "startDate", matched FROM matched"""
ORACLE["first_rule"] = _EV + """
SELECT event_id, ord::INT AS ord, name, interval_hours::INT AS interval_hours FROM (
  SELECT event_id, r.*, row_number() OVER (PARTITION BY event_id ORDER BY ord) AS rn
  FROM ev JOIN (VALUES (0,'Next year',2160), (1,'Months away',600), (2,'Long gone',96), (3,'Pressing',18),
    (4,'Coming up',120), (5,'Others',480)) r(ord, name, interval_hours)
  ON CASE ord WHEN 0 THEN "daysUntilExpiry" > 365 WHEN 1 THEN "daysUntilExpiry" >= 120 WHEN 2 THEN "daysUntilExpiry" < -45
    WHEN 3 THEN "daysUntilExpiry" <= 5 WHEN 4 THEN "daysUntilExpiry" < 45 ELSE true END) WHERE rn = 1"""
ORACLE["manager_lookup"] = _EV + f"""
SELECT event_id, coalesce(department, 'Unknown') AS department, {_MANAGER} AS manager FROM ev"""
ORACLE["rule_eval"] = _ALL.rstrip() + ",\n" + _RULES + """
SELECT "userId", "wwccNumber", "expiryDate", compliance_status, "ruleId", "rulePriority", "ruleIssueType" FROM hits"""
ORACLE["rule_recipients"] = _ALL.rstrip() + ",\n" + _RULES + f"""
SELECT "userId", compliance_status, "ruleId", "rulePriority", 'employee' AS role, email AS recipient FROM hits WHERE e AND email IS NOT NULL
UNION ALL SELECT "userId", compliance_status, "ruleId", "rulePriority", 'manager', {_MANAGER} FROM hits WHERE m
UNION ALL SELECT "userId", compliance_status, "ruleId", "rulePriority", 'compliance_team', 'compliance@example.org' FROM hits WHERE c"""
ORACLE["unsent_commands"] = """
SELECT event_id, user_id||'-'||event_type AS "notificationId" FROM events e
WHERE NOT EXISTS (SELECT 1 FROM events s WHERE s.event_type IN ('error','purchase')
  AND s.user_id = e.user_id AND s.event_type = e.event_type)"""

# --- keyed state ---------------------------------------------------------------------

ORACLE["change_filter"] = _with(POLLS) + """
SELECT event_id, user_id, event_type, fingerprint FROM (
  SELECT *, lag(fingerprint) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS before FROM polls)
WHERE before IS DISTINCT FROM fingerprint"""
ORACLE["change_filter_ttl"] = (
    _with(
        POLLS,
        """numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM polls)""",
        f"""walk AS (
  SELECT user_id, event_type, rn, event_id, fingerprint, t AS stored_at, fingerprint AS stored, true AS sent FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.user_id, n.event_type, n.rn, n.event_id, n.fingerprint,
    CASE WHEN n.fingerprint <> w.stored OR n.t >= w.stored_at + 7 * {_DAY_US} THEN n.t ELSE w.stored_at END,
    CASE WHEN n.fingerprint <> w.stored OR n.t >= w.stored_at + 7 * {_DAY_US} THEN n.fingerprint ELSE w.stored END,
    n.fingerprint <> w.stored OR n.t >= w.stored_at + 7 * {_DAY_US}
  FROM walk w JOIN numbered n ON n.user_id = w.user_id AND n.event_type = w.event_type AND n.rn = w.rn + 1)""",
        recursive=True,
    )
    + "SELECT event_id, user_id, event_type, fingerprint FROM walk WHERE sent"
)
ORACLE["missing_suppressed"] = _walk(
    """SELECT event_id, 'u'||user_id||'@example.org' AS email, floor(day(ts)/10)::BIGINT AS list_version, epoch_us(ts) AS t
       FROM events WHERE event_type = 'signup'""",
    "email||'/'||list_version",
    _DAY_US,
    False,
    "event_id, email, list_version",
)
ORACLE["cooldown_fixed"] = _walk(
    "SELECT event_id, user_id, event_type, epoch_us(ts) AS t, epoch_us(ts) AS ts_us FROM events",
    "user_id||'/'||event_type",
    _DAY_US,
    True,
    "event_id, user_id, event_type, ts_us",
)
ORACLE["cooldown_rules"] = _walk(
    _COOL_BASE, "\"userId\"||'/'||compliance_status", _COOL_WAIT, True, 'event_id, "userId", compliance_status, "daysUntilExpiry"'
)
ORACLE["once_per_id"] = _walk(_COMMAND_BASE, '"notificationId"', _DAY_US, False, 'event_id, "notificationId"')
ORACLE["latest_status"] = _with(EV, LATEST) + 'SELECT "userId", compliance_status, "daysUntilExpiry", event_id FROM latest'

# --- aggregations ---------------------------------------------------------------------

ORACLE["dept_summary"] = _with(EV, LATEST) + _SUMMARY.format(source="latest")
ORACLE["dept_issues"] = _with(EV, LATEST, _PAGES.format(size=20)) + """
SELECT department, page, pages,
  string_agg("firstName"||' '||"lastName"||':'||compliance_status, ';' ORDER BY "firstName"||' '||"lastName", "userId") AS issues,
  any_value(whole."totalCount") AS "totalCount", any_value(whole."expiredCount") AS "expiredCount"
FROM paged JOIN (""" + _SUMMARY.format(source="latest") + """) whole USING (department) GROUP BY 1, 2, 3"""
ORACLE["manager_digest"] = _with(EV, LATEST) + _digest("latest")
ORACLE["poll_counters"] = _with(POLLS) + """
SELECT strftime(ts, '%Y-%m-%d') AS poll, count(*) FILTER (changed) AS changed, count(*) FILTER (NOT changed) AS unchanged FROM (
  SELECT ts, lag(fingerprint) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) IS DISTINCT FROM fingerprint AS changed
  FROM polls) GROUP BY 1"""
ORACLE["topic_counts"] = "SELECT event_type AS topic, count(*) AS messages FROM events GROUP BY 1"
ORACLE["count_reconcile"] = """
SELECT coalesce(e.topic, c.topic) AS topic, expected, coalesce(messages, 0) AS actual,
  CASE WHEN expected IS NULL THEN 'INFO' WHEN expected = coalesce(messages, 0) THEN 'OK' ELSE 'FAIL' END AS result
FROM (VALUES ('error', 2014::BIGINT), ('view', 5::BIGINT), ('absent', 1::BIGINT), ('none', 0::BIGINT)) e(topic, expected)
FULL JOIN (SELECT event_type AS topic, count(*) AS messages FROM events GROUP BY 1) c ON c.topic = e.topic"""
ORACLE["consumer_lag"] = _with(LOG) + """
SELECT consumer_group, lag, CASE WHEN lag < 10 THEN 'ok' WHEN lag < 100 THEN 'warn' ELSE 'fail' END AS level FROM (
  SELECT consumer_group, sum(ends - committed)::BIGINT AS lag FROM (
    SELECT g.consumer_group, topic, partition, max("offset") + 1 AS ends,
      max("offset") FILTER (WHERE ts < read_until) + 1 AS committed
    FROM log CROSS JOIN (VALUES ('reader-live', TIMESTAMP '2024-01-30 23:55:00'), ('reader-near', TIMESTAMP '2024-01-30 12:00:00'),
      ('reader-slow', TIMESTAMP '2024-01-20 00:00:00')) g(consumer_group, read_until) GROUP BY 1, 2, 3)
  GROUP BY 1)"""
_RATE = """SELECT event_type AS topic, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S.%f') AS minute, count(*) AS messages
FROM events GROUP BY 1, 2"""
ORACLE["message_rate"] = _RATE
ORACLE["liveness"] = """
SELECT event_type||'-'||(user_id % 40) AS consumer_group, count(*) FILTER (ts >= TIMESTAMP '2024-01-30 12:00:00') AS members,
  count(*) FILTER (ts >= TIMESTAMP '2024-01-30 12:00:00') > 0 AS alive FROM events GROUP BY 1"""
_METRICS = """metrics AS (
  SELECT 'svc-'||(user_id % 5) AS service, CASE WHEN event_type IN ('error','signup') THEN 'failed' ELSE 'passed' END AS status,
    floor(value)::BIGINT AS tests, floor(value)::BIGINT % 600 AS duration_s, (epoch_us(ts) // 1000000) AS run_ts FROM events)"""
ORACLE["test_totals"] = _with(_METRICS) + """
SELECT service, coalesce(sum(tests) FILTER (status='passed'), 0)::BIGINT AS passed,
  coalesce(sum(tests) FILTER (status='failed'), 0)::BIGINT AS failed, max(run_ts) AS last_run_ts,
  arg_max(duration_s, (run_ts, duration_s)) AS last_duration_s FROM metrics GROUP BY 1"""
ORACLE["test_status_totals"] = _with(_METRICS) + "SELECT status, sum(tests)::BIGINT AS tests FROM metrics GROUP BY 1"
ORACLE["test_log_parse"] = _with(_LINES) + """
SELECT event_id, CASE event_type WHEN 'view' THEN n WHEN 'click' THEN n - k WHEN 'error' THEN n WHEN 'signup' THEN n ELSE 0 END AS passed,
  CASE event_type WHEN 'view' THEN k WHEN 'click' THEN k WHEN 'signup' THEN k ELSE 0 END AS failed FROM lines"""

# --- samples, unions --------------------------------------------------------------------

ORACLE["topic_sample"] = _with(LOG) + """
SELECT topic, partition, "offset", key, value FROM (
  SELECT *, row_number() OVER (PARTITION BY topic ORDER BY ts, partition, "offset") AS rn FROM log) WHERE rn = 1"""
ORACLE["recent_activity"] = _with(_LOGS) + "SELECT event_id, container, line FROM logs ORDER BY ts DESC, event_id DESC LIMIT 100"
ORACLE["status_union"] = _ALL + "SELECT * FROM statuses"
ORACLE["command_union"] = _with(EV, LATEST, f"weekly AS ({_digest('latest')})") + f"""{_ALERT} FROM latest WHERE {_NOTIFY}
UNION ALL SELECT {_id("'system'", "manager", "'2024-02-01T00:00:00Z'")}, 'system', department||' Manager', manager, NULL,
  'Weekly WWCC Compliance Digest - '||department||' ('||"totalIssues"||' issues)', 'DIGEST', priority, 'manager-digest.html', true,
  NULL, NULL, NULL, '2024-02-01T00:00:00Z' FROM weekly"""

# --- end to end ---------------------------------------------------------------------------

ORACLE["compliance_report"] = _ALL + """
SELECT coalesce(department, 'Unknown') AS department, compliance_status, count(*) AS people FROM statuses GROUP BY 1, 2"""
_TOLD = """told AS (
  SELECT event_id, "userId", compliance_status, ts_us AS t, row_number() OVER (PARTITION BY "userId" ORDER BY ts, event_id) AS rn,
    concat_ws('|', event_type, coalesce("wwccNumber", ''), coalesce("daysUntilExpiry"::VARCHAR, '')) AS state FROM ev)"""
ORACLE["status_changes"] = (
    _with(
        EV,
        _TOLD,
        f"""walk AS (
  SELECT "userId", rn, event_id, compliance_status, state, t AS out_at, true AS goes FROM told WHERE rn = 1
  UNION ALL
  SELECT n."userId", n.rn, n.event_id, n.compliance_status, n.state,
    CASE WHEN n.state <> w.state OR n.t >= w.out_at + {_DAY_US} THEN n.t ELSE w.out_at END,
    n.state <> w.state OR n.t >= w.out_at + {_DAY_US}
  FROM walk w JOIN told n ON n."userId" = w."userId" AND n.rn = w.rn + 1)""",
        recursive=True,
    )
    + 'SELECT event_id, "userId", compliance_status FROM walk WHERE goes'
)
ORACLE["digest_run_log"] = _with(
    _DUE,
    "typed AS (SELECT due.*, event_type, strftime(local_ts, '%Y-%m-%d') AS day FROM due JOIN events USING (event_id))",
) + """
SELECT day AS "localDate", arg_min(event_id, local_ts) AS event_id FROM typed
WHERE day NOT IN (SELECT day FROM typed WHERE event_type = 'error') GROUP BY day"""
ORACLE["notification_flow"] = (
    _EV + _ALERT + f"FROM ev WHERE event_id IN (SELECT event_id FROM ({ORACLE['cooldown_rules']}))"
)
ORACLE["digest_flow"] = _with(EV, LATEST) + _digest("latest")
ORACLE["digest_messages"] = (
    _with(EV, LATEST, f"totals AS ({_digest('latest')})", _DIGEST_PAGES)
    + f"""
SELECT s.manager, page, any_value(pages) AS pages, any_value("totalIssues") AS "totalIssues", count(*)::INT AS sections,
  '<!DOCTYPE html><html><head><meta charset="UTF-8"></head><body><h1>Weekly WWCC Compliance Digest</h1><p>Example Council - 2024-02-01</p>'
  ||CASE WHEN any_value(pages) > 1 THEN '<p>Part '||page||' of '||any_value(pages)||'</p>' ELSE '' END
  ||CASE WHEN any_value("totalExpired") > 0
    THEN '<h2>'||any_value("totalIssues")||' Total Compliance Issue'||{_S.format('any_value("totalIssues")')}||'</h2><p>'
      ||any_value("totalExpired")||' Expired • '||any_value("totalExpiring")||' Expiring • '||any_value("totalMissing")
      ||' Missing • '||any_value("totalNotApproved")||' Not Approved</p>'
    ELSE '<h2>All Clear - No Critical Issues</h2><p>'||any_value("totalIssues")||' Total Issue'||{_S.format('any_value("totalIssues")')}
      ||' ('||any_value("totalExpiring")||' Expiring, '||any_value("totalMissing")||' Missing, '
      ||any_value("totalNotApproved")||' Not Approved)</p>' END
  ||'<p>Dear '||any_value("managerName")||',</p><p>Weekly summary of WWCC compliance issues in your department'
  ||{_S.format("count(*)")}||'.</p>'||string_agg(section, '' ORDER BY s.department)
  ||'<footer>Generated: 2024-02-01</footer></body></html>' AS html
FROM sections s JOIN totals t ON t.manager = s.manager GROUP BY s.manager, page"""
)
ORACLE["delivery_flow"] = _EV + f"""
SELECT "userId"||'-'||compliance_status AS "notificationId", "userId", coalesce(email, '') AS email,
  compliance_status AS "issueType", "processedAt" AS "sentAt", email IS NOT NULL AS success,
  CASE WHEN email IS NULL THEN 'no recipient' END AS "errorMessage"
FROM ev WHERE event_id IN (SELECT event_id FROM ({ORACLE['once_per_id']}))"""
ORACLE["latest_person"] = _EV + """
SELECT "userId", email, compliance_status, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY coalesce('e:'||email, 'u:'||"userId") ORDER BY ts DESC, event_id DESC) AS rn FROM ev)
WHERE rn = 1"""
ORACLE["issues_view"] = _with(EV, LATEST) + f'SELECT "userId", compliance_status, department, event_id FROM latest WHERE {_NOTIFY}'

# --- streams: the same rows as their batch twins -------------------------------------------

ORACLE["status_stream"] = _with(REQ, CRED, CHECKS, _matched("checks"), JUDGED, FOUND) + "SELECT * FROM found"
ORACLE["cooldown_stream"] = ORACLE["cooldown_fixed"]
ORACLE["change_stream"] = ORACLE["change_filter_ttl"]
ORACLE["once_per_id_stream"] = ORACLE["once_per_id"]
ORACLE["redelivery_stream"] = 'SELECT event_id::VARCHAR AS "notificationId" FROM events'
ORACLE["notification_stream"] = ORACLE["notification_flow"]
ORACLE["latest_status_stream"] = _with(EV, LATEST) + 'SELECT "userId", compliance_status, event_id FROM latest'
ORACLE["message_rate_stream"] = _RATE

ORACLE["status_as_of"] = (
    _with(
        REQ,
        CRED,
        """versions AS (SELECT range AS v, epoch_us(make_timestamp(range, 1, 1, 0, 0, 0)) AS since FROM range(1993, 1999))""",
        """dated AS (
  SELECT c.*, coalesce((SELECT max(v) FROM versions WHERE since <= epoch_us(o_orderdate::TIMESTAMP) + o_orderkey % 86400 * 1000000),
    1993) AS list_version
  FROM cred c JOIN orders ON o_orderkey::VARCHAR = "documentId" WHERE lower("typeName") LIKE '%children%')""",
        """matched AS (
  SELECT c.*, p.email, p.department, p.position || '-' || c.list_version AS position, p."startDate", p.email IS NOT NULL AS matched
  FROM dated c LEFT JOIN (
    SELECT *, row_number() OVER (PARTITION BY v, lower(trim("firstName")), lower(trim("lastName")) ORDER BY email) AS rn
    FROM req, versions WHERE split_part(email[2:], '@', 1)::BIGINT % 5 <> v % 5) p
  ON p.rn = 1 AND p.v = c.list_version AND lower(trim(p."firstName")) = lower(trim(c."firstName"))
     AND lower(trim(p."lastName")) = lower(trim(c."lastName")))""",
        JUDGED,
        FOUND.replace("FROM judged", ", list_version FROM judged"),
    )
    + "SELECT * FROM found"
)
ORACLE["digest_incremental"] = ORACLE["manager_digest"]
ORACLE["digest_gate"] = (
    _with(EV, LATEST, _DUE, f"digests AS ({_digest('latest')})", "days AS (SELECT DISTINCT strftime(local_ts, '%Y-%m-%d') AS day FROM due)")
    + 'SELECT digests.* REPLACE (day AS "summaryDate") FROM digests, days'
)
