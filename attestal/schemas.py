"""Record types of every topic and document, as Spark schemas.

``REQUIRED_*`` tuples name the fields without which a record is malformed.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CALENDAR_DATE = _struct(year=_I, month=_I, day=_I)
PERSON_REF = _struct(id=_S, first_name=_S, last_name=_S)
APPROVAL = _struct(status=_S, reason=_S)
MEDIA = _struct(id=_S, token=_S, filename=_S, media_type=_S)

DOCUMENT_VERSION = _struct(
    subject_org_id=_S,
    subject_user_id=_S,
    document_type_id=_S,
    document_id=_S,
    document_version_id=_S,
    attributes=_struct(
        media=T.ArrayType(MEDIA),
        expiry_period_start_date=CALENDAR_DATE,
        expiry_period_end_date=CALENDAR_DATE,
        credential_number=_S,
    ),
    metadata=_struct(
        created_at=_S,
        created_by_user=PERSON_REF,
        last_modified=_S,
        last_modified_by_user=PERSON_REF,
        expiry_status=_S,
        approval=APPROVAL,
    ),
    subject_user=PERSON_REF,
    document_type=_struct(id=_S, name=_S),
)

SNAPSHOT = _struct(next_page_token=_S, latest_document_versions=T.ArrayType(DOCUMENT_VERSION))

# The transformer reads fewer fields than the poller publishes; declaring the
# narrow shape lets from_json skip the rest.
CREDENTIAL_MESSAGE = _struct(
    credential=_struct(
        subject_user_id=_S,
        document_id=_S,
        attributes=_struct(expiry_period_end_date=CALENDAR_DATE, credential_number=_S),
        metadata=_struct(expiry_status=_S, approval=APPROVAL),
        subject_user=PERSON_REF,
    ),
    polledAt=_S,
)
CREDENTIAL_MESSAGE_REQUIRED = (
    "credential.subject_user_id",
    "credential.metadata.expiry_status",
    "credential.metadata.approval.status",
    "credential.subject_user.first_name",
    "credential.subject_user.last_name",
    "polledAt",
)

REQUIRED_PERSON = _struct(
    email=_S,
    firstName=_S,
    lastName=_S,
    department=_S,
    position=_S,
    requiresWwcc=_B,
    startDate=_S,
)
REQUIRED_LIST = _struct(requiredUsers=T.ArrayType(REQUIRED_PERSON), timestamp=_S)

# Older exports name a reason instead of department/position and omit the rest.
REQUIRED_PERSON_SHORT = _struct(email=_S, firstName=_S, lastName=_S, requiredBecause=_S)
REQUIRED_LIST_SHORT = _struct(requiredUsers=T.ArrayType(REQUIRED_PERSON_SHORT))

STATUS = _struct(
    userId=_S,
    firstName=_S,
    lastName=_S,
    email=_S,
    department=_S,
    position=_S,
    startDate=_S,
    wwccNumber=_S,
    expiryDate=_S,
    daysUntilExpiry=_L,
    daysSinceStart=_L,
    safetyculture_status=_S,
    approval_status=_S,
    compliance_status=_S,
    flags=T.ArrayType(_S),
    processedAt=_S,
)
STATUS_REQUIRED = (
    "userId",
    "firstName",
    "lastName",
    "safetyculture_status",
    "approval_status",
    "compliance_status",
    "flags",
    "processedAt",
)

COMMAND_DATA = _struct(wwccNumber=_S, expiryDate=_S, daysUntilExpiry=_L)
COMMAND = _struct(
    notificationId=_S,
    userId=_S,
    userName=_S,
    to=T.ArrayType(_S),
    cc=T.ArrayType(_S),
    bcc=T.ArrayType(_S),
    subject=_S,
    issueType=_S,
    priority=_S,
    template=_S,
    isHtml=_B,
    data=COMMAND_DATA,
    createdAt=_S,
)
COMMAND_REQUIRED = (
    "notificationId",
    "userId",
    "userName",
    "to",
    "subject",
    "issueType",
    "priority",
    "template",
    "isHtml",
    "data",
    "createdAt",
)

SENT = _struct(
    notificationId=_S,
    userId=_S,
    email=_S,
    issueType=_S,
    sentAt=_S,
    success=_B,
    errorMessage=_S,
)

DIGEST_ISSUE = _struct(
    userId=_S,
    userName=_S,
    email=_S,
    position=_S,
    complianceStatus=_S,
    wwccNumber=_S,
    expiryDate=_S,
    daysUntilExpiry=_L,
)

RULE = _struct(
    ruleId=_S,
    name=_S,
    description=_S,
    enabled=_B,
    conditions=_struct(
        compliance_statuses=T.ArrayType(_S),
        flags_any=T.ArrayType(_S),
        flags_all=T.ArrayType(_S),
        days_until_expiry_less_than=_I,
        days_since_start_greater_than=_I,
    ),
    notification=_struct(
        priority=_S,
        issue_type=_S,
        template=_S,
        notify_employee=_B,
        notify_manager=_B,
        notify_compliance_team=_B,
    ),
)
RULES_DOCUMENT = _struct(rules=T.ArrayType(RULE), default_compliance_email=_S, timestamp=_S)

DIRECTORY = _struct(uuid=_S, email=_S, first_name=_S, last_name=_S)
