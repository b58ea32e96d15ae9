"""HTML bodies as Column expressions: one concat per message, no template engine.

The wording and colours come from ``constants``; the layout is ours.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from attestal import constants as K
from attestal.functions.scalar import days_colour, issue_text

# Characters replaced in text put into HTML, ampersand first.
HTML_ESCAPES = (
    ("&", "&amp;"),
    ("<", "&lt;"),
    (">", "&gt;"),
    ('"', "&quot;"),
    ("'", "&#39;"),
    ("`", "&#96;"),
    ("=", "&#61;"),
)

_BANNER = {
    K.EXPIRED: "EXPIRED - Immediate Action Required",
    K.EXPIRING: "EXPIRING SOON - Action Required",
    K.MISSING: "MISSING - No WWCC On File",
    K.NOT_APPROVED: "PENDING APPROVAL",
}
_DASH = "—"


def escape(value: Column) -> Column:
    text = value.cast("string")
    for raw, safe in HTML_ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def _escaped(text: str) -> str:
    """``escape`` for fixed wording, done once when the expression is built."""
    for raw, safe in HTML_ESCAPES:
        text = text.replace(raw, safe)
    return text


def _wording(issue: Column, part: int) -> Column:
    """Escaped message (part 0) or action (part 1) of an issue type."""
    text = F.lit(_escaped(K.ISSUE_TEXT_DEFAULT[part]))
    for name, row in K.ISSUE_TEXT.items():
        text = F.when(issue == name, _escaped(row[part])).otherwise(text)
    return text


def _html(*parts: Column | str) -> Column:
    """Concatenation that reads a null part as empty."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts])


def _detail(label: str, value: Column, colour: Column | None = None) -> Column:
    """A table row, left out when the value is absent."""
    cell = "<td>" if colour is None else _html('<td style="color: ', colour, '">')
    row = _html(f"<tr><th>{label}</th>", cell if isinstance(cell, Column) else F.lit(cell), escape(value), "</td></tr>")
    return F.when(value.isNotNull() & (value.cast("string") != ""), row)


def _badge(text: Column, background: Column, foreground: Column) -> Column:
    return _html('<span style="background: ', background, "; color: ", foreground, '">', escape(text), "</span>")


def alert_html(
    user_name: Column,
    issue: Column,
    number: Column,
    expiry: Column,
    days: Column,
    sent_at: Column,
    organisation: str = "",
) -> Column:
    text = issue_text(issue)
    banner = F.lit("")
    for name, words in _BANNER.items():
        strip = _html('<div class="banner" style="background: ', text["background"], "; color: ", text["foreground"], f'">{words}</div>')
        banner = F.when(issue == name, strip).otherwise(banner)
    page = _html(
        '<!DOCTYPE html><html><head><meta charset="UTF-8"></head><body>',
        "<h1>WWCC Compliance Alert</h1><p>",
        escape(F.lit(organisation)),
        "</p>",
        banner,
        "<p>Dear ",
        escape(user_name),
        ",</p><p>",
        _wording(issue, 0),
        "</p><table>",
        _detail("WWCC Number:", number),
        _detail("Expiry Date:", expiry),
        _detail("Days Until Expiry:", days, days_colour(days)),
        "<tr><th>Status:</th><td>",
        _badge(issue, text["background"], text["foreground"]),
        "</td></tr></table><h4>What You Need To Do</h4><p>",
        _wording(issue, 1),
        "</p><footer>Sent: ",
        escape(sent_at),
        "</footer></body></html>",
    )
    # without a name or an issue there is no page: the caller falls back to plain text
    return F.when(user_name.isNotNull() & issue.isNotNull(), page)


def _plural(count: Column) -> Column:
    return F.when(count == 1, "").otherwise("s")


def _or_dash(value: Column) -> Column:
    return F.coalesce(escape(value), F.lit(_DASH))


def _issue_row(issue: Column) -> Column:
    text = issue_text(issue["complianceStatus"])
    position = F.when(issue["position"].isNotNull(), _html("<br><small>", escape(issue["position"]), "</small>"))
    return _html(
        "<tr><td><strong>",
        escape(issue["userName"]),
        "</strong>",
        position,
        "</td><td>",
        _badge(issue["complianceStatus"], text["background"], text["foreground"]),
        "</td><td>",
        _or_dash(issue["wwccNumber"]),
        "</td><td>",
        _or_dash(issue["expiryDate"]),
        '</td><td style="color: ',
        days_colour(issue["daysUntilExpiry"]),
        '">',
        _or_dash(issue["daysUntilExpiry"]),
        "</td></tr>",
    )


def _counts(struct: Column, fields: tuple[tuple[str, str], ...]) -> Column:
    """``3 Expired • 1 Missing``: only the counts that are not zero."""
    shown = [F.when(struct[f] > 0, F.concat(struct[f].cast("string"), F.lit(f" {label}"))) for f, label in fields]
    return F.array_join(F.array_compact(F.array(*shown)), " • ")


_DEPARTMENT_COUNTS = (
    ("expiredCount", "Expired"),
    ("expiringCount", "Expiring"),
    ("missingCount", "Missing"),
    ("notApprovedCount", "Not Approved"),
)


def _department_section(dept: Column) -> Column:
    return _html(
        "<section><h3>",
        escape(dept["department"]),
        "</h3><p>",
        dept["totalCount"].cast("string"),
        " Issue",
        _plural(dept["totalCount"]),
        " • ",
        _counts(dept, _DEPARTMENT_COUNTS),
        "</p><table><tr><th>Name</th><th>Status</th><th>WWCC Number</th><th>Expiry</th><th>Days</th></tr>",
        F.array_join(F.transform(dept["issues"], _issue_row), ""),
        "</table></section>",
    )


def digest_html(
    manager_name: Column,
    summary_date: Column,
    totals: Column,
    departments: Column,
    organisation: str = "",
    page: Column | None = None,
    pages: Column | None = None,
) -> Column:
    """Digest body; ``totals`` carries the five totals, ``departments`` the sections."""
    n = {f: totals[f].cast("string") for f in ("totalIssues", "totalExpired", "totalExpiring", "totalMissing", "totalNotApproved")}
    critical = _html(
        "<h2>",
        n["totalIssues"],
        " Total Compliance Issue",
        _plural(totals["totalIssues"]),
        "</h2><p>",
        n["totalExpired"],
        " Expired • ",
        n["totalExpiring"],
        " Expiring • ",
        n["totalMissing"],
        " Missing • ",
        n["totalNotApproved"],
        " Not Approved</p>",
    )
    calm = _html(
        "<h2>All Clear - No Critical Issues</h2><p>",
        n["totalIssues"],
        " Total Issue",
        _plural(totals["totalIssues"]),
        " (",
        n["totalExpiring"],
        " Expiring, ",
        n["totalMissing"],
        " Missing, ",
        n["totalNotApproved"],
        " Not Approved)</p>",
    )
    part = F.lit("")
    if page is not None and pages is not None:
        part = F.when(pages > 1, _html("<p>Part ", page.cast("string"), " of ", pages.cast("string"), "</p>"))
    return _html(
        '<!DOCTYPE html><html><head><meta charset="UTF-8"></head><body>',
        "<h1>Weekly WWCC Compliance Digest</h1><p>",
        escape(F.lit(organisation)),
        " - ",
        escape(summary_date),
        "</p>",
        part,
        F.when(totals["totalExpired"] > 0, critical).otherwise(calm),
        "<p>Dear ",
        escape(manager_name),
        ",</p><p>Weekly summary of WWCC compliance issues in your department",
        _plural(F.size(departments)),
        ".</p>",
        F.array_join(F.transform(departments, _department_section), ""),
        "<footer>Generated: ",
        escape(summary_date),
        "</footer></body></html>",
    )
