"""Weekly manager digests.

Counts are plain aggregates. Issue lists are cut into pages of about
``page_size`` issues, so that one department or manager with very many issues
becomes many pages instead of one huge row; nothing is dropped, and whoever has
few issues gets exactly one page.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestal import constants as K
from attestal.functions import scalar as S
from attestal.functions.predicates import is_non_compliant
from attestal.operators.rules import with_manager

PAGE_SIZE = 500
_COUNTS = (
    ("expiredCount", K.EXPIRED),
    ("expiringCount", K.EXPIRING),
    ("missingCount", K.MISSING),
    ("notApprovedCount", K.NOT_APPROVED),
)
_TOTALS = (
    ("totalIssues", "totalCount"),
    ("totalExpired", "expiredCount"),
    ("totalExpiring", "expiringCount"),
    ("totalMissing", "missingCount"),
    ("totalNotApproved", "notApprovedCount"),
)


def open_issues(latest: DataFrame) -> DataFrame:
    """Latest rows that are not compliant, with a department in any case."""
    return latest.filter(is_non_compliant(F.col("compliance_status"))).withColumn(
        "department", F.coalesce("department", F.lit(K.UNKNOWN_DEPARTMENT))
    )


def _counts(status: str = "compliance_status") -> list[Column]:
    return [
        F.count(F.lit(1)).alias("totalCount"),
        *[F.count_if(F.col(status) == value).alias(name) for name, value in _COUNTS],
    ]


def department_summary(latest: DataFrame, other: bool = False) -> DataFrame:
    """Issue counts by department; the total also counts kinds without a column.

    ``other`` adds a column for those kinds.
    """
    summary = open_issues(latest).groupBy("department").agg(*_counts())
    if not other:
        return summary
    named = sum((F.col(name) for name, _ in _COUNTS), F.lit(0))
    return summary.withColumn("otherCount", F.col("totalCount") - named)


def manager_digest(summaries: DataFrame, managers: DataFrame, default_manager: str, summary_date: str) -> DataFrame:
    """Department counts added up by manager; ``department`` is the first by name."""
    return (
        with_manager(summaries, managers, default_manager)
        .groupBy("manager")
        .agg(
            F.min("department").alias("department"),
            F.count(F.lit(1)).alias("departmentCount"),
            *[F.sum(source).alias(name) for name, source in _TOTALS],
        )
        .withColumn("managerName", S.manager_display_name(F.col("manager")))
        .withColumn("summaryDate", F.lit(summary_date))
        .withColumn("priority", F.when(F.col("totalExpired") > 0, K.PRIORITY_HIGH).otherwise(K.PRIORITY_MEDIUM))
    )


def _issue() -> Column:
    return F.struct(
        S.full_name(F.col("firstName"), F.col("lastName")).alias("userName"),
        "userId",
        "email",
        "position",
        F.col("compliance_status").alias("complianceStatus"),
        "wwccNumber",
        "expiryDate",
        "daysUntilExpiry",
    )


def _page(pages: Column) -> Column:
    """Page 1..n of a person, by digest of the id: stable and evenly spread."""
    number = F.conv(F.substring(F.md5("userId"), 1, 8), 16, 10).cast("long")
    return (F.pmod(number, pages) + 1).cast("long")


def with_pages(issues: DataFrame, by: Sequence[str], page_size: int) -> DataFrame:
    pages = issues.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / F.lit(page_size)).cast("long").alias("pages"))
    return issues.join(pages, list(by)).withColumn("page", _page(F.col("pages")))


def department_issues(latest: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Issue lists by department and page, sorted by name; the counts are those of the whole department."""
    listed = (
        with_pages(open_issues(latest), ["department"], page_size)
        .groupBy("department", "page", "pages")
        .agg(F.sort_array(F.collect_list(_issue())).alias("issues"))
    )
    return listed.join(department_summary(latest), "department")


def digest_pages(
    latest: DataFrame, managers: DataFrame, default_manager: str, summary_date: str, page_size: int = PAGE_SIZE
) -> DataFrame:
    """Digest content by manager and page: department sections with their issues.

    Section counts are those of the whole department, on whatever page a part
    of its list stands; the totals are those of the manager.
    """
    issues = with_manager(open_issues(latest), managers, default_manager)
    sections = (
        with_pages(issues, ["manager"], page_size)
        .groupBy("manager", "page", "pages", "department")
        .agg(F.sort_array(F.collect_list(_issue())).alias("issues"))
        .join(department_summary(latest), "department")
    )
    section = F.struct("department", "issues", "totalCount", *[name for name, _ in _COUNTS])
    pages = sections.groupBy("manager", "page", "pages").agg(F.sort_array(F.collect_list(section)).alias("departments"))
    totals = manager_digest(department_summary(latest), managers, default_manager, summary_date)
    return pages.join(totals, "manager")
