"""Row rules: each record yields any number of issues, in one pass without a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibspark.functions.text import is_blank, is_doi, number, parts, strip
from bibspark.schema import VALID_MANDATORY, VALID_RECOMMENDED, YEARS

ISSUE_FIELDS = ("record_id", "field", "issue_type", "severity", "description", "source_file")


def _issue(when: Column, field: str, kind: str, severity: str, text: Column) -> Column:
    return F.when(when, F.struct(F.lit(field).alias("field"), F.lit(kind).alias("issue_type"), F.lit(severity).alias("severity"), text.alias("description")))


def rules(columns: list[str]) -> list[Column]:
    """One nullable struct for each rule that applies to a table with these columns."""
    out = []
    for f in VALID_MANDATORY:
        if f not in columns:
            out.append(_issue(F.lit(True), f, "missing_column", "critical", F.lit(f"Mandatory field '{f}' missing from dataset")))
        else:
            out.append(_issue(is_blank(F.col(f).cast("string")), f, "missing_value", "high", F.lit(f"Mandatory field '{f}' is empty")))
    if "PY" in columns:
        raw = F.col("PY").cast("string")
        year = F.when(number("PY").between(-9e15, 9e15), number("PY").cast("bigint"))
        out.append(_issue(year.isNotNull() & ~year.between(*YEARS), "PY", "invalid_value", "medium", F.concat(F.lit("Year "), year.cast("string"), F.lit(" out of typical range"))))
        out.append(_issue(raw.isNotNull() & year.isNull(), "PY", "invalid_format", "high", F.concat(F.lit("Cannot parse year: "), raw)))
    if "DI" in columns:
        out.append(_issue(~is_blank("DI") & ~is_doi("DI"), "DI", "invalid_format", "medium", F.concat(F.lit("DOI format suspicious: "), F.substring("DI", 1, 50))))
    if "TI" in columns:
        n = F.length(strip("TI"))
        out.append(_issue(n < 10, "TI", "short_title", "low", F.concat(F.lit("Title suspiciously short ("), n.cast("string"), F.lit(" chars)"))))
        out.append(_issue((n >= 10) & (F.length("TI") > 500), "TI", "long_title", "low", F.concat(F.lit("Title unusually long ("), F.length("TI").cast("string"), F.lit(" chars)"))))
    if "AU" in columns:
        out.append(_issue(F.size(parts("AU")) == 0, "AU", "empty_authors", "high", F.lit("No authors parsed")))
    for f in VALID_RECOMMENDED:
        if f in columns:
            out.append(_issue(is_blank(F.col(f).cast("string")), f, "missing_recommended", "low", F.lit(f"Recommended field '{f}' is empty")))
    return out


def validation_issues(df: DataFrame) -> DataFrame:
    found = F.filter(F.array(*rules(df.columns)), lambda x: x.isNotNull())
    return df.select("record_id", "source_file", F.explode(found).alias("i")).select("record_id", "i.field", "i.issue_type", "i.severity", "i.description", "source_file")


def issues_by(issues: DataFrame, *keys: str) -> DataFrame:
    return issues.groupBy(*keys).agg(F.count(F.lit(1)).alias("issues"))
