"""Checks of how well a source was mapped onto the tags: profiles, preservation, scores, leftovers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibspark.functions.text import filled, is_blank, number, percent, strip
from bibspark.schema import ALIASES, FILE_HINTS, INDICATORS, INTERNAL, MANDATORY, MAPPINGS, OPTIONAL_COLUMNS, PATTERNS

EMPTY_WARNING = 10.0
UNEXPECTED = 0.05
_FIELDS = "source_field string, target_field string, mapped_records long, missing_records long, null_percentage double, status string"


def detect_database(columns: list[str], file_names: list[str] = ()) -> str:
    """By a column only one database has, else by three usual columns, else by the file name."""
    have = set(columns)
    for db, marks in INDICATORS.items():
        if have & set(marks):
            return db
    for db, usual in PATTERNS.items():
        if len(have & set(usual)) >= 3:
            return db
    low = [f.lower() for f in file_names]
    return next((db for db, hints in FILE_HINTS.items() if any(h in f for h in hints for f in low)), "Unknown")


def to_tags(df: DataFrame, database: str) -> DataFrame:
    """Source columns renamed to tags; several columns of one tag fill each other's gaps in order."""
    mapping = MAPPINGS[database] | ALIASES.get(database, {})
    by: dict[str, list[str]] = {}
    for source, tag in mapping.items():
        if source in df.columns:
            by.setdefault(tag, []).append(source)
    q = lambda c: F.col(f"`{c}`").cast("string")
    made = [(q(cs[0]) if len(cs) == 1 else F.coalesce(*[F.when(~is_blank(q(c)), q(c)) for c in cs], F.lit(""))).alias(tag) for tag, cs in by.items()]
    return df.select(*[c for c in INTERNAL if c in df.columns], *made)


def _empty(c: str) -> Column:
    v = F.col(f"`{c}`").cast("string")
    return v.isNull() | (v == "")


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, total, empty) for each column, in one pass."""
    sums = df.agg(F.count(F.lit(1)).alias("_total"), *[F.coalesce(F.sum(_empty(c).cast("long")), F.lit(0)).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("field"), F.col("_total").alias("total"), F.col(f"`{c}`").alias("empty")) for c in columns])
    return sums.select(F.explode(rows).alias("x")).select("x.*")


def _share(empty, total) -> Column:
    return F.when(total > 0, empty / total * 100).otherwise(0.0)


def field_results(df: DataFrame, database: str, original: list[str] | None = None, legacy_counts: bool = False) -> DataFrame:
    """Mandatory tags, then each mapped source column that the source has."""
    spark = df.sparkSession
    mapping = MAPPINGS.get(database, {})
    present = [t for t in MANDATORY if t in df.columns]
    original = df.columns if original is None else original
    used = [(s, t) for s, t in mapping.items() if s in original]
    p = profile(df, sorted(set(present) | {t for _, t in used if t in df.columns}) or df.columns[:1])
    total = p.agg(F.max("total").alias("total"))
    share = _share(F.col("empty"), F.col("total"))
    status = F.when(share < EMPTY_WARNING, "PASS").otherwise("WARNING")
    checks = spark.createDataFrame([("mandatory", t, t) for t in present] + [("mapped", s, t) for s, t in used if t in df.columns], "part string, source_field string, target_field string") if present or used else None
    parts: list[DataFrame] = []
    if checks is not None:
        j = checks.join(F.broadcast(p), F.col("target_field") == F.col("field"))  # one row for each column
        mapped = F.col("total") - F.col("empty")
        missing, pct = F.col("empty"), share
        if legacy_counts:  # the counting that adds up filled and not-null values
            twice = F.when(F.col("part") == "mapped", 2 * F.col("total") - F.col("empty")).otherwise(mapped)
            mapped, missing = twice, F.when(F.col("part") == "mapped", F.col("total") - twice).otherwise(F.col("empty"))
            pct = _share(missing, F.col("total"))
        named = F.when((F.col("part") == "mapped") & (F.col("source_field") != F.col("target_field")) & (mapped <= 0), "NOT_AVAILABLE_FROM_SOURCE").otherwise(F.when(pct < EMPTY_WARNING, "PASS").otherwise("WARNING") if legacy_counts else status)
        parts.append(j.select("source_field", "target_field", mapped.alias("mapped_records"), missing.alias("missing_records"), percent(missing, "total").alias("null_percentage"), named.alias("status")))
    gone = [(t, t in set(mapping.values())) for t in MANDATORY if t not in df.columns]
    lost = [(s, t) for s, t in used if t not in df.columns]
    if gone or lost:
        g = spark.createDataFrame([("N/A", t, failed) for t, failed in gone] + [(s, t, True) for s, t in lost], "source_field string, target_field string, failed boolean").crossJoin(F.broadcast(total))
        parts.append(
            g.select(
                "source_field", "target_field", F.lit(0).cast("long").alias("mapped_records"), F.when(F.col("failed"), F.col("total")).otherwise(0).alias("missing_records"),
                F.when(F.col("failed"), 100.0).otherwise(0.0).alias("null_percentage"), F.when(F.col("failed"), "FAILED").otherwise("NOT_AVAILABLE_FROM_SOURCE").alias("status"),
            )
        )
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def unmapped_columns(columns: list[str], database: str) -> list[tuple[str, str, str]]:
    """(column, classification, suggestion) of the columns a mapping leaves out."""
    mapped = set(MAPPINGS.get(database, {}))
    out = []
    for c in columns:
        if c in INTERNAL or c.startswith("__") or c in mapped:
            continue
        if c.upper() in OPTIONAL_COLUMNS:
            out.append((c, "OPTIONAL", f"Column '{c}' has no tag and may be left out"))
        elif c.upper() in MANDATORY:
            out.append((c, "UNUSED", f"Column '{c}' has the name of a tag but isn't used"))
        else:
            out.append((c, "POTENTIAL_CANDIDATE", f"Column '{c}' may hold a tag's values"))
    return out


def any_filled(df: DataFrame, columns: list[str]) -> Column:
    cs = [c for c in columns if c in df.columns]
    out = F.lit(False)
    for c in cs:
        out = out | ~is_blank(F.col(f"`{c}`").cast("string"))
    return out


def _measures(df: DataFrame, groups: dict[str, list[str]], years: list[str]) -> DataFrame:
    """One row: record count, rows filled by group, distinct journals, first and last year."""
    ys = [number(F.col(f"`{c}`")) for c in years if c in df.columns]
    aggs, many = [F.count(F.lit(1)).alias("Record Count")], None
    for name, cols in groups.items():
        if name == "Journal Count":
            vals = [F.when(filled(f"`{c}`"), strip(f"`{c}`")) for c in cols if c in df.columns]
            if len(vals) > 1:
                many = df.select(F.explode(F.array_compact(F.array(*vals))).alias("v")).agg(F.count_distinct("v").alias(name))
            aggs.append(F.count_distinct(vals[0]).alias(name) if len(vals) == 1 else F.lit(0).cast("long").alias(name))
        else:
            aggs.append(F.count_if(any_filled(df, cols)).alias(name))
    lo = F.min(F.least(*ys)) if len(ys) > 1 else F.min(ys[0]) if ys else F.lit(None).cast("double")
    hi = F.max(F.greatest(*ys)) if len(ys) > 1 else F.max(ys[0]) if ys else F.lit(None).cast("double")
    years_text = F.concat(lo.cast("int").cast("string"), F.lit("-"), hi.cast("int").cast("string"))
    one = df.agg(*aggs, years_text.alias("Publication Year Range"))
    return one if many is None else one.drop(*many.columns).crossJoin(many).select(*one.columns)  # one row each


BEFORE = {
    "Document Count": ["TI"],
    "Author Count": ["AU", "Authors"],
    "DOI Count": ["DI", "DOI"],
    "Journal Count": ["SO", "Source", "Journal/Book", "Source title"],
    "Keyword Count": ["DE", "ID", "Author Keywords", "Index Keywords", "MeSH terms"],
    "Affiliation Count": ["C1", "Affiliations", "Authors Affiliations", "Authors (Raw Affiliation)"],
}
AFTER = {"Document Count": ["TI"], "Author Count": ["AU"], "DOI Count": ["DI"], "Journal Count": ["SO"], "Keyword Count": ["DE", "ID"], "Affiliation Count": ["C1"]}
BEFORE_YEARS = ["PY", "Year", "PubYear", "Publication Year", "published-print"]


def preservation(original: DataFrame, df: DataFrame) -> DataFrame:
    """(metric, original_value, normalized_value, difference, classification) of eight measures."""
    a, b = _measures(original, BEFORE, BEFORE_YEARS), _measures(df, AFTER, ["PY"])
    names = ["Record Count", *BEFORE]
    both = a.select(F.struct(*[F.col(f"`{c}`") for c in a.columns]).alias("a")).crossJoin(b.select(F.struct(*[F.col(f"`{c}`") for c in b.columns]).alias("b")))  # one row each
    rows = []
    for n in names:
        x, y = F.col(f"a.`{n}`"), F.col(f"b.`{n}`")
        kind = F.when(F.abs(y - x) > UNEXPECTED * F.col("a.`Record Count`"), "Unexpected").when(x != y, "Configuration Driven").otherwise("Expected")
        rows.append(F.struct(F.lit(n).alias("metric"), x.cast("string").alias("original_value"), y.cast("string").alias("normalized_value"), (y - x).cast("string").alias("difference"), kind.alias("classification")))
    x, y = F.col("a.`Publication Year Range`"), F.col("b.`Publication Year Range`")
    same = x == y
    year = F.struct(F.lit("Publication Year Range").alias("metric"), x.alias("original_value"), y.alias("normalized_value"), F.when(same, "0").otherwise(F.concat(x, F.lit(" -> "), y)).alias("difference"), F.when(same, "Expected").otherwise("Configuration Driven").alias("classification"))
    rows.append(F.when(x.isNotNull() & y.isNotNull(), year))
    return both.select(F.explode(F.filter(F.array(*rows), lambda r: r.isNotNull())).alias("r")).select("r.*")


def scores(fields: DataFrame, kept: DataFrame) -> DataFrame:
    """One row: coverage, quality, status and class of a mapping."""
    f = fields.agg(
        F.count_if(F.col("target_field").isin(MANDATORY)).alias("must"),
        F.count_if(F.col("target_field").isin(MANDATORY) & F.col("status").isin("PASS", "NOT_AVAILABLE_FROM_SOURCE")).alias("met"),
        F.avg(F.when(F.col("status") != "NOT_AVAILABLE_FROM_SOURCE", 1 - F.col("null_percentage") / 100)).alias("populated"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count(F.lit(1)).alias("n"),
        # the mapped part warns about nothing; a mandatory tag does, once
        F.count_if((F.col("source_field") == F.col("target_field")) & (F.col("status") == "WARNING") & F.col("target_field").isin(MANDATORY)).alias("warn2"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.count_if((F.col("source_field") == "N/A") & (F.col("status") == "FAILED")).alias("absent"),
    )
    k = kept.agg(F.count_if(F.col("classification") == "Unexpected").alias("unexpected"))
    j = f.crossJoin(k)  # one row each
    coverage = F.when(F.col("must") > 0, F.round(F.col("met") / F.col("must") * 100, 1)).otherwise(0.0)
    j = j.withColumn("field_coverage_score", coverage).withColumn("warnings", F.col("warn2") + F.col("absent") + F.col("unexpected"))
    quality = (
        F.col("field_coverage_score") * 0.30
        + F.coalesce("populated", F.lit(0.0)) * 100 * 0.25
        + F.col("passed") / F.greatest("n", F.lit(1)) * 100 * 0.20
        + F.greatest(100 - F.least(F.col("warnings") * 5.0, F.lit(40.0)), F.lit(0.0)) * 0.15
        + F.greatest(100 - F.least(F.col("unexpected") * 20.0, F.lit(80.0)), F.lit(0.0)) * 0.10
    )
    c = F.col("field_coverage_score")
    return j.select(
        "field_coverage_score",
        F.round(quality, 1).alias("mapping_quality_score"),
        F.when((F.col("failed") > 0) | (F.col("unexpected") > 0), "FAILED").when(F.col("warnings") > 0, "WARNING").when(c >= 95, "PASS").otherwise("PASS_WITH_INFORMATION").alias("overall_status"),
        F.when(c >= 100, "EXCELLENT").when(c >= 95, "GOOD").when(c >= 90, "ACCEPTABLE").otherwise("NEEDS_REVIEW").alias("coverage_class"),
    )


def recommendations(status: str, unexpected: bool, coverage: float, required: float = 95.0) -> list[str]:
    out = []
    if status == "FAILED":
        out.append("Review failed field mappings and correct source-to-target assignments")
    if unexpected:
        out.append("Investigate unexpected metadata loss during normalization")
    if coverage < required:
        out.append(f"Field coverage ({coverage:.1f}%) is below threshold ({required}%)")
    return out
