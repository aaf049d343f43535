"""Screening log, included and excluded studies, flow counts, synchronisation and quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicates(mappings: DataFrame, records: DataFrame) -> DataFrame:
    """One mapping for each record that is a duplicate of another: the most similar, then the first by id and type."""
    real = mappings.where("record_id IS NOT NULL AND duplicate_of IS NOT NULL AND trim(duplicate_of) <> '' AND duplicate_of <> record_id").join(records.select("record_id"), "record_id", "left_semi")
    rank = F.struct(-F.coalesce("similarity_score", F.lit(0.0)), "duplicate_of", F.coalesce("match_type", F.lit("")), F.coalesce("source_file", F.lit("")))
    best = real.groupBy("record_id").agg(F.min_by(F.struct("duplicate_of", "match_type", "similarity_score", "source_file"), rank).alias("m"))
    return best.select("record_id", "m.*")


def screening_log(kept: DataFrame, mappings: DataFrame) -> DataFrame:
    inc = kept.select("record_id", F.substring(F.coalesce("TI", F.lit("")), 1, 100).alias("title"), "source_file", F.lit("included").alias("decision"), F.lit("Passed all validation criteria").alias("reason"))
    reason = F.format_string("Duplicate of %s (%s, score=%.1f)", F.coalesce("duplicate_of", F.lit("None")), F.coalesce("match_type", F.lit("None")), F.coalesce("similarity_score", F.lit(0.0)))
    exc = mappings.select("record_id", F.lit("Duplicate - excluded").alias("title"), "source_file", F.lit("excluded").alias("decision"), reason.alias("reason"))
    return inc.unionByName(exc)


def excluded_studies(mappings: DataFrame) -> DataFrame:
    return mappings.select("record_id", F.format_string("Duplicate (%s)", F.coalesce("match_type", F.lit("None"))).alias("excluded_reason"), "duplicate_of", "similarity_score", "source_file")


def mapping_summary(mappings: DataFrame) -> DataFrame:
    return mappings.groupBy(F.lower("match_type").alias("match_type")).agg(F.count(F.lit(1)).alias("n"))


def flow_counts(imported: DataFrame, merged: DataFrame, kept: DataFrame, cleaned: DataFrame, included: DataFrame, excluded: DataFrame) -> DataFrame:
    """One row of counts of the stages; ``imported`` has the records of each file."""
    one = lambda d, n: d.agg(F.count(F.lit(1)).alias(n))
    a = imported.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("imported")).crossJoin(one(merged, "merged")).crossJoin(one(kept, "after_dedup")).crossJoin(one(cleaned, "after_cleaning")).crossJoin(one(included, "included")).crossJoin(one(excluded, "excluded"))  # one row each
    return a.select("imported", "merged", (F.col("merged") - F.col("after_dedup")).alias("duplicates"), "after_dedup", "after_cleaning", "included", "excluded")


def flow_by_file(records: DataFrame, kept: DataFrame, cleaned: DataFrame) -> DataFrame:
    """(source_file, imported, after_dedup, after_cleaning)."""
    count = lambda d, n: d.groupBy("source_file").agg(F.count(F.lit(1)).alias(n))
    j = count(records, "imported").join(count(kept, "after_dedup"), "source_file", "left").join(count(cleaned, "after_cleaning"), "source_file", "left")
    return j.select("source_file", "imported", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("after_dedup", "after_cleaning")])


def sync_check(validated: DataFrame, included: DataFrame, key: str = "record_id") -> DataFrame:
    """One row: the records of either set, those that the other one lacks, and whether both are the same."""
    side = lambda d, n: d.groupBy(key).agg(F.count(F.lit(1)).alias(n))
    j = side(validated, "a").join(side(included, "b"), key, "full")
    a, b = F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0))
    total = lambda c, n: F.coalesce(F.sum(c), F.lit(0)).alias(n)
    out = j.agg(total(a, "validated"), total(b, "included"), total(F.greatest(a - b, F.lit(0)), "only_validated"), total(F.greatest(b - a, F.lit(0)), "only_included"))
    return out.withColumn("synchronized", (F.col("only_validated") == 0) & (F.col("only_included") == 0))


def quality(counts: DataFrame, issues: DataFrame, synced: DataFrame) -> DataFrame:
    """(overall_score, grade, metadata_status) from flow counts, issues and the synchronisation check."""
    n = issues.agg(F.count(F.lit(1)).alias("issues"))
    j = counts.crossJoin(n).crossJoin(synced.select("synchronized", "validated", F.col("included").alias("in_set")))  # one row each
    score = (
        F.lit(100)
        - F.when(F.col("imported") == 0, 25).otherwise(0)
        - F.when(F.col("merged") == 0, 25).otherwise(0)
        - F.when(F.col("after_cleaning") == 0, 20).otherwise(0)
        - F.when(F.col("validated") == 0, 25).otherwise(0)
        - F.when(~F.col("synchronized"), 20).otherwise(0)
        - F.when(F.col("validated") != F.col("in_set"), 15).otherwise(0)
    )
    return j.select(F.greatest(score, F.lit(0)).alias("overall_score"), F.when(F.col("issues") < F.col("after_dedup") * 0.5, "PASS").otherwise("WARNING").alias("metadata_status")).withColumn(
        "grade", F.when(F.col("overall_score") >= 90, "A").when(F.col("overall_score") >= 75, "B").when(F.col("overall_score") >= 60, "C").when(F.col("overall_score") >= 40, "D").otherwise("F")
    )
