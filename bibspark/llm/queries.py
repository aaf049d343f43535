"""Queries of the problems that this subpackage solves, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibspark.llm import canonical, components, garbled, linkage, mixing, names, packing, spam, survivorship
from bibspark.session import read_table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return garbled.p2_found(read_table(spark, d, "bib_records"))


def p3_entities(spark: SparkSession, d: str) -> DataFrame:
    """Each mention with the entity it means."""
    return names.entities(read_table(spark, d, "name_mentions"), read_table(spark, d, "institutions"), read_table(spark, d, "journals"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return names.p3_found(read_table(spark, d, "name_mentions"), read_table(spark, d, "institutions"), read_table(spark, d, "journals"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    groups = components.p5_found(read_table(spark, d, "duplicate_mappings"))
    return survivorship.survivors(read_table(spark, d, "bib_records"), groups, read_table(spark, d, "source_files"))


def p4_exact_fields(spark: SparkSession, d: str) -> DataFrame:
    """The survivors of the fields whose quality SQL can tell."""
    return p4_found(spark, d).where("fld IN ('cr', 'di')")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return components.p5_found(read_table(spark, d, "duplicate_mappings"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.map_values(read_table(spark, d, "bib_records"), read_table(spark, d, "journals"), read_table(spark, d, "institutions"))


def p7_matches(spark: SparkSession, d: str) -> DataFrame:
    """The matches with their confidence."""
    return linkage.link(read_table(spark, d, "bib_records"), read_table(spark, d, "dimensions_rows"), read_table(spark, d, "journals"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_matches(spark, d).select("idx", "publication_id")


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(read_table(spark, d, "documents"), read_table(spark, d, "pack_specs"))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.report(p8_packed(spark, d))


def p8_kept(spark: SparkSession, d: str) -> DataFrame:
    """What packing promises, by spec: every document is there, no sequence is overfull, only long documents are cut, no token is lost."""
    p = p8_packed(spark, d)
    docs = p.groupBy("spec_id", "capacity_tokens", "doc_id").agg(F.count(F.lit(1)).alias("pieces"), F.sum("n_tokens").alias("tokens"), F.max(F.col("start_token") + F.col("n_tokens")).alias("end"))
    bins = p.groupBy("spec_id", "capacity_tokens", "bin_id").agg(F.sum("n_tokens").alias("used")).groupBy("spec_id").agg(F.count_if(F.col("used") > F.col("capacity_tokens")).alias("overfull"))
    kept = docs.groupBy("spec_id").agg(F.count(F.lit(1)).alias("documents"), F.count_if((F.col("pieces") > 1) & (F.col("tokens") <= F.col("capacity_tokens"))).alias("cut_needlessly"), F.count_if(F.col("tokens") != F.col("end")).alias("incomplete"))
    return kept.join(bins, "spec_id")


def p9_mixed(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(read_table(spark, d, "documents"), read_table(spark, d, "mix_targets"))[0]


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(read_table(spark, d, "documents"), read_table(spark, d, "mix_targets"))[1]


def p9_kept(spark: SparkSession, d: str) -> DataFrame:
    """What mixing promises, by listed source: no document beyond its cap, copies numbered from 1, none of another source."""
    used = p9_mixed(spark, d).groupBy("source", "doc_id").agg(F.count(F.lit(1)).alias("copies"), F.max("copy").alias("last"))
    caps = read_table(spark, d, "mix_targets").groupBy("source").agg(F.min("max_repeats").alias("max_repeats"))
    both = caps.join(used, "source", "full")
    return both.groupBy("source").agg(F.max("max_repeats").alias("max_repeats"), F.count_if(F.coalesce(F.col("copies") > F.col("max_repeats"), F.col("max_repeats").isNull())).alias("beyond_cap"), F.count_if(F.col("copies") != F.col("last")).alias("misnumbered"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spam.spam_pages(read_table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p2_found": p2_found, "p3_found": p3_found, "p3_entities": p3_entities, "p4_found": p4_found, "p4_exact_fields": p4_exact_fields, "p5_found": p5_found, "p6_found": p6_found, "p7_found": p7_found, "p7_matches": p7_matches, "p8_packed": p8_packed, "p8_report": p8_report, "p8_kept": p8_kept, "p9_mixed": p9_mixed, "p9_report": p9_report, "p9_kept": p9_kept, "p10_found": p10_found}
