"""Registry of the core queries: each runs one operator over its whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibspark.functions import text as X
from bibspark.operators import analysis, certify, clean, compat, dedup, mapping, packed, screening, validate
from bibspark.session import cut, ensure_checkpoint_dir, read_table
from bibspark.sources import discovery, files, readers, sinks
from bibspark.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
RECORD_TAGS = "PT AU AF TI SO PY DT DI DE ID AB CR C1 RP TC LA UT".split()
#: Names of the Dimensions table's columns in an export of that source.
DIMENSIONS = {"publication_id": "Publication ID", "title": "Title", "authors": "Authors", "source_title": "Source title", "pubyear": "PubYear", "times_cited": "Times cited"}


def records(spark: SparkSession, d: str) -> DataFrame:
    """bib_records under tag names, with the internal columns idx, record_id and source_file."""
    df = read_table(spark, d, "bib_records")
    return df.select("idx", "record_id", "source_file", *[F.col(t.lower()).alias(t) for t in RECORD_TAGS])


def mappings(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "duplicate_mappings")


def kept(spark: SparkSession, d: str) -> DataFrame:
    """Records that no match names as a duplicate of another."""
    m = mappings(spark, d).where("duplicate_of IS NOT NULL AND trim(duplicate_of) <> '' AND duplicate_of <> record_id").select("record_id").distinct()
    return records(spark, d).join(m, "record_id", "left_anti")


def dimensions(spark: SparkSession, d: str) -> DataFrame:
    df = read_table(spark, d, "dimensions_rows")
    return df.select(*[F.col(c).alias(n) for c, n in DIMENSIONS.items()])


def cleaned(spark: SparkSession, d: str) -> DataFrame:
    return clean.cleaned(records(spark, d))


def compatible(spark: SparkSession, d: str) -> DataFrame:
    return compat.compatible(cleaned(spark, d), keep_internal=True)


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Issues by severity after exact DOI matching and cleaning."""
    r = records(spark, d)
    left = r.join(dedup.exact_duplicates(r, "DI", "doi_exact").select("idx"), "idx", "left_anti")
    return validate.issues_by(validate.validation_issues(clean.cleaned(left)), "severity")


# --- sources and merging


def import_counts(spark, d):
    return readers.import_counts(records(spark, d))


def merge_union_by_name(spark, d):
    dim = mapping.to_tags(dimensions(spark, d), "Dimensions").withColumn("record_id", F.col("UT")).withColumn("source_file", F.lit("dimensions"))
    wos = records(spark, d).select("record_id", "source_file", "AU", "TI", "SO", F.col("PY").cast("string").alias("PY"), F.col("TC").cast("string").alias("TC"), "UT", "LA")
    both = wos.unionByName(dim, allowMissingColumns=True)
    return both.select("record_id", "source_file", "AU", "TI", "SO", "PY", "TC", "UT", "LA")


def provenance(spark, d):
    p = readers.provenance(records(spark, d))
    return p.select("record_id", "source_file", "original_index", F.array_join("transformations", ",").alias("transformations"), "status")


def detect_database(spark, d):
    """The database that each table's own columns tell, under the names they have in an export."""
    heads = {"bib_records": [t for t in RECORD_TAGS if t.lower() in read_table(spark, d, "bib_records").columns], "dimensions_rows": dimensions(spark, d).columns, "documents": read_table(spark, d, "documents").columns}
    rows = [(n, mapping.detect_database(cols), len(cols)) for n, cols in sorted(heads.items())]
    return spark.createDataFrame(rows, "table_name string, detected string, columns int")


def database_group_records(spark, d):
    return discovery.group_records(read_table(spark, d, "source_files"), readers.import_counts(records(spark, d)))


def database_groups(spark, d):
    return discovery.groups(read_table(spark, d, "source_files"))


def merge_policy_pairs(spark, d):
    return discovery.merge_pairs(database_groups(spark, d))


# --- duplicates


def _dups(spark, d, key, kind):
    r = records(spark, d)
    f = dedup.exact_duplicates(r, key, kind)
    return f.select("idx", "keep", "match_type", "similarity_score")


def dedup_doi_exact(spark, d):
    return _dups(spark, d, "DI", "doi_exact")


def dedup_ut_exact(spark, d):
    return _dups(spark, d, "UT", "ut_exact")


def group_places(spark, d):
    return dedup.rank_in_group(records(spark, d), "DI").select("idx", "place")


def title_block_stats(spark, d):
    return dedup.block_stats(records(spark, d))


def title_similarity_pairs(spark, d):
    return dedup.title_pairs(records(spark, d)).select("i", "j", F.round("score", 6).alias("score"))


def title_classes(spark, d):
    return dedup.title_classes(records(spark, d))


def dedup_title_similarity(spark, d):
    return dedup.title_duplicates(records(spark, d)).select("idx", "keep", F.round("similarity_score", 6).alias("score"))


def dedup_author_year(spark, d):
    return dedup.author_duplicates(records(spark, d)).select("idx", "keep", F.round("similarity_score", 6).alias("score"))


def dedup_mappings(spark, d):
    return dedup.dedup(records(spark, d))[1].withColumn("similarity_score", F.round("similarity_score", 6))


def dedup_summary(spark, d):
    return screening.mapping_summary(dedup.dedup(records(spark, d))[1])


def mapping_summary(spark, d):
    return screening.mapping_summary(mappings(spark, d).where("match_type IS NOT NULL"))


# --- validation


def validation_issues(spark, d):
    return validate.validation_issues(records(spark, d))


def issues_by_severity(spark, d):
    return validate.issues_by(validation_issues(spark, d), "severity")


def issues_by_field(spark, d):
    return validate.issues_by(validation_issues(spark, d), "field", "issue_type")


# --- cleaning


def _one(spark, d, field, e):
    return records(spark, d).select("idx", e.alias(field))


def clean_doi(spark, d):
    return _one(spark, d, "di", X.clean_doi("DI"))


def clean_keywords(spark, d):
    return _one(spark, d, "de", X.normal_semicolons("DE"))


def clean_authors(spark, d):
    return _one(spark, d, "au", X.normal_authors("AU"))


def clean_years(spark, d):
    return _one(spark, d, "py", X.clean_year("PY"))


def normal_titles(spark, d):
    return _one(spark, d, "title", X.normal_title("TI"))


def fixed_dashes(spark, d):
    return _one(spark, d, "ti", X.fix_dashes("TI"))


def squeezed_text(spark, d):
    return _one(spark, d, "ti", X.squeeze("TI"))


def countries(spark, d):
    return _one(spark, d, "countries", F.array_join(X.countries("C1"), "; "))


def cleaned_records(spark, d):
    c = cleaned(spark, d)
    return c.select("idx", *[F.col(t).alias(t.lower()) for t in ("TI", "AU", "SO", "PY", "DI", "DE", "ID", "CR", "C1", "SC", "AF")])


def cleaning_actions(spark, d):
    r = records(spark, d)
    return clean.cleaning_actions(r, clean.cleaned(r)).groupBy("field", "action_type").agg(F.count(F.lit(1)).alias("actions"))


def country_counts(spark, d):
    return clean.counts_of(records(spark, d).select(F.explode(X.countries("C1")).alias("value")), "country")


def keyword_counts(spark, d):
    return clean.counts_of(clean.values_of(records(spark, d), "DE"), "keyword")


def journal_counts(spark, d):
    return records(spark, d).where(~X.is_blank("SO")).groupBy(F.col("SO").alias("journal")).agg(F.count(F.lit(1)).alias("n"))


# --- compatibility


def compat_records(spark, d):
    c = compatible(spark, d)
    return c.select("idx", *[F.col(t).alias(t.lower()) for t in ("PT", "AU", "LA", "DT", "DE", "ID", "PY", "UT", "DI")])


def generated_ut(spark, d):
    return records(spark, d).select("idx", X.accession("UT", "DI", "TI").alias("ut"))


def author_format(spark, d):
    return _one(spark, d, "au", X.author_order("AU"))


# --- mapping


def field_profile(spark, d):
    return mapping.profile(records(spark, d), RECORD_TAGS)


def mapping_field_results(spark, d):
    return mapping.field_results(records(spark, d), "Web of Science")


def mapping_field_results_dimensions(spark, d):
    raw = dimensions(spark, d)
    return mapping.field_results(mapping.to_tags(raw, "Dimensions"), "Dimensions", raw.columns)


def metadata_preservation(spark, d):
    return mapping.preservation(records(spark, d), cleaned(spark, d))


def coverage_and_quality(spark, d):
    return mapping.scores(mapping_field_results(spark, d), metadata_preservation(spark, d))


def unmapped_columns(spark, d):
    rows = mapping.unmapped_columns(dimensions(spark, d).columns, "Dimensions")
    return spark.createDataFrame(rows, "column_name string, classification string, suggestion string")


# --- certification and reports


def layer1_checks(spark, d):
    return certify.layer1(compatible(spark, d))


def author_format_sample(spark, d):
    return certify.author_sample(records(spark, d))


def year_range(spark, d):
    return certify.year_range(records(spark, d))


def doi_coverage(spark, d):
    return certify.coverage(records(spark, d), ["DI", "AB"])


def duplicates(spark: SparkSession, d: str) -> DataFrame:
    """One mapping for each record that is a duplicate."""
    return screening.duplicates(mappings(spark, d), records(spark, d))


def screening_log(spark, d):
    return screening.screening_log(kept(spark, d), duplicates(spark, d))


def excluded_studies(spark, d):
    return screening.excluded_studies(duplicates(spark, d))


def _included(spark, d):
    return screening_log(spark, d).where("decision = 'included'")


def prisma_counts(spark, d):
    k = kept(spark, d)
    return screening.flow_counts(readers.import_counts(records(spark, d)), records(spark, d), k, clean.cleaned(k), _included(spark, d), duplicates(spark, d))


def flow_by_file(spark, d):
    k = kept(spark, d)
    return screening.flow_by_file(records(spark, d), k, clean.cleaned(k))


def sync_check(spark, d):
    """The records whose exported text can be read again, against those that the screening log includes."""
    c = compat.compatible(clean.cleaned(kept(spark, d)), keep_internal=True)
    text = sinks.tagged_lines(c.withColumn("idx", F.col("record_id"))).select(F.col("idx").alias("record_id"), F.array_join("lines", "\n").alias("value"))
    back = cut(readers.parse_tagged(text).where("PT IS NOT NULL").select("record_id"))
    return screening.sync_check(back, _included(spark, d))


def quality_score(spark, d):
    return screening.quality(prisma_counts(spark, d), validate.validation_issues(kept(spark, d)), sync_check(spark, d))


# --- text export


def wos_text_lines(spark, d):
    lines = sinks.tagged_lines(records(spark, d))
    return lines.select("idx", F.posexplode("lines").alias("no", "line"))


def wos_record_roundtrip(spark, d):
    """Every record written as tagged text and parsed back, with the fields that come back unchanged."""
    r = records(spark, d)
    t = sinks.tagged_lines(r).select("idx", F.array_join("lines", "\n").alias("value"))
    back = readers.parse_tagged(t)
    same = lambda a, b: F.coalesce(a, F.lit("")) == F.coalesce(b, F.lit(""))
    flat = lambda c: X.strip(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), "[\\r\\n]+", " "))
    j = back.select("idx", F.col("TI").alias("ti2"), F.col("DE").alias("de2"), F.col("AB").alias("ab2")).join(r.select("idx", flat("TI").alias("ti"), flat("DE").alias("de"), flat("AB").alias("ab")), "idx")
    return j.agg(F.count(F.lit(1)).alias("records"), F.count_if(same(F.col("ti"), F.col("ti2"))).alias("titles"), F.count_if(same(F.col("ab"), F.col("ab2"))).alias("abstracts"), F.count_if(same(F.col("de"), F.col("de2"))).alias("keywords"))


# --- analysis


def biblio_analysis(spark, d):
    return analysis.biblio_analysis(records(spark, d))


def _exploded(spark, d, e):
    return records(spark, d).select(F.explode(e).alias("v"))


def top_authors(spark, d):
    return analysis.top(_exploded(spark, d, X.parts("AU")), F.col("v"), "author")


def top_sources(spark, d):
    return analysis.top(records(spark, d), F.col("SO"), "source")


def top_keywords(spark, d):
    return analysis.top(_exploded(spark, d, X.parts("DE")), F.col("v"), "keyword")


def top_countries(spark, d):
    return analysis.top(_exploded(spark, d, X.countries("C1")), F.col("v"), "country")


def annual_production(spark, d):
    return analysis.annual_production(records(spark, d))


def most_cited(spark, d):
    return analysis.most_cited(records(spark, d))


def coauthor_pairs(spark, d):
    return analysis.occurring_together(records(spark, d), X.parts("AU"))


def keyword_cooccurrence(spark, d):
    return analysis.occurring_together(records(spark, d), X.parts("DE"))


def cocitation_pairs(spark, d):
    return analysis.occurring_together(records(spark, d), X.parts("CR"))


def reference_coupling(spark, d):
    return analysis.coupling(records(spark, d), X.parts("CR"))


# --- arriving records


def _into_folder(spark, name: str) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def _stream(spark, d, name: str) -> DataFrame:
    """A table as a stream of its files."""
    path, read = f"{d}/{name}.parquet", spark.readStream.schema(read_table(spark, d, name).schema)
    return read.parquet(path) if files.is_folder(spark, path) else read.option("pathGlobFilter", f"{name}.parquet").parquet(d)


def stream_arrivals(spark, d):
    """Events by hour and type, counted by a stream over the whole table."""
    out = _into_folder(spark, "arrivals")
    stream = _stream(spark, d, "events")
    write = lambda b, no: b.write.mode("overwrite").parquet(f"{out}/table")
    incremental.arrivals(stream, "ts", "event_type").writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", f"{out}/ck").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/table")


def stream_accepted(spark, d):
    """Records that arrive with identifiers not seen before, taken by a stream over the whole table."""
    out = _into_folder(spark, "accepted")
    stream = _stream(spark, d, "bib_records").select("idx", F.col("di").alias("DI"), F.col("ut").alias("UT"))
    incremental.accept(spark, stream, f"{out}/store", f"{out}/ck").awaitTermination()
    return spark.read.parquet(f"{out}/store").select("idx")


# --- problem 1


def p1_found(spark, d):
    return packed.p1_found(read_table(spark, d, "bib_records"))


def queries() -> dict[str, Query]:
    names = """import_counts merge_union_by_name provenance detect_database database_groups database_group_records merge_policy_pairs
        dedup_doi_exact dedup_ut_exact group_places title_block_stats title_similarity_pairs title_classes dedup_title_similarity dedup_author_year dedup_mappings dedup_summary mapping_summary
        validation_issues issues_by_severity issues_by_field
        clean_doi clean_keywords clean_authors clean_years normal_titles fixed_dashes squeezed_text countries cleaned_records cleaning_actions country_counts keyword_counts journal_counts
        compat_records generated_ut author_format field_profile mapping_field_results mapping_field_results_dimensions metadata_preservation coverage_and_quality unmapped_columns
        layer1_checks author_format_sample year_range doi_coverage screening_log excluded_studies prisma_counts flow_by_file sync_check quality_score wos_text_lines wos_record_roundtrip
        biblio_analysis top_authors top_sources top_keywords top_countries annual_production most_cited coauthor_pairs keyword_cooccurrence cocitation_pairs reference_coupling stream_arrivals stream_accepted p1_found""".split()
    return {n: globals()[n] for n in names} | {"flagship": flagship}
