"""The stages in order, over a folder of export files or a frame of records."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibspark.operators import analysis, certify, clean, compat, dedup, mapping, screening, validate
from bibspark.plans import audit
from bibspark.session import cut, ensure_checkpoint_dir
from bibspark.sources import files, readers, sinks


@dataclass
class State:
    """Frames of the stages, lazy but for those that are used several times."""

    imported: DataFrame | None = None
    kept: DataFrame | None = None
    mappings: DataFrame | None = None
    issues: DataFrame | None = None
    cleaned: DataFrame | None = None
    compatible: DataFrame | None = None
    included: DataFrame | None = None
    excluded: DataFrame | None = None
    screening: DataFrame | None = None
    mapping: dict = field(default_factory=dict)
    certification: dict = field(default_factory=dict)
    counts: dict = field(default_factory=dict)
    quality: dict = field(default_factory=dict)
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    log: list[dict] = field(default_factory=list)
    audit: audit.AuditLog = field(default_factory=audit.AuditLog)


class Pipeline:
    """``run`` stops if import or merging fails; other stages record their error and let the rest go on."""

    def __init__(self, spark: SparkSession, title_threshold: float = dedup.TITLE_THRESHOLD, author_threshold: float = dedup.AUTHOR_THRESHOLD, validate_mapping: bool = False, file_count: int = 0, one_database: bool = False, log_folder: str | None = None) -> None:
        self.spark = spark
        self.thresholds = title_threshold, author_threshold
        self.validate_mapping = validate_mapping
        self.file_count, self.one_database = file_count, one_database
        self.logger = audit.logger(log_folder)

    def _stages(self):
        yield "deduplicate", self._dedup
        yield "validate", self._validate
        yield "clean", self._clean
        if self.validate_mapping:
            yield "mapping", self._mapping
        yield "compat", self._compat
        yield "certify", self._certify
        yield "screening", self._screening
        yield "sync", self._sync
        yield "quality", self._quality

    def run(self, source: str | DataFrame, output: str | None = None) -> State:
        s = State()
        self._timed(s, "import", lambda st: self._import(st, source), must=True)
        for name, f in self._stages():
            self._timed(s, name, f)
        if output:
            self._timed(s, "export", lambda st: self._export(st, output))
        return s

    def _timed(self, s: State, name: str, f, must: bool = False) -> None:
        began, error = time.time(), ""
        self.logger.info("%s started", name)
        try:
            f(s)
        except Exception as e:
            error = str(e)
            s.errors.append(f"{name}: {e}")
            self.logger.exception("%s failed", name)
            if must:
                raise
        finally:
            status, seconds = "FAIL" if error else "PASS", round(time.time() - began, 3)
            s.log.append({"stage": name, "status": status, "seconds": seconds})
            s.audit.add(name, status, seconds=seconds, **({"error": error} if error else {}))
            self.logger.info("%s %s in %s s", name, status, seconds)

    def _import(self, s: State, source: str | DataFrame) -> None:
        if isinstance(source, str):
            source = cut(readers.import_folder(self.spark, source, s.warnings.append, s.errors.append, self.file_count, self.one_database))
        s.imported = source
        s.counts["per_file"] = {r.source_file: r.records for r in readers.import_counts(source).collect()}  # the files of a run
        s.counts["imported"], s.counts["merged"] = sum(s.counts["per_file"].values()), source.count()

    def _dedup(self, s: State) -> None:
        kept, m = dedup.dedup(s.imported, *self.thresholds)
        s.mappings, s.kept = cut(m), cut(kept)
        s.counts["after_dedup"] = s.kept.count()
        s.counts["duplicates"] = {r.match_type: r.n for r in screening.mapping_summary(s.mappings).collect()}  # four types

    def _validate(self, s: State) -> None:
        s.issues = validate.validation_issues(s.kept)
        s.counts["issues"] = {r.severity: r.issues for r in validate.issues_by(s.issues, "severity").collect()}  # four severities

    def _clean(self, s: State) -> None:
        s.cleaned = cut(clean.cleaned(s.kept))
        s.counts["after_cleaning"] = s.cleaned.count()

    def _mapping(self, s: State) -> None:
        db = mapping.detect_database(s.imported.columns)
        if db == "Unknown":
            s.counts["mapping"] = {"source_database": db, "overall_status": "WARNING"}
            s.warnings.append("mapping: no mapping for the columns of an unknown database")
            return
        f, k = mapping.field_results(s.cleaned, db), mapping.preservation(s.imported, s.cleaned)
        s.counts["mapping"] = mapping.scores(f, k).first().asDict()
        left = self.spark.createDataFrame(mapping.unmapped_columns(s.imported.columns, db), "column_name string, classification string, suggestion string")
        s.mapping = {"Summary": mapping.scores(f, k), "Field_Mapping": f, "Unmapped_Columns": left, "Metadata": k}

    def _compat(self, s: State) -> None:
        s.compatible = compat.compatible(s.cleaned, keep_internal=True)
        s.counts["repairs"] = compat.repairs(s.cleaned)

    def _certify(self, s: State) -> None:
        lacks = certify.required_fields(s.compatible)
        ok = not lacks and certify.layer1(s.compatible).where("check = 'overall'").first()["status"] == "PASS"
        # what is checked is a file that was really written and read again
        ensure_checkpoint_dir(self.spark)
        path = f"{self.spark.sparkContext.getCheckpointDir()}/certify-{uuid.uuid4().hex}"
        sinks.write_tagged(s.compatible, path, "export")
        written = certify.reread(s.compatible, readers.read_tagged(self.spark, path), [c for c in ("TI", "AU", "SO", "PY", "DI", "UT") if c in s.compatible.columns])
        written["lines"] = sinks.record_count(self.spark.read.text(path)).first()["records"]
        s.certification = certify.certification(ok, written)
        s.certification["missing"] = lacks
        s.certification["analysis"] = analysis.biblio_analysis(s.compatible).first().asDict()

    def _screening(self, s: State) -> None:
        s.excluded = screening.excluded_studies(s.mappings)
        s.screening = cut(screening.screening_log(s.kept, s.mappings))
        s.included = s.kept

    def _sync(self, s: State) -> None:
        """The included studies must be the validated records; if they aren't, they are taken from these."""
        sync = screening.sync_check(s.compatible, s.screening.where("decision = 'included'")).first()
        if not sync["synchronized"]:
            s.warnings.append(f"sync: {sync['only_included']} included studies aren't validated and {sync['only_validated']} validated records aren't included; the validated ones were taken")
            s.screening = cut(screening.screening_log(s.compatible, s.mappings))
        s.included = s.compatible
        after = screening.sync_check(s.compatible, s.screening.where("decision = 'included'")).first()
        s.counts["included"], s.counts["synchronized"] = after["included"], after["synchronized"]

    def _quality(self, s: State) -> None:
        included = s.screening.where("decision = 'included'")
        flow = screening.flow_counts(readers.import_counts(s.imported), s.imported, s.kept, s.cleaned, included, s.excluded)
        s.quality = screening.quality(flow, s.issues, screening.sync_check(s.compatible, included)).first().asDict()

    def _export(self, s: State, output: str) -> None:
        path = lambda n: f"{output.rstrip('/')}/{n}"
        spark = self.spark
        sinks.write_csv(sinks.first_filled(s.cleaned, s.kept, s.imported), path("Master_Dataset.csv"))
        sinks.write_csv(s.included, path("Included_Studies.csv"))
        sinks.write_csv(s.compatible, path("Bibliometrix_Compatible.csv"))
        sinks.write_tagged(s.compatible, path("Bibliometrix_Compatible.txt"))
        s.screening.write.mode("overwrite").option("header", True).csv(path("Screening_Log.csv"))
        s.excluded.write.mode("overwrite").option("header", True).csv(path("Excluded_Studies.csv"))
        s.issues.write.mode("overwrite").parquet(path("Validation_Issues.parquet"))
        readers.provenance(s.imported).write.mode("overwrite").json(path("Provenance_Log.json"))
        doc = {"pipeline_stages": s.log, "stages": {x["stage"]: x for x in s.log}, "r_certification": s.certification, "errors": s.errors, "warnings": s.warnings, "statistics": s.counts, "quality": s.quality}
        sinks.write_json(spark, doc, path("Audit_Log.json"))
        if s.mapping:
            sinks.write_mapping_report(s.mapping, path("Mapping_Report"))
        sinks.write_json(spark, s.certification, path("R_Validation.json"))
        files.write_text(spark, path("PRISMA_Flow.txt"), sinks.flow_text(s.counts, s.counts.get("duplicates", {})))
        files.write_text(spark, path("Pipeline_Summary.txt"), sinks.summary_text(s.counts, len(s.errors)))
        s.audit.save(spark, path("Run_History.json"))
        rows = lambda d: [d] if d else []
        flat = {k: v for k, v in s.certification.items() if k not in ("analysis", "written")}
        reports = {
            "Validation_Report.md": ("Validation", {"Issues by severity": [{"severity": k, "issues": n} for k, n in s.counts.get("issues", {}).items()]}),
            "Screening_Report.md": ("Screening", {"Records of each file": [{"file": k, "records": n} for k, n in s.counts.get("per_file", {}).items()], "Duplicates": [{"type": k, "records": n} for k, n in s.counts.get("duplicates", {}).items()], "Included": [{"records": s.counts.get("included", 0), "synchronized": s.counts.get("synchronized")}]}),
            "Certification_Report.md": ("Certification", {"Layers": rows(flat), "Written and read again": rows(s.certification.get("written"))}),
            "Execution_Summary.md": ("Execution summary", {"Stages": s.log, "Quality": rows(s.quality), "Certification": rows(flat), "Analysis": rows(s.certification.get("analysis")), "Warnings": [{"warning": w} for w in s.warnings], "Errors": [{"error": e} for e in s.errors]}),
        }
        if s.mapping:
            reports["Mapping_Report.md"] = ("Mapping", {name: [r.asDict() for r in d.collect()] for name, d in s.mapping.items()})  # a few dozen rows each
        for name, (title, tables) in reports.items():
            files.write_text(spark, path(name), sinks.markdown(title, tables))
        missing = [n for n, ok in sinks.verify_outputs(spark, output).items() if not ok]
        if missing:
            raise RuntimeError("not written: " + ", ".join(missing))
