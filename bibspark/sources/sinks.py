"""Writers of datasets and documents."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bibspark.functions.text import chunks, squeeze, strip
from bibspark.schema import EXTRA_TAGS, TAGS, TEXT_ALWAYS, WRAPPED
from bibspark.sources import files

HEADER = ["FN Clarivate Analytics Web of Science", "VR 1.0"]
WIDTH = 80


def _lines_of(f: Column) -> Column:
    """The lines of one field: none if it is blank and may be, several if it is long and may be wrapped."""
    v, lead = f["v"], f["lead"]
    many = F.transform(chunks(v, WIDTH), lambda c, i: F.concat(F.when(i == 0, lead).otherwise(F.lit("   ")), c))
    return F.when((v == "") & ~f["always"], F.array().cast("array<string>")).when(f["wrap"] & (F.length(v) > WIDTH), many).otherwise(F.array(F.concat(lead, v)))


def tagged_lines(df: DataFrame, flavour: str = "export") -> DataFrame:
    """(idx, lines): the lines of each record. ``flavour`` export closes with ER, validation doesn't."""
    export = flavour == "export"
    have = set(df.columns)
    text = lambda c: F.coalesce(F.regexp_replace(F.col(c).cast("string"), "[\\r\\n]+", " "), F.lit("")) if c in have else F.lit("")
    value = {t: strip(text(t)) for t in TAGS + EXTRA_TAGS if t in have}
    for t, d in (("PT", "J"), ("LA", "English"), ("DT", "Article")):
        value[t] = F.when(text(t) == "", F.lit(d)).otherwise(strip(text(t)))
    for t in ("C1", "RP", "DE", "CR", "UT"):
        value.setdefault(t, F.lit(""))
    af = strip(text("AF"))
    value["C1"] = F.when((value["C1"] == "") & (af != ""), F.concat(F.lit("[Unknown] "), af)).otherwise(value["C1"])
    value["RP"] = F.when((value["RP"] == "") & (af != ""), strip(F.element_at(F.split(af, ";"), 1))).otherwise(value["RP"])
    fields = []
    for t in TAGS + EXTRA_TAGS:
        if t in value:
            v = value[t] if export else squeeze(value[t])
            lead = "PT " if t == "PT" and export else f"{t}  "
            fields.append(F.struct(F.lit(lead).alias("lead"), v.alias("v"), F.lit(t in WRAPPED).alias("wrap"), F.lit(t in TEXT_ALWAYS and export).alias("always")))
    end = [F.array(F.lit("ER"), F.lit(""))] if export else [F.array(F.lit(""))]
    # a lambda's variable is computed once, however often its lines refer to it
    return df.select("idx", F.concat(F.flatten(F.transform(F.array(*fields), _lines_of)), *end).alias("lines"))


def write_tagged(df: DataFrame, path: str, flavour: str = "export") -> None:
    """Tagged text in import order; every part file starts with the header and is complete by itself."""
    # ranges are drawn from the records, before the lines are made
    rows = tagged_lines(df.repartitionByRange("idx").sortWithinPartitions("idx"), flavour).select(F.array_join("lines", "\n").alias("value"))
    head = "\n".join(HEADER) + "\n"

    def run(batches):
        first = True
        for b in batches:
            if first and len(b):
                b = b.copy()
                b.iloc[0, 0] = head + b.iloc[0, 0]
                first = False
            yield b

    rows.mapInPandas(run, "value string").write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with a header, without internal columns; one file only if asked for."""
    out = df.drop(*[c for c in df.columns if c.startswith("__") or c in ("idx", "record_id", "imported_at")])
    (out.coalesce(1) if single else out).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


#: Rows of a sheet, and what a workbook isn't for.
SHEET_ROWS = 1_000_000


def write_xlsx(df: DataFrame, path: str) -> bool:
    """A workbook on a local path, rows streamed to it, if the optional library is there; False if it was skipped."""
    try:
        from openpyxl import Workbook
    except ImportError:
        return False
    book, sheet = Workbook(write_only=True), None
    for k, row in enumerate(df.toLocalIterator()):
        if k % SHEET_ROWS == 0:
            sheet = book.create_sheet()
            sheet.append(df.columns)
        sheet.append([str(x) if isinstance(x, (list, dict)) else x for x in row])
    if sheet is None:
        book.create_sheet().append(df.columns)
    book.save(path)
    return True


def write_json(spark: SparkSession, doc: dict, path: str) -> None:
    files.write_text(spark, path, json.dumps(doc, ensure_ascii=False, indent=2, default=str))


def read_audit(spark: SparkSession, path: str) -> list | dict:
    """A JSON log; an unreadable or missing one is an empty list."""
    try:
        return json.loads(files.read_text(spark, path)) if files.exists(spark, path) else []
    except ValueError:
        return []


def markdown(title: str, tables: dict[str, list[dict]]) -> str:
    """A report with one section and table for each entry."""
    out = [f"# {title}", ""]
    for name, rows in tables.items():
        out += [f"## {name}", ""]
        if rows:
            keys = list(rows[0])
            out += ["| " + " | ".join(keys) + " |", "|" + "---|" * len(keys)]
            out += ["| " + " | ".join(str(r.get(k, "")) for k in keys) + " |" for r in rows]
        else:
            out.append("none")
        out.append("")
    return "\n".join(out)


def flow_text(counts: dict, duplicates: dict[str, int]) -> str:
    """The counts of the stages as plain text."""
    rows = [("Records imported", counts.get("imported", 0)), ("Duplicates removed", sum(duplicates.values())), *[(f"  {k}", v) for k, v in sorted(duplicates.items())]]
    rows += [(f"  {k}", v) for k, v in sorted(counts.get("per_file", {}).items())]
    rows += [("Merged", counts.get("merged", counts.get("imported", 0))), ("After deduplication", counts.get("after_dedup", 0)), ("After cleaning", counts.get("after_cleaning", 0)), ("Included", counts.get("included", counts.get("after_cleaning", 0)))]
    return "\n".join(f"{name:<24}{n:>12,}" for name, n in rows) + "\n"


def summary_text(counts: dict, errors: int) -> str:
    """One line for each count of a finished run."""
    issues = counts.get("issues", {})
    rows = [
        ("Imported", counts.get("imported", 0)), ("Merged", counts.get("merged", 0)), ("Duplicates", sum(counts.get("duplicates", {}).values())), ("After deduplication", counts.get("after_dedup", 0)),
        ("Validation issues", sum(issues.values())), ("Metadata repairs", counts.get("repairs", 0)), ("After cleaning", counts.get("after_cleaning", 0)), ("Included", counts.get("included", 0)),
        ("Synchronized", "yes" if counts.get("synchronized") else "no"), ("Errors", errors),
    ]
    return "\n".join(f"{name:<24}{n:>12}" for name, n in rows) + "\n"


def write_mapping_report(sheets: dict[str, DataFrame], folder: str) -> None:
    """One CSV for each sheet: summary, field mapping, unmapped columns, metadata preservation."""
    for name, df in sheets.items():
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder.rstrip('/')}/{name}")  # a few dozen rows each


#: What an export leaves.
OUTPUTS = ("Master_Dataset.csv", "Bibliometrix_Compatible.csv", "Bibliometrix_Compatible.txt", "Included_Studies.csv", "Excluded_Studies.csv", "Screening_Log.csv", "Validation_Issues.parquet", "Provenance_Log.json", "Audit_Log.json", "R_Validation.json", "PRISMA_Flow.txt", "Pipeline_Summary.txt", "Run_History.json", "Validation_Report.md", "Screening_Report.md", "Certification_Report.md", "Execution_Summary.md")


def verify_outputs(spark: SparkSession, folder: str, names: list[str] | tuple[str, ...] = OUTPUTS) -> dict[str, bool]:
    """Whether each file or folder is there and not empty."""
    ok = {}
    for n in names:
        p = f"{folder.rstrip('/')}/{n}"
        ok[n] = files.exists(spark, p) and (files.size(spark, p) > 0 or len([x for x in files.walk(spark, p) if not x.rsplit("/", 1)[-1].startswith((".", "_"))]) > 0)
    return ok


def first_filled(*frames: DataFrame | None) -> DataFrame | None:
    """The first dataset with rows."""
    return next((f for f in frames if f is not None and not f.isEmpty()), None)


def record_count(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("value").startswith("PT ")).agg(F.count(F.lit(1)).alias("records"))

