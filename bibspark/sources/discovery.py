"""What export files are: database, format, confidence, schema, groups, and which may be merged."""

from __future__ import annotations

import csv
import enum
import io
import os
import re
import time
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bibspark.operators.mapping import detect_database, profile
from bibspark.schema import INDICATORS, MANDATORY_SOURCE, PATTERNS
from bibspark.sources import files as _files
from bibspark.sources.readers import encoding_of, format_of, sniff_delimiter

EXTENSIONS = (".csv", ".txt", ".ris", ".nbib", ".bib", ".bibtex", ".ciw", ".enw", ".end", ".xml")
MINIMUM_CONFIDENCE = 0.95


class Status(enum.Enum):
    PENDING = "PENDING"
    RUNNING = "RUNNING"
    PASSED = "PASSED"
    FAILED = "FAILED"
    SKIPPED = "SKIPPED"
    BLOCKED = "BLOCKED"
    NOT_EXECUTED = "NOT_EXECUTED"


@dataclass
class FileRecord:
    path: str
    name: str
    size: int
    encoding: str
    delimiter: str
    column_names: list[str]
    field_tags: list[str]
    database_source: str
    export_format: str
    confidence: float
    notes: list[str] = field(default_factory=list)

    def to_dict(self) -> dict:
        return asdict(self)


def discover(spark: SparkSession, folder: str, extensions: tuple[str, ...] = EXTENSIONS) -> list[str]:
    """All files below a folder with one of the endings, sorted."""
    return [p for p in _files.walk(spark, folder) if p.lower().endswith(extensions)]


def confidence_of(database: str, columns: list[str]) -> float:
    """A column that only this database has is near certain; else the share of its usual columns."""
    have = set(columns)
    if have & set(INDICATORS.get(database, ())):
        return 0.97
    usual = PATTERNS.get(database, [])
    must = MANDATORY_SOURCE.get(database, [])
    if not usual:
        return 0.0
    if database == "Web of Science":
        return 0.97 if set(must) <= have and "PT" in have else 0.9 if set(must) <= have else 0.7
    return round(min(0.95, 0.6 + 0.35 * len(have & set(usual)) / len(usual)), 2)


def level(confidence: float) -> str:
    return "HIGH" if confidence >= 0.95 else "MEDIUM" if confidence >= 0.80 else "LOW"


def identify(spark: SparkSession, path: str) -> FileRecord:
    """Look at the beginning of a file."""
    raw = _files.head(spark, path)
    enc = encoding_of(raw)
    head = raw.decode(enc, errors="replace")
    cols: list[str] = []
    tags: list[str] = []
    delim = ""
    if path.lower().endswith(".csv"):
        delim = sniff_delimiter(head)
        cols = next(csv.reader(io.StringIO(head), delimiter=delim), [])
        cols = [c.lstrip("﻿") for c in cols]
    else:
        tags = list(dict.fromkeys(re.findall(r"(?m)^﻿?([A-Z][A-Z0-9])(?: |$)", head)))
    db = detect_database(cols or tags, [os.path.basename(path)])
    return FileRecord(path, os.path.basename(path), _files.size(spark, path), enc, delim, cols, tags, db, format_of([path]), confidence_of(db, cols or tags))


def accept(record: FileRecord, minimum: float = MINIMUM_CONFIDENCE, low: str = "skip") -> Status:
    if record.confidence >= minimum:
        return Status.PENDING
    if low == "abort":
        raise ValueError(f"{record.name}: confidence {record.confidence} is below {minimum}")
    return Status.SKIPPED


#: Source columns that hold a number.
NUMBERS = ("PubYear", "Year", "Publication Year", "PY", "publication_year")


def schema_check(df: DataFrame, database: str) -> tuple[list[dict], float]:
    """Each mandatory source column as PRESENT, EMPTY, MALFORMED or MISSING, and the share of those present.

    A column of numbers is malformed if most of its values are none; ``encoding_valid`` tells whether no value lost characters.
    """
    must = MANDATORY_SOURCE.get(database, [])
    here = [c for c in must if c in df.columns]
    filled = {r.field: (r.total, r.empty) for r in profile(df, here).collect()} if here else {}  # one row for each column
    value = lambda c: F.col(f"`{c}`").cast("string")
    odd = df.agg(*[F.count_if(~value(c).rlike(r"^\s*\d+(?:\.0*)?\s*$") & (value(c) != "")).alias(f"n{k}") if c in NUMBERS else F.lit(0).alias(f"n{k}") for k, c in enumerate(here)], *[F.count_if(F.contains(value(c), F.lit("\ufffd"))).alias(f"e{k}") for k, c in enumerate(here)]).first() if here else None
    out = []
    for c in must:
        total, empty = filled.get(c, (0, 0))
        k = here.index(c) if c in here else -1
        status = "MISSING" if k < 0 else "EMPTY" if total == empty else "MALFORMED" if odd[f"n{k}"] * 2 > total - empty else "PRESENT"
        out.append({"field": c, "status": status, "filled": total - empty, "encoding_valid": k < 0 or odd[f"e{k}"] == 0})
    present = sum(x["status"] == "PRESENT" for x in out)
    return out, round(present / len(must), 4) if must else 0.0


def may_merge(a: str, b: str, cross: bool = False) -> tuple[bool, str]:
    if a == b:
        return True, f"ALLOWED: both from {a}"
    if cross:
        return True, f"ALLOWED: {a} with {b} by configuration"
    return False, f"BLOCKED: {a} and {b} are different databases"


def groups(files: DataFrame) -> DataFrame:
    """(group_id, source_database, files) by database, numbered in order of its name."""
    g = files.groupBy("source_database").agg(F.count(F.lit(1)).alias("files"))
    n = F.dense_rank().over(Window.orderBy("source_database"))  # one row for each database
    return g.select(F.format_string("Group_%03d_%s", n, F.regexp_replace("source_database", " ", "_")).alias("group_id"), "source_database", "files")


def group_records(files: DataFrame, counts: DataFrame) -> DataFrame:
    """``groups`` with the names of the files and their records in all, from (source_file, records)."""
    g = groups(files).withColumnRenamed("files", "n")
    each = files.join(counts, "source_file", "left").groupBy("source_database").agg(F.array_join(F.array_sort(F.collect_list("source_file")), ", ").alias("file_names"), F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"))  # the files of a database
    return g.join(each, "source_database").select("group_id", "source_database", F.col("n").alias("files"), "file_names", "total_records")


def merge_pairs(groups_: DataFrame) -> DataFrame:
    """Every two groups and whether they may be merged; there is one group for each database."""
    a = groups_.select(F.col("group_id").alias("a"), F.col("source_database").alias("da"))
    b = groups_.select(F.col("group_id").alias("b"), F.col("source_database").alias("db"))
    return a.join(F.broadcast(b), F.col("a") < F.col("b")).select("a", "b", (F.col("da") == F.col("db")).alias("allowed"), F.when(F.col("da") == F.col("db"), "ALLOWED").otherwise("BLOCKED").alias("reason"))


def report(records: list[FileRecord], version: str = "2.0.0", run_id: str | None = None, schemas: dict[str, tuple[list[dict], float]] | None = None) -> dict:
    """What a discovery run found: files, databases, fields of each file's schema, warnings."""
    low = [r.name for r in records if level(r.confidence) == "LOW"]
    return {
        "framework_version": version,
        "run_id": run_id or f"run_{time.strftime('%Y%m%d_%H%M%S')}",
        "provenance": {"module": __name__, "files": [r.path for r in records]},
        "schema": {name: {"fields": fields, "score": score} for name, (fields, score) in (schemas or {}).items()},
        "identification": [r.to_dict() for r in records],
        "summary": {"files": len(records), "databases": sorted({r.database_source for r in records})},
        "warnings": {"low_confidence": low} if low else None,
    }
