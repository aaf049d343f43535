"""Structural checks of a finished dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibspark.functions.text import filled, number, percent, strip
from bibspark.schema import LAYER1_MANDATORY, LAYER1_RECOMMENDED, YEARS
from bibspark.sources import files


def layer1(df: DataFrame) -> DataFrame:
    """(check, status, value): rows, required and recommended columns, filling of each required field."""
    need = [c for c in LAYER1_MANDATORY if c in df.columns]
    gone = [c for c in LAYER1_MANDATORY if c not in df.columns]
    less = [c for c in LAYER1_RECOMMENDED if c not in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(filled(F.col(c).cast("string"))).alias(c) for c in need])
    pct = lambda c: F.when(F.col("n") > 0, F.col(c) / F.col("n") * 100).otherwise(0.0)
    row = lambda name, status, value: F.struct(F.lit(name).alias("check"), status.alias("status"), value.cast("double").alias("value"))
    ok = (F.col("n") > 0) & F.lit(not gone)
    rows = [
        row("record_count", F.when(F.col("n") > 0, "PASS").otherwise("FAIL"), F.col("n")),
        row("mandatory_columns", F.lit("FAIL" if gone else "PASS"), F.lit(len(need))),
        row("recommended_columns", F.lit("WARNING" if less else "PASS"), F.lit(len(LAYER1_RECOMMENDED) - len(less))),
        *[row(f"filled_{c}", F.when(pct(c) < 50, "WARNING").otherwise("PASS"), percent(c, "n")) for c in need],
        row("overall", F.when(ok, "PASS").otherwise("FAIL"), ok.cast("int")),
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def author_sample(df: DataFrame, rows: int = 50) -> DataFrame:
    """(sampled, with_comma, status): author form of the first rows in import order, a sample by design."""
    s = df.orderBy("idx").limit(rows).where("AU IS NOT NULL")
    return s.agg(F.count(F.lit(1)).alias("sampled"), F.count_if(F.contains("AU", F.lit(","))).alias("with_comma")).select(
        "sampled", "with_comma", F.when(F.col("with_comma") > 0.5 * F.col("sampled"), "PASS").otherwise("WARNING").alias("status")
    )


def year_range(df: DataFrame) -> DataFrame:
    y = number("PY")
    return df.agg(F.min(y).cast("int").alias("first_year"), F.max(y).cast("int").alias("last_year"), F.count(y).alias("valid_years")).withColumn(
        "status", F.when((F.col("first_year") >= YEARS[0]) & (F.col("last_year") <= YEARS[1]), "PASS").otherwise("WARNING")
    )


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, present, percentage) of filled values."""
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(filled(F.col(c).cast("string"))).alias(c) for c in columns])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("present"), percent(c, "n").alias("percentage")) for c in columns])).alias("r")).select("r.*")


def required_fields(df: DataFrame, fields: tuple[str, ...] = ("AU", "TI", "SO", "PY")) -> list[str]:
    """The fields without which a dataset can't be analysed and that it lacks."""
    return [f for f in fields if f not in df.columns]


def fingerprint(df: DataFrame, fields: list[str]) -> DataFrame:
    """One row: the records, and for each field a sum of hashes that doesn't depend on their order."""
    text = lambda c: strip(F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), "[\\r\\n]+", " "))
    return df.agg(F.count(F.lit(1)).alias("records"), *[F.coalesce(F.sum(F.xxhash64(text(c)).cast("decimal(38,0)")), F.lit(0)).alias(c) for c in fields])


def reread(written: DataFrame, back: DataFrame, fields: list[str]) -> dict:
    """Whether a dataset that was written and read again holds as many records and the same values of each field."""
    a, b = fingerprint(written, fields).first(), fingerprint(back, fields).first()
    return {"records": a["records"], "reread": b["records"], "changed": [f for f in fields if a[f] != b[f]]}


def file_hash(spark: SparkSession, path: str) -> str:
    """First 16 digits of the SHA-256 of a file's bytes, read where they lie."""
    one = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("h"))
    return one.first()["h"][:16]


def certification_id(spark: SparkSession, path: str) -> str:
    return f"cert_{file_hash(spark, path)}"


#: What a finished run leaves besides the dataset.
REPORTS = ("Audit_Log.json", "R_Validation.json", "Execution_Summary.md", "PRISMA_Flow.txt")


def certification_checks(spark: SparkSession, audit: dict, folder: str, dataset: str) -> dict[str, bool]:
    """Checks of a finished run, from its audit document and its files."""
    stages, cert = audit.get("stages") or {}, audit.get("r_certification") or {}
    path = f"{folder.rstrip('/')}/{dataset}"
    return {
        "stages_passed": bool(stages) and all(x.get("status") == "PASS" for x in stages.values()),
        "certified": bool(cert.get("certified")) or bool(cert) and all(isinstance(x, dict) and x.get("success") for x in cert.values()),
        "no_errors": not audit.get("errors"),
        "dataset_exists": files.exists(spark, path),
        "dataset_filled": files.size(spark, path) > 0,
        "reports": all(files.size(spark, f"{folder.rstrip('/')}/{n}") > 0 for n in REPORTS),
    }


def certification(layer1_pass: bool, written: dict) -> dict:
    """Certified if the structure holds and the written text reads back as what it was (see ``reread``)."""
    layer2 = written["records"] > 0 and written["reread"] == written["records"] and not written["changed"]
    ok = layer1_pass and layer2
    return {"layer1": layer1_pass, "layer2": layer2, "certified": ok, "success": ok or layer1_pass or layer2, "status": "READY_FOR_BIBLIOSHINY" if ok else "NOT_CERTIFIED", "written": written}
