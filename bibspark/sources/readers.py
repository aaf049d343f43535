"""Readers of export files, and the numbering of their records."""

from __future__ import annotations

import csv
import os
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bibspark.functions.text import let, strip
from bibspark.operators.clean import tag_names
from bibspark.operators.mapping import detect_database, to_tags
from bibspark.schema import EXTRA_TAGS, TAGS
from bibspark.sources import files

LISTS = ("AU", "AF", "CR")
FORMATS = {".txt": "TXT", ".ciw": "TXT", ".csv": "CSV", ".ris": "RIS", ".bib": "BIB", ".bibtex": "BIB", ".nbib": "NBIB", ".enw": "ENW", ".end": "ENW", ".xml": "XML", ".json": "JSON"}
#: Spark's names of the encodings that ``encoding_of`` tells.
CHARSETS = {"utf-8": "UTF-8", "cp1252": "windows-1252", "latin-1": "ISO-8859-1"}
#: RIS, MEDLINE, BibTeX and EndNote names -> field tags.
RIS = {"TI": "TI", "T1": "TI", "AU": "AU", "A1": "AU", "JO": "SO", "T2": "SO", "JF": "SO", "PY": "PY", "Y1": "PY", "DO": "DI", "AB": "AB", "KW": "DE", "LA": "LA", "SN": "SN", "VL": "VL", "IS": "IS", "SP": "BP", "EP": "EP", "PB": "PU", "AN": "UT", "AD": "C1"}
NBIB = {"TI": "TI", "AU": "AU", "FAU": "AF", "JT": "SO", "DP": "PY", "LID": "DI", "AB": "AB", "OT": "DE", "MH": "ID", "LA": "LA", "PMID": "UT", "AD": "C1", "PT": "DT"}
BIBTEX = {"title": "TI", "author": "AU", "journal": "SO", "booktitle": "SO", "year": "PY", "doi": "DI", "abstract": "AB", "keywords": "DE", "volume": "VL", "number": "IS", "pages": "BP", "issn": "SN", "publisher": "PU", "language": "LA"}
ENDNOTE = {"T": "TI", "A": "AU", "J": "SO", "B": "SO", "D": "PY", "R": "DI", "X": "AB", "K": "DE", "V": "VL", "N": "IS", "P": "BP", "@": "SN", "I": "PU", "G": "LA", "M": "UT", "+": "C1", "0": "DT"}


def list_files(spark: SparkSession, folder: str, count: int = 0) -> list[str]:
    """Sorted .txt files, then .csv files, then those of other known formats; ``count`` above 0 asks for so many in all."""
    here = files.names(spark, folder)
    known = [n for n in here if format_of([n]) != "UNKNOWN"]
    order = lambda n: (0 if n.lower().endswith(".txt") else 1 if n.lower().endswith(".csv") else 2, n)
    if not known:
        raise FileNotFoundError(f"no file of a known format in {folder}")
    if count and len(known) != count:
        raise ValueError(f"{len(known)} files in {folder}, not {count}: {', '.join(sorted(known))}")
    return [f"{folder.rstrip('/')}/{n}" for n in sorted(known, key=order)]


def format_of(names: list[str]) -> str:
    """Format of the first file with a known ending."""
    return next((f for n in names for e, f in FORMATS.items() if n.lower().endswith(e)), "UNKNOWN")


def encoding_of(head: bytes) -> str:
    try:
        head.decode("utf-8")
        return "utf-8"
    except UnicodeDecodeError as e:
        if e.start > len(head) - 4 and e.reason == "unexpected end of data":  # a character cut at the end of the sample
            return "utf-8"
    return "cp1252" if any(0x80 <= b < 0xA0 for b in head) else "latin-1"


def _charset(spark: SparkSession, path: str) -> str:
    """Spark's name of the encoding that the beginning of a file shows."""
    return CHARSETS[encoding_of(files.head(spark, path))]


def _text(spark: SparkSession, path: str, sep: str) -> DataFrame:
    return spark.read.option("encoding", _charset(spark, path)).text(path, lineSep=sep).select("value", F.col("_metadata.file_name").alias("_f"))


def sniff_delimiter(sample: str) -> str:
    try:
        return csv.Sniffer().sniff(sample, delimiters=",;\t|").delimiter
    except csv.Error:
        return ","


def stamp(df: DataFrame, file: Column) -> DataFrame:
    """``source_file``, ``original_index`` (place in the file) and ``record_id`` for rows in file order.

    Rows are numbered within the read partitions; partitions start where those before them end, by a
    small table of counts, so a large file isn't gathered.
    """
    d = df.withColumn("source_file", file).withColumn("_m", F.monotonically_increasing_id()).withColumn("_p", F.shiftright("_m", 33))
    w = Window.partitionBy("source_file", "_p").orderBy("_m")
    sums = d.groupBy("source_file", "_p").agg(F.count(F.lit(1)).alias("_n"))
    before = sums.select("source_file", "_p", F.coalesce(F.sum("_n").over(Window.partitionBy("source_file").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    n = d.withColumn("_k", F.row_number().over(w) - 1).join(before, ["source_file", "_p"])  # already partitioned like this
    return n.withColumn("original_index", F.col("_start") + F.col("_k")).withColumn("record_id", F.concat_ws("_", "source_file", F.col("original_index").cast("string"))).drop("_m", "_p", "_k", "_n", "_start")


def _fold(block: Column) -> Column:
    """(tag, value) of one tagged block: hard wraps of 80 characters joined, list lines by ``;``."""
    tag = F.substring(block, 1, 2)

    def join(lines: Column) -> Column:
        n = F.size(lines)
        hard = F.forall(F.slice(lines, F.lit(1), F.greatest(n - 1, F.lit(1))), lambda x: F.length(x) == 80)
        many = F.when(hard, F.array_join(lines, "")).otherwise(F.when(tag.isin(*LISTS), F.array_join(F.transform(lines, strip), "; ")).otherwise(F.array_join(F.transform(lines, strip), " ")))
        return F.when(n == 1, F.element_at(lines, 1)).otherwise(many)

    text = F.regexp_replace(F.substring(block, F.lit(3), F.length(block)), "^ {1,2}", "")
    return F.struct(tag.alias("tag"), strip(let(F.split(text, "\\n {3}"), join)).alias("value"))


def parse_tagged(df: DataFrame, text: str = "value") -> DataFrame:
    """One row for each tagged record text -> a column for each tag that the records know."""
    body = F.regexp_replace(F.translate(F.col(text), "\r\ufeff", ""), "(?m)^(?:FN|VR|E[RF])(?: [^\\n]*)?(?:\\n|$)", "")
    blocks = F.filter(F.split(F.regexp_replace(body, "^\\s+|\\s+$", ""), "\\n(?=[A-Z][A-Z0-9](?: |\\n|$))"), lambda b: b.rlike("^[A-Z][A-Z0-9]( |$)"))

    def as_map(e: Column) -> Column:
        # the first of repeated tags counts
        tags = F.transform(e, lambda x: x["tag"])
        return F.when(F.size(F.array_distinct(tags)) == F.size(tags), F.map_from_entries(e)).otherwise(F.map_from_entries(F.filter(e, lambda x, i: F.array_position(tags, x["tag"]) == i + 1)))

    m = df.withColumn("_m", let(F.transform(blocks, _fold), as_map))
    return m.select(*[c for c in df.columns if c != text], *[F.try_element_at("_m", F.lit(t)).alias(t) for t in TAGS + EXTRA_TAGS])


def read_tagged(spark: SparkSession, path: str) -> DataFrame:
    """Tagged text with or without closing ER lines, with Unix or Windows line ends."""
    head = files.head(spark, path, 1 << 20).decode("latin-1")
    nl = "\r\n" if "\r\n" in head else "\n"
    sep = f"{nl}ER{nl}" if re.search(r"\r?\nER *\r?\n", head) else f"{nl}{nl}"
    raw = _text(spark, path, sep)
    rows = parse_tagged(raw).where("PT IS NOT NULL OR TI IS NOT NULL OR AU IS NOT NULL")
    return stamp(rows, F.col("_f")).drop("_f")


def _broken_lines(spark: SparkSession, path: str) -> bool:
    """Whether a quoted value goes on in another line: some line has an odd number of quotes."""
    lines = spark.read.text(path)
    return not lines.where(F.pmod(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))), F.lit(2)) == 1).isEmpty()


def read_delimited(spark: SparkSession, path: str, delimiter: str | None = None) -> DataFrame:
    """CSV with a sniffed delimiter; every column is text. A file without line breaks inside values is read in splits."""
    charset = _charset(spark, path)
    sep = delimiter or sniff_delimiter(files.head(spark, path, 8192).decode("utf-8", errors="replace"))
    read = spark.read.option("header", True).option("sep", sep).option("escape", '"').option("mode", "PERMISSIVE").option("encoding", charset)
    df = read.option("multiLine", _broken_lines(spark, path)).csv(path)
    cols = df.columns
    return stamp(df.select(*[F.col(f"`{c}`") for c in cols], F.col("_metadata.file_name").alias("_f")), F.col("_f")).drop("_f")


def _joined(tags: list[str]) -> Column:
    return F.array_join(F.transform(F.filter("_p", lambda p: p["t"].isin(*tags)), lambda p: p["v"]), "; ")


def read_ris(spark: SparkSession, path: str, medline: bool = False) -> DataFrame:
    """RIS or MEDLINE records: repeated tags become ``;`` lists."""
    tags = NBIB if medline else RIS
    raw = _text(spark, path, "\n\n" if medline else "\nER  -")
    lines = F.split(F.regexp_replace(F.regexp_replace(F.col("value"), "\r", ""), "\\n {6}", " "), "\\n")
    pair = F.filter(F.transform(lines, lambda x: F.struct(strip(F.regexp_extract(x, "^([A-Z][A-Z0-9]{1,3}) *- ?(.*)$", 1)).alias("t"), strip(F.regexp_extract(x, "^([A-Z][A-Z0-9]{1,3}) *- ?(.*)$", 2)).alias("v"))), lambda p: (p["t"] != "") & (p["v"] != ""))
    by: dict[str, list[str]] = {}
    for source, tag in tags.items():
        by.setdefault(tag, []).append(source)
    cols = [_joined(s).alias(tag) for tag, s in by.items()]
    return stamp(raw.withColumn("_p", pair).where(F.size("_p") > 0).select("_f", *cols), F.col("_f")).drop("_f")


def _tagged_pairs(raw: DataFrame, pairs: Column, tags: dict[str, str]) -> DataFrame:
    """Records of (name, value) pairs as tags; repeated names become ``;`` lists."""
    by: dict[str, list[str]] = {}
    for source, tag in tags.items():
        by.setdefault(tag, []).append(source)
    rows = raw.withColumn("_p", pairs).where(F.size("_p") > 0)
    return stamp(rows.select("_f", *[_joined(s).alias(t) for t, s in by.items()]), F.col("_f")).drop("_f")


def read_bibtex(spark: SparkSession, path: str) -> DataFrame:
    """BibTeX entries, one for each line that begins with ``@``; braces inside values are left out, authors become a list."""
    raw = _text(spark, path, "\n@")
    field = r"(?s)([A-Za-z_][\w-]*)\s*=\s*(?:\{((?:[^{}]|\{[^{}]*\})*)\}|\"([^\"]*)\"|(\d+))"
    part = lambda k: F.regexp_extract_all("value", F.lit(field), F.lit(k))
    value = lambda i: F.concat(F.element_at(part(2), i), F.element_at(part(3), i), F.element_at(part(4), i))
    flat = lambda x: strip(F.regexp_replace(F.regexp_replace(x, "[{}]", ""), "\\s+", " "))
    pairs = F.transform(part(1), lambda n, i: F.struct(F.lower(n).alias("t"), flat(value(i + 1)).alias("v")))
    rows = _tagged_pairs(raw, F.filter(pairs, lambda p: p["v"] != ""), BIBTEX)
    return rows.withColumn("AU", F.regexp_replace("AU", "\\s+and\\s+", "; "))


def read_endnote(spark: SparkSession, path: str) -> DataFrame:
    """EndNote's tagged format: ``%T value`` lines, records parted by blank lines."""
    raw = _text(spark, path, "\n\n")
    lines = F.split(F.regexp_replace("value", "\r", ""), "\\n")
    get = lambda x, k: strip(F.regexp_extract(x, "^%(\\S) ?(.*)$", k))
    return _tagged_pairs(raw, F.filter(F.transform(lines, lambda x: F.struct(get(x, 1).alias("t"), get(x, 2).alias("v"))), lambda p: (p["t"] != "") & (p["v"] != "")), ENDNOTE)


def read_xml(spark: SparkSession, path: str, row: str = "record") -> DataFrame:
    """EndNote's XML export: the texts of a record's elements, in their order."""
    raw = spark.read.text(path, lineSep=f"</{row}>").select("value", F.col("_metadata.file_name").alias("_f")).where(F.contains("value", F.lit(f"<{row}")))
    plain = lambda x: strip(F.regexp_replace(F.regexp_replace(x, "<[^>]*>", ""), "\\s+", " "))
    every = lambda tag: F.array_join(F.transform(F.regexp_extract_all("value", F.lit(f"(?s)<{tag}(?: [^>]*)?>(.*?)</{tag}>"), F.lit(1)), plain), "; ")
    names = {"TI": "title", "AU": "author", "SO": "secondary-title", "PY": "year", "DI": "electronic-resource-num", "AB": "abstract", "DE": "keyword", "VL": "volume", "IS": "number", "LA": "language", "SN": "isbn", "UT": "accession-num"}
    return stamp(raw.select("_f", *[every(n).alias(t) for t, n in names.items()]), F.col("_f")).drop("_f")


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines or an array of objects; nested values as JSON text. Lines are read in splits."""
    array = files.head(spark, path, 4096).lstrip(b"\xef\xbb\xbf \t\r\n").startswith(b"[")
    df = spark.read.option("multiLine", array).json(path)
    flat = [F.col(f"`{f.name}`").cast("string").alias(f.name) if f.dataType.typeName() not in ("array", "struct", "map") else F.to_json(f"`{f.name}`").alias(f.name) for f in df.schema.fields]
    return stamp(df.select(*flat, F.col("_metadata.file_name").alias("_f")), F.col("_f")).drop("_f")


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """A file of any known format as tags; unknown databases keep their columns under unique names."""
    kind = format_of([path])
    tagged = {"TXT": read_tagged, "RIS": read_ris, "NBIB": lambda s, p: read_ris(s, p, True), "BIB": read_bibtex, "ENW": read_endnote, "XML": read_xml}
    if kind in tagged:
        return tagged[kind](spark, path)
    df = read_json(spark, path) if kind == "JSON" else read_delimited(spark, path)
    db = detect_database([c for c in df.columns if c not in ("record_id", "source_file", "original_index")], [os.path.basename(path)])
    if db in ("Unknown", "Web of Science"):
        return tag_names(df)
    return to_tags(df.withColumn("idx", F.col("original_index")), db).withColumnRenamed("idx", "original_index")


def merge(parts: list[DataFrame]) -> DataFrame:
    """All rows by column name, missing columns null, with ``idx`` in order of the parts."""
    out = None
    for k, p in enumerate(parts):
        p = p.withColumn("_part", F.lit(k))
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    if out is None:
        raise ValueError("nothing to merge")
    # numbers that grow with part and place need no global sort
    return out.withColumn("idx", F.shiftleft(F.col("_part").cast("long"), 40) + F.coalesce(F.col("original_index"), F.monotonically_increasing_id())).drop("_part")


def import_folder(spark: SparkSession, folder: str, warn: Callable[[str], None] = print, fail: Callable[[str], None] | None = None, count: int = 0, one_database: bool = False) -> DataFrame:
    """All readable non-empty files of a folder, merged; the rest is reported: empty files to ``warn``, broken ones to ``fail``.

    With ``one_database`` files of different databases may not be merged.
    """
    fail = fail or warn
    parts, kinds = [], {}
    for f in list_files(spark, folder, count):
        try:
            d = read_any(spark, f) if files.size(spark, f) else None
            if d is None or d.isEmpty():
                warn(f"{f}: no records")
                continue
        except Exception as e:  # a broken file doesn't stop the import
            fail(f"{f}: {type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}")
            continue
        parts.append(d)
        kinds[f] = detect_database(_columns(spark, f, d), [os.path.basename(f)])
    if one_database and len(set(kinds.values())) > 1:
        raise ValueError("files of different databases: " + ", ".join(f"{os.path.basename(f)} ({db})" for f, db in kinds.items()))
    for f, db in kinds.items():
        if db == "Unknown":
            warn(f"{f}: unknown database")
    return merge(parts)


def _columns(spark: SparkSession, path: str, df: DataFrame) -> list[str]:
    """The source's own column names: the header of a table, else the tags."""
    if format_of([path]) != "CSV":
        return df.columns
    head = files.head(spark, path, 8192).decode("utf-8", errors="replace")
    return [c.lstrip("\ufeff") for c in next(csv.reader(head.splitlines(), delimiter=sniff_delimiter(head)), [])]


def import_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("source_file").agg(F.count(F.lit(1)).alias("records"))


def provenance(df: DataFrame) -> DataFrame:
    """One row for each imported record, with what has been done to it."""
    return df.select("record_id", "source_file", F.col("original_index" if "original_index" in df.columns else "idx").alias("original_index"), F.lit(None).cast("long").alias("final_index"), F.array(F.lit("imported")).alias("transformations"), F.lit("imported").alias("status"))
