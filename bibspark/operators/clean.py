"""Cleaning of single fields and of whole records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibspark.functions.text import clean_doi, clean_year, countries, fix_dashes, normal_authors, normal_semicolons, parts
from bibspark.schema import INTERNAL

TEXT_FIELDS = ("TI", "AB", "SO", "AU", "AF", "DE", "ID", "C1")


def tag_names(df: DataFrame) -> DataFrame:
    """Column names stripped and in upper case, internal ones untouched; repeated names get _1, _2 ..."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        n = c if c in INTERNAL else c.strip().upper()
        k = seen.get(n, 0)
        seen[n] = k + 1
        names.append(n if k == 0 else f"{n}_{k}")
    return df.toDF(*names)


def cleaned(df: DataFrame) -> DataFrame:
    """Dashes, years, authors, DOIs and lists brought to one form; rows without TI, AU and SO dropped."""
    have = set(df.columns)
    cols = {c: F.col(c) for c in df.columns}
    for c in TEXT_FIELDS:
        if c in have:
            cols[c] = fix_dashes(cols[c])
    if "PY" in have:
        cols["PY"] = clean_year("PY")
    if "AU" in have:
        cols["AU"] = normal_authors(cols["AU"])
    if "DI" in have:
        cols["DI"] = clean_doi("DI")
    for c in ("DE", "ID", "CR"):
        if c in have:
            cols[c] = normal_semicolons(cols[c])
    if "C1" in have and "SC" not in have:
        cols["SC"] = F.array_join(countries(cols["C1"]), "; ")
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)} - set(INTERNAL) - {"PY"} | {"SC"}
    out = df.select(*[(F.coalesce(e, F.lit("")) if c in strings else e).alias(c) for c, e in cols.items()])
    keys = [c for c in ("TI", "AU", "SO") if c in have]
    if keys:
        empty = F.lit(True)
        for c in keys:
            empty = empty & (F.col(c) == "")
        out = out.where(~empty)
    return out


def cleaning_actions(before: DataFrame, after: DataFrame, fields: tuple[str, ...] = TEXT_FIELDS + ("DI",)) -> DataFrame:
    """(record_id, field, original_value, cleaned_value, action_type, source_file) of all changed values."""
    fs = [c for c in fields if c in before.columns and c in after.columns]
    new = after.select("idx", *[F.col(c).alias(f"new_{c}") for c in fs])
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("original_value"), F.col(f"new_{c}").alias("cleaned_value")) for c in fs])
    changed = F.filter(pairs, lambda x: ~F.coalesce(x["original_value"], F.lit("")).eqNullSafe(x["cleaned_value"]))
    return before.join(new, "idx").select("record_id", "source_file", F.explode(changed).alias("x")).select("record_id", "x.field", "x.original_value", "x.cleaned_value", F.lit("normalised").alias("action_type"), "source_file")


def values_of(df: DataFrame, field: str, sep: str = ";") -> DataFrame:
    """(value): one row for each part of a list field."""
    return df.select(F.explode(parts(field, sep)).alias("value"))


def counts_of(values: DataFrame, name: str) -> DataFrame:
    return values.groupBy(F.col("value").alias(name)).agg(F.count(F.lit(1)).alias("n"))
