"""The form that bibliometric tools read: required tags, defaults, author and keyword lists, accession numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibspark.functions.text import accession, author_order, compat_year, keyword_list, strip
from bibspark.schema import COMPAT_REQUIRED, INTERNAL, TAGS

DEFAULTS = {"PT": "J", "LA": "English", "DT": "Article"}


def repairs(df: DataFrame) -> int:
    """Columns that must be added, plus one for the author form."""
    return sum(c not in df.columns for c in COMPAT_REQUIRED) + 1


def compatible(df: DataFrame, keep_internal: bool = False) -> DataFrame:
    have = set(df.columns)
    value = {c: F.col(c) for c in df.columns}
    for c in COMPAT_REQUIRED:
        value.setdefault(c, F.lit(""))
    for c, d in DEFAULTS.items():
        value[c] = F.when(value[c].isNull() | (value[c] == ""), F.lit(d)).otherwise(value[c])
    ti, di, ut = value["TI"], value.get("DI", F.lit(None).cast("string")), value["UT"]
    value["AU"] = author_order(value["AU"])
    value["DE"], value["ID"] = keyword_list(value["DE"]), keyword_list(value["ID"])
    value["PY"] = compat_year("PY") if "PY" in have else F.lit(0)
    value["UT"] = accession(ut, di, ti)
    if "DI" in have:
        value["DI"] = F.coalesce(strip("DI"), F.lit(""))
    first = [c for c in TAGS if c in value]
    rest = [c for c in value if c not in first and c not in INTERNAL and not c.startswith("__")]
    return df.select(*[F.col(c) for c in INTERNAL if keep_internal and c in have], *[value[c].alias(c) for c in first + rest])
