"""Problem 4: the best representative of each duplicate group, field by field.

One aggregation per group: for every field the extremum of one composite struct (quality of the
value, trust in its source, time of import, id). Quantities of which the larger wins are negated and
``min`` is taken, which is the maximum of the composite and lets the smallest id win ties. The
aggregate is computed partially before the shuffle, so a group of any size costs one row per task.

Quality, smaller is better:
* ``ab``: a whole readable text (0), a whole one that is garbled (1), one cut short (2, then the
  one that keeps more characters). A publisher's notice at the end doesn't count. A text that only
  says there is no abstract isn't usable.
* ``cr``: more different cited works. * ``di``: any complete DOI, however written.

Defined results: blank values, incomplete DOIs and members missing from the record table take no
part; a null trust or time ranks last; no row for a field without a usable value; repeated rows and
extra columns change nothing.
"""

from __future__ import annotations

import re
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibspark.llm.garbled import examine
from bibspark.session import cut

FIELDS = ("ab", "cr", "di")

#: A text that only says there is no abstract: nothing but a word for that, or a short note of which one sentence
#: has both a word for abstracts and a denial.
NO_ABSTRACT = re.compile(r"^\W*(?:n\W?a|none|null|not available|abstract|summary)\W*$", re.I)
NOTE = 250
_ABSTRACTS = re.compile(r"\b(?:abstracts?|summar(?:y|ies)|resumen|resúmenes|resumos?|résumés?|zusammenfassung(?:en)?|аннотаци\w+)\b", re.I)
_DENIAL = re.compile(r"\b(?:no|not|none|never|without|missing|unavailable|withheld|lacks?|absent|sin|sem|não|sans|pas|kein\w*|ohne|nicht|fehlt|нет|не|без)\b", re.I)


def _only_denies(text: str) -> bool:
    return bool(NO_ABSTRACT.match(text)) or (len(text) <= NOTE and any(_ABSTRACTS.search(s) and _DENIAL.search(s) for s in re.split(r"(?<=[.!?;])\s+", text)))


NOTICE = re.compile(r"\s*(?:©|\(c\)|copyright)\s*(?:\(c\)\s*|©\s*)?\d{4}\b.{0,200}$", re.I | re.S)
CUT_MARK = re.compile(r"\s*(?:\[\s*(?:truncated|cut|…|\.\.\.)\s*\]|\(truncated\)|…|\.\.\.+)\s*$", re.I)
WHOLE_END = re.compile(r"[.!?。][\"”’»)\]\s]*$")
DOI = r"10\.\d{4,9}/[^\s]*[A-Za-z0-9]"


def abstract_quality(text: str | None) -> tuple[int, int] | None:
    """(rank, minus kept characters for cut texts), or None if the text isn't usable."""
    if text is None or not text.strip():
        return None
    bad, restored = examine(text, "ab")
    body = NOTICE.sub("", (restored or text).strip()).strip()
    if not body or _only_denies(body):
        return None
    kept = CUT_MARK.sub("", body)
    if kept != body or not WHOLE_END.search(body):
        return 2, -len(kept.rstrip())
    return (1, 0) if bad else (0, 0)


@F.pandas_udf(T.StructType([T.StructField("rank", T.IntegerType()), T.StructField("size", T.IntegerType())]))
def _ab_quality(col: pd.Series) -> pd.DataFrame:
    got = [abstract_quality(t) or (None, None) for t in col]
    return pd.DataFrame({"rank": pd.array([g[0] for g in got], "Int32"), "size": pd.array([g[1] for g in got], "Int32")})


def different_works(cr) -> F.Column:
    """Number of different works in a ``;`` list, compared without case, spacing and final stops."""
    parts = F.transform(F.split(F.lower(cr), ";"), lambda p: F.regexp_replace(F.regexp_replace(p, r"(?U)\s+", " "), r"^ | ?\.? ?$", ""))
    return F.size(F.array_distinct(F.filter(parts, lambda p: p != "")))


#: Group members of which the list may be broadcast: some 40 MB.
BROADCAST = 300_000


def survivors(records: DataFrame, groups: DataFrame, sources: DataFrame, bound: int = BROADCAST) -> DataFrame:
    """(group_id, fld, record_id) from records, (record_id, group_id) and the trusted-source list.

    Texts are judged where they are read and only ranks are moved. A short list of members is broadcast
    before that, so the texts of other records aren't judged at all.
    """
    trust = sources.groupBy("source_file").agg(F.min("trust_rank").alias("trust_rank"))  # one row per file: fixed, small
    groups = cut(groups.select("record_id", "group_id"))
    small = groups.count() <= bound
    rows = records.select("record_id", "source_file", "imported_at", "ab", "cr", "di")
    if small:
        rows = rows.join(F.broadcast(groups), "record_id")
    rows = rows.withColumn("q", _ab_quality("ab")).select(
        "record_id",
        "source_file",
        *(["group_id"] if small else []),
        F.coalesce(-F.unix_micros(F.col("imported_at").cast("timestamp")), F.lit(2**63 - 1)).alias("late"),
        F.col("q.rank").alias("ab_1"),
        F.col("q.size").alias("ab_2"),
        F.when(different_works("cr") > 0, -different_works("cr")).alias("cr_1"),
        F.lit(0).alias("cr_2"),
        F.when(F.col("di").rlike(DOI), 0).alias("di_1"),
        F.lit(0).alias("di_2"),
    )
    if not small:
        rows = rows.join(groups, "record_id")
    rows = rows.join(trust, "source_file", "left").withColumn("trust", F.coalesce(F.col("trust_rank").cast("int"), F.lit(2**31 - 1)))
    best = [F.min(F.when(F.col(f"{f}_1").isNotNull(), F.struct(f"{f}_1", f"{f}_2", "trust", "late", "record_id"))).getField("record_id").alias(f) for f in FIELDS]
    wide = rows.groupBy("group_id").agg(*best)
    return wide.select("group_id", F.explode(F.array(*[F.struct(F.lit(f).alias("fld"), F.col(f).alias("record_id")) for f in FIELDS])).alias("x")).select("group_id", "x.fld", "x.record_id").where("record_id IS NOT NULL")
