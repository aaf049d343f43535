"""Descriptive analysis of a collection, and networks of values that occur together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibspark.functions.text import filled, parts


def biblio_analysis(df: DataFrame) -> DataFrame:
    """One row: sources, documents, authors, appearances, single-authored documents, co-authors a document."""
    n = F.size(parts("AU"))
    base = df.agg(
        F.count_distinct(F.when(filled("SO"), F.col("SO"))).alias("sources"),
        F.count(F.lit(1)).alias("documents"),
        F.coalesce(F.sum(F.when(n > 0, n)), F.lit(0)).alias("appearances"),
        F.count_if(n == 1).alias("single_authored"),
    )
    who = df.select(F.explode(parts("AU")).alias("a")).agg(F.count_distinct("a").alias("authors"))
    return base.crossJoin(who).select("sources", "documents", "authors", "appearances", "single_authored", F.round(F.col("appearances") / F.col("documents"), 6).alias("coauthors_per_doc"))  # one row each


def top(df: DataFrame, value: Column, name: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent values, ties by value: a report of fixed length by design."""
    return df.select(value.alias(name)).where(F.col(name).isNotNull() & (F.col(name) != "")).groupBy(name).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), name).limit(k)


def annual_production(df: DataFrame) -> DataFrame:
    return df.where("PY IS NOT NULL").groupBy(F.col("PY").cast("int").alias("year")).agg(F.count(F.lit(1)).alias("n"))


def most_cited(df: DataFrame, k: int = 10) -> DataFrame:
    return df.where("TC IS NOT NULL").select("record_id", F.col("TC").cast("long").alias("cited")).orderBy(F.desc("cited"), "record_id").limit(k)


def occurring_together(df: DataFrame, values: Column) -> DataFrame:
    """(a, b, n) with a < b: how many documents hold both values.

    Each value of a row's list is paired with the values behind it, by two explosions that stream one pair at
    a time: no self-join, and no value's group is ever gathered; the count combines before the shuffle.
    """
    v = df.select(F.array_sort(F.array_distinct(values)).alias("v")).where(F.size("v") > 1)
    first = v.select(F.posexplode("v").alias("i", "a"), "v")
    return first.select("a", F.explode(F.slice("v", F.col("i") + 2, F.size("v"))).alias("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def coupling(df: DataFrame, values: Column) -> DataFrame:
    """(idx, values, links): for each document the values it holds, and how many times other documents hold them.

    The links of bibliographic coupling by document: their number is added up from the frequency of each value,
    so a value that a third of all documents hold costs one row a document and no pair of documents is made.
    """
    each = df.select("idx", F.explode(F.array_distinct(values)).alias("v"))
    often = each.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    return each.join(often, "v").groupBy("idx").agg(F.count(F.lit(1)).alias("values"), F.sum(F.col("n") - 1).alias("links"))
