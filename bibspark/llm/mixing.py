"""Problem 9: sources mixed to target shares of all tokens.

Systematic sampling. Every document of a source has the same expected number of copies: the tokens the
source must supply divided by the tokens it has, but no more than ``max_repeats``. Expected copies are
summed up along the source; with one random offset for the source, a document comes out once for every
integer the sum crosses. So each document is used either floor or ceiling of the expectation and the
source's total is met within one document's copies.

Documents are lined up from the shortest to the longest, so that every stretch of sizes is used alike
and the tokens follow the expectation, not only the number of documents. The running sum doesn't need a
source in one task: a source is spread over buckets of bounded size (a class of sizes, then a part of
it), numbered within, and started at the number of documents in the buckets before (a table of buckets).

Total: ``total_tokens`` if given, else the tokens of the listed sources; both are an upper bound while
``keep_shares`` is set. Then the total is the largest at which no source needs more than its cap allows,
and every source with documents supplies its share of what is really put together; the shares of sources
without documents go to the others in proportion. Without ``keep_shares`` the total stays, a source at
its cap falls short, and the others' actual shares grow. The report shows target and actual shares.

Defined results: sources that aren't listed, null sources and texts without tokens supply nothing; a
source listed twice counts with the sum of its shares and the smaller cap; a cap or share of null or
below zero counts as zero; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bibspark.llm.tokens import FOLDER, VOCABULARY, with_tokens
from bibspark.session import cut

#: Documents in a bucket, the largest group that one task numbers.
BUCKET = 200_000
SEED = 42


def _plan(sized: DataFrame, targets: DataFrame, total_tokens: int | None, keep_shares: bool) -> DataFrame:
    """One row for each listed source: what it has, what it must supply, expected copies of a document."""
    want = targets.where("source IS NOT NULL").groupBy("source").agg(
        F.sum(F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0))).alias("target_share"), F.min(F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0))).alias("max_repeats")
    )
    have = sized.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_tokens").alias("available"))
    plan = want.join(have, "source", "left").select("source", "target_share", "max_repeats", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("available", F.lit(0)).alias("available"))
    live = (F.col("available") > 0) & (F.col("max_repeats") > 0) & (F.col("target_share") > 0)
    whole = plan.agg(F.sum("available").alias("has"), F.sum(F.when(live, F.col("target_share"))).alias("shares"), F.min(F.when(live, F.col("available") * F.col("max_repeats") / F.col("target_share"))).alias("reach"))
    plan = plan.crossJoin(F.broadcast(whole))  # one row
    total = F.col("has") if total_tokens is None else F.lit(total_tokens)
    if keep_shares:
        # the smallest of what the sources can reach, each for its share among those with documents
        ask = F.when(live, F.col("target_share") / F.col("shares") * F.least(total.cast("double"), F.col("reach") * F.col("shares"))).otherwise(0.0)
    else:
        ask = F.col("target_share") * total
    copies = F.when(F.col("available") > 0, F.least(F.col("max_repeats").cast("double"), F.round(ask / F.col("available"), 9))).otherwise(0.0)
    return plan.withColumn("copies", copies).withColumn("requested", ask).drop("has", "shares", "reach")


def _sized(documents: DataFrame, tokenizer: str) -> DataFrame:
    return cut(with_tokens(documents, ["doc_id", "source"], path=tokenizer).where("n_tokens > 0 AND source IS NOT NULL"))


def mix(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, keep_shares: bool = True, seed: int = SEED, tokenizer: str = f"{FOLDER}/{VOCABULARY}") -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, copy, n_tokens) of the mixture, and the report by source."""
    sized = _sized(documents, tokenizer)
    # listed sources only: a list of a few rows
    plan = cut(_plan(sized, targets, total_tokens, keep_shares))
    n = sized.count()
    parts = max(1, -(-4 * n // BUCKET))
    size_class = F.floor(F.log2(F.col("n_tokens").cast("double")) * 8)
    bucket = size_class * parts + F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(parts))
    used = sized.join(F.broadcast(plan.select("source", "copies")), "source").withColumn("bucket", bucket)
    sums = used.groupBy("source", "bucket").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = sums.withColumn("start", F.coalesce(F.sum("n").over(w), F.lit(0))).select("source", "bucket", "start")
    order = Window.partitionBy("source", "bucket").orderBy("n_tokens", F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id")
    k = used.withColumn("k", F.row_number().over(order)).join(start, ["source", "bucket"])
    # one offset in [0, 1) for each source
    offset = F.pmod(F.xxhash64("source", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    place = F.col("start") + F.col("k")
    k = cut(k.withColumn("times", (F.floor(place * F.col("copies") + offset) - F.floor((place - 1) * F.col("copies") + offset)).cast("int")))
    out = k.where("times > 0").select("doc_id", "source", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"), "n_tokens")
    reached = k.groupBy("source").agg(F.sum(F.col("times") * F.col("n_tokens")).alias("tokens"), F.sum("times").alias("used"))
    rep = plan.join(reached, "source", "left").select("source", "target_share", "max_repeats", "documents", "available", "copies", "requested", F.coalesce("used", F.lit(0)).alias("used"), F.coalesce("tokens", F.lit(0)).alias("tokens"))
    total = rep.agg(F.sum("tokens").alias("all_tokens"))
    rep = rep.crossJoin(F.broadcast(total)).select(  # one row
        "source",
        "target_share",
        F.when(F.col("all_tokens") > 0, F.col("tokens") / F.col("all_tokens")).otherwise(0.0).alias("actual_share"),
        F.when(F.col("requested") > 0, F.col("tokens") / F.col("requested")).otherwise(0.0).alias("supplied"),
        "max_repeats",
        F.col("copies").alias("expected_copies"),
        ((F.col("available") == 0) | (F.col("copies") >= F.col("max_repeats"))).alias("capped"),
        "documents",
        F.col("used").alias("copies_used"),
        "tokens",
    )
    return out, rep
