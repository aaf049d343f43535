"""Problem 8: documents packed into sequences of a fixed number of tokens.

Best-fit decreasing: documents are taken from the longest to the shortest, and each goes into the open
sequence with the least room that still holds it. A segment tree over the remaining capacities finds
that sequence in O(log capacity). A document longer than a sequence is cut into whole sequences and a
rest; nothing else is ever cut.

Documents are spread over partitions of a bounded number of items, each packed by itself. Every
partition leaves only a few sequences with much room; in further levels such sequences are packed
together as wholes, in ever fewer partitions, until one partition sees all that are left.

Defined results: texts without tokens are not packed; a capacity below 1 raises; equal sizes are taken
in the order of ``doc_id``; repeated rows are packed as often as they occur; empty tables give an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibspark.llm.tokens import FOLDER, VOCABULARY, with_tokens
from bibspark.session import cut

#: Items one task packs at a time: some 100 MB of numbers.
BOUND = 500_000
#: Sequences with more room than this share of the capacity are packed again with others.
LOOSE = 0.02
MAX_LEVELS = 8


class TightestFit:
    """Open sequences by their remaining capacity, in a segment tree of counts."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << max(1, capacity.bit_length())
        self.tree = [0] * (2 * self.size)
        self.open: dict[int, list[int]] = {}

    def add(self, room: int, bin_no: int) -> None:
        self.open.setdefault(room, []).append(bin_no)
        k = room + self.size
        while k:
            self.tree[k] += 1
            k >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, sequence) with the least room of at least ``need``; it is removed."""
        tree, k = self.tree, need + self.size
        if not tree[k]:
            while k > 1 and (k & 1 or not tree[k + 1]):
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.size:
                k = 2 * k if tree[2 * k] else 2 * k + 1
        room = k - self.size
        bin_no = self.open[room].pop()
        while k:
            tree[k] -= 1
            k >>= 1
        return room, bin_no


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """A sequence number for each size; sizes must be sorted in descending order and fit the capacity."""
    fit, out, n = TightestFit(capacity), [], 0
    for s in sizes:
        got = fit.take(s)
        if got is None:
            room, no = capacity, n
            n += 1
        else:
            room, no = got
        fit.add(room - s, no)
        out.append(no)
    return out


def _pack(items: DataFrame, parts: int, level: int) -> DataFrame:
    """(spec_id, capacity, item, size) -> (spec_id, capacity, item, bin, used), packed by partition."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "item"], ascending=[False, True], kind="stable")
        cap = int(pdf["capacity"].iloc[0])
        no = best_fit_decreasing(pdf["size"].tolist(), cap)
        tag = f"{level}.{pdf['part'].iloc[0]}."
        pdf["bin"] = [f"{tag}{k}" for k in no]
        pdf["used"] = pdf.groupby("bin")["size"].transform("sum")
        return pdf[["spec_id", "capacity", "item", "bin", "used"]]

    spread = items.withColumn("part", F.pmod(F.xxhash64("item", F.lit(level)), F.lit(parts)).cast("int"))
    return spread.groupBy("spec_id", "part").applyInPandas(run, "spec_id int, capacity long, item string, bin string, used long")


def pack(documents: DataFrame, specs: DataFrame, bound: int = BOUND, tokenizer: str = f"{FOLDER}/{VOCABULARY}") -> DataFrame:
    """(spec_id, capacity_tokens, bin_id, doc_id, piece, start_token, n_tokens): what each sequence holds."""
    caps = [(int(r[0]), int(r[1])) for r in specs.select("spec_id", "capacity_tokens").distinct().toLocalIterator()]  # a handful
    if any(c < 1 for _, c in caps):
        raise ValueError("capacity_tokens must be at least 1")
    spec = documents.sparkSession.createDataFrame(caps, "spec_id int, capacity long")
    sized = cut(with_tokens(documents, ["doc_id"], path=tokenizer).where("n_tokens > 0").withColumn("row", F.monotonically_increasing_id()))
    each = sized.crossJoin(F.broadcast(spec))  # a few specs for each document
    pieces = each.select(
        "spec_id", "capacity", "doc_id", "row", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(n_tokens - 1) div capacity"))).alias("piece"), "n_tokens"
    ).select("spec_id", "capacity", "doc_id", F.concat_ws("_", "row", "piece").alias("item"), "piece", (F.col("piece") * F.col("capacity")).alias("start_token"), F.least("capacity", F.expr("n_tokens - piece * capacity")).alias("size"))
    pieces = cut(pieces)
    whole = pieces.where("size = capacity").select("spec_id", "item", F.concat(F.lit("w."), "item").alias("bin"))
    items = pieces.where("size < capacity").select("spec_id", "capacity", "item", "size")
    n = items.count()
    placed = None
    for level in range(MAX_LEVELS):
        parts = max(1, -(-n // (bound * max(1, len(caps)))))
        packed = cut(_pack(items, parts, level))
        step = packed.select("spec_id", F.col("item").alias("inner"), F.col("bin").alias("outer"))
        if placed is None:
            placed = step.select("spec_id", F.col("inner").alias("item"), F.col("outer").alias("bin"))
        else:
            moved = step.withColumnRenamed("inner", "bin")
            placed = placed.join(moved, ["spec_id", "bin"], "left").select("spec_id", "item", F.coalesce("outer", "bin").alias("bin"))
        if parts == 1:
            break
        loose = packed.where((F.col("capacity") - F.col("used")) > LOOSE * F.col("capacity")).groupBy("spec_id", "capacity", "bin").agg(F.max("used").alias("size"))
        items = cut(loose.select("spec_id", "capacity", F.col("bin").alias("item"), "size"))
        m = items.count()
        if m == 0 or m > 0.9 * n:
            break
        n = m
    bins = placed.unionByName(whole)
    return pieces.join(bins, ["spec_id", "item"]).select("spec_id", F.col("capacity").alias("capacity_tokens"), F.col("bin").alias("bin_id"), "doc_id", F.col("piece").cast("int").alias("piece"), "start_token", F.col("size").alias("n_tokens"))


def report(packed: DataFrame) -> DataFrame:
    """For each spec: sequences, tokens, the fewest sequences that could hold them, and the share filled."""
    bins = packed.groupBy("spec_id", "capacity_tokens", "bin_id").agg(F.sum("n_tokens").alias("used"), F.count(F.lit(1)).alias("pieces"))
    return bins.groupBy("spec_id", "capacity_tokens").agg(
        F.count(F.lit(1)).alias("sequences"),
        F.sum("pieces").alias("pieces"),
        F.sum("used").alias("tokens"),
        F.ceil(F.sum("used") / F.first("capacity_tokens")).alias("least_sequences"),
        (F.sum("used") / (F.count(F.lit(1)) * F.first("capacity_tokens"))).alias("filled"),
    )
