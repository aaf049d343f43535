"""Four ordered phases of duplicate detection: identifier, accession number, title, authors and year.

The first row of a group in import order (``idx``) stays. Phases run on what the ones before have left,
except that accession numbers are grouped over all rows. The similarity phases compare inside blocks and
keep the first earlier row that isn't a duplicate itself (greedy leaders).

A block may be of any size. Its distinct texts are cut into tiles, by classes of length between which no
pair can reach the threshold and by hash within a class; a task compares two tiles, so no task holds more
than two tiles, and what is shuffled are texts, not pairs. Counts of characters rule out most pairs of two
tiles in one matrix product, the rest are aligned.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bibspark.functions.similarity import bounds, lcs, masks
from bibspark.functions.text import filled, normal_title, strip
from bibspark.session import cut, parallelism

TITLE_THRESHOLD = 90.0
AUTHOR_THRESHOLD = 85.0
#: Texts of a tile; two tiles are what one task compares at a time.
TILE = 1000
#: Similar pairs of a block that are gone through in one row; blocks with more are resolved in rounds.
FOLD = 5000


def exact_duplicates(df: DataFrame, key: str, match_type: str) -> DataFrame:
    """(idx, keep, match_type, similarity_score) for all rows but the first of each filled key."""
    firsts = df.where(filled(key)).groupBy(key).agg(F.min("idx").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # the aggregate combines before the shuffle, so a hot key is no hot task; the join may be skew-split
    return df.where(filled(key)).select("idx", key).join(firsts.select(key, "keep"), key).where("idx <> keep").select("idx", "keep", F.lit(match_type).alias("match_type"), F.lit(100.0).alias("similarity_score"))


def leaders(pairs: DataFrame, fold: int = FOLD) -> DataFrame:
    """Similar pairs (block, i, j) with i < j -> (idx, keep): greedy, in order of idx.

    A row that resembles an earlier leader is a duplicate, and the first such leader is its keeper; only rows
    that resemble an earlier row can be. Small blocks are folded in one row. In others each round settles the
    rows all of whose earlier neighbours are settled, until no pair is open.
    """
    pairs = pairs.select("block", "i", "j")
    sized = pairs.join(pairs.groupBy("block").agg(F.count(F.lit(1)).alias("n")), "block")
    later = sized.where(F.col("n") <= fold).groupBy("block", F.col("j").alias("idx")).agg(F.array_sort(F.collect_list("i")).alias("before"))
    rows = later.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("idx", "before"))).alias("rows"))
    # duplicates so far: a row is one if any earlier similar row isn't
    empty = F.array().cast("array<bigint>")
    dups = F.aggregate("rows", empty, lambda d, r: F.when(F.size(F.array_except(r["before"], d)) > 0, F.array_append(d, r["idx"])).otherwise(d))
    small = (
        rows.select(F.col("rows"), dups.alias("dups"))
        .select(F.explode("rows").alias("r"), "dups")
        .select(F.col("r.idx").alias("idx"), F.array_min(F.array_except("r.before", "dups")).alias("keep"), F.array_contains("dups", F.col("r.idx")).alias("is_dup"))
        .where("is_dup")
        .select("idx", "keep")
    )
    large = cut(sized.where(F.col("n") > fold).select("i", "j"))
    left, found = large, []
    while not left.isEmpty():
        first = left.select(F.col("i").alias("idx")).distinct().join(left.select(F.col("j").alias("idx")).distinct(), "idx", "left_anti")
        found.append(cut(left.join(first.withColumnRenamed("idx", "i"), "i", "left_semi").select(F.col("j").alias("idx")).distinct()))
        gone = found[-1]
        left = cut(left.join(gone.withColumnRenamed("idx", "j"), "j", "left_anti").join(gone.withColumnRenamed("idx", "i"), "i", "left_anti").select("i", "j"))
    if not found:
        return small
    every = reduce(DataFrame.unionByName, found)
    by = large.join(every.withColumnRenamed("idx", "i"), "i", "left_anti").join(every.withColumnRenamed("idx", "j"), "j", "left_semi")
    return small.unionByName(by.groupBy(F.col("j").alias("idx")).agg(F.min("i").alias("keep")))


def classes(nodes: DataFrame) -> DataFrame:
    """One node for each distinct text of a block, the first of its rows.

    Copies of a text fare alike: if the first is a leader, it is the keeper of the others; if it is a
    duplicate, its keeper is theirs. So pairs are made between distinct texts only.
    """
    return nodes.groupBy(*[c for c in nodes.columns if c != "idx"]).agg(F.min("idx").alias("idx"))


def _seats(nodes: DataFrame, text: str, least: float, tile: int) -> DataFrame:
    """The nodes once for each pair of tiles they take part in: ``unit``, and whether on its left (1), right (2) or both (3)."""
    # texts whose lengths differ by more than this factor can't reach ``least``; so classes further apart than 1 can't
    least = min(max(least, 1.0), 99.5)
    width = 1.0001 * math.log((200 - least) / least)
    c = nodes.withColumn("c", F.floor(F.log(F.greatest(F.length(text), F.lit(1)).cast("double")) / F.lit(width)))
    sizes = c.groupBy("block", "c").agg(F.count(F.lit(1)).alias("n"))
    whole = sizes.groupBy("block").agg(F.sum("n").alias("all"))
    # a small block is one tile, a text alone has no pair
    sizes = sizes.join(whole.where(F.col("all") > 1), "block").select("block", "c", F.when(F.col("all") <= tile, F.lit(None)).otherwise(F.ceil(F.col("n") / tile)).alias("p"))
    near = lambda by, name: sizes.select("block", (F.col("c") + by).alias("c"), F.col("p").alias(name))
    around = sizes.join(near(-1, "after"), ["block", "c"], "left").join(near(1, "before"), ["block", "c"], "left")
    rows = c.join(around, ["block", "c"]).withColumn("k", F.pmod(F.xxhash64("idx"), F.coalesce("p", F.lit(1))))
    upto = lambda n: F.when(F.coalesce(n, F.lit(0)) > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<bigint>"))
    key = lambda *x: F.concat_ws("|", *[v.cast("string") for v in x])
    seat = lambda unit, side: F.struct(unit.alias("unit"), side.cast("int").alias("side"))
    k, c = F.col("k"), F.col("c")
    own = F.transform(upto(F.col("p")), lambda q: seat(key(c, F.least(k, q), c, F.greatest(k, q)), F.when(k < q, 1).when(k > q, 2).otherwise(3)))
    after = F.transform(upto(F.col("after")), lambda q: seat(key(c, k, c + 1, q), F.lit(1)))
    before = F.transform(upto(F.col("before")), lambda q: seat(key(c - 1, q, c, k), F.lit(2)))
    seats = F.when(F.col("p").isNull(), F.array(seat(F.lit(""), F.lit(3)))).otherwise(F.concat(own, after, before))
    return rows.select(*nodes.columns, F.explode(seats).alias("s")).select(*nodes.columns, F.concat_ws("|", "block", "s.unit").alias("unit"), "s.side")


def _compare(nodes: DataFrame, texts: list[str], least: float, score: Callable[[list[np.ndarray]], np.ndarray], threshold: float, tile: int) -> DataFrame:
    """(block, i, j, score): pairs i < j of a block whose score reaches the threshold.

    ``score`` makes one number of the ratios of the texts, and an upper bound of upper bounds; the first
    text's ratio must reach ``least``.
    """

    def tiles(p: list[np.ndarray]) -> Iterator[tuple]:
        """The similar pairs of one unit, from its columns block, idx, side and texts."""
        block, idx, side = p[0][0], p[1], p[2]
        a, b = side != 2, side != 1
        ia, ib = idx[a], idx[b]
        at, bt = [t[a].tolist() for t in p[3:]], [t[b].tolist() for t in p[3:]]
        if len(ia) * len(ib) <= 36:  # too few for the matrices to pay
            maybe = np.ones((len(ia), len(ib)), bool)
        else:
            tops = [bounds(x, y) for x, y in zip(at, bt)]
            maybe = (score(tops) >= threshold - 1e-6) & (tops[0] >= least - 1e-6)
        if (side == 3).all():  # one tile with itself
            maybe &= ia[:, None] < ib[None, :]
        for x in np.flatnonzero(maybe.any(1)):
            places = [masks(t[x]) for t in at]
            for y in np.flatnonzero(maybe[x]):
                parts = []
                for t, u, m in zip(at, bt, places):
                    n = len(t[x]) + len(u[y])
                    if not parts and 200 * min(len(t[x]), len(u[y])) < least * n:
                        break
                    parts.append(np.float64(100.0 if n == 0 or t[x] == u[y] else 200.0 * lcs(t[x], u[y], m) / n))
                    if parts[0] < least:
                        break
                if len(parts) == len(at) and (s := float(score(parts))) >= threshold:
                    yield (block, *sorted((int(ia[x]), int(ib[y]))), s)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["block", "i", "j", "score"]
        held: list[list[np.ndarray]] = []  # pieces of the unit that may go on in the next batch
        last = None
        whole = lambda: held[0] if len(held) == 1 else [np.concatenate(x) for x in zip(*held)]
        for b in batches:
            if not len(b):
                continue
            unit = b["unit"].to_numpy()
            columns = [b[c].to_numpy() for c in ("block", "idx", "side", *texts)]
            ends = np.flatnonzero(unit[1:] != unit[:-1]) + 1
            out: list[tuple] = []
            for s, e in zip([0, *ends], [*ends, len(b)]):
                if held and unit[s] != last:
                    out += tiles(whole())
                    held = []
                held.append([c[s:e] for c in columns])
                last = unit[s]
            yield pd.DataFrame(out, columns=names)
        if held:
            yield pd.DataFrame(list(tiles(whole())), columns=names)

    # work goes with the square of the rows, so the partitions aren't merged by bytes
    seats = _seats(nodes, texts[0], least, tile)
    ready = seats.repartition(4 * parallelism(nodes.sparkSession), "unit").sortWithinPartitions("unit")
    return ready.mapInPandas(run, "block string, i long, j long, score double")


def _expand(nodes: DataFrame, firsts: DataFrame, pairs: DataFrame, match_type: str) -> DataFrame:
    """Keepers of the distinct texts, brought to all their rows."""
    keys = [c for c in nodes.columns if c != "idx"]
    found = leaders(pairs).join(pairs.select(F.col("i").alias("keep"), F.col("j").alias("idx"), "score"), ["idx", "keep"]).withColumnRenamed("idx", "rep")
    members = nodes.join(firsts.withColumnRenamed("idx", "rep"), keys).select("idx", "rep")
    return (
        members.join(found, "rep", "left")
        .select("idx", F.coalesce("keep", "rep").alias("keep"), F.lit(match_type).alias("match_type"), F.coalesce("score", F.lit(100.0)).alias("similarity_score"))
        .where("idx <> keep")
    )


def title_nodes(df: DataFrame) -> DataFrame:
    t = normal_title(F.coalesce("TI", F.lit("nan")))
    return df.select("idx", t.alias("t")).where(F.length("t") > 5).select(F.substring("t", 1, 4).alias("block"), "idx", "t")


def title_classes(df: DataFrame) -> DataFrame:
    """(idx, representative): the first row with the same normalised title."""
    nodes = title_nodes(df)
    return nodes.join(classes(nodes).withColumnRenamed("idx", "representative"), ["block", "t"]).select("idx", "representative")


def title_pairs(df: DataFrame, threshold: float = TITLE_THRESHOLD, tile: int = TILE) -> DataFrame:
    """(block, i, j, score): distinct titles of one block at least ``threshold`` alike, by their first rows."""
    return _title_pairs(classes(title_nodes(df)), threshold, tile)


def _title_pairs(firsts: DataFrame, threshold: float, tile: int = TILE) -> DataFrame:
    return _compare(firsts, ["t"], threshold, lambda r: r[0], threshold, tile)


def title_duplicates(df: DataFrame, threshold: float = TITLE_THRESHOLD) -> DataFrame:
    nodes = title_nodes(df)
    firsts = cut(classes(nodes))
    return _expand(nodes, firsts, cut(_title_pairs(firsts, threshold)), "title_similarity")


def author_nodes(df: DataFrame) -> DataFrame:
    py, au = strip(F.col("PY").cast("string")), F.lower(strip("AU"))
    first = F.substring(strip(F.element_at(F.split(au, ";"), 1)), 1, 20)
    return (
        df.select("idx", py.alias("py"), au.alias("au"), first.alias("first"), normal_title(F.coalesce("TI", F.lit("nan"))).alias("t"))
        .where("py IS NOT NULL AND py NOT IN ('', 'nan') AND au IS NOT NULL AND au NOT IN ('', 'nan') AND first <> ''")
        .select(F.concat_ws("|", "py", "first").alias("block"), "idx", "au", "t")
    )


def author_pairs(firsts: DataFrame, threshold: float = TITLE_THRESHOLD, author_threshold: float = AUTHOR_THRESHOLD, tile: int = TILE) -> DataFrame:
    return _compare(firsts, ["au", "t"], author_threshold, lambda r: (r[0] + r[1]) / 2, threshold, tile)


def author_duplicates(df: DataFrame, threshold: float = TITLE_THRESHOLD, author_threshold: float = AUTHOR_THRESHOLD) -> DataFrame:
    nodes = author_nodes(df)
    firsts = cut(classes(nodes))
    return _expand(nodes, firsts, cut(author_pairs(firsts, threshold, author_threshold)), "author_year_title")


def dedup(df: DataFrame, title_threshold: float = TITLE_THRESHOLD, author_threshold: float = AUTHOR_THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(kept rows, duplicate mappings) after all four phases."""
    slim = df.select("idx", *[c for c in ("DI", "UT", "TI", "AU", "PY") if c in df.columns])
    found: list[DataFrame] = []

    def gone() -> DataFrame | None:
        return reduce(DataFrame.unionByName, [f.select("idx") for f in found]) if found else None

    def rest() -> DataFrame:
        g = gone()
        return slim if g is None else slim.join(g, "idx", "left_anti")

    if "DI" in slim.columns:
        found.append(cut(exact_duplicates(slim, "DI", "doi_exact")))
    if "UT" in slim.columns:
        ut = exact_duplicates(slim, "UT", "ut_exact")
        g = gone()
        found.append(cut(ut if g is None else ut.join(g, "idx", "left_anti")))
    if "TI" in slim.columns:
        found.append(cut(title_duplicates(cut(rest()), title_threshold)))
    if {"TI", "AU", "PY"} <= set(slim.columns):
        found.append(cut(author_duplicates(cut(rest()), title_threshold, author_threshold)))
    every = reduce(DataFrame.unionByName, found) if found else slim.select("idx", F.col("idx").alias("keep"), F.lit("").alias("match_type"), F.lit(0.0).alias("similarity_score")).limit(0)
    ids = df.select("idx", "record_id", "source_file")
    mapped = (
        every.join(ids, "idx")
        .join(ids.select(F.col("idx").alias("keep"), F.col("record_id").alias("duplicate_of")), "keep")
        .select("record_id", "duplicate_of", "match_type", "similarity_score", "source_file")
    )
    return df.join(every.select("idx"), "idx", "left_anti"), mapped


def block_stats(df: DataFrame) -> DataFrame:
    """(block, titles): eligible titles of each block."""
    return title_nodes(df).groupBy("block").agg(F.count(F.lit(1)).alias("titles"))


def rank_in_group(df: DataFrame, key: str) -> DataFrame:
    """Place of each row in its key's group by import order."""
    w = Window.partitionBy(key).orderBy("idx")
    return df.where(filled(key)).select("idx", key, F.row_number().over(w).alias("place"))
