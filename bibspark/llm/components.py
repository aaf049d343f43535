"""Problem 5: one group identifier for everything that pairwise matches link.

Union-find runs inside edge partitions and keeps only a spanning forest of each (one edge from every
member to the smallest id of its tree), so a partition never emits more edges than it has members.
Forests are then merged level by level: every level repartitions the edges that are left and runs
union-find again, until one partition of at most ``bound`` edges holds what remains.

While more than ``bound`` edges are left, a level works on vertices instead of merging everything:

* a member that hangs on exactly one root and is no root itself is settled; it only waits for the
  label of its root (a hub's millions of leaves leave the loop at once, without being gathered);
* what remains is a graph of roots. Its edges are hashed by both end points (hot ones salted
  beforehand by the partition-local forests), so each level at least joins every vertex with its
  neighbours and the number of roots falls geometrically.

Labels flow back through the settled members by joins on the root. Nothing is collected to the driver.

Defined results: pairs with a null, blank or equal id are no link; repeated and reversed pairs count
once; an empty table gives an empty result; ties can't occur since ids are compared by code point;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibspark.session import cut, parallelism

#: Edges one merging task may hold: about 0.5 GB of Python dictionaries.
BOUND = 2_000_000
MAX_LEVELS = 60
_SCHEMA = "node string, root string"


def clean_edges(df: DataFrame, left: str, right: str) -> DataFrame:
    """Distinct links (node > root) between two different non-blank ids."""
    ws = "(?U)^\\s*$"
    a, b = F.col(left).cast("string"), F.col(right).cast("string")
    ok = df.where(~F.coalesce(a.rlike(ws), F.lit(True)) & ~F.coalesce(b.rlike(ws), F.lit(True)) & (a != b))
    return ok.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root"))


def forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over one partition's edges; each member but the smallest comes out with the smallest."""
    parent: dict[str, str] = {}

    def find(x: str) -> str:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for b in batches:
        for u, v in zip(b["node"], b["root"]):
            ru, rv = find(u), find(v)
            if ru < rv:
                parent[rv] = ru
            elif rv < ru:
                parent[ru] = rv
    rows = [(x, find(x)) for x in parent]
    for k in range(0, len(rows), 100_000):
        yield pd.DataFrame([r for r in rows[k : k + 100_000] if r[0] != r[1]], columns=["node", "root"])


def connected_components(edges: DataFrame, bound: int = BOUND) -> DataFrame:
    """(node, root) edges with node > root -> (id, group): group is the smallest id of the component."""
    spark = edges.sparkSession
    left = cut(edges.mapInPandas(forest, _SCHEMA))
    settled: list[DataFrame] = []
    for _ in range(MAX_LEVELS):
        n = left.count()
        if n <= bound:
            labels = left.coalesce(1).mapInPandas(forest, _SCHEMA)
            break
        parts = max(parallelism(spark), -(-2 * n // bound))
        # join each member's roots, then hash the root graph by both end points
        left = cut(left.repartition(parts, "node").mapInPandas(forest, _SCHEMA).distinct())
        roots = left.select(F.col("root").alias("node")).distinct()
        degree = left.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("root"))
        leaf = degree.where("n = 1").join(roots, "node", "left_anti").select("node", "root")
        leaf = cut(leaf)
        core = left.join(leaf.select("node"), "node", "left_anti")
        settled.append(leaf)
        both = core.select(F.explode(F.array("node", "root")).alias("k"), "node", "root")
        left = cut(both.repartition(parts, "k").select("node", "root").mapInPandas(forest, _SCHEMA).distinct())
    else:
        raise RuntimeError("components did not settle")
    labels = labels if not settled else cut(labels)
    for leaf in reversed(settled):
        # a settled member takes the label of its root, or the root itself where that is a top
        up = leaf.alias("l").join(labels.alias("r"), F.col("l.root") == F.col("r.node"), "left")
        labels = cut(labels.unionByName(up.select(F.col("l.node").alias("node"), F.coalesce("r.root", "l.root").alias("root"))))
    tops = labels.select(F.col("root").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return labels.unionByName(tops).select(F.col("node").alias("id"), F.col("root").alias("group"))


def p5_found(mappings: DataFrame, bound: int = BOUND) -> DataFrame:
    return connected_components(clean_edges(mappings, "record_id", "duplicate_of"), bound).select(F.col("id").alias("record_id"), F.col("group").alias("group_id"))
