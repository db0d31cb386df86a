"""Connected components and partition comparison over edge lists, without gathering a node's neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.spool import Spool


def _apart(df: DataFrame, broadcast: bool = False) -> DataFrame:
    """One side of a join, which does not go through the driver. A spooled table's files are several times smaller
    than its rows, so Spark would broadcast tables of millions of nodes."""
    return df if broadcast else df.hint("merge")


def components(edges: DataFrame, spool: Spool, broadcast: bool = True) -> DataFrame:
    """(node, root) for every node of `edges(a, b)`, root the smallest node that can be reached.

    Alternating star contraction. Large star: neighbours above a node are linked to the smallest it sees. Small
    star: a node and its smaller neighbours are linked to the smallest of them. All group-bys are minima, which
    fold before the shuffle, and joins on hot centres can be split. Ends when neither step changes an edge. Without
    `broadcast` no table of nodes goes through the driver, however small its files are.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, mark = spool.keep(pairs, "edges"), None
    while True:
        both = now.select("a", "b").union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(_apart(least, broadcast), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = spool.keep(large, "large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(_apart(low, broadcast), "a")
        small = small.select("a", F.col("m").alias("b")).union(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        small = spool.keep(small, "small")
        spool.drop(now, large)
        now = small
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select(F.col("b").alias("node"), F.col("b").alias("root")))


def labels(nodes: DataFrame, edges: DataFrame, spool: Spool, broadcast: bool = True) -> DataFrame:
    """(node, root) for all of `nodes(node)`; a node without edges is its own root."""
    found = components(edges, spool, broadcast)
    return nodes.select("node").distinct().join(_apart(found, broadcast), "node", "left").withColumn("root", F.coalesce("root", "node"))


def updated_labels(known: DataFrame, edges: DataFrame, added: DataFrame, removed: DataFrame, spool: Spool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """`known(node, root)` of the edges `edges(a, b)`, after some are added and removed: the new labels, the new edges,
    and the edges that were contracted again, which are those of components with an end of an edge that came or went.
    Nodes stay, those of removed edges too; nodes of added edges may be new. The smallest node is the root.
    """
    both = lambda e: e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    added, removed = both(added), both(removed)
    now = spool.keep(both(edges).join(_apart(removed), ["a", "b"], "left_anti").unionByName(added).distinct(), "edges")
    came = added.unionByName(removed)
    ends = spool.keep(came.select(F.col("a").alias("node")).union(came.select(F.col("b").alias("node"))).distinct(), "ends")
    touched = spool.keep(known.join(_apart(ends), "node", "left_semi").select("root").distinct(), "touched")
    members = known.join(_apart(touched), "root", "left_semi").select("node")
    members = spool.keep(members.union(ends.join(_apart(known.select("node")), "node", "left_anti")), "members")
    # an edge lies in one component, so one end tells
    again = spool.keep(now.join(_apart(members.select(F.col("node").alias("a"))), "a", "left_semi").select("a", "b"), "again")
    found = labels(members, again, spool, broadcast=False)
    return known.join(_apart(touched), "root", "left_anti").select("node", "root").unionByName(found.select("node", "root")), now, again


def star_edges(members: DataFrame, node: str, keys: list[str], broadcast: bool = True) -> DataFrame:
    """Edges from each member of a group to the group's smallest: as connected as all pairs, one row a member."""
    least = members.groupBy(*keys).agg(F.min(node).alias("b"))
    return members.join(_apart(least, broadcast), keys).select(F.col(node).alias("a"), "b").where("a <> b").distinct()


def partition_diff(old: DataFrame, new: DataFrame, spool: Spool) -> DataFrame:
    """(old_labels, new_labels, kind) for each set of labels that share entities, from two tables (entity, label).

    Kinds: unchanged, split, merged, exchanged, added (no old label), removed (no new label).
    """
    a = old.select("entity", F.col("label").alias("old_label"))
    b = new.select("entity", F.col("label").alias("new_label"))
    name = lambda c, s: F.concat(F.lit(s), F.col(c).cast("string"))
    edges = a.join(b, "entity").select(name("old_label", "o").alias("a"), name("new_label", "n").alias("b")).distinct()
    nodes = a.select(name("old_label", "o").alias("node")).union(b.select(name("new_label", "n").alias("node")))
    parts = labels(nodes, edges, spool)
    side = lambda s: F.array_sort(F.collect_list(F.when(F.left("node", F.lit(1)) == s, F.substring("node", 2, 40).cast("bigint"))))
    out = parts.groupBy("root").agg(side("o").alias("old_labels"), side("n").alias("new_labels"))
    n, m = F.size("old_labels"), F.size("new_labels")
    kind = F.when(n == 0, "added").when(m == 0, "removed").when((n == 1) & (m == 1), "unchanged").when(n == 1, "split").when(m == 1, "merged").otherwise("exchanged")
    return out.select("old_labels", "new_labels", kind.alias("kind"))
