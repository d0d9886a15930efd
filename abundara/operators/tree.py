"""Rooted trees as (id, parent) tables: lineages, common ancestors, roll-ups, text forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abundara.operators.scratch import kept


def lineages(tree: DataFrame, max_doublings: int = 40) -> DataFrame:
    """(id, ancestor, steps) for every node and ancestor, itself at 0; the depth looked at doubles with each join until nothing is added.

    Rows whose ancestors go round in a circle never come to an end and are an error.
    """
    step = tree.where("parent is not null and parent <> id").select("id", F.col("parent").alias("ancestor"), F.lit(1).cast("long").alias("steps"))
    closure = ends = kept(step)  # each doubling is written: plans stay small however deep the tree
    for _ in range(max_doublings):
        # ways of exactly 2**k steps are joined to all shorter ones
        longer = kept(closure.alias("x").join(ends.alias("y"), F.col("x.ancestor") == F.col("y.id")).select("x.id", "y.ancestor", (F.col("x.steps") + F.col("y.steps")).alias("steps")))
        ends = kept(ends.alias("x").join(ends.alias("y"), F.col("x.ancestor") == F.col("y.id")).select("x.id", "y.ancestor", (F.col("x.steps") + F.col("y.steps")).alias("steps")))
        if longer.isEmpty():
            break
        if not longer.where("id = ancestor").isEmpty():
            raise ValueError("the tree has a circle")
        closure = closure.unionByName(longer)
    else:
        raise ValueError("the tree is too deep")
    return closure.unionByName(tree.select("id", F.col("id").alias("ancestor"), F.lit(0).cast("long").alias("steps")))


def common_ancestors(closure: DataFrame, pairs: DataFrame) -> DataFrame:
    """The nearest node above both a and b of each pair."""
    x = closure.select(F.col("id").alias("a"), "ancestor", F.col("steps").alias("sa"))
    y = closure.select(F.col("id").alias("b"), "ancestor", F.col("steps").alias("sb"))
    both = pairs.join(x, "a").join(y, ["b", "ancestor"])
    return both.groupBy("a", "b").agg(F.min_by("ancestor", "sa").alias("lca"))


def roll_up(closure: DataFrame, values: DataFrame) -> DataFrame:
    """Sum of the values (id, value) at or below each node."""
    return values.join(closure, "id").groupBy(F.col("ancestor").alias("id")).agg(F.sum("value").alias("value"))


def at_rank(closure: DataFrame, ranks: DataFrame, rank: str) -> DataFrame:
    """For each node its nearest ancestor of a rank (ranks: id, rank)."""
    named = closure.join(ranks.where(F.col("rank") == rank).select(F.col("id").alias("ancestor")), "ancestor")
    return named.groupBy("id").agg(F.min_by("ancestor", "steps").alias("at_rank"))


def nearest_rank(closure: DataFrame, levels: DataFrame, rank_level: int) -> DataFrame:
    """For each node its nearest ancestor, itself included, whose rank's level (levels: id, level; the root's is least) is at most ``rank_level``; else the node itself."""
    near = closure.join(levels.where(F.col("level") <= rank_level).select(F.col("id").alias("ancestor")), "ancestor").groupBy("id").agg(F.min_by("ancestor", "steps").alias("at_rank"))
    return levels.select("id").join(near, "id", "left").select("id", F.coalesce("at_rank", "id").alias("at_rank"))


def averages_of_children(tree: DataFrame, closure: DataFrame, values: DataFrame) -> DataFrame:
    """(id, value) for nodes without a value of their own: the mean of their children's, from the leaves up; own values stay.

    One step a level of the tree, each a grouped mean over the children known by then.
    """
    height = closure.groupBy(F.col("ancestor").alias("id")).agg(F.max("steps").alias("height"))
    rows = kept(tree.select("id", "parent").join(height, "id").join(values.select("id", "value"), "id", "left"))
    top = rows.agg(F.max("height")).first()[0] or 0
    for level in range(1, top + 1):
        means = rows.where("value is not null and parent is not null").groupBy(F.col("parent").alias("id")).agg(F.avg("value").alias("_mean"))
        rows = kept(rows.join(means, "id", "left").withColumn("value", F.coalesce("value", F.when(F.col("height") == level, F.col("_mean")))).drop("_mean"))
    return rows.where("value is not null").select("id", "value")


def without_straight_links(tree: DataFrame, closure: DataFrame) -> DataFrame:
    """(id, parent) of the tree without inner nodes that have one child only: a node's parent is the next one above that stays. The root stays."""
    children = tree.where("parent is not null and parent <> id").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n"))
    stay = tree.join(children, "id", "left").where("n is null or n > 1 or parent is null or parent = id").select("id")
    above = closure.where("steps > 0").join(stay.select(F.col("id").alias("ancestor")), "ancestor").join(stay, "id")
    near = above.groupBy("id").agg(F.min_by("ancestor", "steps").alias("parent"))
    return stay.join(near, "id", "left").select("id", "parent")


def leaves(tree: DataFrame) -> DataFrame:
    return tree.select("id").join(tree.where("parent is not null and parent <> id").select(F.col("parent").alias("id")).distinct(), "id", "left_anti")


def prune(tree: DataFrame, closure: DataFrame, keep: DataFrame) -> DataFrame:
    """The nodes on the ways from kept nodes to the root."""
    wanted = closure.join(keep.select("id"), "id").select(F.col("ancestor").alias("id")).distinct()
    return tree.join(wanted, "id", "left_semi")


def _below(nodes: list[tuple]) -> tuple[dict, dict]:
    below: dict = {}
    for node, parent, _ in nodes:
        if parent is not None and parent != node:
            below.setdefault(parent, []).append(node)
    return {n: sorted(c, key=str) for n, c in below.items()}, {n: name for n, _, name in nodes}


def newick(nodes: list[tuple], root) -> str:
    """Text form of a small tree given as (id, parent, name) rows, of any depth."""
    below, names = _below(nodes)
    done: dict = {}
    open_ = [root]
    while open_:
        node = open_[-1]
        wait = [c for c in below.get(node, ()) if c not in done]
        if wait:
            open_ += wait
            continue
        inner = ",".join(done.pop(c) for c in below.get(node, ()))
        done[open_.pop()] = (f"({inner})" if inner else "") + str(names[node]).replace(" ", "_")
    return done[root] + ";"


def phyloxml(nodes: list[tuple], root) -> str:
    """The same tree as phyloXML text."""
    from xml.sax.saxutils import escape

    below, names = _below(nodes)
    out, open_ = [], [(root, False)]
    while open_:
        node, closing = open_.pop()
        if closing:
            out.append("</clade>")
            continue
        out.append(f"<clade><name>{escape(str(names[node]))}</name>")
        open_.append((node, True))
        open_ += [(c, False) for c in reversed(below.get(node, []))]
    return f'<phyloxml xmlns="http://www.phyloxml.org"><phylogeny rooted="true">{"".join(out)}</phylogeny></phyloxml>'
