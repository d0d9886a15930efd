"""Joins: intervals, lookups, annotation chains, self-joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interval_join(rows: DataFrame, intervals: DataFrame, *, width: int | None = None) -> DataFrame:
    """Rows (ref, first_base, last_base) with each interval (ref, idx, start, stop) they overlap, and covered bases.

    ``width`` turns the range condition into an equality on fixed bins plus a residual, for
    references that hold many intervals; a pair is reported at the bin of its overlap's start.
    """
    intervals = intervals.select("ref", "idx", "start", "stop")
    meet = (F.col("first_base") <= F.col("stop")) & (F.col("last_base") >= F.col("start"))
    if width is None:
        joined = rows.join(intervals, "ref").where(meet)
    else:
        a = rows.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("first_base") / width), F.floor(F.col("last_base") / width))))
        b = intervals.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("stop") / width))))
        here = F.col("_bin") == F.floor(F.greatest("first_base", "start") / width)
        joined = a.join(b, ["ref", "_bin"]).where(meet & here).drop("_bin")
    return joined.withColumn("covered", F.least("last_base", "stop") - F.greatest("first_base", "start") + 1)


def interval_totals(rows: DataFrame, intervals: DataFrame, *, width: int | None = None) -> DataFrame:
    """ref, idx, n and covered of each interval that any row overlaps: how many rows do, and the bases they share.

    Rows of the same place, and intervals of the same place, meet once and count by their
    number, so the pairs met grow with the distinct places of a reference, not with its rows.
    """
    spans = rows.groupBy("ref", "first_base", "last_base").agg(F.count("*").alias("_rows"))
    places = intervals.select("ref", F.lit(0).alias("idx"), "start", "stop").distinct()
    met = interval_join(spans, places, width=width).groupBy("ref", "start", "stop")
    met = met.agg(F.sum("_rows").alias("n"), F.sum(F.col("_rows") * F.col("covered")).alias("covered"))
    return intervals.select("ref", "idx", "start", "stop").join(met, ["ref", "start", "stop"]).select("ref", "idx", "n", "covered")


def lookup(rows: DataFrame, dimension: DataFrame, key: str, *, default: dict | None = None) -> DataFrame:
    """Left join to a dimension; ``default`` fills columns of rows without a match."""
    joined = rows.join(dimension, key, "left")
    return joined.fillna(default) if default else joined


def prefix_key(ref):
    """The leading number of a reference name."""
    return F.regexp_extract(ref, r"^(\d+)", 1)


def annotation_chain(tables: list[DataFrame], key: str, missing: str = "NA") -> DataFrame:
    """Full outer join of all tables on a key; missing annotations become ``missing``."""
    joined = reduce(lambda a, b: a.join(b, key, "full"), tables)
    return joined.select(key, *[F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias(c) for c in joined.columns if c != key])


def all_pairs_within(rows: DataFrame, key: str, item: str) -> DataFrame:
    """How many keys hold both items of each pair (a <= b), as found by a self-join on the key."""
    items = rows.select(key, item).distinct()
    a, b = items.withColumnRenamed(item, "a"), items.withColumnRenamed(item, "b")
    return a.join(b, key).where("a <= b").groupBy("a", "b").agg(F.count("*").alias("n"))


def spanning_pairs(pairs: DataFrame, blocks: DataFrame) -> DataFrame:
    """Blocks (ref, start, stop) with the number of pairs (ref, left, right) that reach over them."""
    joined = blocks.join(pairs, (blocks["ref"] == pairs["ref"]) & (pairs["left"] < blocks["start"]) & (pairs["right"] > blocks["stop"]), "left")
    return joined.groupBy(blocks["ref"], blocks["start"], blocks["stop"]).agg(F.count(pairs["left"]).alias("spanning"))


def og_regions(hits: DataFrame, regions: DataFrame, *, least: int = 10) -> DataFrame:
    """Query hits expanded to the regions of the protein hit, projected onto the query."""
    joined = hits.join(regions, "protein").withColumn("overlap", F.least(F.col("region_stop") - F.col("s_start"), F.col("s_stop") - F.col("region_start")))
    joined = joined.where(F.col("overlap") > least)
    left, right = F.greatest(F.lit(0), F.col("region_start") - F.col("s_start")), F.greatest(F.lit(0), F.col("s_stop") - F.col("region_stop"))
    return joined.withColumn("q_from", F.col("q_start") + left).withColumn("q_to", F.col("q_stop") - right)


def many_to_many(values: DataFrame, mapping: DataFrame, key: str, group: str, value: str) -> DataFrame:
    """Values summed over every group a key belongs to (a key may belong to many), with the members found of each group."""
    pairs = mapping.select(key, group).distinct()
    return values.join(pairs, key).groupBy(group).agg(F.sum(value).alias(value), F.count_distinct(key).alias("members"))


def annotate(rows: DataFrame, annotation: DataFrame, key: str) -> DataFrame:
    """Left join to an annotation whose columns without any value for these rows are dropped."""
    joined = rows.join(annotation, key, "left")
    extra = [c for c in annotation.columns if c != key]
    held = joined.agg(*[F.count(F.nullif(F.col(c).cast("string"), F.lit(""))).alias(c) for c in extra]).first()
    return joined.drop(*[c for c in extra if not held[c]])


def indexed_chain(rows: DataFrame, forward: DataFrame, backward: DataFrame, key: str) -> DataFrame:
    """Rows (key, ...) to names by a forward index (key, name) and on to groups by a backward one (group, name): all groups of a key."""
    return rows.join(forward, key).join(backward, "name").dropDuplicates([key, "group"])
