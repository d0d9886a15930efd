"""Extension surface: level providers, modules, analysis plug-ins and comparison hooks.

Everything is a plain Python function or class over DataFrames that registers itself by a
decorator; nothing here runs on executors.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abundara.operators import profile as P
from abundara.operators.joins import prefix_key
from abundara.sources.writers import long_profile

MODES: dict[str, Callable[[DataFrame, Mapping[str, DataFrame]], dict[str, DataFrame]]] = {}
MODULES: dict[str, Module] = {}
TAXA = ("kingdom", "phylum", "class", "order", "family", "genus", "species", "specI_cluster")


def mode(name: str):
    """Register a provider of levels: (hits, dimensions) to, for each level, hits with a ``taxon`` column."""

    def add(f):
        MODES[name] = f
        return f

    return add


@mode("gene")
def _gene(hits, dimensions):
    return {"gene": hits.withColumn("taxon", F.col("gene"))}


@mode("mOTU")
def _motu(hits, dimensions):
    named = dimensions["markers"].select("gene", F.col("otu").alias("taxon"))
    return _gene(hits, dimensions) | {"mOTU": hits.join(named, "gene")}


@mode("NCBI")
def _ncbi(hits, dimensions):
    taxonomy = dimensions["taxonomy"]
    ranks = [r for r in TAXA if r in taxonomy.columns]
    named = hits.withColumn("taxaid", prefix_key(F.col("gene"))).join(taxonomy.select("taxaid", *ranks), "taxaid")
    return _gene(hits, dimensions) | {r: named.withColumn("taxon", F.col(r)).drop("taxaid", *ranks) for r in ranks} | {"taxaid": named.withColumn("taxon", F.col("taxaid")).drop("taxaid", *ranks)}


@mode("functional")
def _functional(hits, dimensions):
    return _gene(hits, dimensions)


def profiles(hits: DataFrame, mode_name: str, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Long profile of every level of a mode; the functional mode rolls the gene level's values up by the map."""
    levels = MODES[mode_name](hits, dimensions)
    out = None
    for level, rows in levels.items():
        found = P.profile(rows) if level == "gene" else P.profile(rows, "taxon")
        part = long_profile(found, level)
        out = part if out is None else out.unionByName(part)
    if mode_name == "functional":
        genes = out.where("level = 'gene'").withColumnRenamed("feature", "gene").join(hits.select("gene", F.col("length").cast("long").alias("length")).distinct(), "gene")
        names = F.filter(F.split(F.coalesce("cell", F.lit("")), "[,|]"), lambda x: (x != "") & (x != "NA"))
        cells = dimensions["functions"].select("gene", F.col("level").alias("map_level"), F.explode(F.array_distinct(names)).alias("feature"))
        rolled = genes.drop("level").join(cells, "gene").groupBy("sample", F.col("map_level").alias("level"), "feature", "count_type", "dist_type", "norm_type").agg(F.sum("value").alias("value"))
        out = out.unionByName(rolled)
    return out


def features(hits: DataFrame, mode_name: str, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """(level, feature) of ``profiles`` for the levels that the mode's provider gives, without computing any value."""
    out = None
    for level, rows in MODES[mode_name](hits, dimensions).items():
        part = P.features(rows, None if level == "gene" else "taxon").select(F.lit(level).alias("level"), "feature")
        out = part if out is None else out.unionByName(part)
    return out


@dataclass
class Module:
    """A named step: the tables it needs, its settings with defaults, the tables it gives."""

    name: str
    run: Callable
    requires: tuple[str, ...] = ()
    settings: dict[str, str] = field(default_factory=dict)
    produces: tuple[str, ...] = ()


def module(name: str, *, requires: tuple[str, ...] = (), settings: Mapping[str, str] | None = None, produces: tuple[str, ...] = ()):
    """Register (spark, tables, settings) to a dict of tables."""

    def add(f):
        MODULES[name] = Module(name, f, requires, dict(settings or {}), produces)
        return f

    return add


def run_module(name: str, spark: SparkSession, tables: Mapping[str, DataFrame], environment: Mapping[str, str] | None = None, prefix: str = "MC_") -> dict[str, DataFrame]:
    """Run a module: its settings come from the environment's names with the prefix, else from its defaults; missing tables or results are errors."""
    if name not in MODULES:
        raise KeyError(f"no module {name}; there are {', '.join(sorted(MODULES))}")
    found = MODULES[name]
    missing = [t for t in found.requires if t not in tables]
    if missing:
        raise ValueError(f"module {name} requires {', '.join(missing)}")
    given = {k.removeprefix(prefix).lower(): v for k, v in (environment or {}).items() if k.startswith(prefix)}
    result = found.run(spark, tables, found.settings | {k: v for k, v in given.items() if k in found.settings})
    lost = [t for t in found.produces if t not in result]
    if lost:
        raise ValueError(f"module {name} did not give {', '.join(lost)}")
    return result


@module("wilcoxon", requires=("matrix", "metadata"), settings={"group": "group", "first": "a", "second": "b", "correction": "bh"}, produces=("tests",))
def _wilcoxon(spark, tables, settings):
    """Rank-sum tests of all features between two groups of samples, with summaries and adjusted p values."""
    from abundara.operators import stats as T

    rows = tables["matrix"].join(tables["metadata"].select("sample", F.col(settings["group"]).alias("_g")), "sample")
    tests = T.rank_sums(rows, "feature", "_g", "value", settings["first"], settings["second"]).withColumn("p", T.two_sided_p("z"))
    summary = T.rank_sum_summary(rows, "feature", "_g", "value", settings["first"], settings["second"])
    return {"tests": T.adjust(tests, "p", settings["correction"], ["feature"]).join(summary, "feature")}


@module("drill_down", requires=("tests", "members", "modules", "pathways"), settings={"alpha": "0.05"}, produces=("overview", "detail"))
def _drill_down(spark, tables, settings):
    """Pathways, their modules and their features, with how many features of each test significant, the most first."""
    tests = tables["tests"].select("feature", "q", F.coalesce(F.col("q") < float(settings["alpha"]), F.lit(False)).alias("significant"))
    detail = tables["pathways"].select("pathway", "module").distinct().join(tables["modules"].select("module", "feature").distinct(), "module").join(tests, "feature", "left")
    per = detail.groupBy("pathway", "module").agg(F.count_distinct("feature").alias("features"), F.count_if(F.coalesce("significant", F.lit(False))).alias("significant"))
    return {"overview": per.orderBy(F.desc("significant"), "pathway", "module"), "detail": detail}


class Comparison:
    """A comparison of samples by features; a kind of feature overrides what differs."""

    def to_abundance(self, counts: DataFrame) -> DataFrame:
        """Counts (taxon, sample, value) as abundances."""
        return counts

    def merge(self, parts: list[DataFrame]) -> DataFrame:
        """Counts of several sources in one."""
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return rows.groupBy("taxon", "sample").agg(F.sum("value").alias("value"))

    def describe(self, features: DataFrame) -> DataFrame:
        """A text for each feature (taxon)."""
        return features.select("taxon", F.col("taxon").cast("string").alias("text"))

    def run(self, parts: list[DataFrame]) -> DataFrame:
        """taxon, sample, value and text of the merged and converted parts, as shares of each sample."""
        from pyspark.sql import Window

        rows = self.to_abundance(self.merge(parts))
        texts = self.describe(rows.select("taxon").distinct())
        share = F.col("value") / F.nullif(F.sum("value").over(Window.partitionBy("sample")), F.lit(0.0))
        return rows.withColumn("share", share).join(texts, "taxon")


class GenomeComparison(Comparison):
    """Counts over genome sizes (taxon, size)."""

    def __init__(self, sizes: DataFrame):
        self.sizes = sizes

    def to_abundance(self, counts):
        mean = self.sizes.agg(F.avg("size").alias("_mean"))
        joined = counts.join(self.sizes, "taxon", "left").crossJoin(F.broadcast(mean))
        return joined.select("taxon", "sample", (F.col("value") / F.when(F.col("taxon") == "-1", F.col("_mean")).otherwise(F.col("size"))).alias("value"))


class CopyComparison(Comparison):
    """Counts over the copy number of the nearest ancestor that has one."""

    def __init__(self, copies: DataFrame, closure: DataFrame, root: str):
        self.copies, self.closure, self.root = copies, closure, root

    def to_abundance(self, counts):
        from abundara.operators.aggregates import copy_normalised

        return copy_normalised(counts, self.copies, self.closure, self.root)
