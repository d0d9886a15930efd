"""Abundance profiling: fractional counts, unique counts and two-pass redistribution.

Hits are rows (sample, insert_id, mate, gene, cov, length[, taxon]).  Everything up to the
shares needs the rows of an insert together, so one shuffle on (sample, insert_id) serves
all of it; features are then summed with partial aggregation.  The second pass joins the
first pass's unique abundances back to the multi-mapping targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from abundara.operators.scratch import kept

INSERT = ["sample", "insert_id"]


def insert_values(hits: DataFrame, taxon: str | None = None) -> DataFrame:
    """One row per (sample, insert, type, gene): most covered bases for base.1 and base.2, 1 for insert."""
    level = F.col(taxon) if taxon else F.col("gene")
    rows = hits.select(*INSERT, "gene", level.alias("taxon"), F.col("length").cast("double").alias("length"), "mate", F.col("cov").cast("double").alias("cov"))
    types = F.array(F.struct(F.concat(F.lit("base."), F.col("mate").cast("string")).alias("type"), F.col("cov").alias("value")), F.struct(F.lit("insert").alias("type"), F.lit(1.0).alias("value")))
    rows = rows.withColumn("t", F.explode(types))
    return rows.groupBy(*INSERT, F.col("t.type").alias("type"), "gene", "taxon", "length").agg(F.max("t.value").alias("value"))


def allow(values: DataFrame) -> DataFrame:
    """Rows whose taxon the mates agree on; where mates share no taxon, or only one maps, all rows.

    agreed says whether the agreement holds for the insert, alone whether one taxon only is
    allowed within (insert, type), n_genes counts the rows allowed there.
    """
    w = Window.partitionBy(*INSERT)
    per_taxon = Window.partitionBy(*INSERT, "taxon")
    one, two = (F.max((F.col("type") == f"base.{m}").cast("int")) for m in (1, 2))
    rows = values.withColumn("both", one.over(per_taxon) + two.over(per_taxon) == 2)
    rows = rows.withColumn("agreed", F.max("both").over(w))
    rows = rows.where(F.col("both") | ~F.col("agreed"))
    by_type = Window.partitionBy(*INSERT, "type")
    return rows.withColumn("alone", F.min("taxon").over(by_type) == F.max("taxon").over(by_type)).withColumn("n_genes", F.count("*").over(by_type)).drop("both")


def shares(hits: DataFrame, taxon: str | None = None) -> DataFrame:
    """Shares of each allowed gene; for taxa the divisor falls back to the gene level's where mates do not agree."""
    return _shares(insert_values(hits, taxon), taxon is not None)


def _shares(values: DataFrame, taxa: bool) -> DataFrame:
    rows = allow(values)
    count = F.col("n_genes")
    if taxa:
        genes = allow(values.withColumn("taxon", F.col("gene"))).groupBy(*INSERT, "type").agg(F.count("*").alias("gene_count"))
        rows = rows.join(genes, [*INSERT, "type"])
        count = F.when(F.col("agreed"), F.col("n_genes")).otherwise(F.col("gene_count"))
    return rows.select(*INSERT, "type", "gene", "taxon", "length", "alone", (F.col("value") / count).alias("share"), F.when(F.col("type") == "insert", "insert").otherwise("base").alias("kind"))


def seen_taxa(hits: DataFrame, taxon: str) -> DataFrame:
    """The taxa of each insert and type, each with its last gene (by name) and its number of genes."""
    return insert_values(hits, taxon).groupBy(*INSERT, "type", "taxon").agg(F.max("gene").alias("last_gene"), F.count_distinct("gene").alias("genes"))


def multi_mappers(share: DataFrame) -> DataFrame:
    """One record of each insert and type that maps to several taxa: its value and the targets (gene, taxon, length), as many as the aligner reports of one read."""
    rows = share.where("not alone").groupBy(*INSERT, "type", "kind")
    return rows.agg(F.sum("share").alias("value"), F.sort_array(F.collect_list(F.struct("gene", "taxon", "length"))).alias("targets"))


def level_totals(rows: DataFrame) -> DataFrame:
    """All raw and length-normalised values mapped, per sample, kind and distribution."""
    return rows.groupBy("sample", "kind").agg(*[F.sum(f"{d}{n}").alias(f"{d}{n}") for d in ("", "unique_", "mm_") for n in ("raw", "norm")])


def counts(share: DataFrame) -> DataFrame:
    """raw, norm, unique raw and unique norm by (sample, taxon, kind)."""
    norm = F.col("share") / F.col("length")
    unique = F.col("alone")
    return share.groupBy("sample", "taxon", "kind").agg(
        F.sum("share").alias("raw"), F.sum(norm).alias("norm"),
        F.sum(F.when(unique, F.col("share")).otherwise(0.0)).alias("unique_raw"), F.sum(F.when(unique, norm).otherwise(0.0)).alias("unique_norm"),
    )


def _weights(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """Targets with their candidates' weights: unique abundances where any is positive, else plain ones."""
    w = Window.partitionBy(*INSERT, "type")
    rows = rows.join(totals.select("sample", "taxon", "kind", "raw", "norm", "unique_raw", "unique_norm"), ["sample", "taxon", "kind"])
    rows = rows.withColumn("some", F.max((F.col("unique_raw") > 0).cast("int")).over(w) == 1)
    rows = rows.where(~F.col("some") | (F.col("unique_raw") > 0))
    return rows.withColumn("u", F.when(F.col("some"), F.col("unique_raw")).otherwise(F.col("raw"))).withColumn("un", F.when(F.col("some"), F.col("unique_norm")).otherwise(F.col("norm")))


def redistribute(share: DataFrame, totals: DataFrame, gene_totals: DataFrame | None = None, gene_share: DataFrame | None = None) -> DataFrame:
    """mm_raw and mm_norm by (sample, taxon, kind): values of multi-mappers dealt by unique abundance.

    For taxa, only genes that pass the gene level's candidate test deal, and a taxon's part
    is divided among its genes within the insert.
    """
    w = Window.partitionBy(*INSERT, "type")
    many = share.where("not alone").withColumn("v", F.sum("share").over(w))
    if gene_totals is not None:
        genes = gene_share.select(*INSERT, "type", "kind", F.col("gene").alias("taxon"))
        passed = _weights(genes, gene_totals).select(*INSERT, "type", F.col("taxon").alias("gene"))
        many = many.join(passed, [*INSERT, "type", "gene"], "left_semi")
    rows = _weights(many, totals)
    per = F.count("*").over(Window.partitionBy(*INSERT, "type", "taxon"))
    rows = rows.withColumn("per", per)
    raw = F.col("u") / F.sum(F.col("u") / F.col("per")).over(w) * F.col("v") / F.col("per")
    norm_weight = F.col("un") if gene_totals is not None else F.col("u") / F.col("length")
    norm = norm_weight / F.sum(norm_weight / F.col("per")).over(w) / F.col("per") * F.col("v") / F.col("length")
    rows = rows.withColumn("mm_raw", raw).withColumn("mm_norm", norm)
    return rows.groupBy("sample", "taxon", "kind").agg(F.sum("mm_raw").alias("mm_raw"), F.sum("mm_norm").alias("mm_norm"))


def profile(hits: DataFrame, taxon: str | None = None) -> DataFrame:
    """sample, feature, kind (base, insert) and raw, norm and scaled values of the plain, unique and redistributed counts."""
    # both levels derive from one table of insert values; passes and scaling read shares and totals that are written once
    values = kept(insert_values(hits, taxon)) if taxon else insert_values(hits)
    share = kept(_shares(values, taxon is not None))
    totals = kept(counts(share))
    if taxon:
        gene_share = kept(_shares(values.withColumn("taxon", F.col("gene")), False))
        dealt = redistribute(share, totals, counts(gene_share), gene_share)
    else:
        dealt = redistribute(share, totals)
    rows = totals.join(dealt, ["sample", "taxon", "kind"], "left")
    rows = rows.withColumn("mm_raw", F.col("unique_raw") + F.coalesce("mm_raw", F.lit(0.0))).withColumn("mm_norm", F.col("unique_norm") + F.coalesce("mm_norm", F.lit(0.0)))
    return scaled(kept(rows)).withColumnRenamed("taxon", "feature")


def features(hits: DataFrame, taxon: str | None = None) -> DataFrame:
    """The distinct features of ``profile`` over the same hits, without its values: taxa of rows that the mates allow.

    One shuffle and one sort: every row is an insert's, so the types and shares that ``profile`` makes decide nothing here.
    """
    level = F.col(taxon) if taxon else F.col("gene")
    # where profile joins by a key, rows without it are in no feature
    rows = hits.where("sample is not null and insert_id is not null" if taxon else "sample is not null")
    rows = rows.select(*INSERT, level.alias("feature"), F.col("mate").cast("string").alias("mate")).repartition(*INSERT)
    one, two = (F.max(F.coalesce((F.col("mate") == m).cast("int"), F.lit(0))) for m in ("1", "2"))
    per = Window.partitionBy(*INSERT, "feature")
    rows = rows.withColumn("both", one.over(per) + two.over(per) == 2)
    rows = rows.withColumn("agreed", F.max("both").over(Window.partitionBy(*INSERT)))
    return rows.where(F.col("both") | ~F.col("agreed")).select("feature").distinct()


def scaled(rows: DataFrame) -> DataFrame:
    """Adds norm values times the ratio of all raw to all norm values, per sample and kind (0 if there is none)."""
    per = ["sample", "kind"]
    sums = rows.groupBy(*per).agg(*[F.sum(f"{d}{n}").alias(f"_{d}{n}") for d in ("", "unique_", "mm_") for n in ("raw", "norm")])
    rows = rows.join(sums, per)
    for d in ("", "unique_", "mm_"):
        ratio = F.when(F.col(f"_{d}norm") > 0, F.col(f"_{d}raw") / F.col(f"_{d}norm")).otherwise(0.0)
        rows = rows.withColumn(f"{d}scaled", F.col(f"{d}norm") * ratio)
    return rows.drop(*[f"_{d}{n}" for d in ("", "unique_", "mm_") for n in ("raw", "norm")])


def unmapped(rows: DataFrame, totals: DataFrame, lengths: DataFrame | None = None) -> DataFrame:
    """The -1 row per sample and kind: library total less what is mapped, the same in all three distributions; totals has (sample, kind, total).

    norm values are known for taxa only: with ``lengths`` (a length a taxon) they are over the mean length, else null.
    """
    mapped = rows.groupBy("sample", "kind").agg(F.sum("raw").alias("mapped"))
    left = totals.join(mapped, ["sample", "kind"], "left").withColumn("left", F.col("total") - F.coalesce("mapped", F.lit(0.0)))
    norm = F.lit(None).cast("double")
    if lengths is not None:
        left, norm = left.crossJoin(F.broadcast(lengths.agg(F.avg("length").alias("_mean")))), F.col("left") / F.col("_mean")
    values = {"raw": F.col("left"), "norm": norm, "scaled": F.col("left")}
    return left.select("sample", F.lit("-1").alias("feature"), "kind", *[values[n].alias(f"{d}{n}") for d in ("", "unique_", "mm_") for n in ("raw", "norm", "scaled")])


def coverage_stats(rows: DataFrame, totals: DataFrame, intervals: DataFrame) -> DataFrame:
    """Totals, mapped totals and their fractions per sample and kind, with the mean interval length."""
    mean = intervals.agg(F.avg(F.col("stop") - F.col("start") + 1).alias("mean_length"))
    mapped = rows.groupBy("sample", "kind").agg(F.sum("raw").alias("mapped"))
    joined = totals.join(mapped, ["sample", "kind"], "left").crossJoin(F.broadcast(mean))
    return joined.select("sample", "kind", "total", F.coalesce("mapped", F.lit(0.0)).alias("mapped"), (F.coalesce("mapped", F.lit(0.0)) / F.col("total")).alias("fraction"), "mean_length")


def _assigned(genes: DataFrame, categories: DataFrame) -> DataFrame:
    """A row for each gene and level with the names of its categories; as many levels as the map has columns."""
    levels = categories.select("level").distinct()
    if levels.limit(1001).count() > 1000:
        raise ValueError("more than 1,000 levels in a functional map")
    cells = genes.crossJoin(F.broadcast(levels)).join(categories, ["gene", "level"], "left")
    return cells.withColumn("names", F.array_distinct(F.filter(F.split(F.coalesce("cell", F.lit("")), "[,|]"), lambda x: (x != "") & (x != "NA"))))


def functional(genes: DataFrame, categories: DataFrame, value: str) -> DataFrame:
    """level, category, value, length: each gene's value added in full to every category listed for it.

    categories has (gene, level, cell), a cell listing categories by commas or pipes; empty
    cells, NA and genes without a row count as ``unassigned``; ``mapped`` is all genes.
    """
    names = F.when(F.size("names") == 0, F.array(F.lit("unassigned"))).otherwise(F.col("names"))
    rows = _assigned(genes, categories).select("level", F.explode(F.concat(names, F.array(F.lit("mapped")))).alias("category"), F.col(value).alias("value"), "length")
    return rows.groupBy("level", "category").agg(F.sum("value").alias("value"), F.sum("length").alias("length"))


def functional_headers(genes: DataFrame, categories: DataFrame, value: str, total: DataFrame) -> DataFrame:
    """The header values of each level, older ones too: total (one row), mapped, assigned_and_unassigned, unassigned, assigned; a gene counts once."""
    none = F.size("names") == 0
    rows = _assigned(genes, categories).groupBy("level").agg(
        F.sum(value).alias("mapped"), F.sum(F.when(none, F.col(value)).otherwise(0.0)).alias("unassigned"), F.sum(F.when(none, 0.0).otherwise(F.col(value))).alias("assigned"))
    return rows.withColumn("assigned_and_unassigned", F.col("assigned") + F.col("unassigned")).crossJoin(F.broadcast(total.select("total")))


def horizontal_levels(covered: DataFrame, groups: DataFrame, group: str) -> DataFrame:
    """Mean covered bins of the genes (gene, covered) of each group (gene, group), genes without any counting as 0."""
    rows = groups.select("gene", group).distinct().join(covered, "gene", "left")
    return rows.groupBy(group).agg(F.avg(F.coalesce("covered", F.lit(0))).alias("covered"), F.count("*").alias("genes"))


def horizontal(spans: DataFrame, bins: int = 100) -> DataFrame:
    """gene, covered: bins touched by any span (gene, start, length, hit_start, hit_stop)."""
    top = bins - 1
    first = F.round(F.greatest(F.col("hit_start") - F.col("start"), F.lit(0)) * top / F.col("length")).cast("int")
    last = F.round(F.least(F.col("hit_stop") - F.col("start"), F.col("length") - 1) * top / F.col("length")).cast("int")
    rows = spans.select("gene", first.alias("a"), last.alias("b")).where("b >= a").distinct()
    return rows.select("gene", F.explode(F.sequence("a", "b")).alias("bin")).groupBy("gene").agg(F.count_distinct("bin").alias("covered"))
