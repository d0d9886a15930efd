"""Grouped statistics over reads, contigs, coverage and matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def cycle_statistics(reads: DataFrame, *, offset: int = 33) -> DataFrame:
    """Per cycle of (seq, qual): count (and the largest of any cycle), extremes, mean, quartiles by cumulated histogram, whiskers and base counts."""
    letters = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    pairs = F.arrays_zip(letters("qual").alias("q"), letters("seq").alias("b"))
    cells = reads.select(F.posexplode(pairs).alias("at", "x")).where("x.q is not null")
    cells = cells.select((F.col("at") + 1).alias("cycle"), (F.ascii("x.q") - offset).alias("q"), F.upper(F.coalesce("x.b", F.lit(""))).alias("base"))
    bars = cells.groupBy("cycle", "q").agg(F.count("*").alias("rows"), *[F.count_if(F.col("base") == b).alias(f"base_{b}") for b in "ACGTN"])
    upto = Window.partitionBy("cycle").orderBy("q")
    whole = Window.partitionBy("cycle")
    bars = bars.withColumn("c", F.sum("rows").over(upto)).withColumn("t", F.sum("rows").over(whole))

    def quantile(quarters: int):
        return F.min(F.when(F.col("c") > F.floor(F.col("t") * quarters / 4), F.col("q")))

    rows = bars.groupBy("cycle").agg(
        F.sum("rows").alias("count"), F.min("q").alias("min"), F.max("q").alias("max"), F.sum(F.col("q") * F.col("rows")).alias("sum"),
        quantile(1).alias("q1"), quantile(2).alias("med"), quantile(3).alias("q3"), *[F.sum(f"base_{b}").alias(f"{b.lower()}_count") for b in "ACGTN"],
    )
    rows = rows.crossJoin(F.broadcast(rows.agg(F.max("count").alias("max_count"))))  # one row
    iqr = F.col("q3") - F.col("q1")
    rows = rows.withColumn("iqr", iqr).withColumn("mean", F.round(F.col("sum") / F.col("count"), 2))
    reach = F.expr("iqr * 3 div 2")
    return rows.withColumn("lw", F.greatest(F.col("q1") - reach, F.col("min"))).withColumn("rw", F.least(F.col("q3") + reach, F.col("max")))


def read_statistics(reads: DataFrame, read: str, insert: str, length: str) -> DataFrame:
    """Reads, bases, longest, mean length and inserts; a read's length is its longest row's."""
    each = reads.groupBy(read).agg(F.max(length).alias("_n"), F.min(insert).alias("_i"))
    return each.agg(F.count("*").alias("reads"), F.sum("_n").alias("bases"), F.max("_n").alias("max"), F.avg("_n").alias("avg"), F.count_distinct("_i").alias("inserts"))


def assembly_statistics(contigs: DataFrame, group: list[str], length: str, cutoffs: tuple[int, ...] = (0, 200, 500, 1000, 2000, 4000)) -> DataFrame:
    """num, total, n50, n90, max and min of contigs of at least each cutoff.

    Works on the histogram of lengths, which stays small however many contigs there are.
    """
    rows = contigs.withColumn("cutoff", F.explode(F.array(*map(F.lit, cutoffs)))).where(F.col(length) >= F.col("cutoff"))
    key = [*group, "cutoff"]
    bars = rows.groupBy(*key, F.col(length).alias("_l")).agg(F.count("*").alias("_n"))
    down = Window.partitionBy(*key).orderBy(F.desc("_l"))
    bars = bars.withColumn("_c", F.sum(F.col("_l") * F.col("_n")).over(down)).withColumn("_t", F.sum(F.col("_l") * F.col("_n")).over(Window.partitionBy(*key)))
    return bars.groupBy(*key).agg(
        F.sum("_n").alias("num"), F.max("_t").alias("total"), F.max(F.when(F.col("_c") >= 0.5 * F.col("_t"), F.col("_l"))).alias("n50"),
        F.max(F.when(F.col("_c") >= 0.9 * F.col("_t"), F.col("_l"))).alias("n90"), F.max("_l").alias("max"), F.min("_l").alias("min"))


def insert_size(pairs: DataFrame) -> DataFrame:
    """Whole mean distance of mates (pos1, pos2, minus1, minus2, length); minus-strand mates end later."""
    a = F.col("pos1") + F.when(F.col("minus1"), F.col("length")).otherwise(0)
    b = F.col("pos2") + F.when(F.col("minus2"), F.col("length")).otherwise(0)
    return pairs.agg(F.avg(F.abs(a - b)).cast("long").alias("insert_size"))


def prevalent_means(cells: DataFrame, group: str, *, prevalence: int = 2, least: float = 1.0) -> DataFrame:
    """Mean of a (group, sample)'s positive whole values if there are enough of them and it is large enough, else 0; and its fraction."""
    v = F.floor("value")
    rows = cells.groupBy(group, "sample").agg(F.count_if(v > 0).alias("n"), F.avg(F.when(v > 0, v)).alias("m"))
    rows = rows.withColumn("value", F.when((F.col("n") >= prevalence) & (F.col("m") >= least), F.col("m")).otherwise(0.0))
    rows = rows.withColumn("most", F.max("n").over(Window.partitionBy(group))).where(F.col("most") >= prevalence)
    total = F.sum("value").over(Window.partitionBy("sample"))
    return rows.select(group, "sample", "value", F.when(total > 0, F.col("value") / total).otherwise(0.0).alias("fraction"))


def column_fractions(matrix: DataFrame) -> DataFrame:
    """value over its sample's sum; missing stays missing, a zero sum gives 0."""
    total = F.sum("value").over(Window.partitionBy("sample"))
    fraction = F.when(F.col("value").isNull(), None).when(total == 0, 0.0).otherwise(F.col("value") / total)
    return matrix.select("feature", "sample", fraction.alias("fraction"))


def group_columns(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    """sum, mean, non-zero mean and median of non-zero values."""
    some = F.nullif(F.col(value), F.lit(0.0))
    return rows.groupBy(*group).agg(F.sum(value).alias("sum"), F.avg(value).alias("mean"), F.avg(some).alias("nonzero_mean"), F.median(some).alias("nonzero_median"))


def multiplicity(rows: DataFrame, key: str, item: str) -> DataFrame:
    """Histogram of the number of distinct items a key maps to."""
    return rows.groupBy(key).agg(F.count_distinct(item).alias("k")).groupBy("k").agg(F.count("*").alias("n"))


def unique_multi_bins(rows: DataFrame, *, width: int, sub: int = 10) -> DataFrame:
    """Reads, bases and sub-bins filled by full-identity unique hits per (ref, type, identity, bin) of (read, ref, identity, pos, length)."""
    w = Window.partitionBy("read")
    kinds = F.size(F.collect_set("ref").over(w))
    rows = rows.withColumn("type", F.when(kinds == 1, "unique").otherwise("multi"))
    exact = F.when((F.col("identity") >= 100) & (F.col("type") == "unique"), F.floor(F.col("pos") / sub))
    return rows.groupBy("ref", "type", F.round("identity", 1).alias("identity"), (F.floor(F.col("pos") / width) + 1).alias("bin")).agg(
        F.count("*").alias("reads"), F.sum("length").alias("bases"), F.count_distinct(exact).alias("filled"))


def depth_histogram(spans: DataFrame, key: str, start: str, stop: str) -> DataFrame:
    """(key, depth, positions): a sweep over +1 and -1 events, never one row a position."""
    events = spans.select(key, F.explode(F.array(F.struct(F.col(start).alias("at"), F.lit(1).alias("d")), F.struct((F.col(stop) + 1).alias("at"), F.lit(-1).alias("d")))).alias("e"))
    events = events.groupBy(key, F.col("e.at").alias("at")).agg(F.sum("e.d").alias("d"))
    w = Window.partitionBy(key).orderBy("at")
    rows = events.withColumn("depth", F.sum("d").over(w)).withColumn("n", F.lead("at").over(w) - F.col("at"))
    return rows.where("depth > 0 and n > 0").groupBy(key, "depth").agg(F.sum("n").alias("positions"))


def merged_intervals(spans: DataFrame, key: list[str], start: str, stop: str) -> DataFrame:
    """Maximal unions of overlapping or touching intervals (islands)."""
    w = Window.partitionBy(*key).orderBy(start, stop)
    before = F.max(stop).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = spans.withColumn("_new", F.when(before.isNull() | (F.col(start) > before + 1), 1).otherwise(0))
    rows = rows.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*key, "_island").agg(F.min(start).alias("start"), F.max(stop).alias("stop")).drop("_island")


def covered_length(spans: DataFrame, key: list[str], start: str, stop: str) -> DataFrame:
    return merged_intervals(spans, key, start, stop).groupBy(*key).agg(F.sum(F.col("stop") - F.col("start") + 1).alias("covered"))


def gaps(spans: DataFrame, lengths: DataFrame, key: str, start: str, stop: str, *, margin: int = 100) -> DataFrame:
    """Uncovered blocks of each contig (key, length), outside its margins."""
    islands = merged_intervals(spans, [key], start, stop)
    w = Window.partitionBy(key).orderBy("start")
    ends = lengths.select(key, F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("stop")).unionByName(lengths.select(key, (F.col("length") + 1).alias("start"), (F.col("length") + 1).alias("stop")))
    rows = islands.select(key, F.col("start").cast("long"), F.col("stop").cast("long")).unionByName(ends)
    rows = rows.withColumn("next", F.lead("start").over(w)).join(lengths, key)
    rows = rows.select(key, F.greatest(F.col("stop") + 1, F.lit(margin + 1)).alias("gap_start"), F.least(F.col("next") - 1, F.col("length") - margin).alias("gap_stop"))
    return rows.where("gap_stop >= gap_start")


def fractional_assignment(hits: DataFrame, read: str, taxon: str, score: str) -> DataFrame:
    """Reads split evenly over the rows with their best score, summed by taxon."""
    w = Window.partitionBy(read)
    top = hits.withColumn("_m", F.max(score).over(w)).where(F.col(score) == F.col("_m")).withColumn("_n", F.count("*").over(w))
    return top.groupBy(taxon).agg(F.sum(1.0 / F.col("_n")).alias("reads"))


def confident_rank(rows: DataFrame, ranks: list[str], threshold: float) -> DataFrame:
    """Deepest rank of each read with enough confidence, each read counted 1/occurrence."""
    deepest = F.coalesce(*[F.when(F.col(f"{r}_conf") >= threshold, F.struct(F.lit(r).alias("rank"), F.col(r).alias("name"))) for r in reversed(ranks)])
    picked = rows.select("read", deepest.alias("p")).where("p is not null").select("read", "p.*").distinct()
    picked = picked.withColumn("w", 1.0 / F.count("*").over(Window.partitionBy("read")))
    return picked.groupBy("rank", "name").agg(F.sum("w").alias("reads"))


def summary(matrix: DataFrame) -> DataFrame:
    return matrix.agg(F.sum("value").alias("sum"), F.count("value").alias("count"), F.avg("value").alias("avg"), F.min("value").alias("min"), F.max("value").alias("max"))


def binned_distribution(rows: DataFrame, value: str, step: float) -> DataFrame:
    """Share of rows by value rounded to a multiple; the total is a one-row join."""
    bars = rows.groupBy((F.round(F.col(value) / step) * step).alias("bin")).agg(F.count("*").alias("n"))
    return bars.crossJoin(F.broadcast(bars.agg(F.sum("n").alias("_t")))).select("bin", "n", (F.col("n") / F.col("_t")).alias("share"))


def correction_counts(rows: DataFrame, group: list[str] = ()) -> DataFrame:
    """Counters of assembly corrections (depth, first, second, first_quality, second_quality) per group.

    Rows of depth 10 or less are left out.  Without qualities a row is a replacement.  Else the
    allele of the higher quality (the second on a tie) is an indel, its sign first: a minus
    removes bases.  Large ones are longer than 30 with the sign; sizes do not count it.
    """
    rows = rows.where("depth > 10")
    replaced = F.col("first_quality").isNull()
    allele = F.when(F.col("first_quality") > F.col("second_quality"), F.col("first")).otherwise(F.col("second"))
    rows = rows.withColumn("_a", F.when(~replaced, allele)).withColumn("_n", F.length("_a") - 1)
    less = F.col("_a").contains("-")
    none = F.lit(0)
    return rows.groupBy(*group).agg(
        F.count_if(replaced).alias("replaced"), F.count_if(~less).alias("added"), F.count_if(less).alias("removed"), F.count_if(F.col("_n") + 1 > 30).alias("large"),
        F.coalesce(F.sum(F.when(~less, F.col("_n"))), none).alias("bases_added"), F.coalesce(F.sum(F.when(less, F.col("_n"))), none).alias("bases_removed"),
        F.coalesce(F.max(F.when(~less, F.col("_n"))), none).alias("largest_added"), F.coalesce(F.max(F.when(less, F.col("_n"))), none).alias("largest_removed"))


def break_statistics(rows: DataFrame, *, weak: int = 50, spanned: int = 20, short: int = 500) -> DataFrame:
    """Breaks of contigs and the bases they lose: rows (contig, length, sizes, cuts, pairs), the lists by commas, cuts as start-stop.

    A block of at most ``weak`` bases that ``spanned`` pairs or more reach over is no break.  A
    break loses its block, and the piece before it (the last one also the piece after) if that
    is shorter than ``short``.
    """
    cuts = F.concat(F.array(F.lit(0).cast("long")), F.transform(F.split("cuts", "[,-]"), lambda x: x.cast("long")), F.array((F.col("length") + 1).cast("long")))
    rows = rows.select("contig", F.transform(F.split("sizes", ","), lambda x: x.cast("long")).alias("s"), cuts.alias("c"), F.transform(F.split("pairs", ","), lambda x: x.cast("long")).alias("p"))
    each = rows.select("contig", F.posexplode("s").alias("i", "size"), F.size("s").alias("n"), "c", "p")
    piece = lambda k: F.get("c", k + 1) - F.get("c", k) - 1
    before, after = piece(2 * F.col("i")), piece(F.size("c") - 2)
    lost = F.col("size") + F.when(before < short, before).otherwise(0) + F.when((F.col("i") == F.col("n") - 1) & (after < short), after).otherwise(0)
    return each.where(~((F.col("size") <= weak) & (F.get("p", F.col("i")) >= spanned))).agg(F.count("*").alias("breaks"), F.coalesce(F.sum(lost), F.lit(0)).alias("lost"))


def majority_bases(rows: DataFrame, *, max_ref: int = 10, least_share: float = 0.7, min_depth: int = 10, least_quality: float | None = None) -> DataFrame:
    """Positions (a, c, g, t, ref, optionally depth and quality) where another base clearly outweighs the reference.

    With a depth column the share is of the depth, which must exceed ``min_depth``; with
    ``least_quality`` the consensus and mapping qualities (quality, map_quality) must reach it.
    Of equal bases the last in the order A, T, C, G is taken.
    """
    counts = {b: F.col(b.lower()) for b in "GCTA"}
    top = F.greatest(*counts.values())
    base = F.coalesce(*[F.when(c == top, F.lit(b)) for b, c in counts.items()])
    ref = F.coalesce(*[F.when(F.col("ref") == b, c) for b, c in counts.items()], F.lit(0))
    depth = F.col("depth") if "depth" in rows.columns else sum(counts.values())
    keep = (ref <= max_ref) & (F.col("share") >= least_share) & (F.col("base") != F.col("ref"))
    if "depth" in rows.columns:
        keep &= F.col("depth") > min_depth
    if least_quality is not None:
        keep &= (F.col("quality") >= least_quality) & (F.col("map_quality") >= least_quality)
    return rows.withColumn("base", base).withColumn("share", top / depth).where(keep)


def majority_indels(rows: DataFrame, *, cutoff: float, min_depth: int = 10) -> DataFrame:
    """Indels (contig, pos, allele) whose quality a depth exceeds ``cutoff``, the first allele before the second; rows as in ``correction_counts``."""
    sure = lambda allele, quality: (F.col(quality) / F.col("depth") > cutoff) & F.col(allele).rlike("^[+-]")
    allele = F.when(sure("first", "first_quality"), F.col("first")).when(sure("second", "second_quality"), F.col("second"))
    return rows.where(F.col("depth") > min_depth).withColumn("allele", allele).where("allele is not null").select("contig", "pos", "allele")


def patch_sequences(contigs: DataFrame, changes: DataFrame, *, chunk: int = 1000) -> DataFrame:
    """Contigs (contig, seq) with single-base changes (contig, pos, base) put in, one change a position.

    Contigs are cut into chunks that meet their own changes only, so work grows with the length and not with length times changes.
    """
    parts = contigs.select("contig", F.posexplode_outer(F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))).alias("part", "seq"))
    place = F.col("pos").cast("int") - 1
    entry = F.struct((place % chunk + 1).alias("pos"), "base")
    lists = changes.groupBy("contig", F.floor(place / chunk).cast("int").alias("part")).agg(F.map_from_entries(F.collect_list(entry)).alias("changes"))
    bases = F.transform(F.split("seq", ""), lambda b, i: F.coalesce(F.element_at("changes", i + 1), b))
    patched = parts.join(lists, ["contig", "part"], "left").withColumn("seq", F.when(F.col("changes").isNull(), F.col("seq")).otherwise(F.array_join(bases, "")))
    text = F.transform(F.sort_array(F.collect_list(F.struct("part", "seq"))), lambda x: F.coalesce(x["seq"], F.lit("")))
    return patched.groupBy("contig").agg(F.array_join(text, "").alias("seq"))


def size_normalised(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Counts over genome size; the unmapped row -1 over the mean size."""
    mean = sizes.agg(F.avg("size").alias("_mean"))
    joined = rows.join(sizes, "taxon", "left").crossJoin(F.broadcast(mean))
    return joined.select("taxon", (F.col("value") / F.when(F.col("taxon") == "-1", F.col("_mean")).otherwise(F.col("size"))).alias("value"))


def weighted_scaling(rows: DataFrame, taxon: str) -> DataFrame:
    """taxon, norm, raw and scaled sums of genes (taxon, value, length): norm values times the ratio of all values to all norm values."""
    sums = rows.groupBy(taxon).agg(F.sum("value").alias("raw"), F.sum(F.col("value") / F.col("length")).alias("norm"))
    total = sums.agg((F.sum("raw") / F.sum("norm")).alias("_w"))
    return sums.crossJoin(F.broadcast(total)).withColumn("scaled", F.col("norm") * F.col("_w")).drop("_w")


def multiplicity_summary(histogram: DataFrame) -> DataFrame:
    """keys, share of keys with one item, and interactions (all items of all keys) of a histogram (k, n)."""
    return histogram.agg(F.sum("n").alias("keys"), (F.sum(F.when(F.col("k") == 1, F.col("n")).otherwise(0)) / F.sum("n")).alias("unique_fraction"), F.sum(F.col("k") * F.col("n")).alias("interactions"))


def copy_normalised(counts: DataFrame, copies: DataFrame, closure: DataFrame, root: str) -> DataFrame:
    """Counts (taxon, sample, value) over the copy number (id, copies) of the nearest ancestor that has one; unassigned (-1) over the root's."""
    near = closure.join(copies.where("copies > 0").select(F.col("id").alias("ancestor"), "copies"), "ancestor")
    near = near.groupBy(F.col("id").alias("_taxon")).agg(F.min_by("copies", "steps").alias("_copies"))
    key = F.when(F.col("taxon") == "-1", F.lit(root)).otherwise(F.col("taxon"))
    joined = counts.withColumn("_taxon", key).join(near, "_taxon", "left")
    return joined.select("taxon", "sample", (F.col("value") / F.col("_copies")).alias("value"))


def transferred_coverage(hits: DataFrame, coverage: DataFrame, lengths: DataFrame) -> DataFrame:
    """protein, value: each gene's coverage (gene, coverage) times the positions of the protein it covers, over the proteins it ties with and the protein's length.

    hits are (gene, protein, start, stop); overlapping hits of a gene on a protein count a position once.
    """
    covered = covered_length(hits, ["gene", "protein"], "start", "stop")
    covered = covered.withColumn("_ties", F.count("*").over(Window.partitionBy("gene")))
    rows = covered.join(coverage, "gene").join(lengths, "protein")
    return rows.groupBy("protein").agg(F.sum(F.col("covered") * F.col("coverage") / F.col("_ties") / F.col("length")).alias("value"))


def rank_totals(counts: DataFrame, ancestors: DataFrame) -> DataFrame:
    """Counts (taxon, sample, value) summed by the ancestor (id, at_rank) of each taxon; the row -1 is carried apart."""
    rows = counts.join(ancestors.select(F.col("id").alias("taxon"), "at_rank"), "taxon", "left")
    feature = F.when(F.col("taxon") == "-1", F.lit("-1")).otherwise(F.coalesce("at_rank", F.col("taxon")))
    return rows.groupBy(feature.alias("feature"), "sample").agg(F.sum("value").alias("value"))
