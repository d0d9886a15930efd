"""Row selection: length and identity, regions, mates, screens, prevalence."""

from __future__ import annotations

from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from abundara.functions.reads import cigar_project, kmer_size, read_stem
from abundara.operators.scratch import kept


def length_identity(rows: DataFrame, length: str, identity: str, *, least_length: float = 45, least_identity: float = 95) -> DataFrame:
    return rows.where((F.col(length) >= least_length) & (F.col(identity) >= least_identity))


def best_hits(rows: DataFrame, key: list[str], score: str) -> DataFrame:
    """All rows of a key whose absolute score is the key's largest, ties included."""
    top = F.max(F.abs(F.col(score))).over(Window.partitionBy(*key))
    return rows.withColumn("_top", top).where(F.abs(F.col(score)) == F.col("_top")).drop("_top")


def mates_agree(rows: DataFrame, key: list[str], mate: str, ref: str) -> DataFrame:
    """If both mates of an insert share references, its rows on those; else all its rows."""
    both = F.min(mate).over(Window.partitionBy(*key, ref)) != F.max(mate).over(Window.partitionBy(*key, ref))
    rows = rows.withColumn("_both", both)
    rows = rows.withColumn("_any", F.max("_both").over(Window.partitionBy(*key)))
    return rows.where(F.col("_both") | ~F.col("_any")).drop("_both", "_any")


def in_regions(rows: DataFrame, regions: DataFrame, ref: str, first: str, last: str, *, once: bool = False) -> DataFrame:
    """Rows that overlap a region (ref, start, stop): once a region, or ``once`` at most."""
    regions = regions.select(F.col("ref").alias("_ref"), F.col("start").alias("_start"), F.col("stop").alias("_stop"))
    hit = (F.col(ref) == F.col("_ref")) & (F.col(first) <= F.col("_stop")) & (F.col(last) >= F.col("_start"))
    return rows.join(regions, hit, "left_semi" if once else "inner").select(*rows.columns)


def region_times(rows: DataFrame, regions: DataFrame, ref: str, first: str, last: str) -> DataFrame:
    """Rows that overlap a region (ref, start, stop), each once, with ``times``, the number of regions it overlaps.

    Each distinct place of rows meets each distinct place of regions once; rows get their
    place's number by equality.
    """
    place = [ref, first, last]
    regions = regions.groupBy(F.col("ref").alias("_ref"), F.col("start").alias("_start"), F.col("stop").alias("_stop")).agg(F.count("*").alias("_same"))
    hit = (F.col(ref) == F.col("_ref")) & (F.col(first) <= F.col("_stop")) & (F.col(last) >= F.col("_start"))
    times = kept(rows.select(*place).distinct().join(regions, hit).groupBy(*place).agg(F.sum("_same").alias("times")))
    few = times.count() <= 250_000  # one name and three numbers a row
    return rows.join(F.broadcast(times) if few else times, place).select(*rows.columns, "times")


def screen(reads: DataFrame, hits: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(extracted, screened): reads whose key is hit, and the others."""
    found = hits.select(key).distinct()
    return reads.join(found, key, "left_semi"), reads.join(found, key, "left_anti")


def hit_filter(hits: DataFrame, **least) -> DataFrame:
    """Hits with each named column at or above its bound; ``max_evalue`` bounds evalue from above."""
    top = least.pop("max_evalue", None)
    conditions = [F.col(c) >= v for c, v in least.items()] + ([F.col("evalue") <= top] if top is not None else [])
    return hits.where(reduce(Column.__and__, conditions, F.lit(True)))


def not_trivial(hits: DataFrame, query: str, subject: str, identity: str, *, ceiling: float | None = None, allow_self: bool = False, allow_full: bool = False, name: str | None = None) -> DataFrame:
    """Drop self hits, full-identity hits, hits above a ceiling, and subjects matching a pattern."""
    keep = F.lit(True)
    if not allow_self:
        keep &= F.col(query) != F.col(subject)
    if not allow_full:
        keep &= F.col(identity) < 100
    if ceiling is not None:
        keep &= F.col(identity) <= ceiling
    if name is not None:
        keep &= ~F.col(subject).rlike(name)
    return hits.where(keep)


def five_prime_cut(cycles: DataFrame, lane: str, cycle: str, bases: list[str], *, deviations: float = 2.0, least_quality: float | None = None) -> DataFrame:
    """First kept cycle per lane: after the leading run of cycles in which any base is off its mean.

    With ``least_quality`` only cycles whose mean and median quality (mean, med) reach it are looked at.
    """
    if least_quality is not None:
        cycles = cycles.where((F.col("mean") >= least_quality) & (F.col("med") >= least_quality))
    w = Window.partitionBy(lane)
    # with d = n x - sum the test is d^2 (n - 1) > deviations^2 * sum of d^2: whole numbers for counts, so no rounding decides a tie
    times = Fraction(str(deviations))
    offs = []
    for k, b in enumerate(bases):
        whole = isinstance(cycles.schema[b].dataType, (ByteType, ShortType, IntegerType, LongType))
        x, d = F.col(b).cast("decimal(38,0)" if whole else "double"), F.col(f"_d{k}")
        cycles = cycles.withColumn(f"_d{k}", F.count(b).over(w) * x - F.sum(x).over(w))
        offs.append(d * d * (F.count(b).over(w) - 1) * F.lit(times.denominator**2) > F.lit(times.numerator**2) * F.sum(d * d).over(w))
    off = reduce(Column.__or__, offs)
    marked = cycles.withColumn("_off", F.coalesce(off, F.lit(False)))
    return marked.groupBy(lane).agg(F.coalesce(F.min(F.when(~F.col("_off"), F.col(cycle))), F.max(cycle) + 1).alias("first_cycle"))


def frequent_features(matrix: DataFrame, *, least_total: float = 0, least_max: float = 0, least_samples: float = 0) -> DataFrame:
    """Cells of features with enough total, maximum and prevalence (a share of all samples)."""
    samples = matrix.select("sample").distinct().agg(F.count("*").alias("_n"))
    good = matrix.groupBy("feature").agg(F.sum("value").alias("_t"), F.max("value").alias("_m"), F.count_if(F.col("value") > 0).alias("_p"))
    good = good.crossJoin(F.broadcast(samples)).where((F.col("_t") >= least_total) & (F.col("_m") >= least_max) & (F.col("_p") >= least_samples * F.col("_n")))
    return matrix.join(good.select("feature"), "feature", "left_semi")


def top_samples(matrix: DataFrame, share: float) -> DataFrame:
    """Cells of the samples in the top share by total."""
    totals = matrix.groupBy("sample").agg(F.sum("value").alias("_t"))
    ranked = totals.withColumn("_r", F.percent_rank().over(Window.orderBy(F.desc("_t"), "sample")))  # one row a sample
    return matrix.join(ranked.where(F.col("_r") < share), "sample", "left_semi")


def pair_by_header(first: DataFrame, second: DataFrame, stem: str) -> DataFrame:
    """Full outer pairing of two mates' reads; kind says which mates there are."""
    a = first.select(F.col(stem).alias("stem"), *[F.col(c).alias(f"{c}_1") for c in first.columns if c != stem], F.lit(True).alias("_1"))
    b = second.select(F.col(stem).alias("stem"), *[F.col(c).alias(f"{c}_2") for c in second.columns if c != stem], F.lit(True).alias("_2"))
    kind = F.when(F.col("_1") & F.col("_2"), "pair").when(F.col("_1"), "single.1").otherwise("single.2")
    return a.join(b, "stem", "full").withColumn("kind", kind).drop("_1", "_2")


def pair_by_place(first: DataFrame, second: DataFrame, place: str, seq: str) -> DataFrame:
    """Mates paired by their numbered place; kind tells whether both, or which, survived trimming (seq not null)."""
    a = first.select(place, F.col(seq).alias("seq_1"))
    b = second.select(place, F.col(seq).alias("seq_2"))
    kind = F.when(F.col("seq_1").isNotNull() & F.col("seq_2").isNotNull(), "pair").when(F.col("seq_1").isNotNull(), "single.1").when(F.col("seq_2").isNotNull(), "single.2")
    return a.join(b, place, "full").withColumn("kind", kind).where(F.col("kind").isNotNull())


def revision_pairs(rows: DataFrame, *, least_identity: float = 0.9) -> DataFrame:
    """Alignments (insert, mate, identity) of inserts whose two mates pass, with each read's number of hits."""
    good = rows.where(F.col("identity") >= least_identity)
    mates = F.size(F.collect_set("mate").over(Window.partitionBy("insert")))
    return good.withColumn("_m", mates).where("_m = 2").drop("_m").withColumn("hits", F.count("*").over(Window.partitionBy("insert", "mate")))


def sam_filter(rows: DataFrame, *, least_length: int, least_identity: float) -> DataFrame:
    """Alignments (cigar, pos, mismatches) by total length, clips included, and identity on the matched length."""
    p = cigar_project(F.col("cigar"), F.col("pos"))
    share = 100 - F.col("mismatches") / F.col("_p.match_len") * 100
    return rows.withColumn("_p", p).where((F.col("_p.total_len") >= least_length) & (share >= least_identity)).drop("_p")


def merge_in_order(order: DataFrame, parts: list[DataFrame], read: str = "read_id") -> DataFrame:
    """Rows of several alignment tables in the order of a list of reads (read, ord), mates beside each other.

    Every row's read must be in the list: an unknown one is an error, so as many rows come out as go in.
    """
    rows = reduce(lambda a, b: a.unionByName(b), [p.withColumn("_part", F.lit(n)) for n, p in enumerate(parts)])
    joined = rows.join(order.select(F.col(read), F.col("ord")), read, "left")
    checked = F.when(F.col("ord").isNull(), F.raise_error(F.concat(F.lit("not in the list of reads: "), F.col(read))).cast("long")).otherwise(F.col("ord"))
    return joined.withColumn("ord", checked).orderBy("ord", "_part").drop("_part")


def trim_single(reads: DataFrame, trimmed: Column) -> DataFrame:
    """Reads (header, seq, qual) with a trimmed (seq, qual) put in and headers ``stem/1``; those trimmed away or filtered go."""
    rows = reads.select(read_stem(F.col("header")).alias("stem"), trimmed.alias("t")).where("stem is not null and t is not null")
    return rows.select(F.concat("stem", F.lit("/1")).alias("header"), "t.seq", "t.qual")


def trim_paired(first: DataFrame, second: DataFrame, single: DataFrame | None, trim) -> DataFrame:
    """(stem, kind, seq_1, qual_1, seq_2, qual_2) of two mates' reads paired by their stems, whatever their order.

    ``trim`` maps (qual, seq) columns to a trimmed struct or null.  kind is pair, single.1 or
    single.2; reads of a third file are single.1 each.
    """

    def ready(reads: DataFrame) -> DataFrame:
        rows = reads.select(read_stem(F.col("header")).alias("stem"), trim(F.col("qual"), F.col("seq")).alias("t"))
        return rows.where("stem is not null and t is not null").select("stem", "t.seq", "t.qual")

    paired = pair_by_header(ready(first), ready(second), "stem")
    if single is not None:
        alone = ready(single).select("stem", F.col("seq").alias("seq_1"), F.col("qual").alias("qual_1"), F.lit("single.1").alias("kind"))
        paired = paired.unionByName(alone, allowMissingColumns=True)
    return paired.select("stem", "kind", "seq_1", "qual_1", "seq_2", "qual_2")


def cut_lookup(lanes: DataFrame, cuts: DataFrame) -> DataFrame:
    """The first cycle kept of each (sample, lane) from a table (ord, sample, lane, first_cycle), lanes with or without a suffix; the last line wins, none is an error."""
    bare = lambda c: F.regexp_replace(c, r"(\.fq)?(\.gz|\.bz2)?$", "")
    last = cuts.groupBy("sample", bare(F.col("lane")).alias("_lane")).agg(F.max_by("first_cycle", "ord").alias("first_cycle"))
    joined = lanes.withColumn("_lane", bare(F.col("lane"))).join(last, ["sample", "_lane"], "left")
    missing = F.raise_error(F.concat(F.lit("no 5' cut for "), F.col("sample"), F.lit(" "), F.col("lane"))).cast("int")
    return joined.withColumn("first_cycle", F.when(F.col("first_cycle").isNull(), missing).otherwise(F.col("first_cycle"))).drop("_lane")


def screen_statistics(reads: DataFrame, hits: DataFrame, key: str, length: str) -> DataFrame:
    """Reads, bases, longest, mean length, k-mer size and inserts of both sides of a screen, in one pass over the reads."""
    found = hits.select(key).distinct().withColumn("_hit", F.lit(True))
    rows = reads.join(found, key, "left").withColumn("side", F.when(F.col("_hit"), "extracted").otherwise("screened"))
    per = rows.groupBy("side").agg(F.count("*").alias("reads"), F.sum(length).alias("bases"), F.max(length).alias("max"), F.avg(length).alias("avg"), F.count_distinct(key).alias("inserts"))
    return per.withColumn("kmer", kmer_size(F.col("bases"), F.col("reads")))


def hit_inserts(hits: DataFrame, insert: str, length: str, identity: str, *, least_length: float, least_identity: float) -> DataFrame:
    """Inserts with an alignment long and alike enough."""
    return length_identity(hits, length, identity, least_length=least_length, least_identity=least_identity).select(insert).distinct()


def hit_summary(hits: DataFrame, query: str) -> DataFrame:
    """All hits, and queries that have one."""
    return hits.agg(F.count("*").alias("hits"), F.count_distinct(query).alias("queries"))


def subject_order(hits: DataFrame, subject: str) -> DataFrame:
    """Hits by subject, the most first."""
    return hits.groupBy(subject).agg(F.count("*").alias("n")).orderBy(F.desc("n"), subject)


def long_hits(hits: DataFrame, *, queries: DataFrame | None = None, subjects: DataFrame | None = None, least_query: float = 0.0, least_subject: float = 0.0) -> DataFrame:
    """Hits whose aligned part is at least a share of the query's and of the subject's length (tables query or subject, length)."""
    rows = hits
    for table, name, a, b, least in ((queries, "query", "qs", "qe", least_query), (subjects, "subject", "ss", "se", least_subject)):
        if table is not None:
            rows = rows.join(table.select(F.col(name), F.col("length").alias("_n")), name)
            rows = rows.where((F.abs(F.col(b) - F.col(a)) + 1) / F.col("_n") >= least).drop("_n")
    return rows


def long_sequences(rows: DataFrame, seq: str, least: int = 100) -> DataFrame:
    return rows.where(F.length(seq) >= least)


def complete_genes(genes: DataFrame, sequences: DataFrame, gene: str = "gene") -> DataFrame:
    """Sequences of the genes whose type is complete."""
    return sequences.join(genes.where("gene_type = 'complete'").select(gene), gene, "left_semi")


def metadata_subset(rows: DataFrame, samples: DataFrame, key: str, **allowed) -> DataFrame:
    """Rows of the samples whose every named variable has one of its allowed values."""
    keep = reduce(Column.__and__, [F.col(c).isin(*v) for c, v in allowed.items()], F.lit(True))
    return rows.join(samples.where(keep).select(key), key, "left_semi")


def sturdy_cells(matrix: DataFrame, *, least: float | None = None, least_samples: int = 0) -> DataFrame:
    """Cells of a matrix without those that are zero or below ``least``, and without features then left in too few samples."""
    cells = matrix.where(F.col("value") != 0) if least is None else matrix.where((F.col("value") != 0) & (F.col("value") >= least))
    good = cells.groupBy("feature").agg(F.count_distinct("sample").alias("_n")).where(F.col("_n") >= least_samples)
    return cells.join(good.select("feature"), "feature", "left_semi")


def without_empty_rows(matrix: DataFrame) -> DataFrame:
    """Cells of features that are not zero everywhere."""
    return matrix.join(matrix.where("value <> 0").select("feature").distinct(), "feature", "left_semi")


def prune_references(coordinates: DataFrame, present: DataFrame, ref: str = "ref") -> DataFrame:
    """Intervals of the references that occur in a list."""
    return coordinates.join(present.select(ref).distinct(), ref, "left_semi")
