"""Writers of profiles, reads, matrices and summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_profile(profile: DataFrame, path: str) -> None:
    """Long profile, one folder a level, count, distribution and normalisation: column pruning replaces extracting files."""
    profile.write.mode("overwrite").partitionBy("level", "count_type", "dist_type", "norm_type").parquet(path)


def long_profile(rows: DataFrame, level: str) -> DataFrame:
    """(sample, level, feature, count_type, dist_type, norm_type, value) of a wide profile."""
    cells = [F.struct(F.lit(d or "plain").alias("dist_type"), F.lit(n).alias("norm_type"), F.col(f"{p}{n}").alias("value")) for d, p in (("", ""), ("only.unique", "unique_"), ("mm.dist.among.unique", "mm_")) for n in ("raw", "norm", "scaled")]
    return rows.select("sample", F.lit(level).alias("level"), "feature", F.col("kind").alias("count_type"), F.explode(F.array(*cells)).alias("c")).select("sample", "level", "feature", "count_type", "c.*")


def long_horizontal(covered: DataFrame, level: str, sample: str) -> DataFrame:
    """Horizontal coverage (feature, covered) in the form of a long profile."""
    cell = {"level": level, "count_type": "horizontal", "dist_type": "plain", "norm_type": "covered"}
    return covered.select(F.lit(sample).alias("sample"), F.lit(cell["level"]).alias("level"), "feature", *[F.lit(cell[c]).alias(c) for c in ("count_type", "dist_type", "norm_type")], F.col("covered").cast("double").alias("value"))


def unique_names(profile: DataFrame, coordinates: DataFrame) -> DataFrame:
    """Features of interval profiles (ref, idx) by their unique names ref_start_stop."""
    named = coordinates.select("ref", "idx", F.concat_ws("_", "ref", F.col("start").cast("string"), F.col("stop").cast("string")).alias("feature"))
    return profile.join(named, ["ref", "idx"]).drop("ref", "idx")


def read_member(spark, path: str, **member) -> DataFrame:
    """One part of a written profile (level, count_type, dist_type, norm_type): other parts' files are not opened."""
    rows = spark.read.parquet(path)
    for c, v in member.items():
        rows = rows.where(F.col(c) == v)
    return rows


def write_stats(stats: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """A small table of statistics as one tab-separated file with a header; more runs append."""
    names = columns or stats.columns
    stats.select(*names).coalesce(1).write.mode("append").option("header", True).option("sep", "\t").csv(path)


def write_fastq(reads: DataFrame, path: str, by: str | None = None) -> None:
    """Reads (header, seq, qual) as gzipped FASTQ text, one folder a value of ``by``."""
    text = F.concat(F.lit("@"), "header", F.lit("\n"), "seq", F.lit("\n+\n"), "qual")
    rows = reads.select(text.alias("value"), *([by] if by else []))
    out = rows.write.mode("overwrite").option("compression", "gzip")
    (out.partitionBy(by) if by else out).text(path)


def write_sam(alignments: DataFrame, path: str) -> None:
    tags = F.transform(F.map_entries("tags"), lambda e: F.concat_ws(":", e["key"], F.lit("i"), e["value"]))
    names = ("read_id", "flag", "ref", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")
    alignments.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in names], F.array_join(tags, "\t")).alias("value")).write.mode("overwrite").text(path)


def write_fasta(rows: DataFrame, path: str, width: int = 60) -> None:
    from abundara.functions.reads import wrap

    rows.select(F.concat(F.lit(">"), "seq_id", F.lit("\n"), wrap(F.col("seq"), width)).alias("value")).write.mode("overwrite").text(path)


def write_matrix(matrix: DataFrame, samples: list[str], path: str) -> None:
    """Feature-by-sample table; cells have eight decimals, missing ones are 0."""
    wide = matrix.groupBy("feature").pivot("sample", samples).agg(F.sum("value")).fillna(0.0)
    wide.select("feature", *[F.format_string("%.8f", F.col(f"`{s}`")).alias(s) for s in samples]).write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)


def write_cells(matrix: DataFrame, path: str) -> None:
    """Three columns, without zero cells."""
    matrix.where("value <> 0").select("feature", "sample", F.format_string("%.8f", "value").alias("value")).write.mode("overwrite").option("sep", "\t").csv(path)


def summaries(parts: dict[str, DataFrame]) -> DataFrame:
    """Tables of several stages under one another, missing columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn("stage", F.lit(name)) for name, df in parts.items()])


def soap_to_sam(rows: DataFrame, *, least_length: int = 45, least_identity: float = 95) -> DataFrame:
    """Filtered SAM rows of SOAP alignments with identity times ten as score."""
    from abundara.functions.reads import identity, mapping_quality, mismatches

    nm = mismatches(F.col("md"))
    share = identity(nm, F.col("length"))
    kept = rows.withColumn("_nm", nm).withColumn("_id", share).where((F.col("length") >= least_length) & (F.col("_id") >= least_identity))
    return kept.select(
        "read_id", F.when(F.col("strand") == "-", 16).otherwise(0).alias("flag"), "ref", "pos", F.lit(255).alias("mapq"), "cigar", F.lit("*").alias("rnext"), F.lit(0).cast("long").alias("pnext"), F.lit(0).cast("long").alias("tlen"), "seq", "qual",
        F.create_map(F.lit("AS"), mapping_quality(F.col("_id")).cast("string"), F.lit("NM"), F.col("_nm").cast("string")).alias("tags"))


def save_summary(summary: DataFrame, name: str) -> None:
    """A summary as a managed table that replaces the one before."""
    summary.write.mode("overwrite").saveAsTable(name)


def paired_sam(pairs: DataFrame) -> DataFrame:
    """Flags, mate places and insert sizes for rows (insert, mate, ref, pos, length, strand) whose mates may be joined; with marks also MD and NM tags."""
    from abundara.functions.reads import mismatch_tag

    other = pairs.select(F.col("insert").alias("_i"), (3 - F.col("mate")).alias("_m"), F.col("ref").alias("_ref"), F.col("pos").alias("_pos"), F.col("length").alias("_len"), F.col("strand").alias("_strand"))
    rows = pairs.join(other, (F.col("insert") == F.col("_i")) & (F.col("mate") == F.col("_m")), "left")
    found, same = F.col("_i").isNotNull(), F.col("ref") == F.col("_ref")
    reverse, mate_reverse = (F.when(F.col(c) == "-", b).otherwise(0) for c, b in (("strand", 16), ("_strand", 32)))
    flag = F.lit(1).bitwiseOR(F.when(found & same, 2).otherwise(0)).bitwiseOR(F.when(found, 0).otherwise(8)).bitwiseOR(reverse).bitwiseOR(F.when(found, mate_reverse).otherwise(0)).bitwiseOR(F.when(F.col("mate") == 1, 64).otherwise(128))
    left, right = F.least("pos", "_pos"), F.greatest(F.col("pos") + F.col("length"), F.col("_pos") + F.col("_len"))
    size = F.when(found & same, F.when(F.col("pos") <= F.col("_pos"), right - left).otherwise(left - right)).otherwise(0)
    tags = F.create_map(F.lit("MD"), mismatch_tag(F.col("marks"), F.col("length")), F.lit("NM"), F.size(F.filter(F.split(F.coalesce("marks", F.lit("")), ","), lambda m: m != "")).cast("string")) if "marks" in pairs.columns else None
    return rows.select("insert", "mate", "ref", "pos", flag.alias("flag"), *([tags.alias("tags")] if tags is not None else []), F.when(found, F.when(same, "=").otherwise(F.col("_ref"))).otherwise("*").alias("rnext"), F.coalesce("_pos", F.lit(0)).alias("pnext"), size.alias("tlen"))
