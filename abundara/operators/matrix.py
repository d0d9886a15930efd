"""Matrices in long form (feature, sample, value): algebra, normalisation, distance, diversity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def transpose(m: DataFrame) -> DataFrame:
    return m.select(F.col("sample").alias("feature"), F.col("feature").alias("sample"), "value")


def multiply(a: DataFrame, b: DataFrame, *, complete: bool = False) -> DataFrame:
    """a(feature, k) times b(k, sample), each with value.

    With ``complete`` a missing cell is an error, told by the number of products of each result
    cell; else it counts as zero.
    """
    out = a.withColumnRenamed("value", "_a").join(b.withColumnRenamed("value", "_b"), "k").groupBy("feature", "sample").agg(F.sum(F.col("_a") * F.col("_b")).alias("value"), F.count("*").alias("_n"))
    if complete:
        inner = a.select("k").union(b.select("k")).agg(F.count_distinct("k").alias("_k"))
        lost = F.raise_error(F.concat(F.lit("a cell is missing for "), "feature", F.lit(" and "), "sample")).cast("double")
        out = out.crossJoin(F.broadcast(inner)).withColumn("value", F.when(F.col("_n") < F.col("_k"), lost).otherwise(F.col("value")))
    return out.select("feature", "sample", "value")


def scale(m: DataFrame, by: float) -> DataFrame:
    return m.withColumn("value", F.col("value") * by)


def normalise_rows(m: DataFrame) -> DataFrame:
    """Shares within each feature; a feature that sums to zero is an error."""
    total = F.sum("value").over(Window.partitionBy("feature"))
    none = F.raise_error(F.concat(F.lit("a row sums to zero: "), "feature")).cast("double")
    return m.withColumn("value", F.when(total == 0, none).otherwise(F.col("value") / total))


def melt(wide_: DataFrame, key: str = "feature") -> DataFrame:
    """Long form of a table with a column a sample."""
    names = [c for c in wide_.columns if c != key]
    return wide_.unpivot(key, names, "sample", "value")


def rescale(m: DataFrame, by: str = "feature") -> DataFrame:
    """Values moved to 0 to 1 within each feature (or sample); a constant one becomes 0."""
    w = Window.partitionBy(by)
    low, high = F.min("value").over(w), F.max("value").over(w)
    return m.withColumn("value", F.when(high > low, (F.col("value") - low) / (high - low)).otherwise(0.0))


def apply(m: DataFrame, *, cell=None, feature=None, sample=None) -> DataFrame:
    """Functions of columns put to every cell, feature name or sample name; cells that fall together are summed."""
    out = m.select(
        (feature or (lambda c: c))(F.col("feature")).alias("feature"), (sample or (lambda c: c))(F.col("sample")).alias("sample"), (cell or (lambda c: c))(F.col("value")).alias("value"))
    return out.groupBy("feature", "sample").agg(F.sum("value").alias("value")) if feature or sample else out


def diversity_over_groups(m: DataFrame, group) -> DataFrame:
    """Mean and deviation over groups of features (marker genes) of richness, Chao1, effective species and evenness, per sample."""
    parts = m.withColumn("sample", F.concat_ws("\x01", "sample", group))
    each = alpha_diversity(parts).withColumn("sample", F.split_part("sample", F.lit("\x01"), F.lit(1)))
    names = ("richness", "chao1", "effective", "evenness")
    return each.groupBy("sample").agg(*[f(c).alias(f"{c}_{n}") for c in names for n, f in (("mean", F.avg), ("sd", F.stddev_samp))])


def zero_fill(m: DataFrame, value: float = 0.0) -> DataFrame:
    """Every feature of every sample: the result itself is the product of the two key sets."""
    keys = m.select("feature").distinct().crossJoin(m.select("sample").distinct())
    return keys.join(m, ["feature", "sample"], "left").select("feature", "sample", F.coalesce("value", F.lit(value)).alias("value"))


def row_sums(m: DataFrame) -> DataFrame:
    return m.groupBy("feature").agg(F.sum("value").alias("value"))


def column_sums(m: DataFrame) -> DataFrame:
    return m.groupBy("sample").agg(F.sum("value").alias("value"))


def merge(*parts: DataFrame) -> DataFrame:
    """Cells of all matrices, a later one's before an earlier one's."""
    rows = parts[0].withColumn("_p", F.lit(0))
    for n, part in enumerate(parts[1:], 1):
        rows = rows.unionByName(part.withColumn("_p", F.lit(n)))
    return rows.groupBy("feature", "sample").agg(F.max_by("value", "_p").alias("value"))


def with_prior(m: DataFrame, prior: float = 1e-6) -> DataFrame:
    """(x + p) / (1 + n p) within each sample of n cells."""
    n = F.count("*").over(Window.partitionBy("sample"))
    return m.withColumn("value", (F.col("value") + prior) / (1 + n * prior))


def normalise(m: DataFrame, how: str) -> DataFrame:
    """total, max, freq, normalize, standardize, pa, hellinger or log (base 2)."""
    s, f, v = Window.partitionBy("sample"), Window.partitionBy("feature"), F.col("value")
    share = F.when(F.sum(v).over(s) == 0, 0.0).otherwise(v / F.sum(v).over(s))
    value = {
        "total": lambda: share, "max": lambda: v / F.max(v).over(f), "hellinger": lambda: F.sqrt(share),
        "freq": lambda: v / F.max(v).over(f) * 0 + v / F.sum(v).over(f) * F.count_if(v > 0).over(f),
        "normalize": lambda: v / F.sqrt(F.sum(v * v).over(s)), "standardize": lambda: (v - F.avg(v).over(f)) / F.stddev_samp(v).over(f),
        "pa": lambda: (v > 0).cast("double"), "log": lambda: F.when(v > 0, F.log2(v) + 1).otherwise(0.0),
    }[how]()
    return m.withColumn("value", value)


def distances(m: DataFrame, how: str, prior: float = 1e-6) -> DataFrame:
    """(a, b, distance) of samples a < b over a filled matrix: euclid on shares, kld or jsd on shares with a prior.

    The result has a row for every two samples; the join is on features.
    """
    p = F.col("value") / F.sum("value").over(Window.partitionBy("sample"))
    shares = m.withColumn("value", p)
    if how != "euclid":
        shares = shares.withColumn("value", F.when(F.col("value") == 0, prior).otherwise(F.col("value")))
    a, b = (shares.select("feature", F.col("sample").alias(n), F.col("value").alias(f"_{n}")) for n in ("a", "b"))
    pairs = a.join(b, "feature").where("a < b")
    x, y = F.col("_a"), F.col("_b")
    mid = (x + y) / 2
    total = {"euclid": F.sqrt(F.sum((x - y) ** 2)), "kld": F.sum(x * F.log(x / y)), "jsd": F.sqrt(F.sum(0.5 * x * F.log(x / mid) + 0.5 * y * F.log(y / mid)))}[how]
    return pairs.groupBy("a", "b").agg(total.alias("distance"))


def alpha_diversity(m: DataFrame) -> DataFrame:
    """Richness, Shannon, Simpson, inverse Simpson, Chao1, effective species and evenness on whole counts."""
    rows = m.withColumn("c", F.floor("value").cast("double")).where("c > 0")
    rows = rows.withColumn("p", F.col("c") / F.sum("c").over(Window.partitionBy("sample")))
    found = rows.groupBy("sample").agg(
        F.count("*").alias("richness"), (-F.sum(F.col("p") * F.log("p"))).alias("shannon"), (1 - F.sum(F.col("p") ** 2)).alias("simpson"),
        (1 / F.sum(F.col("p") ** 2)).alias("inverse_simpson"), F.count_if(F.col("c") == 1).alias("f1"), F.count_if(F.col("c") == 2).alias("f2"))
    found = found.withColumn("chao1", F.col("richness") + F.col("f1") * (F.col("f1") - 1) / (2 * (F.col("f2") + 1)))
    return found.withColumn("effective", F.exp("shannon")).withColumn("evenness", F.exp("shannon") / F.col("richness"))


def beta_components(m: DataFrame) -> DataFrame:
    """Features shared by two samples (a < b), and held by only one of them."""
    held = m.where("value > 0").select("feature", "sample").distinct()
    n = held.groupBy("sample").agg(F.count("*").alias("n"))
    x, y = held.withColumnRenamed("sample", "a"), held.withColumnRenamed("sample", "b")
    both = x.join(y, "feature").where("a < b").groupBy("a", "b").agg(F.count("*").alias("shared"))
    pairs = n.select(F.col("sample").alias("a"), F.col("n").alias("na")).join(n.select(F.col("sample").alias("b"), F.col("n").alias("nb")), F.col("a") < F.col("b"))
    shared = F.coalesce("shared", F.lit(0).cast("long"))
    return pairs.join(both, ["a", "b"], "left").select("a", "b", shared.alias("shared"), (F.col("na") - shared).alias("only_a"), (F.col("nb") - shared).alias("only_b"))


def feature_ratio(m: DataFrame, top: str, bottom: str) -> DataFrame:
    """Per sample the ratio of two features, null where the lower one is missing or zero."""
    each = m.groupBy("sample").agg(F.sum(F.when(F.col("feature") == top, F.col("value"))).alias("t"), F.sum(F.when(F.col("feature") == bottom, F.col("value"))).alias("b"))
    return each.select("sample", (F.col("t") / F.nullif(F.col("b"), F.lit(0.0))).alias("ratio"))


def wide(m: DataFrame, samples: list[str]) -> DataFrame:
    """One column a sample; missing cells are 0."""
    return m.groupBy("feature").pivot("sample", samples).agg(F.sum("value")).fillna(0.0)
