"""Rank tests, multiple-testing correction, AUC, cutoff sweeps."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import DoubleType


def rank_sums(rows: DataFrame, feature: str, group: str, value: str, first: str, second: str) -> DataFrame:
    """Per feature: sizes, rank sum and U of the first group (average ranks), ties, z with tie and continuity correction, AUC."""
    rows = rows.where(F.col(group).isin(first, second))
    same = Window.partitionBy(feature, value)
    w = Window.partitionBy(feature).orderBy(value)
    ties = F.count("*").over(same)
    rows = rows.withColumn("_rank", F.rank().over(w) + (ties - 1) / 2.0).withColumn("_ties", ties.cast("double"))
    one = F.col(group) == first
    found = rows.groupBy(feature).agg(F.count_if(one).alias("n1"), F.count_if(~one).alias("n2"), F.sum(F.when(one, F.col("_rank")).otherwise(0.0)).alias("rank_sum"), F.sum(F.col("_ties") ** 2 - 1).alias("_t"))
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    u = F.col("rank_sum") - n1 * (n1 + 1) / 2
    mean, n = n1 * n2 / 2, n1 + n2
    deviation = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.col("_t") / (n * (n - 1))))
    d = u - mean
    z = (d - F.signum(d) * 0.5) / deviation
    return found.withColumn("u", u).withColumn("z", F.when(deviation > 0, z)).withColumn("auc", F.when((n1 > 0) & (n2 > 0), u / (n1 * n2))).drop("_t")


@F.pandas_udf(DoubleType())
def two_sided_p(z: pd.Series) -> pd.Series:
    return z.map(lambda x: None if x is None or x != x else math.erfc(abs(x) / math.sqrt(2)))


def exact_rank_p(u: float, n1: int, n2: int) -> float:
    """Two-sided exact p of U without ties, by counting arrangements."""
    ways = [[0] * (n1 * n2 + 1) for _ in range(n1 + 1)]
    ways[0][0] = 1
    for value in range(1, n1 + n2 + 1):
        for k in range(min(n1, value), 0, -1):
            shift = value - k
            if shift <= n2:
                for s in range(n1 * n2, shift - 1, -1):
                    ways[k][s] += ways[k - 1][s - shift]
    total = math.comb(n1 + n2, n1)
    low = sum(ways[n1][: int(min(u, n1 * n2 - u)) + 1])
    return min(1.0, 2 * low / total)


def adjust(rows: DataFrame, p: str, how: str, order: list[str]) -> DataFrame:
    """Adds q: bonferroni, bh or by over all rows with a p value.

    Ranks and running minima come from a range partition: each part numbers its own rows and
    takes what the parts before (or after) it hold from a table with one row a part.
    """
    some = rows.where(F.col(p).isNotNull())
    n = some.agg(F.count("*").cast("double").alias("_n"))
    some = some.crossJoin(F.broadcast(n))
    if how == "bonferroni":
        return some.withColumn("q", F.least(F.lit(1.0), F.col(p) * F.col("_n"))).drop("_n")
    factor = F.lit(1.0)
    if how == "by":  # the sum of 1 / i is taken once, in blocks, not for each row
        some, factor = some.crossJoin(F.broadcast(_harmonic(n))), F.col("_h")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = some.agg(F.percentile_approx(p, [k / parts for k in range(1, parts)], 10_000).alias("_b")) if parts > 1 else some.agg(F.array().cast("array<double>").alias("_b"))
    some = some.crossJoin(F.broadcast(bounds)).withColumn("_part", F.size(F.filter("_b", lambda b: b < F.col(p)))).drop("_b")
    inside = Window.partitionBy("_part").orderBy(F.col(p), *order)
    counts = some.groupBy("_part").agg(F.count("*").alias("_c"))
    before = counts.withColumn("_before", F.sum("_c").over(Window.partitionBy(F.lit(0)).orderBy("_part")) - F.col("_c"))  # one row a part
    some = some.join(F.broadcast(before.select("_part", "_before")), "_part").withColumn("_q", F.col(p) * F.col("_n") * factor / (F.col("_before") + F.row_number().over(inside)))
    least = some.groupBy("_part").agg(F.min("_q").alias("_m"))
    after = least.withColumn("_after", F.min("_m").over(Window.partitionBy(F.lit(0)).orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)))
    back = Window.partitionBy("_part").orderBy(F.desc(p), *[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    some = some.join(F.broadcast(after.select("_part", "_after")), "_part")
    return some.withColumn("q", F.least(F.lit(1.0), F.min("_q").over(back), F.col("_after"))).drop("_q", "_n", "_h", "_part", "_before", "_after")


def _harmonic(n: DataFrame, block: int = 1 << 16) -> DataFrame:
    """One row, _h: the sum of 1 / i for i up to _n, in blocks that tasks share."""
    n = n.select(F.col("_n").cast("long").alias("_n"))
    blocks = n.select("_n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / block))).alias("_b")).where("_n > 0").repartition("_b")
    terms = F.sequence(F.col("_b") * block + 1, F.least("_n", (F.col("_b") + 1) * block))
    return blocks.select(F.aggregate(terms, F.lit(0.0), lambda a, i: a + 1.0 / i).alias("_s")).agg(F.coalesce(F.sum("_s"), F.lit(0.0)).alias("_h"))


def rank_sum_summary(rows: DataFrame, feature: str, group: str, value: str, first: str, second: str, shift: float = 1e-8) -> DataFrame:
    """Per feature: medians and means of log10(x + shift) in both groups, and the fold change of their means."""
    rows = rows.where(F.col(group).isin(first, second)).withColumn("_l", F.log10(F.col(value) + shift))
    of = lambda f, g: f(F.when(F.col(group) == g, F.col("_l")))
    found = rows.groupBy(feature).agg(*[of(f, g).alias(f"{name}{k}") for k, g in ((1, first), (2, second)) for name, f in (("median", F.median), ("mean", F.avg))])
    return found.withColumn("fold_change", F.pow(F.lit(10.0), F.greatest("mean1", "mean2") - F.least("mean1", "mean2")))


def roc_curve(rows: DataFrame, feature: str, score: str, truth: Column) -> DataFrame:
    """Per feature and distinct score, from the highest: true and false positive rates of scores at least that high."""
    bars = rows.groupBy(feature, score).agg(F.count_if(truth).alias("_t"), F.count_if(~truth).alias("_f"))
    down, all_ = Window.partitionBy(feature).orderBy(F.desc(score)), Window.partitionBy(feature)
    rate = lambda c: F.sum(c).over(down) / F.nullif(F.sum(c).over(all_), F.lit(0))
    return bars.select(feature, score, rate("_t").alias("tpr"), rate("_f").alias("fpr"))


def cutoff_sweep(rows: DataFrame, score: str, truth: Column, cutoffs: Column) -> DataFrame:
    """Precision, recall and F1 of score >= cutoff; the table of scores is read once."""
    total = rows.agg(F.count_if(truth).alias("_p"))
    each = rows.select(F.col(score).alias("_s"), truth.alias("_y")).withColumn("cutoff", F.explode(cutoffs)).where(F.col("_s") >= F.col("cutoff"))
    found = each.groupBy("cutoff").agg(F.count_if("_y").alias("tp"), F.count_if(~F.col("_y")).alias("fp")).crossJoin(F.broadcast(total))
    found = found.withColumn("precision", F.col("tp") / (F.col("tp") + F.col("fp"))).withColumn("recall", F.col("tp") / F.nullif(F.col("_p"), F.lit(0)))
    return found.withColumn("f1", F.coalesce(2 * F.col("precision") * F.col("recall") / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0)), F.lit(0.0))).drop("_p")


def best_cutoff(sweep: DataFrame) -> DataFrame:
    """The cutoff of the largest F1, the highest of ties."""
    top = sweep.agg(F.max(F.struct("f1", "cutoff", "precision", "recall")).alias("b"))
    return top.select("b.cutoff", "b.f1", "b.precision", "b.recall")


def anova_f(rows: DataFrame, feature: str, group: str, value: str) -> DataFrame:
    """One-way F statistic per feature with its degrees of freedom."""
    g = rows.groupBy(feature, group).agg(F.count("*").alias("n"), F.avg(value).alias("m"), F.sum(F.col(value) ** 2).alias("s2"))
    g = g.withColumn("_grand", F.sum(F.col("m") * F.col("n")).over(Window.partitionBy(feature)) / F.sum("n").over(Window.partitionBy(feature)))
    t = g.groupBy(feature).agg((F.count("*") - 1).alias("df1"), (F.sum("n") - F.count("*")).alias("df2"), F.sum(F.col("n") * (F.col("m") - F.col("_grand")) ** 2).alias("between"), F.sum(F.col("s2") - F.col("n") * F.col("m") ** 2).alias("within"))
    return t.select(feature, "df1", "df2", ((F.col("between") / F.col("df1")) / (F.col("within") / F.col("df2"))).alias("f"))


def friedman(rows: DataFrame, feature: str, block: str, treatment: str, value: str) -> DataFrame:
    """Friedman's statistic (without tie correction) per feature over complete blocks."""
    w = Window.partitionBy(feature, block)
    ranks = rows.withColumn("_r", F.rank().over(w.orderBy(value)) + (F.count("*").over(Window.partitionBy(feature, block, value)) - 1) / 2.0)
    sums = ranks.groupBy(feature, treatment).agg(F.sum("_r").alias("r"), F.count("*").alias("n"))
    t = sums.groupBy(feature).agg(F.count("*").alias("k"), F.max("n").alias("n"), F.sum(F.col("r") ** 2).alias("rr"))
    return t.select(feature, "k", "n", (12.0 / (F.col("n") * F.col("k") * (F.col("k") + 1)) * F.col("rr") - 3 * F.col("n") * (F.col("k") + 1)).alias("q"))


def size_factors(m: DataFrame) -> DataFrame:
    """Median-of-ratios factors of the samples of a filled count matrix."""
    logs = m.withColumn("_l", F.avg(F.when(F.col("value") > 0, F.log("value"))).over(Window.partitionBy("feature"))).withColumn("_z", F.min("value").over(Window.partitionBy("feature")))
    return logs.where("_z > 0").groupBy("sample").agg(F.median(F.col("value") / F.exp("_l")).alias("factor"))


def _beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_share(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d, out = 1.0, 0.0, 1.0
    for m in range(300):
        k, odd = divmod(m, 2)
        if m == 0:
            step = 1.0
        elif odd:
            step = -(a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1))
        else:
            step = k * (b - k) * x / ((a + 2 * k - 1) * (a + 2 * k))
        d = 1 / ((1 + step * d) or 1e-300)
        c = (1 + step / c) or 1e-300
        out *= c * d
        if m and abs(1 - c * d) < 1e-14:
            break
    return front * (out - 1)


def f_tail(f: float, df1: float, df2: float) -> float:
    """P(F >= f)."""
    return _beta_share(df2 / 2, df1 / 2, df2 / (df2 + df1 * f)) if f > 0 else 1.0


def chi2_tail(x: float, k: float) -> float:
    """P(chi squared with k degrees of freedom >= x), by series or continued fraction."""
    a, x = k / 2, x / 2
    if x <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > 1e-16 * total:
            n += 1
            term *= x / n
            total += term
        return 1 - total * scale
    b, c = x + 1 - a, 1e300
    d = out = 1 / b
    for i in range(1, 500):
        step = -i * (i - a)
        b += 2
        d, c = 1 / (step * d + b), b + step / c
        out *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return scale * out


@F.pandas_udf(DoubleType())
def f_p(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    return pd.Series([None if v is None or v != v else f_tail(v, a, b) for v, a, b in zip(f, df1, df2, strict=True)], dtype="float64")


@F.pandas_udf(DoubleType())
def chi2_p(x: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([None if v is None or v != v else chi2_tail(v, d) for v, d in zip(x, k, strict=True)], dtype="float64")


def anova_two(rows: DataFrame, feature: str, first: str, second: str, value: str) -> DataFrame:
    """F statistics of two factors without interaction on complete layouts (every pair of levels once), with p values: f1, f2, df1, df2, df_rest, p1, p2."""
    v = F.col(value)
    each = lambda by: F.avg(v).over(Window.partitionBy(feature, *by))
    rows = rows.select(feature, first, second, v.alias(value)).withColumns({"_a": each([first]), "_b": each([second]), "_m": each([])})
    t = rows.groupBy(feature).agg(
        (F.count_distinct(first) - 1).cast("double").alias("df1"), (F.count_distinct(second) - 1).cast("double").alias("df2"),
        F.sum((F.col("_a") - F.col("_m")) ** 2).alias("s1"), F.sum((F.col("_b") - F.col("_m")) ** 2).alias("s2"), F.sum((v - F.col("_a") - F.col("_b") + F.col("_m")) ** 2).alias("rest"))
    t = t.withColumn("df_rest", F.col("df1") * F.col("df2"))
    over = lambda x, n: x / F.nullif(n, F.lit(0.0))
    f = lambda s, df: over(over(F.col(s), F.col(df)), over(F.col("rest"), F.col("df_rest")))
    t = t.withColumns({"f1": f("s1", "df1"), "f2": f("s2", "df2")})
    return t.select(feature, "f1", "f2", "df1", "df2", "df_rest", f_p("f1", "df1", "df_rest").alias("p1"), f_p("f2", "df2", "df_rest").alias("p2"))
