"""Seeded resampling of counts, exact and without collecting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from abundara.operators.scratch import kept


def _lot(seed: int, *columns):
    return F.xxhash64(F.lit(seed), *columns)


#: Counts of a cell are numbered and drawn this many at a time, so one large cell is many tasks' work.
BLOCK = 1 << 16


def _near_draw(cells: DataFrame, depth: int, seed: int, wide: float) -> DataFrame:
    """(_cell, lot, n): counts by digest up to a bound somewhat past the ``depth``-th of a sample; a null lot sums those well before it."""
    t, chance = F.col("_t"), F.lit(float(depth)) / F.col("_t")
    spread = wide * (8 * F.sqrt(depth * (1 - chance)) + 16)
    signed = lambda share: ((share - 0.5) * 2.0**64).cast("long")
    low, high = (depth - spread) / t, (depth + spread) / t
    rows = cells.withColumn("_low", F.when(low > 0, signed(low))).withColumn("_high", F.when(high < 1, signed(high)))
    rows = rows.withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("c") - 1) / BLOCK))))
    rows = rows.repartition(int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_cell", "_b")
    rows = rows.withColumn("n", F.explode(F.sequence(F.col("_b") * BLOCK + 1, F.least("c", (F.col("_b") + 1) * BLOCK))))
    number = F.col("n")
    lot = F.when(number < 2**31, _lot(seed, F.col("sample"), F.col("feature"), number.cast("int"))).otherwise(_lot(seed, F.col("sample"), F.col("feature"), number))
    rows = rows.select("_cell", "_low", "_high", lot.alias("lot")).where("_high is null or lot < _high")
    return rows.groupBy("_cell", F.when(F.col("_low").isNull() | (F.col("lot") >= F.col("_low")), F.col("lot")).alias("lot")).agg(F.count("*").alias("n"))


def rarefy(m: DataFrame, depth: int, seed: int = 1) -> DataFrame:
    """``depth`` whole counts of each sample drawn without replacement; smaller samples stay as they are.

    Drawn are the counts of the ``depth`` least digests.  Digests are spread evenly, so the
    last one drawn lies close to depth / total of their range: counts well before it are
    summed by cell, those in a narrow band about it are ranked one by one.  Whether the band
    holds the place is counted; if it does not in any sample, a wider band is taken.
    """
    by = Window.partitionBy("sample")
    cells = m.select("sample", "feature", F.floor("value").cast("long").alias("c")).where("c > 0").withColumn("_t", F.sum("c").over(by))
    cells = kept(cells.withColumn("_cell", F.monotonically_increasing_id()))
    whole, cut = cells.where(F.col("_t") <= depth), cells.where(F.col("_t") > depth)
    samples, wide = cut.select("sample").distinct().count(), 1.0
    while True:
        near = kept(_near_draw(cut, depth, seed, wide).join(cut.select("_cell", "sample", "feature"), "_cell"))
        held = near.groupBy("sample").agg(F.sum(F.when(F.col("lot").isNull(), F.col("n")).otherwise(0)).alias("before"), F.sum("n").alias("all"))
        if depth <= 0 or held.where((F.col("before") <= depth) & (F.col("all") >= depth)).count() == samples:
            break
        wide *= 64
    upto = F.sum("n").over(by.orderBy(F.col("lot").asc_nulls_first(), "feature").rowsBetween(Window.unboundedPreceding, 0))
    drawn = near.withColumn("c", F.least(F.col("n"), F.lit(depth) - (upto - F.col("n")))).where("c > 0").select("sample", "feature", "c")
    return whole.select("sample", "feature", "c").unionByName(drawn).groupBy("sample", "feature").agg(F.sum("c").cast("double").alias("value"))


def thin(m: DataFrame, share: float, seed: int = 1) -> DataFrame:
    """Each whole count kept with a probability, by a digest of its cell and number."""
    each = m.withColumn("c", F.floor("value").cast("int")).where("c > 0").select("sample", "feature", F.explode(F.sequence(F.lit(1), F.col("c"))).alias("n"))
    kept = each.where(F.pmod(_lot(seed, F.col("sample"), F.col("feature"), F.col("n")), F.lit(1_000_000)) < int(share * 1_000_000))
    return kept.groupBy("sample", "feature").agg(F.count("*").cast("double").alias("value"))


def bootstrap(m: DataFrame, draws: int, replicates: int, seed: int = 1, steps: int = 64) -> DataFrame:
    """Multinomial replicates: each draw is a point on the sample's cumulated values.

    A sample's line is cut into ``steps`` equal bins; a draw meets only the cells of its bin.
    """
    w = Window.partitionBy("sample").orderBy("feature")
    cells = m.where("value > 0").withColumn("hi", F.sum("value").over(w)).withColumn("lo", F.col("hi") - F.col("value"))
    totals = m.groupBy("sample").agg(F.sum("value").alias("t")).where("t > 0")
    cells = cells.join(totals, "sample").withColumn("bin", F.explode(F.sequence(F.floor(F.col("lo") / F.col("t") * steps).cast("int"), F.least(F.floor(F.col("hi") / F.col("t") * steps).cast("int"), F.lit(steps))))).drop("t")
    points = totals.withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates)))).withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    point = F.pmod(_lot(seed, F.col("sample"), F.col("replicate"), F.col("draw")), F.lit(1 << 52)) / float(1 << 52) * F.col("t")
    points = points.select("sample", "replicate", point.alias("x"), F.floor(point / F.col("t") * steps).cast("int").alias("bin"))
    hit = points.join(cells, ["sample", "bin"]).where("x >= lo and x < hi")
    return hit.groupBy("sample", "replicate", "feature").agg(F.count("*").alias("value"))


def rarefy_to_least(m: DataFrame, *, top_share: float = 1.0, seed: int = 1) -> DataFrame:
    """All samples, or the ``top_share`` with the largest totals, rarefied to the smallest total among them."""
    m = kept(m)  # read for the totals and for the draw
    totals = m.groupBy("sample").agg(F.sum(F.floor("value")).alias("_t"))
    ranked = totals.withColumn("_r", F.row_number().over(Window.orderBy("_t", "sample"))).withColumn("_n", F.count("*").over(Window.partitionBy(F.lit(0))))  # one row a sample
    top = ranked.where(F.col("_r") >= F.ceil(F.col("_n") * F.lit(1 - top_share)))
    least = top.agg(F.min("_t")).first()[0]
    return rarefy(m.join(top.select("sample"), "sample", "left_semi"), int(least or 0), seed)


def thin_to_bases(m: DataFrame, target: float, lengths: DataFrame, seed: int = 1) -> DataFrame:
    """Base counts thinned by pseudo-reads: a cell's count over its sample's read length (sample, length) gives reads, each kept with
    the chance target / sample total; a last part of a read is kept with its share of that chance."""
    total = F.sum("value").over(Window.partitionBy("sample"))
    rows = m.withColumn("_chance", target / total).join(lengths, "sample").withColumn("_reads", F.col("value") / F.col("length"))
    each = rows.withColumn("_k", F.explode(F.sequence(F.lit(0), F.floor("_reads").cast("int"))))
    chance = F.when(F.col("_k") < F.floor("_reads"), F.col("_chance")).otherwise(F.col("_chance") * (F.col("_reads") - F.floor("_reads")))
    point = F.pmod(_lot(seed, F.col("sample"), F.col("feature"), F.col("_k")), F.lit(1 << 52)) / float(1 << 52)
    return each.groupBy("sample", "feature").agg((F.count_if(point < chance) * F.first("length")).cast("double").alias("value"))


def resample(items: DataFrame, id_: str, replicates: int, seed: int = 1) -> DataFrame:
    """Bootstrap by rows: each replicate draws as many rows as there are, with replacement; (replicate, id, times).

    Rows get places by a digest's order in parts; a draw is a place, so draws meet rows by equality.
    """
    n = items.count()
    parts = max(1, n // 1_000_000)
    placed = items.select(id_).withColumn("_part", F.pmod(_lot(seed, F.col(id_)), F.lit(parts)))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_c")).withColumn("_before", F.sum("_c").over(Window.partitionBy(F.lit(0)).orderBy("_part")) - F.col("_c"))  # one row a part
    placed = placed.join(F.broadcast(sizes.select("_part", "_before")), "_part").withColumn("_place", F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy(id_)) - 1)
    draws = items.sparkSession.range(n * replicates).select((F.floor(F.col("id") / n) + 1).cast("int").alias("replicate"), F.pmod(_lot(seed + 1, F.col("id")), F.lit(n)).alias("_place"))
    draws = draws.groupBy("replicate", "_place").agg(F.count("*").alias("times"))
    return draws.join(placed.select("_place", id_), "_place").select("replicate", id_, "times")


def shuffle(items: DataFrame, id_: str, seed: int = 1) -> DataFrame:
    """A seeded permutation: rows with the digest whose order is their place."""
    return items.withColumn("place", _lot(seed, F.col(id_)))
