"""Queries of aggregates, matrices, statistics, trees and sampling on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from abundara.operators import aggregates as A
from abundara.operators import matrix as M
from abundara.operators import sampling as S
from abundara.operators import stats as T
from abundara.operators import tree as G
from abundara.plans.profiles import rounded
from abundara.plans.registry import query

C = F.col


def cells(t):
    """Feature = brand, sample = nation of the supplier, value = quantity."""
    rows = t.lineitem.join(t.part, C("l_partkey") == C("p_partkey")).join(t.supplier, C("l_suppkey") == C("s_suppkey")).join(F.broadcast(t.nation), C("s_nationkey") == C("n_nationkey"))
    return rows.groupBy(C("p_brand").alias("feature"), C("n_name").alias("sample")).agg(F.sum("l_quantity").alias("value"))


_CELLS = """WITH m AS (SELECT p_brand AS feature, n_name AS sample, sum(l_quantity) AS value FROM lineitem JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)"""
_FILLED = _CELLS + ", f AS (SELECT a.feature, b.sample, coalesce(m.value, 0) AS value FROM (SELECT DISTINCT feature FROM m) a CROSS JOIN (SELECT DISTINCT sample FROM m) b LEFT JOIN m ON m.feature = a.feature AND m.sample = b.sample)"


@query("quality_stats", """
WITH d AS (SELECT regexp_replace(text, '[^!-~]', 'J', 'g') AS q FROM documents),
e AS (SELECT unnest(range(1, len(q) + 1)) AS cycle, ascii(unnest(string_split(q, ''))) - 33 AS q, upper(unnest(string_split(q, ''))) AS b FROM d),
h AS (SELECT cycle, q, count(*) AS n FROM e GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY cycle ORDER BY q) AS c, sum(n) OVER (PARTITION BY cycle) AS t FROM h),
x AS (SELECT cycle, sum(n)::BIGINT AS count, min(q) AS min, max(q) AS max, sum(q * n)::BIGINT AS sum, min(q) FILTER (c > t // 4) AS q1, min(q) FILTER (c > t * 2 // 4) AS med, min(q) FILTER (c > t * 3 // 4) AS q3 FROM c GROUP BY cycle),
b AS (SELECT cycle, sum((b = 'A')::INT)::BIGINT AS a_count, sum((b = 'C')::INT)::BIGINT AS c_count, sum((b = 'G')::INT)::BIGINT AS g_count, sum((b = 'T')::INT)::BIGINT AS t_count, sum((b = 'N')::INT)::BIGINT AS n_count FROM e GROUP BY cycle)
SELECT *, max(count) OVER () AS max_count, q3 - q1 AS iqr, (200 * sum + count) // (2 * count) / 100.0::DOUBLE AS mean, greatest(q1 - (q3 - q1) * 3 // 2, min) AS lw, least(q3 + (q3 - q1) * 3 // 2, max) AS rw FROM x JOIN b USING (cycle)""")
def quality_stats(t):
    q = F.regexp_replace("text", "[^!-~]", "J")
    return A.cycle_statistics(t.documents.select(q.alias("seq"), q.alias("qual")))


@query("read_stats", "SELECT count(*) AS reads, sum(n) AS bases, max(n) AS max, round(avg(n), 6) AS avg, count(DISTINCT i) AS inserts FROM (SELECT l_orderkey, l_linenumber, max(l_quantity) AS n, min(l_orderkey) AS i FROM lineitem GROUP BY ALL)")
def read_stats(t):
    rows = t.lineitem.select(F.struct("l_orderkey", "l_linenumber").alias("read"), "l_orderkey", "l_quantity")
    return rounded(A.read_statistics(rows, "read", "l_orderkey", "l_quantity"), "avg")


@query("n50_n90", """
WITH x AS (SELECT lang, cutoff, n_chars AS l FROM documents, (SELECT unnest([0, 200, 500, 1000, 2000, 4000]) AS cutoff) WHERE n_chars >= cutoff),
c AS (SELECT *, sum(l) OVER (PARTITION BY lang, cutoff ORDER BY l DESC) AS c, sum(l) OVER (PARTITION BY lang, cutoff) AS t FROM x)
SELECT lang, cutoff, count(*) AS num, max(t)::BIGINT AS total, max(l) FILTER (c >= 0.5 * t) AS n50, max(l) FILTER (c >= 0.9 * t) AS n90, max(l) AS max, min(l) AS min FROM c GROUP BY ALL""")
def n50_n90(t):
    return A.assembly_statistics(t.documents.select("lang", "n_chars"), ["lang"], "n_chars")


@query("insert_size", """
WITH p AS (SELECT a.l_extendedprice AS x, b.l_extendedprice AS y, a.l_returnflag = 'R' AS mx, b.l_returnflag = 'R' AS my FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = 1 AND b.l_linenumber = 2)
SELECT trunc(avg(abs((x + CASE WHEN mx THEN 50 ELSE 0 END) - (y + CASE WHEN my THEN 50 ELSE 0 END))))::BIGINT AS insert_size FROM p""")
def insert_size(t):
    def side(line, n):
        return t.lineitem.where(C("l_linenumber") == line).select("l_orderkey", C("l_extendedprice").alias(f"pos{n}"), (C("l_returnflag") == "R").alias(f"minus{n}"))

    return A.insert_size(side(1, 1).join(side(2, 2), "l_orderkey").withColumn("length", F.lit(50)))


@query("prevalence_mean", """
WITH g AS (SELECT c_mktsegment AS grp, n_name AS sample, count(*) FILTER (floor(c_acctbal / 1000) > 0) AS n, avg(CASE WHEN floor(c_acctbal / 1000) > 0 THEN floor(c_acctbal / 1000) END) AS m FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
v AS (SELECT *, CASE WHEN n >= 2 AND m >= 1 THEN m ELSE 0 END AS value, max(n) OVER (PARTITION BY grp) AS most FROM g)
SELECT grp, sample, round(value, 6) AS value, round(CASE WHEN sum(value) OVER (PARTITION BY sample) > 0 THEN value / sum(value) OVER (PARTITION BY sample) ELSE 0 END, 6) AS fraction FROM v WHERE most >= 2""")
def prevalence_mean(t):
    rows = t.customer.join(F.broadcast(t.nation), C("c_nationkey") == C("n_nationkey")).select(C("c_mktsegment").alias("grp"), C("n_name").alias("sample"), (C("c_acctbal") / 1000).alias("value"))
    return rounded(A.prevalent_means(rows, "grp"), "value", "fraction")


@query("column_fraction", _CELLS + " SELECT feature, sample, round(value / sum(value) OVER (PARTITION BY sample), 6) AS fraction FROM m")
def column_fraction(t):
    return rounded(A.column_fractions(cells(t)), "fraction")


@query("group_mean_median_nonzero", "SELECT l_returnflag, l_linestatus, round(sum(l_discount), 4) AS sum, round(avg(l_discount), 6) AS mean, round(avg(nullif(l_discount, 0)), 6) AS nonzero_mean, round(median(nullif(l_discount, 0)), 6) AS nonzero_median FROM lineitem GROUP BY ALL")
def group_mean_median_nonzero(t):
    return rounded(rounded(A.group_columns(t.lineitem, ["l_returnflag", "l_linestatus"], "l_discount"), "sum", digits=4), "mean", "nonzero_mean", "nonzero_median")


@query("histogram_k", "SELECT k, count(*) AS n FROM (SELECT count(DISTINCT l_partkey) AS k FROM lineitem GROUP BY l_orderkey) GROUP BY k")
def histogram_k(t):
    return A.multiplicity(t.lineitem, "l_orderkey", "l_partkey")


@query("unique_multi_bins", """
WITH h AS (SELECT l_orderkey AS read, p_brand AS ref, 100 - round(l_discount * 100, 1) AS identity, l_linenumber * 31 AS pos, l_quantity AS length FROM lineitem JOIN part ON l_partkey = p_partkey),
k AS (SELECT read, count(DISTINCT ref) AS n FROM h GROUP BY read), x AS (SELECT h.*, CASE WHEN n = 1 THEN 'unique' ELSE 'multi' END AS type FROM h JOIN k USING (read))
SELECT ref, type, round(identity, 1) AS identity, pos // 30 + 1 AS bin, count(*) AS reads, sum(length) AS bases, count(DISTINCT CASE WHEN identity >= 100 AND type = 'unique' THEN pos // 10 END) AS filled FROM x GROUP BY ALL""")
def unique_multi_bins(t):
    rows = t.lineitem.join(t.part, C("l_partkey") == C("p_partkey")).select(C("l_orderkey").alias("read"), C("p_brand").alias("ref"), (100 - F.round(C("l_discount") * 100, 1)).alias("identity"), (C("l_linenumber") * 31).alias("pos"), C("l_quantity").alias("length"))
    return A.unique_multi_bins(rows, width=30)


@query("depth_histogram", """
WITH s AS (SELECT l_suppkey AS k, l_linenumber * 5 AS a, l_linenumber * 5 + l_quantity::BIGINT AS b FROM lineitem), e AS (SELECT k, unnest(range(a, b + 1)) AS p FROM s),
d AS (SELECT k, p, count(*) AS depth FROM e GROUP BY ALL) SELECT k, depth, count(*) AS positions FROM d GROUP BY ALL""")
def depth_histogram(t):
    rows = t.lineitem.select(C("l_suppkey").alias("k"), (C("l_linenumber") * 5).cast("long").alias("a"), (C("l_linenumber") * 5 + C("l_quantity").cast("long")).alias("b"))
    return A.depth_histogram(rows, "k", "a", "b")


@query("interval_union_cov", """
WITH s AS (SELECT l_partkey AS k, l_linenumber * 100 AS a, l_linenumber * 100 + l_quantity::BIGINT * 4 AS b FROM lineitem), e AS (SELECT DISTINCT k, unnest(range(a, b + 1)) AS p FROM s)
SELECT k, count(*) AS covered FROM e GROUP BY k""")
def interval_union_cov(t):
    rows = t.lineitem.select(C("l_partkey").alias("k"), (C("l_linenumber") * 100).cast("long").alias("a"), (C("l_linenumber") * 100 + C("l_quantity").cast("long") * 4).alias("b"))
    return A.covered_length(rows, ["k"], "a", "b")


@query("zero_coverage_blocks", """
WITH s AS (SELECT l_partkey AS k, l_linenumber * 100 AS a, l_linenumber * 100 + l_quantity::BIGINT AS b FROM lineitem), c AS (SELECT DISTINCT k, unnest(range(a, b + 1)) AS p FROM s),
g AS (SELECT k, p FROM (SELECT DISTINCT k FROM s), (SELECT unnest(range(101, 901)) AS p) EXCEPT SELECT k, p FROM c),
i AS (SELECT k, p, p - row_number() OVER (PARTITION BY k ORDER BY p) AS g FROM g) SELECT k, min(p) AS gap_start, max(p) AS gap_stop FROM i GROUP BY k, g""")
def zero_coverage_blocks(t):
    rows = t.lineitem.select(C("l_partkey").alias("k"), (C("l_linenumber") * 100).cast("long").alias("a"), (C("l_linenumber") * 100 + C("l_quantity").cast("long")).alias("b"))
    lengths = rows.select("k").distinct().withColumn("length", F.lit(1000).cast("long"))
    return A.gaps(rows, lengths, "k", "a", "b")


@query("fractional_assignment", """
WITH b AS (SELECT l_orderkey, l_suppkey FROM lineitem QUALIFY rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC) = 1)
SELECT l_suppkey, round(sum(w), 6) AS reads FROM (SELECT l_suppkey, 1.0::DOUBLE / count(*) OVER (PARTITION BY l_orderkey) AS w FROM b) GROUP BY l_suppkey""")
def fractional_assignment(t):
    return rounded(A.fractional_assignment(t.lineitem, "l_orderkey", "l_suppkey", "l_quantity"), "reads")


@query("confident_rank", """
WITH d AS (SELECT DISTINCT l_orderkey AS read, CASE WHEN l_discount >= 0.05 THEN 'species' WHEN l_tax >= 0.03 THEN 'genus' END AS rank, CASE WHEN l_discount >= 0.05 THEN l_partkey::VARCHAR WHEN l_tax >= 0.03 THEN l_suppkey::VARCHAR END AS name FROM lineitem)
SELECT rank, name, round(sum(w), 6) AS reads FROM (SELECT *, 1.0::DOUBLE / count(*) OVER (PARTITION BY read) AS w FROM d WHERE rank IS NOT NULL) GROUP BY ALL""")
def confident_rank(t):
    rows = t.lineitem.select(C("l_orderkey").alias("read"), C("l_suppkey").cast("string").alias("genus"), (C("l_tax") + 0.02).alias("genus_conf"), C("l_partkey").cast("string").alias("species"), C("l_discount").alias("species_conf"))
    rows = rows.withColumn("genus_conf", F.when(F.round("genus_conf", 2) >= 0.05, 1.0).otherwise(0.0)).withColumn("species_conf", F.when(C("species_conf") >= 0.05, 1.0).otherwise(0.0))
    return rounded(A.confident_rank(rows, ["genus", "species"], 0.5), "reads")


@query("matrix_summary", _CELLS + " SELECT sum(value) AS sum, count(value) AS count, round(avg(value), 6) AS avg, min(value) AS min, max(value) AS max FROM m")
def matrix_summary(t):
    return rounded(A.summary(cells(t)), "avg")


@query("bin_distribution", "SELECT round(l_quantity / 5) * 5 AS bin, count(*) AS n, round(count(*) / (SELECT count(*) FROM lineitem), 6) AS share FROM lineitem GROUP BY 1")
def bin_distribution(t):
    return rounded(A.binned_distribution(t.lineitem, "l_quantity", 5), "share")


_CORRECTIONS = """WITH r AS (SELECT l_returnflag AS grp, l_partkey AS contig, l_linenumber AS pos, l_quantity AS depth, CASE WHEN l_linestatus = 'O' THEN '-' ELSE '+' END || repeat('A', l_suppkey % 40) AS first,
  CASE WHEN l_discount > 0.05 THEN '-' ELSE '+' END || repeat('C', l_partkey % 35) AS second, CASE WHEN l_linenumber % 3 > 0 THEN l_tax END AS q1, CASE WHEN l_linenumber % 3 > 0 THEN l_discount END AS q2 FROM lineitem)"""


def _corrections(t):
    signed = lambda minus, base, n: F.concat(F.when(minus, "-").otherwise("+"), F.repeat(F.lit(base), n.cast("int")))
    some = C("l_linenumber") % 3 > 0
    return t.lineitem.select(
        C("l_returnflag").alias("grp"), C("l_partkey").alias("contig"), C("l_linenumber").alias("pos"), C("l_quantity").alias("depth"), signed(C("l_linestatus") == "O", "A", C("l_suppkey") % 40).alias("first"),
        signed(C("l_discount") > 0.05, "C", C("l_partkey") % 35).alias("second"), F.when(some, C("l_tax")).alias("first_quality"), F.when(some, C("l_discount")).alias("second_quality"))


@query("correction_counts", _CORRECTIONS + """, x AS (SELECT grp, q1 IS NULL AS plain, CASE WHEN q1 IS NULL THEN NULL WHEN q1 > q2 THEN first ELSE second END AS allele FROM r WHERE depth > 10)
SELECT grp, count(*) FILTER (plain) AS replaced, count(*) FILTER (allele LIKE '+%') AS added, count(*) FILTER (allele LIKE '-%') AS removed, count(*) FILTER (length(allele) > 30) AS large,
coalesce(sum(length(allele) - 1) FILTER (allele LIKE '+%'), 0)::BIGINT AS bases_added, coalesce(sum(length(allele) - 1) FILTER (allele LIKE '-%'), 0)::BIGINT AS bases_removed,
coalesce(max(length(allele) - 1) FILTER (allele LIKE '+%'), 0)::INTEGER AS largest_added, coalesce(max(length(allele) - 1) FILTER (allele LIKE '-%'), 0)::INTEGER AS largest_removed FROM x GROUP BY grp""")
def correction_counts(t):
    return A.correction_counts(_corrections(t), ["grp"])


@query("majority_indels", _CORRECTIONS + """ SELECT contig, pos, CASE WHEN q1 / depth > 0.001 THEN first ELSE second END AS allele, count(*) AS n FROM r WHERE depth > 10 AND (q1 / depth > 0.001 OR q2 / depth > 0.001) GROUP BY ALL""")
def majority_indels(t):
    return A.majority_indels(_corrections(t), cutoff=0.001).groupBy("contig", "pos", "allele").agg(F.count("*").alias("n"))


@query("majority_bases", """
WITH x AS (SELECT l_orderkey, max(l_quantity) AS a, min(l_quantity) - 1 AS c, count(*) + 0.0::DOUBLE AS g, 0.0::DOUBLE AS t FROM lineitem GROUP BY 1), y AS (SELECT *, greatest(a, c, g, t) AS top FROM x)
SELECT l_orderkey, CASE top WHEN g THEN 'G' WHEN c THEN 'C' WHEN t THEN 'T' ELSE 'A' END AS base, round(top / (a + c + g + t), 6) AS share FROM y
WHERE g <= 10 AND top / (a + c + g + t) >= 0.7::DOUBLE AND CASE top WHEN g THEN 'G' WHEN c THEN 'C' WHEN t THEN 'T' ELSE 'A' END <> 'G'""")
def majority_bases(t):
    rows = t.lineitem.groupBy("l_orderkey").agg(F.max("l_quantity").alias("a"), (F.min("l_quantity") - 1).alias("c"), F.count("*").cast("double").alias("g"), F.lit(0.0).alias("t"), F.lit("G").alias("ref"))
    return rounded(A.majority_bases(rows).select("l_orderkey", "base", "share"), "share")


@query("patch_sequences", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'X' || p_name[2:] ELSE p_name END AS seq FROM part")
def patch_sequences(t):
    contigs = t.part.select(C("p_partkey").alias("contig"), C("p_name").alias("seq"))
    changes = t.part.where("p_partkey % 2 = 0").select(C("p_partkey").alias("contig"), F.lit(1).alias("pos"), F.lit("X").alias("base"))
    return A.patch_sequences(contigs, changes).withColumnRenamed("contig", "p_partkey")


@query("size_normalised", """SELECT t.taxon, round(t.value / CASE WHEN t.taxon = '-1' THEN (SELECT avg(p_size) FROM part) ELSE p_size END, 6) AS value
FROM (SELECT l_partkey::VARCHAR AS taxon, sum(l_quantity) AS value FROM lineitem GROUP BY 1 UNION ALL SELECT '-1', 500) t LEFT JOIN part ON t.taxon = p_partkey::VARCHAR""")
def size_normalised(t):
    rows = t.lineitem.groupBy(C("l_partkey").cast("string").alias("taxon")).agg(F.sum("l_quantity").alias("value"))
    rows = rows.unionByName(t.spark.range(1).select(F.lit("-1").alias("taxon"), F.lit(500.0).alias("value")))
    return rounded(A.size_normalised(rows, t.part.select(C("p_partkey").cast("string").alias("taxon"), C("p_size").alias("size"))), "value")


@query("frequent_features", _CELLS + """, g AS (SELECT feature FROM m GROUP BY feature HAVING sum(value) >= 100 AND max(value) >= 60 AND count(*) FILTER (value > 0) >= 0.5 * (SELECT count(DISTINCT sample) FROM m))
SELECT feature, sample, value FROM m WHERE feature IN (SELECT feature FROM g)""")
def frequent_features(t):
    from abundara.operators.filters import frequent_features as run

    return run(cells(t), least_total=100, least_max=60, least_samples=0.5).select("feature", "sample", "value")


@query("top_samples", _CELLS + ", s AS (SELECT sample, percent_rank() OVER (ORDER BY sum(value) DESC, sample) AS r FROM m GROUP BY sample) SELECT feature, sample, value FROM m WHERE sample IN (SELECT sample FROM s WHERE r < 0.5)")
def top_samples(t):
    from abundara.operators.filters import top_samples as run

    return run(cells(t), 0.5).select("feature", "sample", "value")


@query("matrix_transpose", _CELLS + " SELECT sample AS feature, feature AS sample, value FROM m")
def matrix_transpose(t):
    return M.transpose(cells(t))


@query("matmul", _CELLS + " SELECT a.feature, b.feature AS sample, sum(a.value * b.value) AS value FROM m a JOIN m b ON a.sample = b.sample GROUP BY ALL")
def matmul(t):
    m = cells(t)
    return M.multiply(m.select("feature", C("sample").alias("k"), "value"), m.select(C("sample").alias("k"), C("feature").alias("sample"), "value"))


@query("zero_fill", _FILLED + " SELECT * FROM f")
def zero_fill(t):
    return M.zero_fill(cells(t))


@query("row_sums", _CELLS + " SELECT feature, sum(value) AS value FROM m GROUP BY feature")
def row_sums(t):
    return M.row_sums(cells(t))


@query("column_sums", _CELLS + " SELECT sample, sum(value) AS value FROM m GROUP BY sample")
def column_sums(t):
    return M.column_sums(cells(t))


@query("matrix_merge", _CELLS + " SELECT feature, sample, CASE WHEN value > 100 THEN value * 2 ELSE value END AS value FROM m")
def matrix_merge(t):
    m = cells(t)
    return M.merge(m, m.where("value > 100").withColumn("value", C("value") * 2))


@query("uniform_prior", _FILLED + ", p AS (SELECT feature, sample, value / sum(value) OVER (PARTITION BY sample) AS v FROM f) SELECT feature, sample, round((v + 1e-6) / (1 + count(*) OVER (PARTITION BY sample) * 1e-6), 6) AS value FROM p")
def uniform_prior(t):
    return rounded(M.with_prior(M.normalise(M.zero_fill(cells(t)), "total")), "value")


_NORM = {
    "total": "value / sum(value) OVER s", "max": "value / max(value) OVER f", "normalize": "value / sqrt(sum(value * value) OVER s)", "pa": "(value > 0)::DOUBLE",
    "standardize": "(value - avg(value) OVER f) / stddev_samp(value) OVER f", "hellinger": "sqrt(value / sum(value) OVER s)", "log": "CASE WHEN value > 0 THEN log2(value) + 1 ELSE 0 END",
    "freq": "value / sum(value) OVER f * count(*) FILTER (value > 0) OVER f",
}
for _how, _sql in _NORM.items():
    query(f"normalise_{_how}", f"{_FILLED} SELECT feature, sample, round({_sql}, 6) AS value FROM f WINDOW s AS (PARTITION BY sample), f AS (PARTITION BY feature)")(
        lambda t, how=_how: rounded(M.normalise(M.zero_fill(cells(t)), how), "value"))

_PAIRS = _FILLED + """, p AS (SELECT feature, sample, value / sum(value) OVER (PARTITION BY sample) AS v0 FROM f), q AS (SELECT feature, sample, {v} AS v FROM p)
SELECT a.sample AS a, b.sample AS b, round({d}, 6) AS distance FROM q a JOIN q b ON a.feature = b.feature AND a.sample < b.sample GROUP BY ALL"""
_PRIOR = "CASE WHEN v0 = 0 THEN 1e-6 ELSE v0 END"
for _how, _v, _d in (
    ("euclid", "v0", "sqrt(sum((a.v - b.v) * (a.v - b.v)))"), ("kld", _PRIOR, "sum(a.v * ln(a.v / b.v))"),
    ("jsd", _PRIOR, "sqrt(sum(0.5 * a.v * ln(a.v / ((a.v + b.v) / 2)) + 0.5 * b.v * ln(b.v / ((a.v + b.v) / 2))))"),
):
    query(f"distance_{_how}", _PAIRS.format(v=_v, d=_d))(lambda t, how=_how: rounded(M.distances(M.zero_fill(cells(t)), how), "distance"))


@query("alpha_diversity", _CELLS + """, c AS (SELECT sample, floor(value) AS c FROM m WHERE floor(value) > 0), p AS (SELECT *, c / sum(c) OVER (PARTITION BY sample) AS p FROM c),
x AS (SELECT sample, count(*) AS richness, -sum(p * ln(p)) AS shannon, 1 - sum(p * p) AS simpson, 1 / sum(p * p) AS inverse_simpson, count(*) FILTER (c = 1) AS f1, count(*) FILTER (c = 2) AS f2 FROM p GROUP BY sample)
SELECT sample, richness, round(shannon, 6) AS shannon, round(simpson, 6) AS simpson, round(inverse_simpson, 6) AS inverse_simpson, f1, f2, round(richness + f1 * (f1 - 1) / (2 * (f2 + 1)), 6) AS chao1, round(exp(shannon), 6) AS effective, round(exp(shannon) / richness, 6) AS evenness FROM x""")
def alpha_diversity(t):
    return rounded(M.alpha_diversity(cells(t)), "shannon", "simpson", "inverse_simpson", "chao1", "effective", "evenness")


@query("beta_components", _CELLS + """, n AS (SELECT sample, count(*) AS n FROM m GROUP BY sample), s AS (SELECT x.sample AS a, y.sample AS b, count(*) AS shared FROM m x JOIN m y ON x.feature = y.feature AND x.sample < y.sample GROUP BY ALL)
SELECT x.sample AS a, y.sample AS b, coalesce(shared, 0) AS shared, x.n - coalesce(shared, 0) AS only_a, y.n - coalesce(shared, 0) AS only_b FROM n x JOIN n y ON x.sample < y.sample LEFT JOIN s ON s.a = x.sample AND s.b = y.sample""")
def beta_components(t):
    return M.beta_components(cells(t))


@query("feature_ratio", _CELLS + ", b AS (SELECT min(feature) AS lo, max(feature) AS hi FROM m) SELECT sample, round(sum(value) FILTER (feature = 'Brand#11') / nullif(sum(value) FILTER (feature = 'Brand#12'), 0), 6) AS ratio FROM m GROUP BY sample")
def feature_ratio(t):
    return rounded(M.feature_ratio(cells(t), "Brand#11", "Brand#12"), "ratio")


_NATIONS = [f"NATION_{n}" for n in range(25)]


@query("pivot_matrix", _CELLS + " SELECT feature, " + ", ".join(f"coalesce(sum(value) FILTER (sample = '{n}'), 0) AS {n}" for n in _NATIONS) + " FROM m GROUP BY feature")
def pivot_matrix(t):
    return M.wide(cells(t), _NATIONS)


_WILCOX = """WITH d AS (SELECT p_brand AS feature, l_returnflag AS g, l_quantity AS v FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag IN ('A', 'R')),
r AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY v) + (count(*) OVER (PARTITION BY feature, v) - 1) / 2.0 AS rk, count(*) OVER (PARTITION BY feature, v) AS ties FROM d),
x AS (SELECT feature, count(*) FILTER (g = 'A') AS n1, count(*) FILTER (g = 'R') AS n2, coalesce(sum(rk) FILTER (g = 'A'), 0)::DOUBLE AS rank_sum, sum(ties * ties - 1)::DOUBLE AS t FROM r GROUP BY feature),
y AS (SELECT *, rank_sum - n1 * (n1 + 1) / 2 AS u, sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - t / ((n1 + n2) * (n1 + n2 - 1.0::DOUBLE)))) AS sd FROM x)"""


def _wilcoxon(t):
    rows = t.lineitem.join(t.part, C("l_partkey") == C("p_partkey")).select(C("p_brand").alias("feature"), C("l_returnflag").alias("g"), C("l_quantity").alias("v"))
    return T.rank_sums(rows, "feature", "g", "v", "A", "R")


@query("wilcoxon_u", _WILCOX + " SELECT feature, n1, n2, rank_sum, u, round(CASE WHEN sd > 0 THEN (u - n1 * n2 / 2 - sign(u - n1 * n2 / 2) * 0.5) / sd END, 6) AS z, round(u / (n1 * n2), 6) AS auc FROM y")
def wilcoxon_u(t):
    return rounded(_wilcoxon(t), "z", "auc")


@query("wilcoxon_p")
def wilcoxon_p(t):
    return T.adjust(_wilcoxon(t).withColumn("p", T.two_sided_p("z")), "p", "bh", ["feature"])


_P = "WITH p AS (SELECT p_partkey AS feature, (p_partkey * 7919 % 1000 + 1) / 1000.0::DOUBLE AS p FROM part), n AS (SELECT count(*) AS n FROM p)"


def _adjust(how, sql):
    def run(t):
        rows = t.part.select(C("p_partkey").alias("feature"), ((C("p_partkey") * 7919 % 1000 + 1) / 1000).alias("p"))
        return rounded(T.adjust(rows, "p", how, ["feature"]), "q")

    query(f"p_adjust_{how}", sql)(run)


_adjust("bonferroni", _P + " SELECT feature, p, round(least(1, p * n), 6) AS q FROM p, n")
_STEP = _P + ", r AS (SELECT feature, p, p * n * {f} / row_number() OVER (ORDER BY p, feature) AS x FROM p, n) SELECT feature, p, round(least(1, min(x) OVER (ORDER BY p DESC, feature DESC ROWS UNBOUNDED PRECEDING)), 6) AS q FROM r"
_adjust("bh", _STEP.format(f="1"))
_adjust("by", _STEP.format(f="(SELECT sum(1.0::DOUBLE / i) FROM n m, range(1, m.n + 1) t(i))"))


@query("anova_f", """
WITH g AS (SELECT l_returnflag AS feature, l_linenumber AS g, count(*) AS n, avg(l_quantity) AS m, sum(l_quantity * l_quantity) AS s2 FROM lineitem GROUP BY ALL), h AS (SELECT *, sum(m * n) OVER (PARTITION BY feature) / sum(n) OVER (PARTITION BY feature) AS grand FROM g)
SELECT feature, count(*) - 1 AS df1, (sum(n) - count(*))::BIGINT AS df2, round((sum(n * (m - grand) * (m - grand)) / (count(*) - 1)) / (sum(s2 - n * m * m) / (sum(n) - count(*))), 6) AS f FROM h GROUP BY feature""")
def anova_f(t):
    return rounded(T.anova_f(t.lineitem.withColumnRenamed("l_returnflag", "feature"), "feature", "l_linenumber", "l_quantity"), "f")


@query("friedman", _FILLED + """, r AS (SELECT left(feature, 7) AS grp, feature, sample, rank() OVER (PARTITION BY left(feature, 7), sample ORDER BY value) + (count(*) OVER (PARTITION BY left(feature, 7), sample, value) - 1) / 2.0::DOUBLE AS rk FROM f),
s AS (SELECT grp, feature, sum(rk) AS r, count(*) AS n FROM r GROUP BY ALL) SELECT grp, count(*) AS k, max(n) AS n, round(12.0 / (max(n) * count(*) * (count(*) + 1)) * sum(r * r) - 3 * max(n) * (count(*) + 1), 6) AS q FROM s GROUP BY grp""")
def friedman(t):
    rows = M.zero_fill(cells(t)).withColumn("grp", F.left(C("feature"), F.lit(7)))
    return rounded(T.friedman(rows, "grp", "sample", "feature", "value"), "q")


@query("size_factors", _FILLED + ", x AS (SELECT *, avg(CASE WHEN value > 0 THEN ln(value) END) OVER (PARTITION BY feature) AS l, min(value) OVER (PARTITION BY feature) AS z FROM f) SELECT sample, round(median(value / exp(l)), 6) AS factor FROM x WHERE z > 0 GROUP BY sample")
def size_factors(t):
    return rounded(T.size_factors(M.zero_fill(cells(t))), "factor")


_SWEEP = """WITH d AS (SELECT n_chars AS s, quality = 1 AS y FROM documents JOIN labels USING (doc_id)), c AS (SELECT unnest(range(0, 5001, 250)) AS cutoff),
x AS (SELECT cutoff, count(*) FILTER (y) AS tp, count(*) FILTER (NOT y) AS fp FROM c JOIN d ON s >= cutoff GROUP BY cutoff), z AS (SELECT *, tp / (tp + fp) AS precision, tp / nullif((SELECT count(*) FROM d WHERE y), 0) AS recall FROM x),
f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM z)"""


def _sweep(t):
    rows = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id")
    return T.cutoff_sweep(rows, "n_chars", C("quality") == 1, F.sequence(F.lit(0).cast("long"), F.lit(5000).cast("long"), F.lit(250).cast("long")))


@query("cutoff_sweep_f1", _SWEEP + " SELECT cutoff, tp, fp, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM f")
def cutoff_sweep_f1(t):
    return rounded(_sweep(t), "precision", "recall", "f1")


@query("best_cutoff", _SWEEP + " SELECT cutoff, round(f1, 6) AS f1, round(precision, 6) AS precision, round(recall, 6) AS recall FROM f ORDER BY f.f1 DESC, cutoff DESC LIMIT 1")
def best_cutoff(t):
    return rounded(T.best_cutoff(_sweep(t)), "f1", "precision", "recall")


def tree(t):
    """root - region - nation - customer."""
    root = t.spark.range(1).select(F.lit("root").alias("id"), F.lit(None).cast("string").alias("parent"), F.lit("root").alias("rank"))
    region = t.region.select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit("root").alias("parent"), F.lit("region").alias("rank"))
    nation = t.nation.select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.concat(F.lit("r"), "n_regionkey").alias("parent"), F.lit("nation").alias("rank"))
    customer = t.customer.select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.concat(F.lit("n"), "c_nationkey").alias("parent"), F.lit("customer").alias("rank"))
    return root.unionByName(region).unionByName(nation).unionByName(customer)


_TREE = """WITH RECURSIVE t AS (SELECT 'root' AS id, NULL AS parent, 'root' AS rank UNION ALL SELECT 'r' || r_regionkey, 'root', 'region' FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 'nation' FROM nation
UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, 'customer' FROM customer),
c AS (SELECT id, id AS ancestor, 0 AS steps FROM t UNION ALL SELECT c.id, t.parent, steps + 1 FROM c JOIN t ON c.ancestor = t.id WHERE t.parent IS NOT NULL)"""


@query("lineage_closure", _TREE + " SELECT id, ancestor, steps FROM c")
def lineage_closure(t):
    return G.lineages(tree(t)).withColumn("steps", C("steps").cast("int"))


@query("lca", _TREE + """, p AS (SELECT 'c' || c_custkey AS a, 'c' || (c_custkey + 1) AS b FROM customer)
SELECT p.a, p.b, arg_min(x.ancestor, x.steps) AS lca FROM p JOIN c x ON x.id = p.a JOIN c y ON y.id = p.b AND x.ancestor = y.ancestor GROUP BY ALL""")
def lca(t):
    pairs = t.customer.select(F.concat(F.lit("c"), "c_custkey").alias("a"), F.concat(F.lit("c"), C("c_custkey") + 1).alias("b"))
    return G.common_ancestors(G.lineages(tree(t)), pairs)


@query("rank_rollup", _TREE + " SELECT c.ancestor AS id, round(sum(c_acctbal), 2) AS value FROM customer JOIN c ON c.id = 'c' || c_custkey GROUP BY 1")
def rank_rollup(t):
    values = t.customer.select(F.concat(F.lit("c"), "c_custkey").alias("id"), C("c_acctbal").alias("value"))
    return rounded(G.roll_up(G.lineages(tree(t)), values), "value", digits=2)


@query("ancestor_at_rank", _TREE + " SELECT c.id, arg_min(c.ancestor, steps) AS at_rank FROM c JOIN t ON c.ancestor = t.id AND t.rank = 'region' GROUP BY c.id")
def ancestor_at_rank(t):
    nodes = tree(t)
    return G.at_rank(G.lineages(nodes), nodes.select("id", "rank"), "region")


@query("tree_leaves", _TREE + " SELECT id FROM t WHERE id NOT IN (SELECT parent FROM t WHERE parent IS NOT NULL)")
def tree_leaves(t):
    return G.leaves(tree(t))


@query("tree_prune", _TREE + " SELECT DISTINCT t.id, t.rank FROM t JOIN c ON t.id = c.ancestor WHERE c.id IN (SELECT 'c' || c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def tree_prune(t):
    nodes = tree(t)
    keep = t.customer.where("c_mktsegment = 'BUILDING'").select(F.concat(F.lit("c"), "c_custkey").alias("id"))
    return G.prune(nodes, G.lineages(nodes), keep).select("id", "rank")


@query("module_rollup", """
WITH v AS (SELECT l_partkey AS k, sum(l_quantity) AS value FROM lineitem GROUP BY 1), p AS (SELECT DISTINCT p_partkey AS k, unnest(string_split(p_name, ' ')) AS module FROM part)
SELECT module, sum(value) AS value, count(DISTINCT k) AS members FROM v JOIN p USING (k) GROUP BY module""")
def module_rollup(t):
    from abundara.operators.joins import many_to_many

    values = t.lineitem.groupBy(C("l_partkey").alias("k")).agg(F.sum("l_quantity").alias("value"))
    return many_to_many(values, t.part.select(C("p_partkey").alias("k"), F.explode(F.split("p_name", " ")).alias("module")), "k", "module", "value")


@query("rarefy")
def rarefy(t):
    return S.rarefy(cells(t), 100)


@query("thin_counts")
def thin_counts(t):
    return S.thin(cells(t), 0.5)


@query("bootstrap")
def bootstrap(t):
    return S.bootstrap(cells(t), 100, 3)


@query("sample_clusters")
def sample_clusters(t):
    """k-medoids of samples on their Jensen-Shannon distances, k by between over within variance."""
    from abundara.operators import clustering as K

    names, d = K.square(M.distances(M.zero_fill(cells(t)), "jsd"))
    groups, _ = K.k_medoids(d, K.best_k(d)) if len(names) > 2 else ([0] * len(names), None)
    return t.spark.createDataFrame([(n, int(g)) for n, g in zip(names, groups, strict=True)], "sample string, cluster int")


@query("principal_coordinates")
def principal_coordinates(t):
    from abundara.operators import clustering as K

    names, d = K.square(M.distances(M.zero_fill(cells(t)), "jsd"))
    if not names:
        return t.spark.createDataFrame([], "sample string, x double, y double")
    axes, _ = K.principal_coordinates(d)
    return t.spark.createDataFrame([(n, float(a[0]), float(a[1])) for n, a in zip(names, axes, strict=True)], "sample string, x double, y double")


@query("event_windows", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY ALL")
def event_windows(t):
    from abundara.streaming.profiles import windowed_events

    return rounded(windowed_events(t.events), "value", digits=4)
