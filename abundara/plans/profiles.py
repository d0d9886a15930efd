"""Profiling queries: sample = order number by three, insert = order, mate = line number parity, gene = part, taxon = brand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abundara.operators import profile as P
from abundara.plans.registry import Tables, query


def hits(t: Tables) -> DataFrame:
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_size", "p_brand")
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity").join(parts, "l_partkey").select(
        F.concat(F.lit("s"), (F.col("l_orderkey") % 3).cast("string")).alias("sample"), F.col("l_orderkey").alias("insert_id"), (F.col("l_linenumber") % 2 + 1).alias("mate"),
        F.col("l_partkey").cast("string").alias("gene"), F.col("p_brand").alias("brand"), F.col("l_quantity").alias("cov"), F.col("p_size").alias("length"))


def _shares(taxon: str) -> str:
    """CTEs up to shares s, at a level given by a column."""
    return f"""
h AS (SELECT l_orderkey AS ins, l_linenumber % 2 + 1 AS mate, l_partkey::VARCHAR AS gene, p_brand AS brand, l_quantity AS cov, p_size::DOUBLE AS len
      FROM lineitem JOIN part ON l_partkey = p_partkey),
v AS (SELECT ins, 'base.' || mate AS type, gene, brand, len, max(cov) AS value FROM h GROUP BY ALL
      UNION ALL SELECT DISTINCT ins, 'insert', gene, brand, len, 1.0 FROM h),
gc AS (SELECT *, max((m1 AND m2)::INT) OVER (PARTITION BY ins) AS ag FROM (
      SELECT ins, gene, bool_or(type = 'base.1') AS m1, bool_or(type = 'base.2') AS m2 FROM v GROUP BY ins, gene)),
ga AS (SELECT v.* FROM v JOIN gc USING (ins, gene) WHERE (m1 AND m2) OR ag = 0),
gn AS (SELECT ins, type, count(*) AS gene_count FROM ga GROUP BY ins, type),
tc AS (SELECT *, max((m1 AND m2)::INT) OVER (PARTITION BY ins) AS ag FROM (
      SELECT ins, {taxon} AS taxon, bool_or(type = 'base.1') AS m1, bool_or(type = 'base.2') AS m2 FROM v GROUP BY 1, 2)),
ta AS (SELECT v.*, taxon, ag FROM v JOIN tc ON v.ins = tc.ins AND v.{taxon} = tc.taxon WHERE (m1 AND m2) OR ag = 0),
tn AS (SELECT ins, type, count(*) AS n_genes, count(DISTINCT taxon) AS n_taxa FROM ta GROUP BY ins, type),
s AS (SELECT ins, type, CASE WHEN type = 'insert' THEN 'insert' ELSE 'base' END AS kind, gene, taxon, len, n_taxa,
      value / CASE WHEN ag = 1 THEN n_genes ELSE gene_count END AS share FROM ta JOIN tn USING (ins, type) JOIN gn USING (ins, type)),
u AS (SELECT 's' || ins % 3 AS sample, taxon, kind, sum(share) AS raw, sum(share / len) AS norm, sum(CASE WHEN n_taxa = 1 THEN share ELSE 0 END) AS uraw,
      sum(CASE WHEN n_taxa = 1 THEN share / len ELSE 0 END) AS unorm FROM s GROUP BY ALL)"""


_TAIL = """,
f AS (SELECT u.sample, u.taxon, u.kind, raw, norm, uraw, unorm, uraw + coalesce(mraw, 0) AS mraw, unorm + coalesce(mnorm, 0) AS mnorm FROM u LEFT JOIN d USING (sample, taxon, kind)),
t AS (SELECT sample, kind, sum(raw) / sum(norm) AS w, CASE WHEN sum(unorm) > 0 THEN sum(uraw) / sum(unorm) ELSE 0 END AS uw, CASE WHEN sum(mnorm) > 0 THEN sum(mraw) / sum(mnorm) ELSE 0 END AS mw FROM f GROUP BY sample, kind)
SELECT sample, taxon AS feature, kind, round(raw + 1e-9, 6) AS raw, round(norm + 1e-9, 6) AS norm, round(norm * w + 1e-9, 6) AS scaled, round(uraw + 1e-9, 6) AS unique_raw, round(unorm + 1e-9, 6) AS unique_norm,
       round(unorm * uw + 1e-9, 6) AS unique_scaled, round(mraw + 1e-9, 6) AS mm_raw, round(mnorm + 1e-9, 6) AS mm_norm, round(mnorm * mw + 1e-9, 6) AS mm_scaled
FROM f JOIN t USING (sample, kind)"""

GENE_SQL = "WITH" + _shares("gene") + """,
m AS (SELECT s.*, sum(share) OVER (PARTITION BY ins, type) AS v, u.raw, u.norm, uraw, unorm FROM s JOIN u ON s.taxon = u.taxon AND s.kind = u.kind AND u.sample = 's' || s.ins % 3 WHERE n_taxa > 1),
m2 AS (SELECT *, max((uraw > 0)::INT) OVER (PARTITION BY ins, type) AS anyu FROM m),
m3 AS (SELECT *, CASE WHEN anyu = 1 THEN uraw ELSE raw END AS x FROM m2 WHERE anyu = 0 OR uraw > 0),
d AS (SELECT sample, taxon, kind, sum(r) AS mraw, sum(q) AS mnorm FROM (
      SELECT 's' || ins % 3 AS sample, taxon, kind, x / sum(x) OVER w * v AS r, (x / len) / sum(x / len) OVER w * v / len AS q FROM m3 WINDOW w AS (PARTITION BY ins, type)) GROUP BY ALL)""" + _TAIL

TAXON_SQL = "WITH" + _shares("brand") + """,
g1 AS (SELECT ga.ins, ga.type, CASE WHEN ga.type = 'insert' THEN 'insert' ELSE 'base' END AS kind, gene, len, value / gene_count AS share, gene_count FROM ga JOIN gn USING (ins, type)),
gu AS (SELECT 's' || ins % 3 AS sample, gene, kind, sum(CASE WHEN gene_count = 1 THEN share ELSE 0 END) AS uraw FROM g1 GROUP BY ALL),
g2 AS (SELECT g1.*, uraw, max((uraw > 0)::INT) OVER (PARTITION BY ins, type) AS anyu FROM g1 JOIN gu ON g1.gene = gu.gene AND g1.kind = gu.kind AND gu.sample = 's' || g1.ins % 3),
gp AS (SELECT ins, type, gene FROM g2 WHERE anyu = 0 OR uraw > 0),
m AS (SELECT x.*, u.raw, u.norm, uraw, unorm FROM (SELECT *, sum(share) OVER (PARTITION BY ins, type) AS v FROM s WHERE n_taxa > 1) x
      JOIN gp USING (ins, type, gene) JOIN u ON x.taxon = u.taxon AND x.kind = u.kind AND u.sample = 's' || x.ins % 3),
m2 AS (SELECT *, max((uraw > 0)::INT) OVER (PARTITION BY ins, type) AS anyu FROM m),
m3 AS (SELECT *, CASE WHEN anyu = 1 THEN uraw ELSE raw END AS x, CASE WHEN anyu = 1 THEN unorm ELSE norm END AS y, count(*) OVER (PARTITION BY ins, type, taxon) AS per FROM m2 WHERE anyu = 0 OR uraw > 0),
d AS (SELECT sample, taxon, kind, sum(r) AS mraw, sum(q) AS mnorm FROM (
      SELECT 's' || ins % 3 AS sample, taxon, kind, x / sum(x / per) OVER w * v / per AS r, y / sum(y / per) OVER w / per * v / len AS q FROM m3 WINDOW w AS (PARTITION BY ins, type)) GROUP BY ALL)""" + _TAIL

VALUES = [f"{d}{n}" for d in ("", "unique_", "mm_") for n in ("raw", "norm", "scaled")]


def rounded(df: DataFrame, *columns: str, digits: int = 6, nudge: float = 0.0) -> DataFrame:
    """Rounded columns; ``nudge`` settles values that lie on a rounding tie, where engines differ."""
    return df.withColumns({c: F.round(F.col(c) + nudge, digits) for c in columns})


@query("profile_gene", GENE_SQL)
def profile_gene(t):
    return rounded(P.profile(hits(t)), *VALUES, nudge=1e-9)


@query("profile_taxon", TAXON_SQL)
def profile_taxon(t):
    return rounded(P.profile(hits(t), "brand"), *VALUES, nudge=1e-9)


@query("frac_count", "WITH" + _shares("gene") + " SELECT sample, taxon AS feature, kind, round(raw + 1e-9, 6) AS raw, round(norm + 1e-9, 6) AS norm FROM u")
def frac_count(t):
    return rounded(P.counts(P.shares(hits(t))).select("sample", F.col("taxon").alias("feature"), "kind", "raw", "norm"), "raw", "norm", nudge=1e-9)


@query("only_unique", "WITH" + _shares("brand") + " SELECT sample, taxon AS feature, kind, round(uraw, 6) AS unique_raw FROM u WHERE uraw > 0")
def only_unique(t):
    rows = P.counts(P.shares(hits(t), "brand")).where("unique_raw > 0")
    return rounded(rows.select("sample", F.col("taxon").alias("feature"), "kind", "unique_raw"), "unique_raw")


@query("seen_taxa", """
WITH h AS (SELECT l_orderkey AS insert_id, l_linenumber % 2 + 1 AS mate, l_partkey::VARCHAR AS gene, p_brand AS taxon FROM lineitem JOIN part ON l_partkey = p_partkey),
v AS (SELECT insert_id, 'base.' || mate AS type, gene, taxon FROM h UNION SELECT insert_id, 'insert', gene, taxon FROM h)
SELECT insert_id, type, taxon, max(gene) AS last_gene, count(DISTINCT gene) AS genes FROM v GROUP BY ALL""")
def seen_taxa(t):
    return P.seen_taxa(hits(t), "brand").drop("sample")


@query("multi_mappers", "WITH" + _shares("brand") + """ SELECT ins AS insert_id, type, round(sum(share), 6) AS value, count(*) AS n_targets, min(gene) AS first_target, sum(len) AS target_length FROM s WHERE n_taxa > 1 GROUP BY ALL""")
def multi_mappers(t):
    rows = P.multi_mappers(P.shares(hits(t), "brand"))
    lengths = F.aggregate("targets", F.lit(0.0), lambda a, x: a + x["length"])
    return rounded(rows.select("insert_id", "type", "value", F.size("targets").cast("long").alias("n_targets"), F.get("targets", F.lit(0))["gene"].alias("first_target"), lengths.alias("target_length")), "value")


@query("level_totals", GENE_SQL.split("\nSELECT sample, taxon AS feature")[0] + " SELECT sample, kind, round(sum(raw), 4) AS raw, round(sum(norm), 4) AS norm, round(sum(uraw), 4) AS unique_raw, round(sum(unorm), 4) AS unique_norm, round(sum(mraw), 4) AS mm_raw, round(sum(mnorm), 4) AS mm_norm FROM f GROUP BY ALL")
def level_totals(t):
    rows = P.level_totals(P.profile(hits(t)))
    return rounded(rows, *[f"{d}{n}" for d in ("", "unique_", "mm_") for n in ("raw", "norm")], digits=4)


def library(t: Tables) -> DataFrame:
    sample = F.concat(F.lit("s"), (F.col("l_orderkey") % 3).cast("string")).alias("sample")
    total = t.lineitem.groupBy(sample).agg((F.sum("l_quantity") + 1000).alias("base"), (F.count_distinct("l_orderkey") + 10).cast("double").alias("insert"))
    return total.select("sample", F.expr("stack(2, 'base', base, 'insert', insert) AS (kind, total)"))


_LIB = "l AS (SELECT 's' || l_orderkey % 3 AS sample, 'base' AS kind, sum(l_quantity) + 1000 AS total FROM lineitem GROUP BY ALL UNION ALL SELECT 's' || l_orderkey % 3, 'insert', count(DISTINCT l_orderkey) + 10.0::DOUBLE FROM lineitem GROUP BY ALL)"


_LEFT = ", ".join(f"round(total - mapped, 4) AS {d}raw, round((total - mapped) / mean, 4) AS {d}norm, round(total - mapped, 4) AS {d}scaled" for d in ("", "unique_", "mm_"))


@query("unmapped_row", "WITH" + _shares("brand") + f""", {_LIB}, m AS (SELECT sample, kind, sum(raw) AS mapped FROM u GROUP BY ALL), x AS (SELECT avg(length) AS mean FROM (SELECT p_brand, sum(p_size) AS length FROM part GROUP BY p_brand))
SELECT sample, '-1' AS feature, kind, {_LEFT} FROM l JOIN m USING (sample, kind), x""")
def unmapped_row(t):
    lengths = t.part.groupBy("p_brand").agg(F.sum("p_size").alias("length"))
    rows = P.unmapped(P.counts(P.shares(hits(t), "brand")), library(t), lengths)
    return rounded(rows, *VALUES, digits=4)


@query("coverage_stats", "WITH" + _shares("gene") + f""", {_LIB}, m AS (SELECT sample, kind, sum(raw) AS mapped FROM u GROUP BY ALL)
SELECT sample, kind, round(total, 4) AS total, round(mapped, 4) AS mapped, round(mapped / total, 6) AS fraction, (SELECT round(avg(p_size + 0.0), 6) FROM part) AS mean_length FROM l JOIN m USING (sample, kind)""")
def coverage_stats(t):
    intervals = t.part.select(F.lit(1).alias("start"), F.col("p_size").alias("stop"))
    rows = P.coverage_stats(P.counts(P.shares(hits(t))), library(t), intervals)
    return rounded(rounded(rows, "total", "mapped", digits=4), "fraction", "mean_length")


@query("functional_rollup", """
WITH g AS (SELECT l_partkey AS gene, sum(l_quantity) AS value FROM lineitem GROUP BY 1),
c AS (SELECT p_partkey AS gene, p_size, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE replace(p_name, ' ', ',') END AS cell FROM part),
x AS (SELECT value, p_size, CASE WHEN cell = '' THEN ['unassigned'] ELSE list_distinct(string_split(cell, ',')) END AS cats FROM g JOIN c USING (gene)),
e AS (SELECT value, p_size, unnest(list_append(cats, 'mapped')) AS category FROM x)
SELECT 'name' AS level, category, round(sum(value), 4) AS value, sum(p_size)::BIGINT AS length FROM e GROUP BY category""")
def functional_rollup(t):
    genes = t.lineitem.groupBy(F.col("l_partkey").alias("gene")).agg(F.sum("l_quantity").alias("value"))
    genes = genes.join(t.part.select(F.col("p_partkey").alias("gene"), F.col("p_size").cast("long").alias("length")), "gene")
    cells = t.part.select(F.col("p_partkey").alias("gene"), F.lit("name").alias("level"), F.when(F.col("p_partkey") % 7 == 0, "").otherwise(F.replace(F.col("p_name"), F.lit(" "), F.lit(","))).alias("cell"))
    return rounded(P.functional(genes, cells, "value"), "value", digits=4)


@query("horizontal_cov", """
WITH s AS (SELECT l_partkey AS gene, 7 * l_linenumber AS a, 7 * l_linenumber + l_quantity AS b FROM lineitem),
x AS (SELECT DISTINCT gene, round(greatest(a - 1, 0) * 99 / 100.0)::INT AS f, round(least(b - 1, 99) * 99 / 100.0)::INT AS l FROM s),
e AS (SELECT gene, unnest(range(f, l + 1)) AS bin FROM x WHERE l >= f)
SELECT gene, count(DISTINCT bin) AS covered FROM e GROUP BY gene""")
def horizontal_cov(t):
    spans = t.lineitem.select(F.col("l_partkey").alias("gene"), F.lit(1).alias("start"), F.lit(100).alias("length"), (7 * F.col("l_linenumber")).alias("hit_start"), (7 * F.col("l_linenumber") + F.col("l_quantity")).alias("hit_stop"))
    return P.horizontal(spans)


@query("functional_headers", """
WITH g AS (SELECT l_partkey AS gene, sum(l_quantity) AS value FROM lineitem GROUP BY 1), c AS (SELECT p_partkey AS gene, p_partkey % 7 = 0 AS bare FROM part)
SELECT 'name' AS level, (SELECT sum(l_quantity) + 1000 FROM lineitem) AS total, sum(value) AS mapped, sum(value) AS assigned_and_unassigned, sum(CASE WHEN bare THEN value ELSE 0 END) AS unassigned, sum(CASE WHEN bare THEN 0 ELSE value END) AS assigned FROM g JOIN c USING (gene)""")
def functional_headers(t):
    genes = t.lineitem.groupBy(F.col("l_partkey").alias("gene")).agg(F.sum("l_quantity").alias("value"))
    cells = t.part.select(F.col("p_partkey").alias("gene"), F.lit("name").alias("level"), F.when(F.col("p_partkey") % 7 == 0, "NA").otherwise(F.replace(F.col("p_name"), F.lit(" "), F.lit(","))).alias("cell"))
    return P.functional_headers(genes, cells, "value", t.lineitem.agg((F.sum("l_quantity") + 1000).alias("total")))


@query("horizontal_level", """
WITH s AS (SELECT l_partkey AS gene, 7 * l_linenumber AS a, 7 * l_linenumber + l_quantity AS b FROM lineitem),
x AS (SELECT DISTINCT gene, round(greatest(a - 1, 0) * 99 / 100.0)::INT AS f, round(least(b - 1, 99) * 99 / 100.0)::INT AS l FROM s),
e AS (SELECT gene, unnest(range(f, l + 1)) AS bin FROM x WHERE l >= f), g AS (SELECT gene, count(DISTINCT bin) AS covered FROM e GROUP BY gene)
SELECT p_brand, round(avg(coalesce(covered, 0)), 6) AS covered, count(*) AS genes FROM part LEFT JOIN g ON p_partkey = gene GROUP BY p_brand""")
def horizontal_level(t):
    groups = t.part.select(F.col("p_partkey").alias("gene"), "p_brand")
    return rounded(P.horizontal_levels(horizontal_cov(t), groups, "p_brand"), "covered")
