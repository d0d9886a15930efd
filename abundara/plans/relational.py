"""Queries of filters, joins, rankings, sets and scalar functions on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from abundara.functions import reads as R
from abundara.operators import filters, joins, ranking
from abundara.plans.registry import query

C = F.col


@query("best_hit_ties", "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem QUALIFY rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC) = 1")
def best_hit_ties(t):
    return filters.best_hits(t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity"), ["l_orderkey"], "l_quantity")


@query("best_hit_single", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_extendedprice, l_partkey, l_suppkey, l_linenumber) = 1""")
def best_hit_single(t):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return ranking.single_best(rows, ["l_orderkey"], "l_quantity", ["l_extendedprice", "l_partkey", "l_suppkey", "l_linenumber"])


@query("topn_subjects_ties", """
WITH h AS (SELECT o_custkey AS q, l_partkey AS s, floor(l_extendedprice / 1000) AS score FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
g AS (SELECT q, s, max(score) AS subject_best FROM h GROUP BY ALL), b AS (SELECT * FROM g QUALIFY rank() OVER (PARTITION BY q ORDER BY subject_best DESC) <= 3)
SELECT h.q, h.s, score::DOUBLE AS score, subject_best::DOUBLE AS subject_best FROM h JOIN b USING (q, s)""")
def topn_subjects_ties(t):
    h = t.lineitem.join(t.orders, C("l_orderkey") == C("o_orderkey")).select(C("o_custkey").alias("q"), C("l_partkey").alias("s"), F.floor(C("l_extendedprice") / 1000).cast("double").alias("score"))
    return ranking.top_subjects(h, "q", "s", "score", 3)


@query("top_fraction", """
SELECT l_orderkey, l_partkey, l_extendedprice FROM (SELECT *, max(l_extendedprice) OVER (PARTITION BY l_orderkey, l_partkey) AS a, max(l_extendedprice) OVER (PARTITION BY l_orderkey) AS b FROM lineitem)
WHERE a >= (1 - 0.1::DOUBLE) * b""")
def top_fraction(t):
    return ranking.top_fraction(t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice"), "l_orderkey", "l_partkey", "l_extendedprice", 0.1).drop("subject_best", "query_best")


@query("unambiguous_best", """
WITH h AS (SELECT l_orderkey AS gene, p_brand AS cog, l_quantity AS score FROM lineitem JOIN part ON l_partkey = p_partkey),
x AS (SELECT * FROM h QUALIFY rank() OVER (PARTITION BY gene ORDER BY score DESC) = 1)
SELECT gene, min(cog) AS cog, max(score) AS score FROM x GROUP BY gene HAVING count(DISTINCT cog) = 1""")
def unambiguous_best(t):
    h = t.lineitem.join(t.part, C("l_partkey") == C("p_partkey")).select(C("l_orderkey").alias("gene"), C("p_brand").alias("cog"), C("l_quantity").alias("score"))
    return ranking.unambiguous_best(h, "gene", "cog", "score")


@query("best_per_group", """
SELECT p_brand, l_suppkey, l_orderkey, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey
QUALIFY row_number() OVER (PARTITION BY p_brand, l_suppkey ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey) = 1""")
def best_per_group(t):
    rows = t.lineitem.join(t.part, C("l_partkey") == C("p_partkey"))
    return ranking.single_best(rows, ["p_brand", "l_suppkey"], "l_quantity", ["l_orderkey", "l_linenumber", "l_partkey"]).select("p_brand", "l_suppkey", "l_orderkey", "l_quantity")


@query("clash_resolution")
def clash_resolution(t):
    rows = t.lineitem.join(t.part, C("l_partkey") == C("p_partkey")).select(
        C("l_orderkey").cast("string").alias("gene"), C("p_brand").alias("grp"), (7 * C("l_linenumber")).cast("long").alias("start"), (7 * C("l_linenumber") + C("l_quantity")).cast("long").alias("stop"), C("l_extendedprice").alias("score"))
    return ranking.resolve_clashes(rows)


@query("identity_length_filter", "SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem WHERE l_quantity >= 30 AND 100 - l_discount * 100 >= 95")
def identity_length_filter(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", (100 - C("l_discount") * 100).alias("identity"))
    return filters.length_identity(rows, "l_quantity", "identity", least_length=30, least_identity=95).drop("identity")


@query("pe_filter", """
WITH h AS (SELECT l_orderkey, l_linenumber % 2 AS mate, p_brand, l_linenumber FROM lineitem JOIN part ON l_partkey = p_partkey),
b AS (SELECT *, min(mate) OVER (PARTITION BY l_orderkey, p_brand) <> max(mate) OVER (PARTITION BY l_orderkey, p_brand) AS m FROM h),
c AS (SELECT *, bool_or(m) OVER (PARTITION BY l_orderkey) AS a FROM b)
SELECT l_orderkey, mate, p_brand, l_linenumber FROM c WHERE m OR NOT a""")
def pe_filter(t):
    h = t.lineitem.join(t.part, C("l_partkey") == C("p_partkey")).select("l_orderkey", (C("l_linenumber") % 2).alias("mate"), "p_brand", "l_linenumber")
    return filters.mates_agree(h, ["l_orderkey"], "mate", "p_brand")


_REGION = "SELECT p_brand || ' ' || p_type AS ref, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) - 1 AS idx, p_size AS start, p_size + 10 AS stop FROM part"
_ALIGN = "SELECT l_orderkey, l_linenumber, p_brand || ' ' || p_type AS ref, 7 * l_linenumber AS first_base, 7 * l_linenumber + l_quantity AS last_base FROM lineitem JOIN part ON l_partkey = p_partkey"


def _ref(by):
    return (F.concat_ws(" ", *by) if len(by) > 1 else C(by[0])).alias("ref")


def _regions(t, by=("p_brand", "p_type")):
    """Every part is an interval on its reference, the brand and type if not told otherwise."""
    idx = F.row_number().over(Window.partitionBy(*by).orderBy("p_partkey")) - 1
    return t.part.select(_ref(by), idx.alias("idx"), C("p_size").alias("start"), (C("p_size") + 10).alias("stop"))


def _alignments(t, by=("p_brand", "p_type")):
    return t.lineitem.join(t.part, C("l_partkey") == C("p_partkey")).select("l_orderkey", "l_linenumber", _ref(by), (7 * C("l_linenumber")).alias("first_base"), (7 * C("l_linenumber") + C("l_quantity")).alias("last_base"))


_JOIN = f"""WITH c AS ({_REGION}), a AS ({_ALIGN})
SELECT c.ref, c.idx, count(*) AS n, sum(least(last_base, stop) - greatest(first_base, start) + 1) AS covered
FROM a JOIN c ON a.ref = c.ref AND first_base <= stop AND last_base >= start GROUP BY ALL"""


# a whole brand is one reference: parts of other types overlap too
@query("interval_join", _JOIN.replace("p_brand || ' ' || p_type", "p_brand").replace("p_brand, p_type", "p_brand"))
def interval_join(t):
    return joins.interval_totals(_alignments(t, ["p_brand"]), _regions(t, ["p_brand"]))


@query("interval_join_binned", _JOIN)
def interval_join_binned(t):
    return joins.interval_totals(_alignments(t), _regions(t), width=16)


@query("region_filter", f"WITH c AS ({_REGION}), a AS ({_ALIGN}) SELECT l_orderkey, l_linenumber, count(*) AS times FROM a JOIN c ON a.ref = c.ref AND first_base <= stop AND last_base >= start GROUP BY ALL")
def region_filter(t):
    return filters.region_times(_alignments(t), _regions(t), "ref", "first_base", "last_base").groupBy("l_orderkey", "l_linenumber").agg(F.sum("times").alias("times"))


@query("region_semi", f"WITH c AS ({_REGION}), a AS ({_ALIGN}) SELECT l_orderkey, l_linenumber, ref FROM a WHERE EXISTS (SELECT 1 FROM c WHERE a.ref = c.ref AND first_base <= stop AND last_base >= start)")
def region_semi(t):
    return filters.in_regions(_alignments(t), _regions(t), "ref", "first_base", "last_base", once=True).select("l_orderkey", "l_linenumber", "ref")


def _screen(t):
    hits = t.customer.where("c_mktsegment = 'BUILDING'").select(C("c_custkey").alias("o_custkey"))
    return filters.screen(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), hits, "o_custkey")


@query("screen_semi", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def screen_semi(t):
    return _screen(t)[0]


@query("screen_anti", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def screen_anti(t):
    return _screen(t)[1]


@query("hit_statistics", "SELECT (SELECT count(*) FROM orders) AS reads, count(*) AS hits, count(DISTINCT l_orderkey) AS queries FROM lineitem WHERE l_quantity >= 40")
def hit_statistics(t):
    hits = filters.hit_summary(filters.hit_filter(t.lineitem, l_quantity=40), "l_orderkey")
    return t.orders.agg(F.count("*").alias("reads")).crossJoin(hits)


@query("subject_counts", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey")
def subject_counts(t):
    return filters.subject_order(t.lineitem, "l_suppkey")


@query("blast_filter", "SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice FROM lineitem WHERE l_quantity >= 20 AND l_extendedprice >= 30000 AND l_tax <= 0.04")
def blast_filter(t):
    return filters.hit_filter(t.lineitem.withColumnRenamed("l_tax", "evalue"), l_quantity=20, l_extendedprice=30000, max_evalue=0.04).select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")


@query("not_trivial", "SELECT l_partkey, l_suppkey, l_quantity FROM lineitem WHERE l_partkey <> l_suppkey AND l_quantity * 2 < 100 AND l_quantity * 2 <= 90")
def not_trivial(t):
    rows = t.lineitem.select("l_partkey", "l_suppkey", "l_quantity", (C("l_quantity") * 2).alias("identity"))
    return filters.not_trivial(rows, "l_partkey", "l_suppkey", "identity", ceiling=90).drop("identity")


@query("metadata_subset", "SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND o_orderstatus = 'F'")
def metadata_subset(t):
    samples = t.customer.withColumnRenamed("c_custkey", "o_custkey")
    return filters.metadata_subset(t.orders.where("o_orderstatus = 'F'"), samples, "o_custkey", c_mktsegment=["BUILDING", "MACHINERY"]).select("o_orderkey")


_LANES = "WITH c AS (SELECT l_suppkey AS lane, l_linenumber AS cycle, count(*) FILTER (l_linestatus = 'O') AS o, count(*) FILTER (l_linestatus = 'F') AS f, avg(l_quantity) AS mean, median(l_quantity) AS med FROM lineitem GROUP BY ALL)"
_OFF = """, m AS (SELECT *, abs(o - avg(o) OVER w) > 2 * stddev_samp(o) OVER w OR abs(f - avg(f) OVER w) > 2 * stddev_samp(f) OVER w AS bad FROM c WINDOW w AS (PARTITION BY lane))
SELECT lane, coalesce(min(cycle) FILTER (NOT coalesce(bad, false)), max(cycle) + 1) AS first_cycle FROM m GROUP BY lane"""


def _lanes(t):
    return t.lineitem.groupBy(C("l_suppkey").alias("lane"), C("l_linenumber").alias("cycle")).agg(F.count_if(C("l_linestatus") == "O").alias("o"), F.count_if(C("l_linestatus") == "F").alias("f"), F.avg("l_quantity").alias("mean"), F.median("l_quantity").alias("med"))


@query("five_prime_cut", _LANES + _OFF)
def five_prime_cut(t):
    return filters.five_prime_cut(_lanes(t), "lane", "cycle", ["o", "f"])


@query("five_prime_cut_quality", _LANES.replace("GROUP BY ALL", "GROUP BY ALL HAVING avg(l_quantity) >= 24 AND median(l_quantity) >= 24") + _OFF)
def five_prime_cut_quality(t):
    return filters.five_prime_cut(_lanes(t), "lane", "cycle", ["o", "f"], least_quality=24)


@query("pair_by_header", """
WITH a AS (SELECT DISTINCT l_orderkey AS stem FROM lineitem WHERE l_linenumber = 1), b AS (SELECT DISTINCT l_orderkey AS stem FROM lineitem WHERE l_linenumber = 2)
SELECT kind, count(*) AS n FROM (SELECT CASE WHEN a.stem IS NULL THEN 'single.2' WHEN b.stem IS NULL THEN 'single.1' ELSE 'pair' END AS kind FROM a FULL JOIN b ON a.stem = b.stem) GROUP BY kind""")
def pair_by_header(t):
    a, b = (t.lineitem.where(C("l_linenumber") == m).select(C("l_orderkey").alias("stem")).distinct() for m in (1, 2))
    return filters.pair_by_header(a, b, "stem").groupBy("kind").agg(F.count("*").alias("n"))


@query("fastq_trim", """
WITH d AS (SELECT doc_id, regexp_replace(text, '[^!-~]', 'J', 'g') AS q FROM documents),
g AS (SELECT doc_id, q, list_transform(string_split(q, ''), lambda c: ascii(c) - 33) AS v FROM d),
k AS (SELECT *, coalesce(list_max(list_transform(v, lambda x, i: CASE WHEN x >= 70 THEN i ELSE 0 END)), 0) AS n FROM g)
SELECT doc_id, q[1:n] AS trimmed FROM k WHERE n >= 10 AND floor(100 * len(list_filter(v[1:n], lambda x: x >= 70)) / greatest(n, 1)) >= 60""")
def fastq_trim(t):
    rows = t.documents.select("doc_id", F.regexp_replace("text", "[^!-~]", "J").alias("q"))
    cut = R.trim_tail(C("q"), C("q"), offset=33, least_quality=70, least_length=10, least_percent=60)
    return rows.select("doc_id", cut.alias("c")).where("c is not null").select("doc_id", C("c.qual").alias("trimmed"))


@query("solexa_trim", """
WITH d AS (SELECT doc_id, regexp_replace(text, '[^!-~]', 'J', 'g') AS q FROM documents),
e AS (SELECT doc_id, q, unnest(range(1, len(q) + 1)) AS i, ascii(unnest(string_split(q, ''))) - 33 > 68 AS ok FROM d),
r AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, ok ORDER BY i) AS g FROM e WHERE ok),
l AS (SELECT doc_id, any_value(q) AS q, min(i) AS a, count(*) AS n FROM r GROUP BY doc_id, g),
b AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, a) = 1)
SELECT doc_id, q[a:a + n - 1] AS trimmed FROM b WHERE n >= 5""")
def solexa_trim(t):
    rows = t.documents.select("doc_id", F.regexp_replace("text", "[^!-~]", "J").alias("q"))
    cut = R.trim_longest(C("q"), C("q"), offset=33, least_quality=68, least_length=5)
    return rows.select("doc_id", cut.alias("c")).where("c is not null").select("doc_id", C("c.qual").alias("trimmed"))


@query("read_id_split", "SELECT l_orderkey::VARCHAR AS insert_id, (l_linenumber % 2 + 1)::INTEGER AS mate, count(*) AS n FROM lineitem GROUP BY ALL")
def read_id_split(t):
    insert, mate = R.split_read_id(C("read"))
    rows = t.lineitem.select(F.concat_ws("/", C("l_orderkey").cast("string"), (C("l_linenumber") % 2 + 1).cast("string")).alias("read"))
    return rows.groupBy(insert.alias("insert_id"), mate.alias("mate")).agg(F.count("*").alias("n"))


@query("cigar_project", """
SELECT l_orderkey, l_linenumber, l_quantity::BIGINT + 5 AS match_len, l_quantity::BIGINT + 5 + l_linenumber + 2 AS total_len, 100 + l_linenumber AS first_base, 100 + l_linenumber + l_quantity::BIGINT + 5 - 1 AS last_base FROM lineitem""")
def cigar_project(t):
    n = C("l_quantity").cast("int").cast("string")
    cigar = F.concat(C("l_linenumber").cast("string"), F.lit("S"), n, F.lit("M2D1I4M2S"))
    return t.lineitem.select("l_orderkey", "l_linenumber", R.cigar_project(cigar, F.lit(100).cast("long")).alias("p")).select("l_orderkey", "l_linenumber", "p.*")


@query("mismatch_count", "SELECT doc_id, len(regexp_extract_all(text, '[ACGT]')) AS bases, len(regexp_extract_all(text, '[A-Za-z]')) AS letters FROM documents")
def mismatch_count(t):
    return t.documents.select("doc_id", R.mismatches(C("text")).cast("long").alias("bases"), R.mismatches(C("text"), True).cast("long").alias("letters"))


@query("kmer_choice", """
WITH a AS (SELECT doc_id, floor(n_chars / 7.0 + 0.5)::BIGINT AS m FROM documents)
SELECT doc_id, CASE WHEN m % 2 = 0 THEN CASE WHEN (m // 2) % 2 = 0 THEN m // 2 + 1 ELSE m // 2 + 2 END WHEN ((m + 1) // 2) % 2 = 0 THEN (m + 1) // 2 + 1 ELSE (m + 1) // 2 END AS k FROM a""")
def kmer_choice(t):
    return t.documents.select("doc_id", R.kmer_size(C("n_chars"), F.lit(7)).alias("k"))


@query("scaftig_split", """
WITH d AS (SELECT doc_id, list_filter(regexp_extract_all(text, '[ATGCatgc]+'), lambda s: length(s) >= 3) AS runs FROM documents),
e AS (SELECT doc_id, unnest(runs) AS seq, unnest(range(1, len(runs) + 1)) AS n FROM d)
SELECT doc_id::VARCHAR || '_' || n AS id, seq FROM e""")
def scaftig_split(t):
    return t.documents.select(F.explode(R.scaftigs(C("doc_id").cast("string"), C("text"), 3)).alias("s")).select("s.*")


@query("reverse_complement", "SELECT doc_id, translate(reverse(regexp_replace(text, '[^ -~]', 'N', 'g')), 'ACGTacgt', 'TGCAtgca') AS rc FROM documents")
def reverse_complement(t):
    return t.documents.select("doc_id", R.reverse_complement(F.regexp_replace("text", "[^ -~]", "N")).alias("rc"))


@query("padded_coordinates", "SELECT p_partkey, greatest(1, p_size * 10 - 100) AS a, p_size * 10 + 200 AS b, p_size * 10 - greatest(1, p_size * 10 - 100) + 1 AS c, p_size * 10 + 100 - greatest(1, p_size * 10 - 100) + 1 AS d FROM part")
def padded_coordinates(t):
    cells = R.padded(C("p_size") * 10, C("p_size") * 10 + 100)
    return t.part.select("p_partkey", *[c.alias(n) for c, n in zip(cells, "abcd", strict=True)])


@query("overlap_share", "SELECT l_orderkey, l_linenumber, round(greatest(0, least(50, 7 * l_linenumber + l_quantity) - greatest(10, 7 * l_linenumber)) / least(40, l_quantity), 6) AS share, least(7 * l_linenumber + l_quantity - 10, 50 - 7 * l_linenumber) AS overlap FROM lineitem")
def overlap_share(t):
    a, b = 7 * C("l_linenumber"), 7 * C("l_linenumber") + C("l_quantity")
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(R.overlap_share(F.lit(10), F.lit(50), a, b), 6).alias("share"), R.overlap(F.lit(10), F.lit(50), a, b).alias("overlap"))


@query("log_transforms", "SELECT l_orderkey, l_linenumber, round(log10(l_discount + 1e-8), 6) AS l8, round(log10(l_discount + 1e-6), 6) AS l6, round(asin(sqrt(l_discount)), 6) AS a FROM lineitem")
def log_transforms(t):
    d = C("l_discount")
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(R.log_shift(d, 1e-8), 6).alias("l8"), F.round(R.log_shift(d, 1e-6), 6).alias("l6"), F.round(R.arcsine_root(d), 6).alias("a"))


@query("multi_value_cells", "SELECT o_custkey, array_to_string(list_sort(list_distinct(list(o_orderpriority))), '|') AS cell FROM orders GROUP BY o_custkey")
def multi_value_cells(t):
    return t.orders.groupBy("o_custkey").agg(R.joined_cells(R.cell_set(C("o_orderpriority"))).alias("cell"))


@query("taxonomy_lookup", "SELECT p_brand, count(*) AS n, coalesce(sum(s_acctbal > 0), 0)::BIGINT AS positive FROM part LEFT JOIN supplier ON regexp_extract(p_partkey || '.x', '^([0-9]+)', 1)::BIGINT = s_suppkey GROUP BY p_brand")
def taxonomy_lookup(t):
    rows = t.part.select("p_brand", joins.prefix_key(F.concat(C("p_partkey").cast("string"), F.lit(".x"))).cast("long").alias("s_suppkey"))
    return joins.lookup(rows, t.supplier, "s_suppkey").groupBy("p_brand").agg(F.count("*").alias("n"), F.count_if(C("s_acctbal") > 0).alias("positive"))


@query("annotation_join", """
SELECT l_partkey, n_name, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
WHERE least(7 * l_linenumber + l_quantity, 40) - greatest(7 * l_linenumber, 20) > 0 GROUP BY ALL""")
def annotation_join(t):
    rows = t.lineitem.join(t.supplier, C("l_suppkey") == C("s_suppkey")).join(F.broadcast(t.nation), C("s_nationkey") == C("n_nationkey"))
    shared = F.least(7 * C("l_linenumber") + C("l_quantity"), F.lit(40)) - F.greatest(7 * C("l_linenumber"), F.lit(20))
    return rows.where(shared > 0).groupBy("l_partkey", "n_name").agg(F.count("*").alias("n"))


@query("full_outer_annotation_chain", """
WITH a AS (SELECT p_partkey AS k, p_brand FROM part), b AS (SELECT s_suppkey AS k, s_name FROM supplier), c AS (SELECT c_custkey AS k, c_mktsegment FROM customer)
SELECT k, coalesce(p_brand, 'NA') AS p_brand, coalesce(s_name, 'NA') AS s_name, coalesce(c_mktsegment, 'NA') AS c_mktsegment FROM a FULL JOIN b USING (k) FULL JOIN c USING (k)""")
def full_outer_annotation_chain(t):
    a = t.part.select(C("p_partkey").alias("k"), "p_brand")
    b = t.supplier.select(C("s_suppkey").alias("k"), "s_name")
    c = t.customer.select(C("c_custkey").alias("k"), "c_mktsegment")
    return joins.annotation_chain([a, b, c], "k")


@query("og_regions", """
WITH r AS (SELECT p_partkey, p_brand AS og, p_size AS a, p_size + 30 AS b FROM part)
SELECT l_orderkey, l_linenumber, og, 1 + greatest(0, a - 7 * l_linenumber) AS q_from, 61 - greatest(0, 7 * l_linenumber + 60 - b) AS q_to FROM lineitem JOIN r ON l_partkey = p_partkey
WHERE least(b - 7 * l_linenumber, 7 * l_linenumber + 60 - a) > 10""")
def og_regions(t):
    hits = t.lineitem.select("l_orderkey", "l_linenumber", C("l_partkey").alias("protein"), (7 * C("l_linenumber")).alias("s_start"), (7 * C("l_linenumber") + 60).alias("s_stop"), F.lit(1).alias("q_start"), F.lit(61).alias("q_stop"))
    regions = t.part.select(C("p_partkey").alias("protein"), C("p_brand").alias("og"), C("p_size").alias("region_start"), (C("p_size") + 30).alias("region_stop"))
    return joins.og_regions(hits, regions).select("l_orderkey", "l_linenumber", "og", "q_from", "q_to")


@query("group_by_map_default", "SELECT coalesce(n_name, 'unassigned') AS grp, round(sum(c_acctbal), 4) AS value FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON c_nationkey = n_nationkey GROUP BY 1")
def group_by_map_default(t):
    names = t.nation.where("n_regionkey < 3").select(C("n_nationkey").alias("c_nationkey"), C("n_name").alias("grp"))
    return joins.lookup(t.customer, F.broadcast(names), "c_nationkey", default={"grp": "unassigned"}).groupBy("grp").agg(F.round(F.sum("c_acctbal"), 4).alias("value"))


@query("all_by_all_pairs", "WITH s AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) SELECT x.l_suppkey AS a, y.l_suppkey AS b, count(*) AS n FROM s x JOIN s y ON x.l_orderkey = y.l_orderkey AND x.l_suppkey <= y.l_suppkey GROUP BY ALL")
def all_by_all_pairs(t):
    return joins.all_pairs_within(t.lineitem, "l_orderkey", "l_suppkey")


@query("top_pairs", "WITH s AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) SELECT x.l_suppkey AS a, y.l_suppkey AS b, count(*) AS n FROM s x JOIN s y ON x.l_orderkey = y.l_orderkey AND x.l_suppkey < y.l_suppkey GROUP BY ALL HAVING count(*) >= 5 ORDER BY n DESC, a, b")
def top_pairs(t):
    return joins.all_pairs_within(t.lineitem, "l_orderkey", "l_suppkey").where("a < b and n >= 5").orderBy(F.desc("n"), "a", "b")


@query("spanning_pairs", """
WITH p AS (SELECT l_partkey % 50 AS ref, min(l_linenumber) * 10 AS l, max(l_linenumber) * 10 AS r FROM lineitem GROUP BY l_orderkey, l_partkey % 50), b AS (SELECT DISTINCT l_partkey % 50 AS ref, 22 AS s, 27 AS e FROM lineitem)
SELECT b.ref, s AS start, e AS stop, count(p.l) AS spanning FROM b LEFT JOIN p ON b.ref = p.ref AND p.l < s AND p.r > e GROUP BY ALL""")
def spanning_pairs(t):
    ref = (C("l_partkey") % 50).alias("ref")
    pairs = t.lineitem.groupBy("l_orderkey", ref).agg((F.min("l_linenumber") * 10).alias("left"), (F.max("l_linenumber") * 10).alias("right"))
    return joins.spanning_pairs(pairs, t.lineitem.select(ref).distinct().select("ref", F.lit(22).alias("start"), F.lit(27).alias("stop")))


@query("lane_union", "SELECT lane, count(*) AS n FROM (SELECT 'a' AS lane, o_orderkey FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'b', o_orderkey FROM orders WHERE o_totalprice > 100000) GROUP BY lane")
def lane_union(t):
    a = t.orders.where("o_orderstatus = 'F'").select(F.lit("a").alias("lane"), "o_orderkey")
    b = t.orders.where("o_totalprice > 100000").select(F.lit("b").alias("lane"), "o_orderkey")
    return a.unionByName(b).groupBy("lane").agg(F.count("*").alias("n"))


@query("union_distinct", "SELECT l_partkey AS k FROM lineitem WHERE l_quantity > 45 UNION SELECT p_partkey FROM part WHERE p_size > 40")
def union_distinct(t):
    return t.lineitem.where("l_quantity > 45").select(C("l_partkey").alias("k")).union(t.part.where("p_size > 40").select("p_partkey")).distinct()


@query("intersect_levels", "SELECT l_partkey AS k FROM lineitem WHERE l_quantity > 45 INTERSECT SELECT p_partkey FROM part WHERE p_size > 20")
def intersect_levels(t):
    return t.lineitem.where("l_quantity > 45").select(C("l_partkey").alias("k")).intersect(t.part.where("p_size > 20").select("p_partkey"))


@query("except_reads", "SELECT o_orderkey AS k FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def except_reads(t):
    return t.orders.select(C("o_orderkey").alias("k")).subtract(t.lineitem.select("l_orderkey"))


@query("change_detection", "SELECT l_orderkey, sum((mate IS DISTINCT FROM before)::INT)::BIGINT AS changes FROM (SELECT l_orderkey, l_linenumber % 2 AS mate, lag(l_linenumber % 2) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS before FROM lineitem) GROUP BY 1")
def change_detection(t):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    rows = t.lineitem.select("l_orderkey", (C("l_linenumber") % 2).alias("mate"), F.lag(C("l_linenumber") % 2).over(w).alias("before"))
    return rows.groupBy("l_orderkey").agg(F.count_if(~C("mate").eqNullSafe(C("before"))).alias("changes"))


@query("first_reads", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def first_reads(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(100)


@query("top_tags", "SELECT l_partkey, round(sum(l_extendedprice), 2) AS v FROM lineitem GROUP BY 1 ORDER BY v DESC, l_partkey LIMIT 50")
def top_tags(t):
    rows = t.lineitem.groupBy("l_partkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("v"))
    return rows.orderBy(F.desc("v"), "l_partkey").limit(50)


@query("codon_translation", """
WITH d AS (SELECT doc_id, regexp_replace(upper(text), '[^ACGT]', '', 'g') AS s FROM documents)
SELECT doc_id, coalesce(array_to_string(list_transform(range(0, length(s) // 3), lambda i:
  'FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG'[16 * (position(s[3 * i + 1] IN 'TCAG') - 1) + 4 * (position(s[3 * i + 2] IN 'TCAG') - 1) + position(s[3 * i + 3] IN 'TCAG')]), ''), '') AS protein FROM d""")
def codon_translation(t):
    return t.documents.select("doc_id", R.translate_codons(F.regexp_replace(F.upper("text"), "[^ACGT]", "")).alias("protein"))


@query("positional_pairs", """
SELECT kind, count(*) AS n FROM (SELECT CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN 'pair' WHEN a IS NOT NULL THEN 'single.1' WHEN b IS NOT NULL THEN 'single.2' END AS kind
FROM (SELECT doc_id, CASE WHEN n_chars > 1000 THEN 1 END AS a, CASE WHEN doc_id % 3 > 0 THEN 1 END AS b FROM documents)) WHERE kind IS NOT NULL GROUP BY kind""")
def positional_pairs(t):
    a = t.documents.select("doc_id", F.when(C("n_chars") > 1000, "x").alias("seq"))
    b = t.documents.select("doc_id", F.when(C("doc_id") % 3 > 0, "x").alias("seq"))
    return filters.pair_by_place(a, b, "doc_id", "seq").groupBy("kind").agg(F.count("*").alias("n"))


@query("colour_trim", "SELECT doc_id, regexp_extract(text, '^[A-Za-z ]*') AS trimmed FROM documents WHERE length(regexp_extract(text, '^[A-Za-z ]*')) >= 20")
def colour_trim(t):
    cut = R.colour_trim(C("text"), C("text"), "A-Za-z ", 20)
    return t.documents.select("doc_id", cut.alias("c")).where("c is not null").select("doc_id", C("c.qual").alias("trimmed"))


@query("revision_pairs", """
WITH g AS (SELECT l_orderkey, l_linenumber % 2 AS mate, l_partkey FROM lineitem WHERE 1 - l_discount >= 0.95)
SELECT l_orderkey, mate, l_partkey, count(*) OVER (PARTITION BY l_orderkey, mate) AS hits FROM g QUALIFY min(mate) OVER (PARTITION BY l_orderkey) <> max(mate) OVER (PARTITION BY l_orderkey)""")
def revision_pairs(t):
    rows = t.lineitem.select(C("l_orderkey").alias("insert"), (C("l_linenumber") % 2).alias("mate"), "l_partkey", (1 - C("l_discount")).alias("identity"))
    return filters.revision_pairs(rows, least_identity=0.95).select(C("insert").alias("l_orderkey"), "mate", "l_partkey", "hits")


@query("flag_mates", "SELECT CASE WHEN l_orderkey % 256 & 4 <> 0 THEN NULL WHEN l_orderkey % 256 & 128 <> 0 THEN 2 ELSE 1 END AS mate, count(*) AS n FROM lineitem GROUP BY 1")
def flag_mates(t):
    return t.lineitem.groupBy(R.flag_mate(C("l_orderkey") % 256).alias("mate")).agg(F.count("*").alias("n"))


@query("quality_conversion", "SELECT doc_id, array_to_string(list_transform(string_split(regexp_replace(text, '[^A-Za-z]', '', 'g'), ''), lambda c: chr(ascii(c) - 31)), '') AS qual FROM documents WHERE regexp_matches(text, '[A-Za-z]')")
def quality_conversion(t):
    q = F.regexp_replace("text", "[^A-Za-z]", "")
    return t.documents.select("doc_id", R.sanger_quality(q, "i").alias("qual")).where("qual <> ''")


@query("quality_format", """
WITH q AS (SELECT lang, regexp_replace(text, '[^!-~]', '', 'g') AS q FROM documents),
r AS (SELECT lang, min(list_min(list_transform(string_split(q, ''), lambda c: ascii(c)))) AS lo, max(list_max(list_transform(string_split(q, ''), lambda c: ascii(c)))) AS hi FROM q WHERE q <> '' GROUP BY lang)
SELECT lang, CASE WHEN lo < 59 THEN 's' WHEN lo < 64 THEN 'x' WHEN hi > 74 THEN 'i' ELSE 's' END AS form FROM r""")
def quality_format(t):
    codes = F.transform(F.split(F.regexp_replace("text", "[^!-~]", ""), ""), F.ascii)
    rows = t.documents.select("lang", F.filter(codes, lambda c: c > 0).alias("codes")).where(F.size("codes") > 0)
    return rows.groupBy("lang").agg(R.quality_format(F.min(F.array_min("codes")), F.max(F.array_max("codes"))).alias("form"))


@query("sequence_formats", "SELECT doc_id, '>' || doc_id || chr(10) || text AS fasta, '@' || doc_id || chr(10) || text || chr(10) || '+' || chr(10) || repeat('I', length(text)) AS fastq FROM documents")
def sequence_formats(t):
    name, seq = C("doc_id").cast("string"), C("text")
    return t.documents.select("doc_id", R.fastq_to_fasta(name, seq).alias("fasta"), R.fasta_to_fastq(name, seq).alias("fastq"))


@query("marker_partitions", "SELECT split_part(p_brand || '.' || p_partkey, '.', 1) AS cog, count(*) AS features, sum(p_size)::BIGINT AS value FROM part GROUP BY 1")
def marker_partitions(t):
    rows = t.part.select(F.concat_ws(".", "p_brand", C("p_partkey").cast("string")).alias("feature"), "p_size")
    return rows.groupBy(F.split_part("feature", F.lit("."), F.lit(1)).alias("cog")).agg(F.count("*").alias("features"), F.sum("p_size").alias("value"))


@query("summary_union", "SELECT 'orders' AS stage, count(*) AS rows, sum(o_totalprice) AS total, NULL::BIGINT AS parts FROM orders UNION ALL SELECT 'lines', count(*), NULL, count(DISTINCT l_partkey) FROM lineitem")
def summary_union(t):
    from abundara.sources.writers import summaries

    return summaries({"orders": t.orders.agg(F.count("*").alias("rows"), F.sum("o_totalprice").alias("total")), "lines": t.lineitem.agg(F.count("*").alias("rows"), F.count_distinct("l_partkey").alias("parts"))}).select("stage", "rows", "total", "parts")


@query("paired_sam", """
WITH r AS (SELECT l_orderkey * 1000 + l_linenumber // 2 * 100 + row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS i, l_linenumber % 2 + 1 AS m, l_suppkey % 5 AS ref, l_partkey AS pos, l_quantity::BIGINT AS len, l_linestatus = 'O' AS rev FROM lineitem)
SELECT a.i AS insert, a.m AS mate, a.pos, 1 + CASE WHEN a.ref = b.ref THEN 2 ELSE 0 END + CASE WHEN b.i IS NULL THEN 8 ELSE 0 END + CASE WHEN a.rev THEN 16 ELSE 0 END + CASE WHEN b.rev THEN 32 ELSE 0 END + CASE WHEN a.m = 1 THEN 64 ELSE 128 END AS flag,
coalesce(b.pos, 0) AS pnext, CASE WHEN a.ref = b.ref THEN (greatest(a.pos + a.len, b.pos + b.len) - least(a.pos, b.pos)) * CASE WHEN a.pos <= b.pos THEN 1 ELSE -1 END ELSE 0 END AS tlen,
CASE WHEN a.len > 1 THEN '0A' || (a.len - 1) ELSE '0A0' END AS md FROM r a LEFT JOIN r b ON a.i = b.i AND b.m = 3 - a.m""")
def paired_sam(t):
    """Lines 2k and 2k + 1 of an order are mates; a line number that stands more than once belongs to further inserts."""
    from abundara.sources.writers import paired_sam as run

    copy = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))
    insert = C("l_orderkey") * 1000 + F.floor(C("l_linenumber") / 2) * 100 + copy
    rows = t.lineitem.select(insert.alias("insert"), (C("l_linenumber") % 2 + 1).alias("mate"), (C("l_suppkey") % 5).cast("string").alias("ref"), C("l_partkey").alias("pos"), C("l_quantity").cast("long").alias("length"), F.when(C("l_linestatus") == "O", "-").otherwise("+").alias("strand"), F.lit("0:A").alias("marks"))
    return run(rows).select("insert", "mate", "pos", "flag", "pnext", "tlen", F.element_at("tags", "MD").alias("md"))
