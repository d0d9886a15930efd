"""Queries through files: driver tables are written in a format to the scratch folder and read back by its reader."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from abundara.functions import reads as R
from abundara.operators import tree as G
from abundara.operators.scratch import folder, memoised
from abundara.plans.profiles import hits, rounded
from abundara.plans.registry import query
from abundara.plans.statistics import _CELLS, cells, tree
from abundara.sources import readers, writers

C = F.col


def place(t, name: str) -> str:
    return f"{folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def put(t, name: str, rows, *columns, sep: str = "\t") -> str:
    """Text lines of the columns (or of the one text column) in a new folder."""
    path = place(t, name)
    line = F.concat_ws(sep, *[c.cast("string") for c in columns])
    rows.select(line.alias("value")).write.text(path)
    return path


def _text():
    return F.regexp_replace("text", "[^!-~]", "N")


@query("fastq_scan", "SELECT 'd ' || doc_id AS header, regexp_replace(text, '[^!-~]', 'N', 'g') AS seq, repeat('I', length(text)) AS qual FROM documents")
def fastq_scan(t):
    rows = t.documents.select(F.concat(F.lit("@d "), "doc_id").alias("h"), _text().alias("s"))
    path = put(t, "reads", rows, C("h"), C("s"), F.lit("+"), F.repeat(F.lit("I"), F.length("s")), sep="\n")
    return readers.read_fastq(t.spark, path).drop("file")


@query("fastq_sink", "SELECT 'd' || doc_id AS header, regexp_replace(text, '[^!-~]', 'N', 'g') AS seq, lang FROM documents")
def fastq_sink(t):
    """Gzipped files, a folder a language, read back."""
    path = place(t, "sink")
    rows = t.documents.select(F.concat(F.lit("d"), "doc_id").alias("header"), _text().alias("seq"), F.repeat(F.lit("I"), F.length("text")).alias("qual"), "lang")
    writers.write_fastq(rows, path, by="lang")
    return readers.read_fastq(t.spark, f"{path}/lang=*").select("header", "seq", F.regexp_extract("file", "lang=([^/]*)", 1).alias("lang"))


@query("fasta_scan", "SELECT 'p' || p_partkey AS seq_id, p_name AS description, replace(p_name, ' ', '') || p_type AS seq FROM part")
def fasta_scan(t):
    rows = t.part.select(F.concat_ws(" ", F.concat(F.lit(">p"), "p_partkey"), "p_name").alias("h"), "p_name", "p_type")
    return readers.read_fasta(t.spark, put(t, "genes", rows, C("h"), C("p_name"), C("p_type"), sep="\n"))


@query("fasta_sink", "SELECT 'p' || p_partkey AS seq_id, repeat(p_type, 20) AS seq FROM part")
def fasta_sink(t):
    path = place(t, "wrapped")
    writers.write_fasta(t.part.select(F.concat(F.lit("p"), "p_partkey").alias("seq_id"), F.repeat(C("p_type"), 20).alias("seq")), path)
    return readers.read_fasta(t.spark, path).select("seq_id", "seq")


@query("fasta_to_tab", "SELECT p_partkey, p_brand || ' ' || p_type || chr(9) || replace(p_name, ' ', '') AS line FROM part")
def fasta_to_tab(t):
    return t.part.select("p_partkey", R.fasta_to_tab(F.concat_ws("\t", "p_brand", "p_type"), C("p_name")).alias("line"))


_SOAP = "SELECT l_orderkey || '/' || (l_linenumber % 2 + 1) AS read_id, l_quantity::INTEGER AS length, CASE WHEN l_linestatus = 'O' THEN '-' ELSE '+' END AS strand, 'p' || l_partkey AS ref, l_suppkey AS pos, l_quantity::INTEGER || 'M' AS cigar, repeat('5A', (l_suppkey % 4)::INTEGER) || '10' AS md FROM lineitem"


def _soap(t):
    mate = F.concat_ws("/", C("l_orderkey").cast("string"), (C("l_linenumber") % 2 + 1).cast("string"))
    n = C("l_quantity").cast("int")
    return put(
        t, "soap", t.lineitem, mate, F.repeat(F.lit("A"), n), F.repeat(F.lit("I"), n), F.lit(1), F.lit("a"), n, F.when(C("l_linestatus") == "O", "-").otherwise("+"),
        F.concat(F.lit("p"), "l_partkey"), C("l_suppkey"), F.lit(0), F.concat(n.cast("string"), F.lit("M")), F.concat(F.repeat(F.lit("5A"), (C("l_suppkey") % 4).cast("int")), F.lit("10")))


@query("soap_scan", _SOAP)
def soap_scan(t):
    return readers.read_soap(t.spark, _soap(t)).select("read_id", "length", "strand", "ref", "pos", "cigar", "md")


@query("soap_to_sam", f"""WITH s AS ({_SOAP}), x AS (SELECT *, (length(md) - 2) // 2 AS nm FROM s)
SELECT read_id, CASE WHEN strand = '-' THEN 16 ELSE 0 END AS flag, ref, pos, cigar, floor((100 - nm / length * 100) * 10 + 1e-9)::INTEGER::VARCHAR AS score, nm::VARCHAR AS nm FROM x WHERE length >= 30 AND 100 - nm / length * 100 >= 95""")
def soap_to_sam(t):
    """Alignments filtered, written as SAM and read back."""
    path = place(t, "sam")
    writers.write_sam(writers.soap_to_sam(readers.read_soap(t.spark, _soap(t)), least_length=30), path)
    return readers.read_sam(t.spark, path).select("read_id", "flag", "ref", "pos", "cigar", F.element_at("tags", "AS").alias("score"), F.element_at("tags", "NM").alias("nm"))


@query("mapped_reads", "SELECT l_orderkey || '/' || (l_linenumber % 2 + 1) AS read_id, CASE WHEN l_linestatus = 'O' THEN l_returnflag ELSE 'N' END AS seq, count(*) AS n FROM lineitem GROUP BY ALL")
def mapped_reads(t):
    out = R.mate_suffix(C("l_orderkey").cast("string"), C("l_linenumber") % 2 + 1, C("l_linestatus") == "O", C("l_returnflag"))
    return t.lineitem.select(out.alias("x")).groupBy("x.read_id", "x.seq").agg(F.count("*").alias("n"))


@query("coordinate_scan", "SELECT p_brand AS ref, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS idx, p_partkey AS start, p_partkey + p_size AS stop FROM part")
def coordinate_scan(t):
    return readers.read_coordinates(t.spark, put(t, "coord", t.part, C("p_brand"), C("p_partkey"), C("p_partkey") + C("p_size")))


@query("coordinate_memo", "SELECT p_brand AS ref, count(*) AS n FROM part GROUP BY 1")
def coordinate_memo(t):
    """The dimension is built once; the second call reads what the first one wrote."""
    path = place(t, "memo")
    memoised(t.spark, path, lambda: readers.read_coordinates(t.spark, put(t, "coord", t.part, C("p_brand"), C("p_partkey"), C("p_partkey") + C("p_size"))))
    return memoised(t.spark, path, lambda: t.spark.range(0)).groupBy("ref").agg(F.count("*").alias("n"))


@query("functional_map_scan", "SELECT p_partkey::VARCHAR AS gene, 'name' AS level, replace(p_name, ' ', ',') AS cell FROM part UNION ALL SELECT p_partkey::VARCHAR, 'kind', p_type FROM part")
def functional_map_scan(t):
    header = t.spark.range(1).select(F.lit("#gene\tname\tkind").alias("value"))
    rows = t.part.select(F.concat_ws("\t", C("p_partkey").cast("string"), F.replace(C("p_name"), F.lit(" "), F.lit(",")), "p_type").alias("value"))
    path = place(t, "map")
    header.unionByName(rows).write.text(path)
    return readers.read_functional_map(t.spark, path)


@query("marker_scan", "SELECT p_partkey::VARCHAR AS gene, p_size::BIGINT AS length, p_brand AS cog, p_type AS otu FROM part")
def marker_scan(t):
    return readers.read_markers(t.spark, put(t, "markers", t.part, C("p_partkey"), C("p_size"), C("p_brand"), C("p_type")))


@query("taxonomy_scan", "SELECT p_partkey::VARCHAR AS taxaid, p_brand AS species, p_size::DOUBLE AS length FROM part")
def taxonomy_scan(t):
    none = F.lit("x")
    path = put(t, "taxa", t.part, C("p_partkey"), none, none, none, none, none, none, C("p_brand"), none, C("p_size"))
    return readers.read_taxonomy(t.spark, path).select("taxaid", "species", "length")


@query("stats_scan", "SELECT count(*) AS reads, sum(l_quantity)::BIGINT AS bases, count(DISTINCT l_orderkey) AS inserts, NULL::VARCHAR AS note FROM lineitem UNION ALL SELECT 0, 0, 0, 'missing'")
def stats_scan(t):
    """A statistics file written and read back, and one that is not there."""
    path = place(t, "stats")
    one = t.lineitem.agg(F.count("*").alias("Reads"), F.sum("l_quantity").cast("long").alias("Bases"), F.max("l_quantity").cast("int").alias("Max"), F.avg("l_quantity").alias("Avg"), F.lit(45).alias("Kmer"), F.count_distinct("l_orderkey").alias("Inserts"))
    writers.write_stats(one, path)
    found = readers.read_stats(t.spark, path, missing_ok=True).unionByName(readers.read_stats(t.spark, f"{path}-none", missing_ok=True))
    return found.select("reads", "bases", "inserts", F.regexp_extract("note", "^[a-z]+", 0).alias("note"))


@query("hit_scan", """SELECT 'o' || l_orderkey AS query, 'p' || l_partkey AS subject, l_discount * 100 AS pident, l_quantity AS bits, l_linenumber::BIGINT AS qs, CASE WHEN l_linestatus = 'O' THEN l_quantity::BIGINT END AS length, CASE WHEN l_linestatus = 'O' THEN 3::BIGINT END AS mismatch FROM lineitem""")
def hit_scan(t):
    """Both flavours in one folder: twelve columns for open lines, the wider layout for the others."""
    s = lambda c: c.cast("string")
    q, p, ident, bits = F.concat(F.lit("o"), "l_orderkey"), F.concat(F.lit("p"), "l_partkey"), s(C("l_discount") * 100), s(C("l_quantity"))
    x = F.lit("7")
    narrow = F.concat_ws("\t", q, p, ident, s(C("l_quantity").cast("long")), F.lit("3"), F.lit("0"), s(C("l_linenumber")), x, x, x, F.lit("1e-5"), bits)
    wide = F.concat_ws("\t", q, p, F.lit("1e-5"), x, bits, x, x, x, x, x, ident, x, x, x, x, x, x, s(C("l_linenumber")), x, x, x, x)
    path = put(t, "hits", t.lineitem, F.when(C("l_linestatus") == "O", narrow).otherwise(wide))
    return rounded(readers.read_hits(t.spark, path).select("query", "subject", "pident", "bits", "qs", "length", "mismatch"), "pident")


@query("gene_header_scan", "SELECT 'g' || p_partkey AS gene, '-' AS strand, p_partkey AS start, p_partkey + p_size AS stop, p_size + 1::BIGINT AS length, 'ATG' AS start_codon, 'complete' AS gene_type FROM part")
def gene_header_scan(t):
    path = put(t, "headers", t.part, F.concat(F.lit(">g"), "p_partkey"), C("p_partkey"), C("p_partkey") + C("p_size"), F.lit("-1"), F.lit("ID=1;partial=00;start_type=ATG"), sep=" # ")
    return readers.read_gene_headers(t.spark, path).select("gene", "strand", "start", "stop", "length", "start_codon", "gene_type")


@query("gene_report_scan", "SELECT 'n' || n_nationkey AS contig, 'n' || n_nationkey || '_1' AS gene, '+' AS strand, 5::BIGINT AS start, 10::BIGINT + n_nationkey AS stop FROM nation")
def gene_report_scan(t):
    path = put(t, "report", t.nation, F.concat(F.lit("FASTA definition line: n"), "n_nationkey"), F.lit(" Gene Strand"), F.concat_ws(" ", F.lit(" 1 + <5"), (C("n_nationkey") + 10).cast("string"), F.lit("6 1")), sep="\n")
    return readers.read_gene_report(t.spark, path).select("contig", "gene", "strand", "start", "stop")


@query("domain_scan", "SELECT p_partkey || '.proj.x' AS target, p_brand AS query, p_size::DOUBLE AS bits, p_partkey::VARCHAR AS taxid, 'proj' AS project FROM part WHERE p_size >= 20")
def domain_scan(t):
    path = put(t, "domains", t.part, F.concat(C("p_partkey").cast("string"), F.lit(".proj.x")), F.lit("-"), F.lit("9"), C("p_brand"), F.lit("-"), F.lit("9"), F.lit("1e-9"), C("p_size"), sep="   ")
    return readers.read_domains(t.spark, path, least_bits=20)


@query("feature_scan", "SELECT 'b' || p_brand AS seqname, 'f' || p_size AS name, min(p_partkey) AS start, max(p_partkey + 5) AS stop, count(*)::BIGINT AS places FROM part GROUP BY p_brand, p_size")
def feature_scan(t):
    """Lines of one identifier are one feature with several locations."""
    path = put(t, "gff", t.part, F.concat(F.lit("b"), "p_brand"), F.lit("src"), F.lit("CDS"), C("p_partkey"), C("p_partkey") + 5, F.lit("."), F.lit("+"), F.lit("0"), F.concat(F.lit("ID=f"), C("p_size").cast("string"), F.lit("; note \"x\"")))
    return readers.read_features(t.spark, path).select("seqname", "name", "start", C("end").alias("stop"), F.size("locations").cast("long").alias("places"))


_SHOWN = [f"NATION_{n}" for n in range(6)]
_IN = ", ".join(f"'{n}'" for n in _SHOWN)


@query("matrix_round_trip", _CELLS + f", k AS (SELECT * FROM m WHERE sample IN ({_IN})) SELECT f.feature, s.sample, coalesce(k.value, 0) AS value FROM (SELECT DISTINCT feature FROM k) f, (SELECT unnest([{_IN}]) AS sample) s LEFT JOIN k ON k.feature = f.feature AND k.sample = s.sample")
def matrix_round_trip(t):
    path = place(t, "matrix")
    writers.write_matrix(cells(t).where(C("sample").isin(_SHOWN)), _SHOWN, path)
    return readers.read_matrix(t.spark, path)


@query("cells_round_trip", _CELLS + " SELECT feature, sample, value FROM m WHERE value <> 0")
def cells_round_trip(t):
    path = place(t, "cells")
    writers.write_cells(cells(t), path)
    return readers.read_cells(t.spark, path)


@query("column_scan", "SELECT p_partkey::VARCHAR AS feature, 'size' AS sample, p_size::DOUBLE AS value FROM part UNION ALL SELECT p_partkey::VARCHAR, 'price', CASE WHEN p_size > 25 THEN p_retailprice END FROM part")
def column_scan(t):
    path = put(t, "columns", t.part, C("p_partkey"), C("p_size"), F.when(C("p_size") > 25, C("p_retailprice").cast("string")).otherwise("NA"))
    return readers.read_columns(t.spark, path, ["size", "price"])


@query("pair_scan", "SELECT p_name AS key, p_size::DOUBLE AS value FROM part")
def pair_scan(t):
    return readers.read_pairs(t.spark, put(t, "pairs", t.part, C("p_name"), C("p_size")))


@query("triangle_scan", "SELECT 'r' || a.r_regionkey AS a, 'r' || b.r_regionkey AS b, abs(a.r_regionkey - b.r_regionkey) * 1.0::DOUBLE AS value FROM region a, region b")
def triangle_scan(t):
    lower = F.when(C("r_regionkey") > 0, F.array_join(F.transform(F.sequence(F.lit(0), C("r_regionkey") - 1), lambda k: (C("r_regionkey") - k).cast("string")), " ")).otherwise("")
    path = put(t, "triangle", t.region, F.concat(F.lit("r"), "r_regionkey"), lower, sep=" ")
    return readers.read_lower_triangle(t.spark, path)


@query("sample_scan", "SELECT n_name AS sample FROM nation")
def sample_scan(t):
    return readers.read_samples(t.spark, put(t, "samples", t.nation, C("n_name")))


@query("profile_sink", """
WITH g AS (SELECT l_partkey::VARCHAR AS feature FROM lineitem GROUP BY 1) SELECT feature, count(DISTINCT l_orderkey)::DOUBLE AS times FROM lineitem JOIN g ON feature = l_partkey::VARCHAR GROUP BY feature""")
def profile_sink(t):
    """A profile written in parts with its horizontal coverage; one part is read."""
    path = place(t, "profile")
    times = hits(t).withColumn("sample", F.lit("s")).groupBy("sample", C("gene").alias("feature")).agg(F.count_distinct("insert_id").cast("double").alias("value"))
    part = times.select("sample", F.lit("gene").alias("level"), "feature", F.lit("insert").alias("count_type"), F.lit("plain").alias("dist_type"), F.lit("times").alias("norm_type"), "value")
    flat = writers.long_horizontal(t.part.select(C("p_partkey").cast("string").alias("feature"), C("p_size").alias("covered")), "gene", "s")
    writers.write_profile(part.unionByName(flat), path)
    return writers.read_member(t.spark, path, level="gene", norm_type="times").select("feature", C("value").alias("times"))


@query("unique_names", "SELECT p_brand || '_' || p_partkey || '_' || (p_partkey + p_size) AS feature, p_retailprice AS value FROM part")
def unique_names(t):
    from pyspark.sql import Window

    idx = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey"))
    rows = t.part.select(C("p_brand").alias("ref"), idx.alias("idx"), C("p_partkey").alias("start"), (C("p_partkey") + C("p_size")).alias("stop"), C("p_retailprice").alias("value"))
    return writers.unique_names(rows.select("ref", "idx", "value"), rows)


@query("tree_texts", "SELECT unnest(['newick', 'phyloxml']) AS form, (SELECT count(*) FROM nation) AS leaves")
def tree_texts(t):
    """Leaves named in the tree's text; the region and nation levels only, as a text's tree is small."""
    nodes = [(r.id, r.parent, r.id) for r in tree(t).where("rank <> 'customer'").collect()]
    text, xml = G.newick(nodes, "root"), G.phyloxml(nodes, "root")
    return t.spark.createDataFrame([("newick", text.count("n")), ("phyloxml", xml.count("<name>n"))], "form string, leaves long")
