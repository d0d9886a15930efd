"""Readers in splits, binary alignments, header stems, several samples, sampling, clusters and the extension surface."""

import gzip
import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from abundara import modules
from abundara.functions import reads as R
from abundara.operators import clustering as K
from abundara.operators import filters
from abundara.operators import matrix as M
from abundara.operators import profile as P
from abundara.operators import sampling as S
from abundara.operators import stats as T
from abundara.operators import tree as G
from abundara.plans import registry
from abundara.sources import readers, writers

SF = "/root/testdata/sf0.001"


def test_fastq_in_splits(spark, tmp_path):
    """Plain and bz2 files cut anywhere, with qualities that start like headers, give the records of the whole file."""
    rnd = random.Random(4)
    records = []
    for n in range(400):
        size = rnd.randrange(1, 90)
        records.append((f"r{n} {'@' * (n % 3)}+", "".join(rnd.choices("ACGTN", k=size)), "".join(rnd.choices("@+IJ#", k=size))))
    text = "".join(f"@{h}\n{s}\n+{h if n % 5 == 0 else ''}\n{q}\n" for n, (h, s, q) in enumerate(records))
    (tmp_path / "a.fq").write_text(text)
    (tmp_path / "b.fq.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "c.fq").write_text("@only\nAC\n+\nII")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("900b", "4k", "1g"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            for name, want in (("a.fq", records), ("b.fq.gz", records), ("c.fq", [("only", "AC", "II")])):
                got = readers.read_fastq(spark, str(tmp_path / name)).collect()
                assert sorted((r.header, r.seq, r.qual) for r in got) == sorted(want), (size, name)
            assert readers.read_fastq(spark, str(tmp_path)).count() == 801
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    (tmp_path / "d.fq").write_text(text + "@broken\nACG\n")
    with pytest.raises(Exception, match="ends within a record"):
        readers.read_fastq(spark, str(tmp_path / "d.fq")).collect()


def test_bam(spark, tmp_path):
    def record(name, flag, ref, pos, ops, seq, qual, tags):
        codes = ["=ACMGRSVTWYHKDBN".index(c) for c in seq] + [0]
        packed = bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(seq), 2))
        body = struct.pack("<iiBBHHHiiii", ref, pos - 1, len(name) + 1, 30, 0, len(ops), flag, len(seq), -1, -1, 0)
        body += name.encode() + b"\0" + b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(o)) for n, o in ops) + packed + bytes(ord(q) - 33 for q in qual) + tags
        return struct.pack("<i", len(body)) + body

    head = b"BAM\x01" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 3) + b"g1\0" + struct.pack("<i", 1000)
    rows = head + record("r1", 16, 0, 7, [(3, "M"), (1, "S")], "ACGT", "IIII", b"NMC\x02ASi" + struct.pack("<i", -5) + b"XZZab\0") + record("r2", 4, -1, 0, [], "AC", "##", b"")
    (tmp_path / "a.bam").write_bytes(gzip.compress(rows[:40]) + gzip.compress(rows[40:]))
    one, two = readers.read_bam(spark, str(tmp_path / "a.bam")).orderBy("read_id").collect()
    assert (one.read_id, one.flag, one.ref, one.pos, one.cigar, one.seq, one.qual, one.tags) == ("r1", 16, "g1", 7, "3M1S", "ACGT", "IIII", {"NM": "2", "AS": "-5", "XZ": "ab"})
    assert (two.read_id, two.ref, two.cigar, two.seq) == ("r2", "*", "*", "AC")


def test_header_stems(spark):
    want = {
        "@r 1/1": "@r_1", "@r 1/2": "@r_1", "@plain x": "@plain_x", "@a/b/1": "@a/b/1",
        "@EAS:1:FC:2:2104:15343:197393 1:N:18:ATC": "@EAS:1:FC:2:2104:15343:197393:0:N:18:ATC", "@EAS:1:FC:2:2104:15343:197394 2:N:18:ATC": "@EAS:1:FC:2:2104:15343:197394:0:N:18:ATC",
        "@EAS:1:FC:2:2104:15343:197393 1:Y:18:ATC": None, "@EAS:1:FC:2:2104:15343:197393 3:N:18:ATC": None,
        "@S:1:2:3:4:5": "@S:2:3:4:5#0", "@S:1:2:3:4:5:6": "@S:2:3:4:5#0",
    }
    got = spark.createDataFrame([(h,) for h in want], "h string").select("h", R.read_stem(F.col("h")).alias("s")).collect()
    assert {r.h: r.s for r in got} == want


def test_several_samples(spark):
    """A profile of two samples is that of each by itself."""
    rnd = random.Random(7)
    rows = [(s, i, m, f"g{rnd.randrange(8)}", rnd.randrange(20, 90), 100) for s in ("a", "b") for i in range(60) for m in (1, 2) for _ in range(rnd.randrange(0, 3))]
    lengths = {f"g{k}": 100 + k for k in range(8)}
    hits = spark.createDataFrame([(s, i, m, g, c, lengths[g], f"t{int(g[1]) // 2}") for s, i, m, g, c, _ in rows], "sample string, insert_id long, mate int, gene string, cov int, length int, family string")
    for taxon in (None, "family"):
        both = P.profile(hits, taxon)
        names = [c for c in both.columns if c not in ("sample", "feature", "kind")]
        got = {(r["sample"], r.feature, r.kind): [r[n] for n in names] for r in both.collect()}
        for s in "ab":
            alone = {(s, r.feature, r.kind): [r[n] for n in names] for r in P.profile(hits.where(F.col("sample") == s), taxon).collect()}
            assert alone.keys() == {k for k in got if k[0] == s}
            assert all(a == pytest.approx(b) for k in alone for a, b in zip(alone[k], got[k]))


def test_resampling(spark):
    items = spark.range(50).withColumnRenamed("id", "k")
    got = S.resample(items, "k", 4).collect()
    for r in range(1, 5):
        assert sum(x.times for x in got if x.replicate == r) == 50
    assert 20 <= len({x.k for x in got if x.replicate == 1}) < 50
    m = spark.createDataFrame([(f, s, float(3 * f + len(s))) for f in range(9) for s in ("a", "bb", "ccc")], "feature int, sample string, value double")
    even = S.rarefy_to_least(m).groupBy("sample").agg(F.sum("value").alias("t")).collect()
    assert len(even) == 3 and {r.t for r in even} == {117.0}
    lengths = m.select("sample").distinct().withColumn("length", F.lit(2))
    thin = S.thin_to_bases(m, 60.0, lengths)
    assert thin.where("value > 0").count() > 0 and all(r.value % 2 == 0 for r in thin.collect())
    total = S.bootstrap(m, 500, 2).groupBy("sample", "replicate").agg(F.sum("value").alias("t")).collect()
    assert {r.t for r in total} == {500} and len(total) == 6
    shares = {r.feature: r.n / 1000 for r in S.bootstrap(m.where("sample = 'a'"), 500, 2).groupBy("feature").agg(F.sum("value").alias("n")).collect()}
    whole = sum(3 * f + 1 for f in range(9))
    assert all(abs(shares.get(f, 0) - (3 * f + 1) / whole) < 0.06 for f in range(9))


def test_deep_tree(spark):
    chain = spark.range(70).selectExpr("id", "CASE WHEN id = 0 THEN NULL ELSE id - 1 END AS parent")
    closure = G.lineages(chain)
    assert closure.count() == 70 * 71 // 2 and closure.where("id = 69 and ancestor = 0").first().steps == 69
    with pytest.raises(ValueError):
        G.lineages(spark.createDataFrame([(1, 2), (2, 1)], "id long, parent long"))
    nodes = [(0, None, "a b"), (1, 0, "x<y"), (2, 0, "z")]
    assert G.newick(nodes, 0) == "(x<y,z)a_b;" and "<name>x&lt;y</name>" in G.phyloxml(nodes, 0)
    many = [(n, n - 1 if n else None, n) for n in range(5000)]
    assert G.newick(many, 0).count("(") == 4999


def test_distributions_and_adjustment(spark):
    assert abs(T.f_tail(4.102821, 2, 10) - 0.05) < 1e-6 and abs(T.chi2_tail(5.991465, 2) - 0.05) < 1e-6 and T.f_tail(0, 2, 3) == 1
    rnd = random.Random(2)
    ps = [rnd.random() ** 3 for _ in range(200)] + [0.5] * 5
    rows = spark.createDataFrame(list(enumerate(ps)), "k long, p double")
    for how, c in (("bh", 1.0), ("by", sum(1 / i for i in range(1, 206)))):
        order = sorted(range(205), key=lambda k: (ps[k], k))
        want, least = {}, 1.0
        for rank in range(205, 0, -1):
            least = min(least, ps[order[rank - 1]] * 205 * c / rank)
            want[order[rank - 1]] = least
        got = {r.k: r.q for r in T.adjust(rows, "p", how, ["k"]).collect()}
        assert all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def test_clusters():
    import numpy as np

    x = np.concatenate([np.random.default_rng(0).normal(0, 0.1, (30, 4)), np.random.default_rng(1).normal(5, 0.1, (30, 4))], axis=1)
    distance = lambda v: np.sqrt(((v[:, :, None] - v[:, None, :]) ** 2).sum(0))
    support = dict(K.cluster_support(x, distance, replicates=20))
    assert support[frozenset(range(4))] == support[frozenset(range(4, 8))] == 1.0
    axes, share = K.between_classes(distance(x), np.array([0] * 4 + [1] * 4), 1)
    assert share > 0.9 and abs(np.sign(axes[:4, 0]).sum()) == 4


def test_strict_matrices(spark):
    full = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0)], "feature string, sample string, value double")
    right = spark.createDataFrame([("x", "s", 3.0)], "k string, sample string, value double")
    assert M.multiply(full.withColumnRenamed("sample", "k"), right).first().value == 3.0
    with pytest.raises(Exception, match="missing"):
        M.multiply(full.withColumnRenamed("sample", "k"), right, complete=True).collect()
    with pytest.raises(Exception, match="zero"):
        M.normalise_rows(full.withColumn("value", F.lit(0.0))).collect()
    with pytest.raises(Exception, match="not in the list"):
        filters.merge_in_order(spark.createDataFrame([("a", 1)], "read_id string, ord long"), [spark.createDataFrame([("b",)], "read_id string")]).collect()


def test_summary_table(spark):
    rows = spark.createDataFrame([(1, "a")], "n int, s string")
    try:
        writers.save_summary(rows, "abundara_test_summary")
        writers.save_summary(rows.union(rows), "abundara_test_summary")
        assert spark.table("abundara_test_summary").count() == 2
    finally:
        spark.sql("DROP TABLE IF EXISTS abundara_test_summary")


def test_modules(spark):
    table = spark.range(1)
    with pytest.raises(KeyError):
        modules.run_module("none", spark, {})
    with pytest.raises(ValueError, match="requires"):
        modules.run_module("wilcoxon", spark, {"matrix": table})

    @modules.module("lost", produces=("x",))
    def lost(spark, tables, settings):
        return {}

    with pytest.raises(ValueError, match="did not give"):
        modules.run_module("lost", spark, {})
    del modules.MODULES["lost"]


def test_functional_mode_sums_the_gene_level(spark):
    t = registry.Tables(spark, SF)
    from abundara.plans.profiles import hits

    cells = t.part.select(F.col("p_partkey").cast("string").alias("gene"), F.lit("kind").alias("level"), F.concat_ws(",", "p_type", "p_brand").alias("cell"))
    found = modules.profiles(hits(t).drop("brand"), "functional", {"functions": cells}).where("count_type = 'base' and dist_type = 'plain' and norm_type = 'raw'")
    per = {r.level: r.v for r in found.groupBy("level").agg(F.sum("value").alias("v")).collect()}
    assert abs(per["kind"] - 2 * per["gene"]) < 1e-6 * per["gene"]


def test_every_query_has_one_form():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_queries_are_listed_without_a_session():
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e; assert len(e.oracle_sql()) <= len(e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[1], timeout=120)


def test_patches_across_chunks(spark):
    from abundara.operators.aggregates import patch_sequences

    contigs = spark.createDataFrame([(1, "ACGTACGTAC"), (2, ""), (3, "GGG")], "contig int, seq string")
    changes = spark.createDataFrame([(1, 1, "T"), (1, 4, "A"), (1, 5, "C"), (1, 10, "G"), (9, 1, "A")], "contig int, pos long, base string")
    for chunk in (1, 4, 1000):
        assert {r.contig: r.seq for r in patch_sequences(contigs, changes, chunk=chunk).collect()} == {1: "TCGACCGTAG", 2: "", 3: "GGG"}
