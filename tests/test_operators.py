"""Small fixtures for scalar functions, filters, rankings, statistics, trees, sampling and streaming."""

import math
import random

import pytest
from pyspark.sql import functions as F

from abundara.functions import reads as R
from abundara.operators import aggregates as A
from abundara.operators import clustering, filters, joins, ranking, sampling, stats, tree
from abundara.operators import matrix as M


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("cigar,want", [("90M", (90, 90, 100, 189)), ("5S90M", (90, 95, 105, 194)), ("10M2I88M", (100, 100, 100, 199)), ("3I4M", (4, 7, 103, 106)), ("5H10M5S", (10, 20, 105, 114)), ("10M3D5M", (15, 15, 100, 114))])
def test_cigar(spark, cigar, want):
    assert tuple(value(spark, R.cigar_project(F.lit(cigar), F.lit(100).cast("long")))) == want


def test_cigar_rejects_other_operations(spark):
    with pytest.raises(Exception, match="unsupported CIGAR"):
        value(spark, R.cigar_project(F.lit("5M3N5M"), F.lit(1).cast("long")))


def test_trimming(spark):
    qual, seq = "IIII!II#!!", "ACGTACGTAC"
    cut = value(spark, R.trim_tail(F.lit(qual), F.lit(seq), offset=33, least_quality=20, least_length=3, least_percent=50))
    assert (cut.seq, cut.qual) == ("ACGTACG", "IIII!II")
    assert value(spark, R.trim_tail(F.lit(qual), F.lit(seq), offset=33, least_quality=20, least_length=8, least_percent=50)) is None
    run = value(spark, R.trim_longest(F.lit(qual), F.lit(seq), offset=33, least_quality=20, least_length=3))
    assert (run.seq, run.qual) == ("ACGT", "IIII")


def test_scalars(spark):
    assert value(spark, R.kmer_size(F.lit(900), F.lit(10))) == 47
    assert value(spark, R.reverse_complement(F.lit("AACg"))) == "cGTT"
    assert value(spark, R.wrap(F.lit("ACGTACG"), 3)) == "ACG\nTAC\nG"
    assert [tuple(s) for s in value(spark, R.scaftigs(F.lit("s"), F.lit("ACNNACGTNNNACG"), 3))] == [("s_1", "ACGT"), ("s_2", "ACG")]
    assert value(spark, R.translate_codons(F.lit("ATGTAA"))) == "M*"
    assert value(spark, R.tags(F.array(F.lit("AS:i:97"), F.lit("XX:Z:a:b")))) == {"AS": "97", "XX": "a:b"}
    assert R.synonymous_sites("GGG") == 1.0
    with pytest.raises(Exception, match="not a mate id"):
        value(spark, R.split_read_id(F.lit("r1"))[0])


def test_pairs_and_best_hits(spark):
    rows = spark.createDataFrame([(1, 1, "a", 5), (1, 2, "a", 7), (1, 2, "b", 7), (2, 1, "a", 1), (2, 2, "b", 1)], "i int, mate int, ref string, score int")
    assert sorted((r.i, r.ref) for r in filters.mates_agree(rows, ["i"], "mate", "ref").collect()) == [(1, "a"), (1, "a"), (2, "a"), (2, "b")]
    assert filters.best_hits(rows, ["i"], "score").count() == 4
    assert ranking.single_best(rows, ["i"], "score", ["ref", "mate"]).orderBy("i").collect()[0].ref == "a"
    regions = spark.createDataFrame([("a", 1, 5), ("a", 4, 9)], "ref string, start int, stop int")
    hit = spark.createDataFrame([("r", "a", 4, 4)], "read string, ref string, f int, l int")
    assert filters.in_regions(hit, regions, "ref", "f", "l").count() == 2
    assert filters.in_regions(hit, regions, "ref", "f", "l", once=True).count() == 1


def test_clashes(spark):
    rows = spark.createDataFrame([("g", "o", 1, 100, 90.0), ("g", "o", 20, 140, 80.0), ("g", "p", 1, 100, 70.0), ("g", "o", 200, 250, 60.0)], "gene string, grp string, start long, stop long, score double")
    got = sorted((r.grp, r.start) for r in ranking.resolve_clashes(rows).collect())
    assert got == [("o", 20), ("o", 200), ("p", 1)]


def test_binned_interval_join_agrees(spark):
    rnd = random.Random(3)
    a = spark.createDataFrame([(n, "r", s := rnd.randrange(500), s + rnd.randrange(60)) for n in range(80)], "n int, ref string, first_base int, last_base int")
    b = spark.createDataFrame([("r", n, s := rnd.randrange(500), s + rnd.randrange(90)) for n in range(60)], "ref string, idx int, start int, stop int")
    plain, binned = (sorted(map(tuple, joins.interval_join(a, b, width=w).select("n", "idx", "covered").collect())) for w in (None, 32))
    assert plain == binned and plain


def test_rank_tests(spark):
    rows = [("f", "a", x) for x in (1.0, 2.0, 4.0)] + [("f", "b", x) for x in (3.0, 5.0, 6.0, 7.0)]
    r = stats.rank_sums(spark.createDataFrame(rows, "feature string, g string, v double"), "feature", "g", "v", "a", "b").first()
    assert (r.rank_sum, r.u, r.auc) == (7, 1, 1 / 12)
    assert stats.exact_rank_p(1, 3, 4) == pytest.approx(4 / 35)
    p = spark.createDataFrame([(n, x) for n, x in enumerate([0.01, 0.04, 0.03, None])], "n int, p double")
    assert {r.n: round(r.q, 6) for r in stats.adjust(p, "p", "bh", ["n"]).collect()} == {0: 0.03, 1: 0.04, 2: 0.04}


def test_intervals(spark):
    spans = spark.createDataFrame([("k", 5, 9), ("k", 8, 12), ("k", 20, 22), ("k", 13, 14)], "k string, a long, b long")
    assert [(r.start, r.stop) for r in A.merged_intervals(spans, ["k"], "a", "b").orderBy("start").collect()] == [(5, 14), (20, 22)]
    lengths = spark.createDataFrame([("k", 30)], "k string, length long")
    assert [(r.gap_start, r.gap_stop) for r in A.gaps(spans, lengths, "k", "a", "b", margin=2).orderBy("gap_start").collect()] == [(3, 4), (15, 19), (23, 28)]


def test_tree(spark):
    nodes = spark.createDataFrame([("r", None), ("a", "r"), ("b", "r"), ("x", "a"), ("y", "a"), ("z", "x")], "id string, parent string")
    closure = tree.lineages(nodes, 8)
    assert closure.count() == 1 + 2 + 2 + 3 + 3 + 4
    pairs = spark.createDataFrame([("z", "y"), ("z", "b"), ("z", "x")], "a string, b string")
    assert {(r.a, r.b): r.lca for r in tree.common_ancestors(closure, pairs).collect()} == {("z", "y"): "a", ("z", "b"): "r", ("z", "x"): "x"}
    assert tree.newick([("r", None, "root"), ("a", "r", "one"), ("b", "r", "two b")], "r") == "(one,two_b)root;"


def test_sampling(spark):
    m = spark.createDataFrame([("s", f"f{n}", float(n)) for n in range(1, 30)] + [("t", "f1", 3.0)], "sample string, feature string, value double")
    got = {r["sample"]: r.v for r in sampling.rarefy(m, 50).groupBy("sample").agg(F.sum("value").alias("v")).collect()}
    assert got == {"s": 50, "t": 3}
    assert sampling.rarefy(m, 50).exceptAll(m).join(m.withColumnRenamed("value", "most"), ["sample", "feature"]).where("value > most").count() == 0
    draws = sampling.bootstrap(m, 40, 2).groupBy("sample", "replicate").agg(F.sum("value").alias("v")).collect()
    assert {r.v for r in draws} == {40} and len(draws) == 4
    half = sampling.thin(m, 0.5).agg(F.sum("value").alias("v")).first().v
    assert 150 < half < 290


def test_diversity(spark):
    m = spark.createDataFrame([("a", "s", 1.0), ("b", "s", 1.0), ("c", "s", 2.0)], "feature string, sample string, value double")
    r = M.alpha_diversity(m).first()
    assert r.shannon == pytest.approx(1.5 * math.log(2)) and r.simpson == pytest.approx(0.625) and r.chao1 == pytest.approx(3 + 2 / 4)


def test_clustering():
    import numpy as np

    points = np.concatenate([np.random.default_rng(0).normal(c, 0.1, (6, 2)) for c in (0, 5, 10)])
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    groups, medoids = clustering.k_medoids(d, 3)
    assert len(set(map(tuple, np.split(groups, 3)))) == 3 and all(len(set(g)) == 1 for g in np.split(groups, 3))
    assert clustering.best_k(d, range(2, 6)) == 3
    axes, share = clustering.principal_coordinates(d, 2)
    again = np.sqrt(((axes[:, None] - axes[None]) ** 2).sum(2))
    assert np.allclose(again, d, atol=1e-6) and share.sum() == pytest.approx(1)
    merges = clustering.linkage(d, "average")
    assert len(merges) == len(d) - 1 and merges[-1][2] == max(m[2] for m in merges)


def test_streaming(spark, tmp_path):
    from abundara.streaming.profiles import append_profiles, running_counts

    rows = spark.createDataFrame([("g1", 1, 5.0), ("g1", 2, 6.0), ("g2", 2, 7.0)], "feature string, insert_id long, cov double")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = append_profiles(stream, running_counts, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.processAllAvailable()
    q.stop()
    got = {r.feature: (r.bases, r.rows) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"g1": (11, 2), "g2": (7, 1)}
