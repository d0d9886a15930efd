import bz2
import gzip

import pytest

from abundara.sources import readers as R
from abundara.sources import writers as W


def put(path, text, packer=None):
    path.write_bytes(packer(text.encode()) if packer else text.encode())
    return str(path)


FASTQ = "".join(f"@r{n} x\n{'ACGT' * (n + 1)}\n+\n{'IIII' * (n + 1)}\n" for n in range(5))


def test_fastq(spark, tmp_path):
    for name, packer in (("a.fq", None), ("a.fq.gz", gzip.compress), ("a.fq.bz2", bz2.compress)):
        rows = R.read_fastq(spark, put(tmp_path / name, FASTQ, packer)).orderBy("header").collect()
        assert [(r.header, r.seq, r.qual) for r in rows] == [(f"r{n} x", "ACGT" * (n + 1), "IIII" * (n + 1)) for n in range(5)]
    with pytest.raises(Exception, match="differ in length"):
        R.read_fastq(spark, put(tmp_path / "bad.fq", "@r\nACG\n+\nII\n")).collect()


def test_fasta_and_writers(spark, tmp_path):
    rows = R.read_fasta(spark, put(tmp_path / "a.fa", ">g1 some gene\nACGT\nAC\n>g2\nTT\n"))
    assert [tuple(r) for r in rows.orderBy("seq_id").collect()] == [("g1", "some gene", "ACGTAC"), ("g2", "", "TT")]
    W.write_fasta(rows, str(tmp_path / "out.fa"), width=4)
    back = R.read_fasta(spark, str(tmp_path / "out.fa"))
    assert sorted((r.seq_id, r.seq) for r in back.collect()) == [("g1", "ACGTAC"), ("g2", "TT")]


def test_alignments(spark, tmp_path):
    sam = "@SQ\tSN:g\nr1\t16\tg1\t5\t255\t10M\t*\t0\t0\tACGT\tIIII\tAS:i:971\tNM:i:3\n"
    row = R.read_sam(spark, put(tmp_path / "a.sam", sam)).first()
    assert (row.read_id, row.flag, row.pos, row.tags) == ("r1", 16, 5, {"AS": "971", "NM": "3"})
    soap = "r1/1\t" + "A" * 50 + "\t" + "I" * 50 + "\t1\ta\t50\t-\tg1\t7\t0\t50M\t12A37\nr2/1\tAA\tII\t1\ta\t2\t+\tg1\t7\t0\t2M\t2\n"
    rows = W.soap_to_sam(R.read_soap(spark, put(tmp_path / "a.soap", soap)))
    assert [(r.read_id, r.flag, r.tags["AS"], r.tags["NM"]) for r in rows.collect()] == [("r1/1", 16, "980", "1")]
    W.write_sam(rows, str(tmp_path / "out.sam"))
    assert R.read_sam(spark, str(tmp_path / "out.sam")).first().tags == {"AS": "980", "NM": "1"}


def test_dimensions(spark, tmp_path):
    coord = R.read_coordinates(spark, put(tmp_path / "a.coord", "g1\t1\t9\ng1\t20\t30\ng2\t4\t8\n")).orderBy("ref", "idx").collect()
    assert [tuple(r) for r in coord] == [("g1", 0, 1, 9), ("g1", 1, 20, 30), ("g2", 0, 4, 8)]
    cells = R.read_functional_map(spark, put(tmp_path / "f.map", "#gene\tko\tmodule\ng1\tK1,K2\tNA\ng2\t\tM1|M2\n"))
    assert {(r.gene, r.level, r.cell) for r in cells.collect()} == {("g1", "ko", "K1,K2"), ("g1", "module", "NA"), ("g2", "ko", ""), ("g2", "module", "M1|M2")}
    with pytest.raises(Exception, match="ten fields"):
        R.read_taxonomy(spark, put(tmp_path / "t.map", "1\t2\n")).collect()
    gff = R.read_gff(spark, put(tmp_path / "a.gff", '##x\nc\ts\tCDS\t3\t9\t.\t+\t0\tgene_id "a b"; ID=x1\n')).first()
    assert (gff.start, gff.attributes) == (3, {"gene_id": "a b", "ID": "x1"})
    gene = R.read_gene_headers(spark, put(tmp_path / "g.faa", ">c_1 # 3 # 11 # -1 # ID=1;partial=00;start_type=ATG\nM\n")).first()
    assert (gene.gene, gene.strand, gene.length, gene.start_codon, gene.gene_type) == ("c_1", "-", 9, "ATG", "complete")
    hits = R.read_hits(spark, put(tmp_path / "h.tab", "#c\nq\ts\t99\t10\t0\t0\t1\t10\t5\t14\t1e-5\t50\n")).first()
    assert (hits["query"], hits.subject, hits.qe, hits.bits) == ("q", "s", 10, 50.0)
    stats = R.read_stats(spark, put(tmp_path / "s.stats", "Reads\tBases\n1617\t113116\t98\t69.9542362399505\t45\t1617\t95\t40\tNA\n")).first()
    assert stats.bases / stats.reads == pytest.approx(stats.avg, rel=1e-14)


def test_matrices(spark, tmp_path):
    m = R.read_matrix(spark, put(tmp_path / "m.tab", "#note\nfeature\ta\tb\nx\t1\tNA\ny\t2\t3.5\n"))
    assert {(r.feature, r.sample, r.value) for r in m.collect()} == {("x", "a", 1.0), ("x", "b", None), ("y", "a", 2.0), ("y", "b", 3.5)}
    d = R.read_lower_triangle(spark, put(tmp_path / "d.phy", "3\na\nb 1\nc 2 3\n"))
    assert {(r.a, r.b): r.value for r in d.collect()} == {("a", "a"): 0, ("b", "b"): 0, ("c", "c"): 0, ("a", "b"): 1, ("b", "a"): 1, ("a", "c"): 2, ("c", "a"): 2, ("b", "c"): 3, ("c", "b"): 3}
    W.write_cells(m.fillna(0.0), str(tmp_path / "cells"))
    assert R.read_cells(spark, str(tmp_path / "cells")).count() == 3
    W.write_matrix(m.fillna(0.0), ["a", "b"], str(tmp_path / "wide"))
    assert "3.50000000" in "".join(r.value for r in spark.read.text(str(tmp_path / "wide")).collect())
