"""The profiling core against a hand-derived table and a plain Python model."""

import random
from collections import defaultdict

import pytest

from abundara.operators import profile as P

HITS = "sample string, insert_id long, mate int, gene string, brand string, cov double, length double"


def model(hits, level):
    """Per (feature, kind): raw, norm, unique raw, unique norm, mm raw, mm norm; written from the definitions, record by record."""
    inserts = defaultdict(list)
    length, taxon = {}, {}
    for _, ins, mate, gene, brand, cov, size in hits:
        inserts[ins].append((mate, gene, cov))
        length[gene], taxon[gene] = size, {"gene": gene, "brand": brand}

    def allowed(values, of):
        sets = {t: {of(g) for g in v} for t, v in values.items()}
        common = sets.get("base.1", set()) & sets.get("base.2", set())
        agreed = bool(common)
        return {t: {g: x for g, x in v.items() if not agreed or of(g) in common} for t, v in values.items()}, agreed

    def shares(at):
        out = []
        for ins, rows in inserts.items():
            values = defaultdict(dict)
            for mate, gene, cov in rows:
                values[f"base.{mate}"][gene] = max(cov, values[f"base.{mate}"].get(gene, 0))
                values["insert"][gene] = 1.0
            genes, _ = allowed(values, lambda g: g)
            kept, agreed = allowed(values, lambda g: taxon[g][at])
            for t, v in kept.items():
                n = len(v) if at == "gene" or agreed else len(genes[t])
                out.append((ins, t, {g: x / n for g, x in v.items()}))
        return out

    def totals(rows, at):
        raw, norm, uraw, unorm = (defaultdict(float) for _ in range(4))
        for _, t, v in rows:
            kind = "insert" if t == "insert" else "base"
            alone = len({taxon[g][at] for g in v}) == 1
            for g, x in v.items():
                key = taxon[g][at], kind
                raw[key] += x
                norm[key] += x / length[g]
                if alone:
                    uraw[key] += x
                    unorm[key] += x / length[g]
        return raw, norm, uraw, unorm

    gene_rows = {(i, t): v for i, t, v in shares("gene")}
    gene_raw, _, gene_unique, _ = totals([(i, t, v) for (i, t), v in gene_rows.items()], "gene")
    rows = shares(level)
    raw, norm, uraw, unorm = totals(rows, level)
    mraw, mnorm = defaultdict(float, uraw), defaultdict(float, unorm)
    for ins, t, v in rows:
        kind = "insert" if t == "insert" else "base"
        if len({taxon[g][level] for g in v}) < 2:
            continue
        whole = sum(v.values())
        genes = list(v)
        if level != "gene":
            targets = gene_rows[ins, t]
            if any(gene_unique[g, kind] > 0 for g in targets):
                genes = [g for g in genes if g in targets and gene_unique[g, kind] > 0]
            else:
                genes = [g for g in genes if g in targets]
        if any(uraw[taxon[g][level], kind] > 0 for g in genes):
            genes = [g for g in genes if uraw[taxon[g][level], kind] > 0]
            u, un = uraw, unorm
        else:
            u, un = raw, norm
        taxa = {taxon[g][level] for g in genes}
        per = {x: sum(taxon[g][level] == x for g in genes) for x in taxa}
        for g in genes:
            x = taxon[g][level]
            mraw[x, kind] += u[x, kind] / sum(u[y, kind] for y in taxa) * whole / per[x]
            if level == "gene":
                mnorm[x, kind] += (u[x, kind] / length[g]) / sum(u[y, kind] / length[y] for y in taxa) * whole / length[g]
            else:
                mnorm[x, kind] += un[x, kind] / sum(un[y, kind] for y in taxa) / per[x] * whole / length[g]
    return {k: (raw[k], norm[k], uraw[k], unorm[k], mraw[k], mnorm[k]) for k in raw}


def run(spark, hits, taxon=None):
    rows = P.profile(spark.createDataFrame(hits, HITS), taxon).collect()
    return {(r.feature, r.kind): (r.raw, r.norm, r.unique_raw, r.unique_norm, r.mm_raw, r.mm_norm) for r in rows}, {(r.feature, r.kind): r for r in rows}


VECTOR = [("s", 1, 1, "g1", "x", 50.0, 100.0), ("s", 1, 2, "g1", "x", 50.0, 100.0), ("s", 2, 1, "g1", "x", 60.0, 100.0), ("s", 2, 1, "g2", "x", 60.0, 200.0),
          ("s", 3, 1, "g2", "x", 80.0, 200.0), ("s", 3, 2, "g1", "x", 40.0, 100.0)]


def test_worked_vector(spark):
    _, rows = run(spark, VECTOR)
    g1, g2, i1, i2 = (rows[k] for k in (("g1", "base"), ("g2", "base"), ("g1", "insert"), ("g2", "insert")))
    assert (g1.raw, g2.raw, g1.unique_raw, g2.unique_raw) == (170, 110, 140, 80)
    assert (g1.mm_raw, g2.mm_raw) == pytest.approx((178.181818, 101.818182))
    assert (g1.norm, g2.norm, g1.mm_norm, g2.mm_norm) == pytest.approx((1.7, 0.55, 1.866667, 0.466667), abs=1e-6)
    assert (g1.scaled, g2.scaled, g1.mm_scaled, g2.mm_scaled) == pytest.approx((211.555556, 68.444444, 224, 56))
    assert (i1.raw, i2.raw, i1.unique_raw, i2.unique_raw, i1.mm_raw, i2.mm_raw) == (2, 1, 1, 0, 3, 0)
    assert (i1.mm_norm, i2.mm_norm) == pytest.approx((0.03, 0))
    totals = spark.createDataFrame([("s", "base", 400.0), ("s", "insert", 5.0)], "sample string, kind string, total double")
    left = P.unmapped(P.counts(P.shares(spark.createDataFrame(VECTOR, HITS))), totals).collect()
    assert {r.kind: r.raw for r in left} == {"base": 120, "insert": 2}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("level", ["gene", "brand"])
def test_against_model(spark, seed, level):
    rnd = random.Random(seed)
    genes = {f"g{n}": (f"b{n % 4}", float(rnd.randrange(50, 300))) for n in range(12)}
    hits = []
    for ins in range(120):
        for mate in rnd.choice([(1,), (2,), (1, 2), (1, 2)]):
            for gene in rnd.sample(sorted(genes), rnd.choice([1, 1, 2, 3])):
                brand, size = genes[gene]
                hits.append(("s", ins, mate, gene, brand, float(rnd.randrange(20, 90)), size))
    got, _ = run(spark, hits, None if level == "gene" else "brand")
    want = model(hits, level)
    assert got.keys() == want.keys()
    for key, values in want.items():
        assert got[key] == pytest.approx(values, abs=1e-9), key


def test_functional_rollup(spark):
    genes = spark.createDataFrame([("a", 2.0, 10), ("b", 3.0, 20), ("c", 5.0, 30)], "gene string, value double, length long")
    cells = spark.createDataFrame([("a", "ko", "K1,K2"), ("b", "ko", "K1|NA"), ("z", "ko", "K9")], "gene string, level string, cell string")
    got = {r.category: (r.value, r.length) for r in P.functional(genes, cells, "value").collect()}
    assert got == {"K1": (5, 30), "K2": (2, 10), "unassigned": (5, 30), "mapped": (10, 60)}
