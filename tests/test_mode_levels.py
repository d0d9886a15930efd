"""Features of a mode's levels: those of its whole profiles, without the profiles' passes."""

import random

import pytest

from abundara import modules
from abundara.operators import profile as P
from abundara.plans import registry

HITS = "sample string, insert_id long, mate int, gene string, cov double, length double"
SF = "/root/testdata/sf0.001"


def _hits(spark, seed):
    """Few hits of rare genes, so that the mates' agreement takes some genes and taxa away altogether; nulls and third mates too."""
    rnd, rows = random.Random(seed), []
    for insert in range(40):
        for mate in (1, 2):
            rows += [("s1", insert, mate, str(g), 5.0, 10.0) for g in {insert % 9, *rnd.sample(range(100 * insert, 100 * insert + 4), 2)}]
    rows += [("s1", None, 1, "9001", 1.0, 10.0), ("s1", None, 2, "9002", 1.0, 10.0), (None, 3, 1, "9003", 1.0, 10.0)]
    rows += [("s2", 1, 3, "9004", 1.0, 10.0), ("s2", 1, 1, "9005", 1.0, 10.0), ("s2", 1, 2, "9005", 1.0, 10.0), ("s2", 2, None, "9006", 1.0, 10.0)]
    return spark.createDataFrame(rows, HITS)


@pytest.mark.parametrize("seed", [1, 2])
def test_features_are_the_profiles(spark, seed):
    hits = _hits(spark, seed)
    keys = sorted({r.gene for r in hits.select("gene").distinct().collect()})
    taxonomy = spark.createDataFrame([(k, None if k == "9006" else f"p{int(k) % 7 + int(k) // 100}", f"q{int(k) % 3}") for k in keys if k != "3"], "taxaid string, species string, genus string")
    want = {(r.level, r.feature) for r in modules.profiles(hits, "NCBI", {"taxonomy": taxonomy}).select("level", "feature").distinct().collect()}
    got = [(r.level, r.feature) for r in modules.features(hits, "NCBI", {"taxonomy": taxonomy}).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert len({f for level, f in got if level == "gene"}) < len(keys)  # some are allowed nowhere


def test_mode_levels_makes_no_profile(spark, monkeypatch):
    """Whole profiles of four levels, for their names alone, did not end at 60 x sf0.1."""

    def refuse(*_):
        raise AssertionError("a step was written")

    monkeypatch.setattr(P, "kept", refuse)
    rows = registry.queries()["mode_levels"](spark, SF).collect()
    assert {r.level for r in rows} == {"gene", "species", "genus", "taxaid"} and all(r.features for r in rows)
