"""Findings of round 3: intervals of a whole brand."""

from abundara.plans.registry import oracle_sql, queries

PARTS = [(1, "b", "s", 5), (2, "b", "t", 40), (3, "b", "t", 5), (4, "c", "s", 5), (5, None, "t", 5), (6, "b", None, 12), (7, "c", "u", 30)]
LINES = [(1, 1, 1, 3.0), (1, 2, 2, 30.0), (2, 1, 4, 9.0), (2, 2, 5, 20.0), (3, 1, 6, 2.0), (3, 5, 1, 8.0)]  # order, line number, part, quantity


def test_intervals_of_other_types_meet(spark, tmp_path):
    """Rows meet every interval of their brand, whatever its type; parts without a brand meet none."""
    spark.createDataFrame(PARTS, "p_partkey long, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame(LINES, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    brand, want = {k: b for k, b, _, _ in PARTS}, {}
    for b in "bc":
        for idx, size in enumerate(s for _, o, _, s in PARTS if o == b):
            met = [min(7 * n + q, size + 10) - max(7 * n, size) + 1 for _, n, k, q in LINES if brand[k] == b and 7 * n <= size + 10 and 7 * n + q >= size]
            if met:
                want[b, idx] = (len(met), sum(met))
    got = {(r.ref, r.idx): (r.n, r.covered) for r in queries()["interval_join"](spark, str(tmp_path)).collect()}
    assert got == want and want["b", 1][0] == 2 and want["b", 2][0] == 3
    assert "p_type" not in oracle_sql()["interval_join"]
