import math
import random

from abundara.llm.vectors import nearest

TABLE = "vec_id long, embedding array<float>, label int, list string"


def brute(rows, every, k=5):
    good = [r for r in rows if r[0] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    out = {}
    for i, q in enumerate(good):
        if q[0] % every == 0:
            scored = []
            for j, r in enumerate(good):
                if r[0] != q[0]:
                    dot = sum(a * b for a, b in zip(q[1], r[1]))
                    scored.append((-dot / math.sqrt(sum(a * a for a in q[1]) * sum(b * b for b in r[1])), r[0]))
            out[q[0]] = sorted(scored)[:k]
    return out


def make(seed, n, dim=16):
    rnd = random.Random(seed)
    middles = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(8)]
    return [(i, [x + rnd.gauss(0, 0.4) for x in rnd.choice(middles)], 0, "a") for i in range(n)]


def test_recall_and_scores(spark):
    import numpy as np

    rows = [(i, [float(np.float32(x)) for x in v], a, b) for i, v, a, b in make(1, 1500)]
    rows += [(5000 + i, rows[100][1], 0, None) for i in range(20)]
    rows += [(7000, None, 1, ""), (7001, [0.0] * 16, 1, ""), (7002, [float("nan")] * 16, 1, ""), (7003, [None] + [1.0] * 15, 1, ""), (None, [1.0] * 16, 1, "")]
    want = brute(rows, 20)
    for block in (4096, 64):
        got = {}
        for r in nearest(spark.createDataFrame(rows, TABLE), every=20, block=block).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert got.keys() == want.keys()
        hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
        assert hits >= 0.95 * sum(map(len, want.values()))
        # ties at the smaller ids, the query's own row left out
        assert [i for _, i in got[100]] == [5000, 5001, 5002, 5003, 5004]


def test_few_and_none(spark):
    rows = [(0, [1.0, 0.0], 0, ""), (1, [1.0, 1.0], 0, ""), (2, [0.0, 1.0], 0, "")]
    got = nearest(spark.createDataFrame(rows, TABLE), every=50).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, 1, 1), (0, 2, 2)]
    assert nearest(spark.createDataFrame([], TABLE)).count() == 0


def test_repeated_queries_and_lengths(spark):
    rows = make(2, 300)
    extra = [(50, rows[50][1], 0, ""), (110, rows[110][1], 0, "")] * 7 + [(100, rows[7][1], 0, "")]
    rows += extra + [(1000, [1.0, 2.0], 0, ""), (1001, [2.0, 1.0], 0, ""), (1003, [1.0, 2.1], 0, ""), (1050, [1.0], 0, "")]
    got = {}
    for r in nearest(spark.createDataFrame(rows, TABLE), every=50, probes=1000).orderBy("query_id", "rank", "vec_id").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    one = {}
    for r in nearest(spark.createDataFrame([r for r in rows if len(r[1]) == 16][:300], TABLE), every=50, probes=1000).collect():
        one.setdefault(r.query_id, []).append(r.vec_id)
    assert [n for n, _ in got[50]] == [1, 2, 3, 4, 5] and 50 not in [i for _, i in got[50]]
    assert len(got[100]) == 10  # one id asking with two vectors
    assert got[1000] == [(1, 1003), (2, 1001)] and 1050 not in got
    near = brute([r for r in rows if len(r[1]) == 16], 50)
    assert [i for _, i in got[50]] == [i for _, i in near[50]] and [i for _, i in got[0]] == [i for _, i in near[0]]


def test_equal_vectors_of_one_id(spark):
    rows = [(50, [1.0, 0.5], 0, "")] * 9 + [(60 + i, [1.0, 0.5], 0, "") for i in range(8)]
    got = nearest(spark.createDataFrame(rows, TABLE), every=50).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [60, 61, 62, 63, 64]
    got = nearest(spark.createDataFrame([*rows, (0, [1.0, 0.5], 0, "")], TABLE), every=100).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [50] * 5
