"""Approximate nearest neighbours: an adaptive dimension scan within probed lists.

Unit vectors are rotated by a fixed random rotation and dealt to lists by their nearest
centroid (spherical k-means on a bounded sample; every vector is indexed).  A query probes
its nearest lists, as many as hold 97 % of true neighbours in that sample.  Within a list it adds up squared distances column block by column
block; after each block a hypothesis test on the partial distance abandons candidates that
are unlikely to beat the nearest found so far.  Survivors are scored exactly on the
original vectors.

Equal vectors are indexed once, with their smallest ids.  Lists longer than ``block`` are
cut into blocks and their queries into groups, so no task holds a whole hot list; each
block returns its few best for each query and a grouped top-k joins them.

Defined results: null, zero and non-finite vectors (also with a null component) and rows
with a null id take no part; vectors are compared with those of their own length; repeated
rows are candidates each, but no row of the query's own id is one of its candidates; rows
repeated with one id and vector ask once, an id with several vectors has ranks from 1 for
each; fewer candidates than ``k`` are all returned; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from abundara.llm.common import cut


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, count: int, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """Spherical k-means of unit vectors."""
    rng = np.random.default_rng(seed)
    found = sample[rng.choice(len(sample), min(count, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        own = np.concatenate([(sample[k : k + 4096] @ found.T).argmax(1) for k in range(0, len(sample), 4096)])
        total = np.zeros_like(found)
        np.add.at(total, own, sample)
        size = np.linalg.norm(total, axis=1)
        found = np.where(size[:, None] > 1e-12, total / np.maximum(size, 1e-12)[:, None], found)
    return found


def probes_needed(unit: np.ndarray, middle: np.ndarray, k: int, aim: float, queries: int = 256) -> int:
    """How many lists hold the ``aim`` share of true neighbours, measured within the sample."""
    own = np.concatenate([(unit[a : a + 4096] @ middle.T).argmax(1) for a in range(0, len(unit), 4096)])
    ranks = []
    for a in range(min(queries, len(unit))):
        near = unit @ unit[a]
        near[a] = -2
        top = np.argpartition(-near, min(k, len(near) - 1))[:k]
        order = np.argsort(-(middle @ unit[a]), kind="stable")
        place = np.empty(len(middle), np.int64)
        place[order] = np.arange(1, len(middle) + 1)
        ranks += place[own[top]].tolist()
    return int(np.quantile(ranks, aim, method="higher")) if ranks else 1


def scan(queries: np.ndarray, rows: np.ndarray, k: int, columns: int, slack: float, start: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) that may be among a query's k nearest rows, but for the test's rare errors."""
    dim = queries.shape[1]
    first = rows[:start]
    dist = ((queries[:, None, :] - first[None, :, :]) ** 2).sum(2) if len(queries) * len(first) * dim < 1 << 22 else np.stack([((first - q) ** 2).sum(1) for q in queries])
    bound = np.partition(dist, k - 1, axis=1)[:, k - 1] if dist.shape[1] >= k else np.full(len(queries), np.inf)
    i, j = np.nonzero(dist <= bound[:, None])
    found = [(i, j, dist[i, j])]
    if len(rows) > start:
        # the first block for all pairs at once; later blocks only for pairs not yet abandoned
        rest = rows[start:]
        x, q = rest[:, :columns], queries[:, :columns]
        part = (q * q).sum(1)[:, None] + (x * x).sum(1)[None, :] - 2 * (q @ x.T)
        seen = min(columns, dim)
        for a in range(seen, dim + columns, columns):
            limit = bound * (1 + slack / np.sqrt(seen)) ** 2 * (seen / dim) if seen < dim else bound
            if a == seen == min(columns, dim):
                i, j = np.nonzero(part <= limit[:, None] + 1e-9)
                part = part[i, j]
            else:
                stay = part <= limit[i] + 1e-9
                i, j, part = i[stay], j[stay], part[stay]
            if a >= dim:
                break
            step = np.empty(len(i))
            for c in range(0, len(i), 1 << 18):
                s = slice(c, c + (1 << 18))
                step[s] = ((queries[i[s], a : a + columns] - rest[j[s], a : a + columns]) ** 2).sum(1)
            part = part + step
            seen = min(dim, a + columns)
        found.append((i, j + start, part))
    i, j, part = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((part, i))
    i, j, part = i[order], j[order], part[order]
    nth = np.arange(len(i)) - np.searchsorted(i, i)
    last = np.full(len(queries), np.inf)
    at = nth == k - 1
    last[i[at]] = part[at]
    stay = part <= last[i] + 1e-9
    return i[stay], j[stay]


def nearest(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", max_dims: int = 64, **options) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest by cosine of each row whose id is divisible by ``every``, see ``nearest_of``.

    Vectors of different lengths have no cosine: each length is searched by itself.  More than
    ``max_dims`` lengths in one table are an error, not a loss.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where("vec_id is not null and v is not null")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.coalesce(finite, F.lit(False)) & (F.size("v") > 0)).withColumn("norm", F.sqrt(norm)).where("norm > 0 and norm < double('Infinity')")
    rows = cut(rows)
    sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy("dim").limit(max_dims + 1).collect()
    if len(sizes) > max_dims:
        raise ValueError(f"more than {max_dims} vector lengths in one table")
    found = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for number, (dim, total) in enumerate(sizes):
        one = nearest_of(rows.where(F.size("v") == dim), dim, total, **options)
        found = found.unionByName(one) if number else one
    return found


def nearest_of(rows: DataFrame, dim: int, total: int, *, every: int = 50, k: int = 5, lists: int | None = None, aim: float = 0.97, probes: int | None = None, sample: int | None = None, columns: int = 16, slack: float = 2.1, block: int = 2048) -> DataFrame:
    """The search among ``total`` vectors of one length (vec_id, v, norm).

    There are about the root of ``total`` lists, so a list and a query's work grow with the root
    too.  Lists are fitted on ``sample`` vectors: 16 a list, at least 20,000, at most 64 MB of
    them; beyond that bound (a million lists at 16 components, 20,000 at 768) lists are longer.
    """
    spark = rows.sparkSession
    wanted = lists or int(np.sqrt(total)) + 1
    sample = sample or min(max(20_000, 16 * wanted), max(20_000, (64 << 20) // (4 * dim)))
    lot = rows.select("v", "norm", F.xxhash64("vec_id").alias("lot")).orderBy("lot").limit(sample)
    lot = lot.select(F.transform("v", lambda x: (x / F.col("norm")).cast("float")).alias("unit")).toArrow()
    turn = rotation(dim)
    unit = lot.column("unit").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) @ turn.astype(np.float32)
    middle = centroids(unit, min(wanted, max(1, len(unit) // 8)))
    probes = probes or probes_needed(unit, middle, k, aim)
    del lot, unit

    def unit_rows(batch):
        v = batch.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        return (v / batch.column("norm").to_numpy()[:, None]) @ turn

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                own = np.concatenate([(x @ middle.T).argmax(1) for x in np.array_split(unit_rows(pa.Table.from_batches([batch])), batch.num_rows // 2048 + 1)])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))], [*batch.schema.names, "list"])

    # equal vectors: the k + 1 smallest ids, each with up to k of its rows, stand for all
    per_id = rows.groupBy("v", "vec_id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("n"), F.max("norm").alias("norm"))
    firsts = per_id.withColumn("nth", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("nth") <= k + 1)
    kinds = firsts.groupBy("v").agg(F.sort_array(F.flatten(F.collect_list(F.array_repeat("vec_id", F.col("n"))))).alias("ids"), F.max("norm").alias("norm"))
    indexed = cut(kinds.mapInArrow(assign, "v array<double>, ids array<long>, norm double, list int"))
    counts = {r["list"]: r["count"] for r in indexed.groupBy("list").count().collect()}  # at most 65,536 rows
    held = np.array([counts.get(c, 0) for c in range(len(middle))])
    blocks = np.maximum(1, -(-held // block))

    def probe(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v = unit_rows(pa.Table.from_batches([batch]))
            row, where = [], []
            for a in range(0, len(v), 1024):
                order = np.argsort(-(v[a : a + 1024] @ middle.T), axis=1, kind="stable")
                enough = (np.cumsum(held[order], axis=1) > 8 * (k + 1)).argmax(1)
                enough = np.where(np.cumsum(held[order], axis=1)[:, -1] > 8 * (k + 1), enough + 1, len(middle))
                for q, (o, n) in enumerate(zip(order, np.maximum(enough, probes), strict=True)):
                    chosen = o[:n][held[o[:n]] > 0]
                    row.append(np.full(len(chosen), a + q))
                    where.append(chosen)
            take = pa.array(np.concatenate(row))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), batch.column(2).take(take), pa.array(np.concatenate(where).astype(np.int32))], ["query_id", "v", "norm", "list"])

    # rows of one id and one vector ask once; one id with several vectors asks once for each
    asked = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"]).select(F.col("vec_id").alias("query_id"), "v", "norm")
    asked = cut(asked.mapInArrow(probe, "query_id long, v array<double>, norm double, list int"))
    per_list = {r["list"]: r["count"] for r in asked.groupBy("list").count().collect()}
    groups = np.maximum(1, -(-np.array([per_list.get(c, 0) for c in range(len(middle))]) // block))
    spread = F.broadcast(spark.createDataFrame([(c, int(b), int(g)) for c, (b, g) in enumerate(zip(blocks, groups, strict=True))], "list int, blocks int, groups int"))
    left = indexed.join(spread, "list").select(
        "list", F.pmod(F.xxhash64("ids"), "blocks").alias("part"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("crowd"), "v", "ids", "norm")
    right = asked.join(spread, "list").select(
        "list", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).alias("part"), F.pmod(F.xxhash64("query_id"), "groups").cast("int").alias("crowd"), "query_id", F.xxhash64("v").alias("which"), "v", "norm")

    def compare(rows_: pd.DataFrame, asked_: pd.DataFrame) -> pd.DataFrame:
        out: tuple[list, list, list, list] = ([], [], [], [])
        if len(rows_) and len(asked_):
            x, q = np.stack(rows_["v"].to_numpy()), np.stack(asked_["v"].to_numpy())
            nx, nq = rows_["norm"].to_numpy(), asked_["norm"].to_numpy()
            tx, tq = (x / nx[:, None]) @ turn, (q / nq[:, None]) @ turn
            ids = rows_["ids"].to_numpy()
            pair_q, pair_x = scan(tq, tx, k + 1, columns, slack)
            edges = np.searchsorted(pair_q, np.arange(len(q) + 1))
            for n, (query, which) in enumerate(zip(asked_["query_id"].to_numpy(), asked_["which"].to_numpy(), strict=True)):
                some = pair_x[edges[n] : edges[n + 1]]
                score = (x[some] * q[n]).sum(1) / (nx[some] * nq[n])
                floor = np.sort(score)[-(k + 1)] if len(score) > k else -2.0
                best = [(-s, int(i)) for s, m in zip(score, some, strict=True) if s >= floor for i in ids[m] if i != query]
                for s, i in sorted(best)[:k]:
                    out[0].append(query)
                    out[1].append(i)
                    out[2].append(-s)
                    out[3].append(which)
        return pd.DataFrame({"query_id": np.array(out[0], np.int64), "vec_id": np.array(out[1], np.int64), "score": np.array(out[2], np.float64), "which": np.array(out[3], np.int64)})

    key = ["list", "part", "crowd"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(compare, "query_id long, vec_id long, score double, which long")
    order = Window.partitionBy("query_id", "which").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
