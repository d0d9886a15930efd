"""Ranking within groups: best hits, top-N with ties, clash resolution."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def single_best(hits: DataFrame, key: list[str], score: str, order: list[str]) -> DataFrame:
    """One hit a key, the first by ``order`` among the largest positive scores."""
    w = Window.partitionBy(*key).orderBy(F.desc(score), *order)
    return hits.where(F.col(score) > 0).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def top_subjects(hits: DataFrame, query: str, subject: str, score: str, n: int) -> DataFrame:
    """All hits of the subjects scoring at least as the n-th best subject of the query."""
    best = hits.groupBy(query, subject).agg(F.max(score).alias("_best"))
    ranked = best.withColumn("_r", F.rank().over(Window.partitionBy(query).orderBy(F.desc("_best")))).where(F.col("_r") <= n)
    return hits.join(ranked.drop("_r").withColumnRenamed("_best", "subject_best"), [query, subject])


def top_fraction(hits: DataFrame, query: str, subject: str, score: str, fraction: float) -> DataFrame:
    """All hits of subjects within a fraction of the query's best score."""
    rows = hits.withColumn("subject_best", F.max(score).over(Window.partitionBy(query, subject)))
    rows = rows.withColumn("query_best", F.max(score).over(Window.partitionBy(query)))
    return rows.where(F.col("subject_best") >= (1 - fraction) * F.col("query_best"))


def unambiguous_best(hits: DataFrame, key: str, group: str, score: str) -> DataFrame:
    """The best group of each key; a tie between different groups drops the key."""
    top = hits.withColumn("_m", F.max(score).over(Window.partitionBy(key))).where(F.col(score) == F.col("_m"))
    return top.groupBy(key).agg(F.min(group).alias(group), F.max(score).alias(score), F.count_distinct(group).alias("_n")).where("_n = 1").drop("_n")


def resolve_clashes(mappings: DataFrame, *, least_overlap: float = 0.5) -> DataFrame:
    """Per gene: mappings by falling score; one clashing with a kept mapping of its group leaves the longer of the two.

    Input columns gene, grp, start, stop, score.  Only mappings of one gene and group can
    clash, so rows come sorted by these and then in greedy order: a row alone in its group
    passes with its batch, the others are read one by one, and only what is kept of the
    group at hand is held.  Mappings without a start or stop clash with none.
    """

    def place(row, kept: list) -> None:
        start, stop = row[2], row[3]
        if start is not None and stop is not None:
            for k, (_, _, a, b, _) in enumerate(kept):
                if a is not None and b is not None and min(stop, b) - max(start, a) + 1 >= least_overlap * (min(stop - start, b - a) + 1):
                    if stop - start > b - a:
                        kept[k] = row
                    return
        kept.append(row)

    def same(column: pa.Array) -> np.ndarray:
        here, next_ = column.slice(0, len(column) - 1), column.slice(1)
        alike = pc.fill_null(pc.equal(here, next_), False)
        return pc.or_(alike, pc.and_(pc.is_null(here), pc.is_null(next_))).to_numpy(zero_copy_only=False)

    def run(batches):
        key, kept, schema = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            schema, out = batch.schema, []
            begins = np.ones(batch.num_rows + 1, bool)
            begins[1:-1] = ~(same(batch.column(0)) & same(batch.column(1)))
            alone = begins[:-1] & begins[1:]
            alone[0] = alone[-1] = False  # their groups may go on in another batch
            yield batch.filter(pa.array(alone))
            for row in zip(*(c.to_pylist() for c in batch.filter(pa.array(~alone)).columns), strict=True):
                if row[:2] != key:
                    out += dict.fromkeys(kept)
                    key, kept = row[:2], []
                place(row, kept)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
        if kept:
            out = dict.fromkeys(kept)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    types = {"gene": "string", "grp": "string", "start": "long", "stop": "long", "score": "double"}
    rows = mappings.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()]).repartition("gene", "grp")
    falling = F.when(~F.isnan("score"), F.col("score")).desc_nulls_last()
    rows = rows.sortWithinPartitions("gene", "grp", falling, F.col("start").asc_nulls_last(), F.col("stop").asc_nulls_last())
    return rows.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in types.items()))
