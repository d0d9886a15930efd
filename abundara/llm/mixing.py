"""Temperature mixing of sources, realised as budgeted block permutations, in DataFrame functions only.

With t the tokens of a source, its weight is t**a normalised.  The exponent a is bisected
(five halvings a pass, over a table of one row per source) until the entropy of the
weights or the largest number of repetitions meets its target.  The budget is scaled so
that no source gets less than one whole pass; nothing is dropped.

A source's documents are permuted by a digest of their ids and cut into blocks of about
``block_tokens``.  Block sums place the budget's last partial pass in one block, and only
that block is looked into, so no source is ever ordered as a whole.  Each pass permutes the
source's blocks and, within a block, its documents: ordered by (pass_no, block_draw, draw) the
drawn copies are a block permutation that can be read block by block.

Defined results: null and empty texts hold no tokens and come along once a whole pass; a
null source is a source of its own; a null id is placed by a fixed digest; rows with equal
ids stay together; an empty table gives an empty result; extra columns are kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from abundara.llm.common import WORD, cut, fresh

TOP = 1 << 60
#: Source tables up to this many rows (under 10 MB) are broadcast; larger ones are joined by shuffle.
SMALL = 100_000


def _place(id_: Column) -> Column:
    """60 bits of a digest of the id."""
    return F.conv(F.substring(F.md5(F.coalesce(id_.cast("string"), F.lit("none"))), 1, 15), 16, 10).cast("long")


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def bisect_exponent(sources: DataFrame, *, max_repeats: float | None = None, target_entropy: float | None = None, passes: int = 5) -> float:
    """Least a of [0, 1] (to 2**-25) whose repetitions are at most ``max_repeats``, or whose entropy share is at most ``target_entropy``."""
    if (max_repeats is None) == (target_entropy is None):
        raise ValueError("give max_repeats or target_entropy")
    lo, step = 0.0, 1.0  # a lies in (lo, lo + step], or is 0
    some = sources.where("t > 0")
    for number in range(passes):
        step /= 32
        grid = [lo + step * k for k in range(0 if number == 0 else 1, 33)]
        w = some.select("t", "t_max", F.explode(F.array(*map(F.lit, grid))).alias("a")).withColumn("w", F.pow(F.col("t") / F.col("t_max"), F.col("a")))
        found = w.groupBy("a").agg(
            F.max(F.pow(F.col("t_max") / F.col("t"), 1 - F.col("a"))).alias("repeats"),
            ((F.log(F.sum("w")) - F.sum(F.col("w") * F.log("w")) / F.sum("w")) / F.greatest(F.log(F.count("*").cast("double")), F.lit(1e-12))).alias("entropy"),
        )
        good = F.col("repeats") <= max_repeats if max_repeats is not None else F.col("entropy") <= target_entropy
        least = found.where(good).agg(F.min("a")).first()[0]
        if least is None:
            return 1.0
        if least == 0:
            return 0.0
        lo = least - step
    return lo + step


def small(df: DataFrame) -> DataFrame:
    """A broadcast hint where the written table's checked size allows it."""
    return F.broadcast(df) if df.count() <= SMALL else df


def plan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", max_repeats: float | None = 2.0, target_entropy: float | None = None, block_tokens: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, key, place, tokens) of every row, and per key the whole passes and the last place of the partial one."""
    sizes = cut(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), _key(F.col(source_col)).alias("key"), _place(F.col(id_col).cast("long")).alias("place"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("tokens"),
    ))
    totals = cut(sizes.groupBy("key").agg(F.sum("tokens").alias("t")))
    most = totals.agg(F.max("t")).first()[0] or 0
    sources = totals.withColumn("t_max", F.lit(most).cast("long"))
    a = bisect_exponent(sources, max_repeats=max_repeats, target_entropy=target_entropy)
    budget = F.when(F.col("t") > 0, F.round(F.col("t") * F.pow(F.col("t_max") / F.col("t"), F.lit(1 - a)))).otherwise(0).cast("long")
    sources = sources.withColumn("budget", F.greatest(budget, F.col("t")))
    sources = sources.select(
        "key", "t", "budget", F.when(F.col("t") > 0, F.expr("budget div t")).otherwise(1).alias("passes"),
        F.when(F.col("t") > 0, F.col("budget") % F.col("t")).otherwise(0).alias("rest"),
        (F.lit(1) + F.expr(f"t div {block_tokens}")).alias("blocks"),
    )
    sources = small(cut(sources))
    block = F.floor(F.col("place") / F.lit(float(TOP)) * F.col("blocks"))
    placed = sizes.join(sources.select("key", "blocks"), "key").select("key", "place", "tokens", block.alias("block"))
    sums = placed.groupBy("key", "block").agg(F.sum("tokens").alias("n"))
    sums = sums.withColumn("before", F.sum("n").over(Window.partitionBy("key").orderBy("block")) - F.col("n"))
    edge = sums.join(sources.select("key", "rest"), "key").where("before <= rest and rest < before + n").select("key", "block", "before", "rest")
    edge = small(cut(edge))
    inside = Window.partitionBy("key", "block").orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = placed.join(edge, ["key", "block"]).withColumn("upto", F.col("before") + F.sum("tokens").over(inside))
    last = last.where("upto <= rest").groupBy("key").agg(F.max("place").alias("last"))
    # no document of the edge block fits: the pass ends with the block before
    first = (F.col("block") / F.col("blocks") * F.lit(float(TOP))).cast("long") - 1
    ends = edge.select("key", "block").join(sources.select("key", "blocks"), "key").select("key", first.alias("first")).join(last, "key", "left")
    return sizes, small(cut(sources.join(ends.select("key", F.coalesce("last", "first").alias("last")), "key", "left").select("key", "budget", "passes", "rest", "last", "blocks")))


def _copies() -> Column:
    """Whole passes, and the partial one where the place falls into it."""
    return F.col("passes") + F.when((F.col("rest") > 0) & (F.col("place") <= F.col("last")), 1).otherwise(0)


def draws(docs: DataFrame, **options) -> DataFrame:
    """One row per drawn copy: doc_id, source, tokens, pass_no (from 1), block (of the source), block_draw (the block's place in the pass) and draw (the document's place in the block)."""
    sizes, per_source = plan(docs, **options)
    rows = sizes.join(per_source, "key").withColumn("copies", _copies().cast("int"))
    block = F.floor(F.col("place") / F.lit(float(TOP)) * F.col("blocks")).cast("long")
    rows = rows.select("doc_id", "source", "tokens", "key", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("pass_no"), block.alias("block"))
    one = F.col("pass_no").cast("string")
    draw = _place(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), one))
    return rows.withColumns({"block_draw": _place(F.concat_ws(":", "key", F.col("block").cast("string"), one)), "draw": draw}).drop("key")


def mix(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, with all columns, each as often as it is drawn; texts are not shuffled."""
    _, per_source = plan(docs, id_col=id_col, source_col=source_col, **options)
    names = {c: fresh(f"mix_{c}", docs.columns) for c in per_source.columns}
    plan_ = small(cut(per_source.withColumnsRenamed(names)))
    times = F.col(names["passes"]) + F.when((F.col(names["rest"]) > 0) & (_place(F.col(id_col).cast("long")) <= F.col(names["last"])), 1).otherwise(0)
    joined = docs.join(plan_, _key(F.col(source_col)) == plan_[names["key"]])
    return joined.select(*docs.columns, F.explode(F.sequence(F.lit(1), times.cast("int"))).alias(fresh("mix_pass", docs.columns))).select(*docs.columns)


ORACLE = r"""
WITH RECURSIVE z AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS key, ('0x' || md5(coalesce(doc_id::VARCHAR, 'none'))[1:15])::BIGINT AS place,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens
  FROM documents
), s AS (
  SELECT key, sum(tokens)::BIGINT AS t, max(sum(tokens)::BIGINT) OVER () AS t_max FROM z GROUP BY key
), b(n, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT n + 1, CASE WHEN ok THEN lo ELSE (lo + hi) / 2 END, CASE WHEN ok THEN (lo + hi) / 2 ELSE hi END
  FROM (SELECT n, lo, hi, (SELECT max(pow(t_max / t, 1 - (lo + hi) / 2)) FROM s WHERE t > 0) <= 2.0 AS ok FROM b WHERE n < 25)
), a AS (
  SELECT CASE WHEN (SELECT max(t_max / t) FROM s WHERE t > 0) <= 2.0 THEN 0.0 ELSE hi END AS a FROM b WHERE n = 25
), p AS (
  SELECT key, t, CASE WHEN t > 0 THEN greatest(t, round(t * pow(t_max / t, 1 - a))::BIGINT) ELSE 0 END AS budget FROM s, a
), q AS (
  SELECT key, CASE WHEN t > 0 THEN budget // t ELSE 1 END AS passes, CASE WHEN t > 0 THEN budget % t ELSE 0 END AS rest, 1 + t // 1048576 AS blocks FROM p
), c AS (
  SELECT z.*, blocks, passes + CASE WHEN rest > 0 AND sum(tokens) OVER (PARTITION BY key ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= rest THEN 1 ELSE 0 END AS copies
  FROM z JOIN q USING (key)
), e AS (
  SELECT doc_id, source, tokens, key, floor(place / 1152921504606846976.0::DOUBLE * blocks)::BIGINT AS block, unnest(range(1, copies + 1)) AS pass_no FROM c
)
SELECT doc_id, source, tokens, pass_no::INTEGER AS pass_no, block, ('0x' || md5(key || ':' || block || ':' || pass_no)[1:15])::BIGINT AS block_draw, ('0x' || md5(coalesce(doc_id::VARCHAR, 'none') || ':' || pass_no)[1:15])::BIGINT AS draw FROM e
"""
