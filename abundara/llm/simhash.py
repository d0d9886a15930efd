"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint is cut into two halves of 32 bits, one fewer than the three that a plain
pigeonhole over two differing bits needs, so in every linked pair one half differs by at
most one bit.  Each distinct fingerprint is indexed under the 32 one-wildcard variants of
either half; fingerprints that meet under a variant are verified in full.

A variant shared by more than ``hot`` fingerprints is indexed again, by one-wildcard
variants of the two quarters of the other half.  Such a finer bucket fixes 46 of 64 bits,
so it holds at most 2**18 distinct fingerprints whatever the corpus: the bound on a group.
Within a bucket only links of a spanning forest are returned, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abundara.llm.common import cut, discard, fresh, lean, text_bytes, text_digest
from abundara.llm.graph import connected

#: Shingles are hashed and counted this many at a time, so a very long text needs bounded memory.
STRETCH = 1 << 15


def simhash(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit fingerprint: bit i is set if it is set in over half the shingle hashes; no words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    ends = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(ends + 1) - 1
    joined = b" ".join(words)
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    width = min(shingle, len(words)) - 1
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, STRETCH):
        to = min(n, at + STRETCH)
        pairs = zip(starts[at:to].tolist(), ends[at + width : to + width].tolist(), strict=True)
        h = np.array([digest(joined[a:b], seed) for a, b in pairs], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id long, row long, fp long) for every row; row is a digest of the text, fp holds the 64 bits as a signed long."""

    def run(batches):
        for batch in batches:
            found = np.array([simhash(t.as_py(), shingle, seed) for t in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found.view(np.int64))], ["doc_id", "row", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_digest(text_col).alias("row"), text_bytes(text_col).alias("text")).mapInArrow(lean(run), "doc_id long, row long, fp long")


def variant_keys(fp: np.ndarray, hot_low: np.ndarray, hot_high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket keys and the positions of their fingerprints; the masks name the wildcards whose buckets are hot."""
    keys, at = [], []
    where = np.arange(len(fp))
    one = np.uint64(1)
    for half, hot in ((0, hot_low), (1, hot_high)):
        value = (fp >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        other = (fp >> np.uint64(32 * (1 - half))) & np.uint64(0xFFFFFFFF)
        for j in range(32):
            bucket = np.uint64(half << 37 | j << 32) | value & ~(one << np.uint64(j))
            finer = (hot >> np.uint64(j) & one).astype(bool)
            keys.append(bucket[~finer])
            at.append(where[~finer])
            if finer.any():
                b, o, w = bucket[finer], other[finer], where[finer]
                for quarter in (0, 1):
                    q = o >> np.uint64(16 * quarter) & np.uint64(0xFFFF)
                    for i in range(16):
                        keys.append(one << np.uint64(62) | np.uint64(quarter << 20 | i << 16) << np.uint64(38) | (q & ~(one << np.uint64(i))) << np.uint64(38) | b)
                        at.append(w)
    return np.concatenate(keys), np.concatenate(at)


def bucket_links(members: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Spanning links among one bucket's distinct fingerprints (uint64), by the cheaper of two exact ways."""
    rest = np.sort(members)
    out: list[tuple[int, int]] = []
    masks = None
    if len(rest) > 4096:
        single = np.uint64(1) << np.arange(64, dtype=np.uint64)
        masks = single if bits == 1 else np.concatenate([single, np.unique((single[:, None] | single[None, :]).ravel())])
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        frontier = [root]
        while frontier and len(rest):
            x = frontier.pop()
            if masks is not None and len(rest) > 4096:
                near = x ^ masks
                spot = np.minimum(np.searchsorted(rest, near), len(rest) - 1)
                hit = np.zeros(len(rest), bool)
                hit[spot[rest[spot] == near]] = True
            else:
                hit = np.bitwise_count(rest ^ x) <= bits
            if hit.any():
                found = rest[hit]
                out += [(int(root), int(y)) for y in found]
                frontier += list(found)
                rest = rest[~hit]
    return out


def links_of_runs(key: np.ndarray, fp: np.ndarray, bits: int, near: int = 8) -> np.ndarray:
    """Links within runs of equal key; short runs are compared by offset, longer ones bucket by bucket."""
    cuts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    size = np.diff(cuts)
    found = []
    small = np.repeat(size <= near, size)
    for d in range(1, near):
        if len(key) <= d:
            break
        ok = (key[d:] == key[:-d]) & small[d:]
        ok[ok] = np.bitwise_count(fp[d:][ok] ^ fp[:-d][ok]) <= bits
        found.append(np.stack([fp[:-d][ok], fp[d:][ok]], axis=1))
    for r in np.flatnonzero(size > near):
        pairs = bucket_links(fp[cuts[r] : cuts[r + 1]], bits)
        found.append(np.array(pairs, np.uint64).reshape(-1, 2))
    found = np.concatenate(found) if found else np.zeros((0, 2), np.uint64)
    found = np.sort(found.view(np.int64), axis=1)
    return np.unique(found, axis=0)


def fingerprint_links(classes: DataFrame, bits: int = 2, hot: int = 2000) -> DataFrame:
    """(a, b) links spanning the components of distinct fingerprints (column fp) within ``bits`` (1 or 2)."""
    halves = classes.select(
        F.explode(F.array(
            F.struct(F.lit(0).alias("half"), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)).alias("value")),
            F.struct(F.lit(1).alias("half"), F.shiftrightunsigned("fp", 32).alias("value")),
        )).alias("h")
    ).select("h.*")
    crowded = halves.groupBy("half", "value").count().where(F.col("count") > hot // 2)
    crowded = cut(crowded.select("half", "value"))
    n_hot = crowded.count()
    rows = classes.select("fp", F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("high"))
    if n_hot:
        beside = crowded.select("half", F.explode(F.concat(
            F.array(F.struct("value", F.lit(0xFFFFFFFF).alias("mask"))),
            F.transform(F.sequence(F.lit(0), F.lit(31)), lambda j: F.struct(
                F.col("value").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), j)).alias("value"), F.call_function("shiftleft", F.lit(1).cast("long"), j).alias("mask"))),
        )).alias("x")).select("half", "x.*").groupBy("half", "value").agg(F.bit_or("mask").alias("mask"))
        beside = cut(beside)
        low = beside.where("half = 0").select(F.col("value").alias("low_value"), F.col("mask").alias("low"))
        high = beside.where("half = 1").select(F.col("value").alias("high_value"), F.col("mask").alias("high"))
        if n_hot <= 10_000:  # at most 33 rows each: under 10 MB
            low, high = F.broadcast(low), F.broadcast(high)
        rows = (
            classes.select("fp", F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)).alias("low_value"), F.shiftrightunsigned("fp", 32).alias("high_value"))
            .join(low, "low_value", "left").join(high, "high_value", "left")
            .select("fp", F.coalesce("low", F.lit(0)).alias("low"), F.coalesce("high", F.lit(0)).alias("high"))
        )

    def index(batches):
        for batch in batches:
            for piece in (batch.slice(k, 20_000) for k in range(0, batch.num_rows, 20_000)):
                fp, low, high = (c.to_numpy().view(np.uint64) for c in piece.columns)
                keys, at = variant_keys(fp, low, high)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(fp[at].view(np.int64))], ["key", "fp"])

    def verify(batches):
        empty = np.zeros(0, np.uint64)
        held = [(empty, empty)]
        for batch in batches:
            if not batch.num_rows:
                continue
            key, fp = (c.to_numpy().view(np.uint64) for c in batch.columns)
            held.append((key, fp))
            if key[-1] == key[0] and (not len(held[0][0]) or held[0][0][-1] == key[0]):
                continue  # one bucket so far; buckets are bounded
            key, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            last = int(np.searchsorted(key.view(np.int64), key[-1:].view(np.int64)[0]))
            held = [(key[last:], fp[last:])]
            found = links_of_runs(key[:last], fp[:last], bits)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])
        key, fp = (np.concatenate(x) for x in zip(*held, strict=True))
        if len(key):
            found = links_of_runs(key, fp, bits)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    indexed = rows.mapInArrow(lean(index), "key long, fp long")
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return indexed.repartition(n, "key").sortWithinPartitions("key").mapInArrow(lean(verify), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42, bits: int = 2, hot: int = 2000) -> DataFrame:
    """One row per input row: doc_id, row (digest of the text), fp (long), root (one fingerprint of the component), component_id (smallest id reachable over links of <= ``bits``).

    Null and empty texts have fingerprint zero and link like any other.  Rows with a null
    id get their component's id (null if no row of it has one).  Repeated rows give
    repeated results; other columns are ignored; an empty table gives an empty result.
    """
    marked = cut(fingerprints(docs, id_col, text_col, shingle, seed))
    classes = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    nodes = cut(connected(fingerprint_links(classes.select("fp"), bits, hot)))
    rooted = cut(classes.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    least = cut(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")))
    components = cut(rooted.join(least, "root").select("fp", "root", "component_id"))
    discard(classes, nodes, rooted, least)
    return marked.join(components, "fp").select("doc_id", "row", "fp", "root", "component_id")


def small(df: DataFrame, rows: int = 250_000) -> DataFrame:
    """A broadcast hint where the written table's checked size (two longs a row: under 25 MB) allows it."""
    return F.broadcast(df) if df.count() <= rows else df


def keep_roots(docs: DataFrame, marked: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with one row of each component of ``marked`` (doc_id, row, root, component_id): that of the smallest id.

    Of rows that share the smallest id the one whose text has the least digest stays, and of
    that one's exact repeats one.  Rows without an id stay.  Where the rows to drop are few
    enough to be broadcast, no text is shuffled.
    """
    marked = cut(marked.where("doc_id is not null").select("doc_id", "row", "root", "component_id"))
    first = marked.where("doc_id = component_id").groupBy("root", "doc_id", "row").agg(F.count("*").alias("n"))
    first = cut(first.groupBy("root", "doc_id").agg(F.min(F.struct("row", "n")).alias("w")).select("doc_id", "w.*"))
    id_, row = fresh("kept_id", docs.columns), fresh("kept_row", docs.columns)
    gone = marked.select("doc_id", "row").join(first, ["doc_id", "row"], "left_anti").distinct()
    again = cut(first.where("n > 1").select(F.col("doc_id").alias(id_), F.col("row").alias(row)))
    gone = cut(gone.select(F.col("doc_id").alias(id_), F.col("row").alias(row)).unionByName(again))
    rows = docs.withColumns({id_: F.col(id_col).cast("long"), row: text_digest(text_col)})
    kept = rows.join(small(gone), [id_, row], "left_anti")
    once = rows.join(small(again), [id_, row], "left_semi").dropDuplicates([id_, row])
    return kept.unionByName(once).select(*docs.columns)


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id; rows without an id stay."""
    return keep_roots(docs, near_duplicates(docs, id_col=id_col, text_col=text_col, **options), id_col, text_col)
