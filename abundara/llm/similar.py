"""Near copies by the share of common word shingles: MinHash buckets, then every link verified exactly.

Rows of one set of shingles form a class, so exact copies cost one grouped minimum.  A class
is indexed under ``BANDS`` keys of ``ROWS`` minima each: two sets of similarity s meet with
probability 1 - (1 - s**ROWS)**BANDS, 0.9993 at 0.8 and more above.  Buckets of the same members
are looked at once.  Within a bucket whole sets are compared, so no link is an estimate, and
links of a spanning forest are returned, never all pairs.

A bucket of more than ``hot`` classes is never gathered.  In rounds its least open class leads:
all open ones are compared with the leader's set in a join that can be split, and those near
it are linked and closed.  Classes still open in the end are compared with the whole bucket,
block by block, so a task holds a few thousand sets at most and no link of the bucket is lost.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abundara.llm.common import cut, discard, lean, slices, text_bytes, text_digest
from abundara.llm.graph import connected
from abundara.llm.simhash import keep_roots, near_duplicates, small

ROWS, BANDS = 6, 24
#: Shingles of a text that are mixed at a time.
STRETCH = 1 << 10


def shingle_set(text: bytes, shingle: int = 5, seed: int = 42) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words are one shingle, no words none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    return np.unique(np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends, strict=False)], np.uint64))


def band_keys(shingles: np.ndarray, rows: int = ROWS, bands: int = BANDS, seed: int = 42) -> np.ndarray:
    """One 64-bit key a band, of the least values of ``rows`` permutations."""
    rng = np.random.default_rng(seed)
    salt, factor = rng.integers(0, 2**32, (2, rows * bands), dtype=np.uint32)
    factor = factor | np.uint32(1)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(rows * bands, 2**32 - 1, np.uint32)
    for at in range(0, len(short), STRETCH):
        np.minimum(least, ((short[at : at + STRETCH, None] ^ salt) * factor).min(axis=0), out=least)
    least = least.reshape(bands, rows)
    return np.array([xxhash.xxh64_intdigest(least[b].tobytes(), b) for b in range(bands)], np.uint64)


class Postings:
    """Sets of numbers, asked how many members each shares with another set."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(x) for x in sets], np.int64)
        words = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        order = np.argsort(words, kind="stable")
        self.words, self.holder = words[order], np.repeat(np.arange(len(sets)), self.size)[order]

    def near(self, asked: np.ndarray, least: float) -> np.ndarray:
        """Whether each set's Jaccard similarity to ``asked`` is at least ``least``."""
        low = np.searchsorted(self.words, asked)
        n = np.searchsorted(self.words, asked, side="right") - low
        spots = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(asked) else np.zeros(0, np.int64)
        both = np.bincount(self.holder[spots], minlength=len(self.size))
        return both / np.maximum(1, len(asked) + self.size - both) >= least


def set_links(sets: list[np.ndarray], least: float = 0.8) -> list[tuple[int, int]]:
    """Spanning links among positions of distinct sets whose Jaccard similarity is at least ``least``."""
    if len(sets) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return [(0, 1)] if both / max(1, len(sets[0]) + len(sets[1]) - both) >= least else []
    rest, out = np.arange(len(sets)), []
    postings, place = Postings(sets), rest  # place: the numbers that the open sets have in the postings
    while len(rest) > 1:
        frontier, rest, place = [int(rest[0])], rest[1:], place[1:]
        while frontier and len(rest):
            x = frontier.pop()
            hit = postings.near(sets[x], least)[place]
            out += [(x, int(y)) for y in rest[hit]]
            frontier += rest[hit].tolist()
            rest, place = rest[~hit], place[~hit]
            if 2 * len(rest) < len(postings.size):
                postings, place = Postings([sets[i] for i in rest]), np.arange(len(rest))
    return out


def cross_links(probes: list[np.ndarray], others: list[np.ndarray], least: float = 0.8) -> list[tuple[int, int]]:
    """Spanning links (probe, other) of the sets at least ``least`` alike: one that joins nothing new is left out."""
    root = list(range(len(probes) + len(others)))

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    postings, out = Postings(probes), []
    for k, other in enumerate(others):
        for p in np.flatnonzero(postings.near(other, least)).tolist():
            a, b = find(p), find(len(probes) + k)
            if a != b:
                root[a] = b
                out.append((p, k))
    return out


def similar(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, least: float = 0.8, seed: int = 42, hot: int = 1024, rounds: int = 6) -> DataFrame:
    """One row per input row: doc_id, row (digest of the text), node (digest of the shingle set), root (one node of the component), component_id (smallest id reachable over links of similarity >= ``least``).

    Null and empty texts have the empty set and are copies of each other.  Rows with a null
    id get their component's id (null if no row of it has one); repeated rows give repeated
    results; other columns are ignored; an empty table gives an empty result.
    """

    def mark(batches):
        for batch in slices(batches):
            sets = [shingle_set(t.as_py(), shingle, seed) for t in batch.column(2)]
            node = np.array([xxhash.xxh64_intdigest(s.tobytes(), seed) for s in sets], np.uint64)
            bands = [band_keys(s, seed=seed).view(np.int64) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(node.view(np.int64)), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "row", "node", "bands"])

    def shingled(batches):
        for batch in slices(batches):
            sets = [shingle_set(t.as_py(), shingle, seed).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["row", "shingles"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_digest(text_col).alias("row"), text_bytes(text_col).alias("text"))
    marked = cut(texts.mapInArrow(lean(mark), "doc_id long, row long, node long, bands array<long>"), batch_rows=1000)
    classes = cut(marked.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.min("row").alias("row")))
    # the same set has the same keys, so a class's rows repeat them
    keyed = marked.select("node", F.explode("bands").alias("key")).distinct()
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("least"), F.bit_xor(F.xxhash64("node")).alias("members")).where("n > 1")
    shared = cut(shared.groupBy("n", "least", "members").agg(F.min("key").alias("key")).select("key", "n"))
    members = cut(keyed.join(shared, "key").join(classes.select("node", "row"), "node").select("key", "n", "node", "row"))
    wanted = cut(members.select("row").distinct())
    sets = cut(texts.select("row", "text").join(small(wanted), "row", "left_semi").dropDuplicates(["row"]).mapInArrow(lean(shingled), "row long, shingles binary"), batch_rows=1000)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = members.where(F.col("n") <= hot).join(sets, "row").select("key", "node", "shingles")
    links = cut(few.repartition(n, "key").sortWithinPartitions("key").mapInArrow(lean(_verify(least)), "a long, b long"), batch_rows=1000)
    many = members.where(F.col("n") > hot)
    if not many.isEmpty():
        links = links.unionByName(_hot_links(cut(many), sets, least, hot, rounds, n))
    nodes = cut(connected(links))
    rooted = cut(classes.join(nodes, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root")))
    least_id = cut(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")))
    components = cut(rooted.join(least_id, "root").select("node", "root", "component_id"))
    discard(classes, shared, members, wanted, sets, nodes, rooted, least_id)
    return marked.select("doc_id", "row", "node").join(components, "node").select("doc_id", "row", "node", "root", "component_id")


def _links(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _rows(batches):
    """Rows of any number of columns, the last one's sets as arrays; one batch is held at a time."""
    for batch in batches:
        first = [c.to_pylist() for c in batch.columns[:-1]]
        yield from zip(*first, (np.frombuffer(x.as_py(), np.uint64) for x in batch.columns[-1]), strict=True)


def _verify(least: float):
    def run(batches):
        for _, bucket in groupby(_rows(batches), key=lambda r: r[0]):
            _, nodes, sets = zip(*bucket, strict=True)
            if len(sets) > 1 and (found := set_links(list(sets), least)):
                yield _links([(nodes[i], nodes[j]) for i, j in found])

    return run


def _hot_links(members: DataFrame, sets: DataFrame, least: float, hot: int, rounds: int, partitions: int) -> DataFrame:
    """Links (a, b) that join all classes of each crowded bucket which a chain of similar ones joins, see the module's text."""

    def judge(batches):
        for batch in batches:
            key, node, row, leader, own, lead = (batch.column(k) for k in range(6))
            near = []
            for x, y in zip(own, lead, strict=True):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                near.append(both / max(1, len(x) + len(y) - both) >= least)
            yield pa.RecordBatch.from_arrays([key, node, row, leader, pa.array(near, pa.bool_())], ["key", "node", "row", "leader", "near"])

    def compare(batches):
        for _, group in groupby(_rows(batches), key=lambda r: r[:3]):
            group = list(group)
            probes, others = ([r for r in group if r[3] == kind] for kind in (True, False))
            found = cross_links([r[5] for r in probes], [r[5] for r in others], least) if probes and others else []
            if found:
                yield _links([(probes[i][4], others[j][4]) for i, j in found])

    links, open_ = [], members.select("key", "node", "row")
    for _ in range(rounds):
        lead = open_.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("node", "row")).alias("l")).where(F.col("n") > hot)
        lead = cut(lead.select("key", F.col("l.node").alias("leader"), F.col("l.row").alias("row")).join(sets, "row").select("key", "leader", F.col("shingles").alias("lead")))
        if lead.isEmpty():
            break
        pairs = open_.join(sets, "row").join(lead, "key").select("key", "node", "row", "leader", "shingles", "lead")
        judged = cut(pairs.mapInArrow(lean(judge), "key long, node long, row long, leader long, near boolean"))
        links.append(judged.where("near and node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")))
        rest = open_.join(lead.select("key"), "key", "left_anti")
        open_ = cut(rest.unionByName(judged.where("not near").select("key", "node", "row")))
    dealt = members.groupBy("key").agg(F.count("*").alias("n")).join(open_.groupBy("key").agg(F.count("*").alias("open")), "key")
    dealt = cut(dealt.select("key", F.ceil(F.col("n") / hot).cast("int").alias("chunks"), F.ceil(F.col("open") / 256).cast("int").alias("blocks")))
    zero = F.lit(0)
    # sets are joined before rows are repeated, so that no row's key gets hot
    probes = open_.join(sets, "row").join(dealt, "key").select("key", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"), F.explode(F.sequence(zero, F.col("chunks") - 1)).alias("chunk"), F.lit(True).alias("probe"), "node", "shingles")
    others = members.join(sets, "row").join(dealt, "key").select("key", F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("node"), "chunks").cast("int").alias("chunk"), F.lit(False).alias("probe"), "node", "shingles")
    both = probes.unionByName(others)
    keys = ["key", "block", "chunk"]
    links.append(both.repartition(partitions, *keys).sortWithinPartitions(*keys).mapInArrow(lean(compare), "a long, b long"))
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return cut(out)


def joined(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: doc_id, row, root and component_id of the components over both SimHash links and ``similar``'s.

    SimHash components come from ``simhash.near_duplicates`` as they are; one that reaches
    several components of similar sets joins them, so chains through both kinds of link hold.
    """
    bits = near_duplicates(docs, id_col=id_col, text_col=text_col).select("row", F.col("root").alias("bits"))
    sets = cut(similar(docs, id_col=id_col, text_col=text_col, **options).select("doc_id", "row", "root", "component_id"))
    both = cut(bits.distinct().join(sets.select("row", "root").distinct(), "row").select("bits", "root").distinct())
    first = both.groupBy("bits").agg(F.min("root").alias("a"), F.count("*").alias("n")).where("n > 1")
    nodes = cut(connected(both.join(first, "bits").select("a", F.col("root").alias("b"))))
    roots = sets.groupBy("root").agg(F.min("component_id").alias("least"))
    roots = cut(roots.join(nodes.withColumnRenamed("root", "top"), F.col("root") == F.col("node"), "left").select("root", "least", F.coalesce("top", "root").alias("top")))
    least = cut(roots.groupBy("top").agg(F.min("least").alias("component_id")))
    roots = cut(roots.join(least, "top").select("root", "top", "component_id"))
    discard(both, nodes, least)
    return sets.select("doc_id", "row", "root").join(roots, "root").select("doc_id", "row", F.col("top").alias("root"), "component_id")


def keep_first_joined(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component of ``joined``, that of the smallest id; rows without an id stay."""
    return keep_roots(docs, joined(docs, id_col=id_col, text_col=text_col, **options), id_col, text_col)


def keep_first_similar(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id; rows without an id stay."""
    return keep_roots(docs, similar(docs, id_col=id_col, text_col=text_col, **options), id_col, text_col)
