import random

import numpy as np
import xxhash

from abundara.llm.simhash import bucket_links, fingerprint_links, keep_first, near_duplicates, simhash
from abundara.llm.graph import connected

DOCS = "doc_id long, text string, lang string, fp string"


def brute(rows, bits=2):
    """Components by comparing every two fingerprints, written apart from the operator."""
    def one(text):
        words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
        if not words:
            return 0
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
        h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [one(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], f"{fps[i]:016x}", least.get(find(i))) for i, r in enumerate(rows)), key=str)


def corpus(seed, n):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        if rows and rnd.random() < 0.5:
            words = (rnd.choice(rows)[1] or "").split()
            if words and rnd.random() < 0.7:
                words[rnd.randrange(len(words))] = rnd.choice(vocab)
        else:
            words = rnd.choices(vocab, k=rnd.choice([0, 1, 2, 5, 80]))
        rows.append((i, rnd.choice([" ", "\n", "\t "]).join(words), "en", "x"))
    return rows


def result(df):
    return sorted(((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in df.collect()), key=str)


def test_against_every_pair(spark):
    rows = corpus(1, 250) + [(900, None, None, None), (901, "", "en", None), (None, "w1 w2", "en", None), (7, corpus(1, 8)[7][1], "en", "x")]
    for hot in (2000, 2):  # 2: nearly every bucket takes the finer index
        assert result(near_duplicates(spark.createDataFrame(rows, DOCS), hot=hot)) == brute(rows)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_hot_buckets_link_alike(spark):
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 2**63, 3).astype(np.uint64)
    fps = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, 120).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 20, 120).astype(np.uint64)) for c in centre]))
    table = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    want = {frozenset(c) for c in components(fps, bucket_links(fps, 2))}
    for hot in (5000, 4):
        got = {}
        for r in connected(fingerprint_links(table, 2, hot)).collect():
            got.setdefault(r.root, set()).add(r.node & (1 << 64) - 1)
        assert {frozenset(v) for v in got.values()} == want


def components(fps, links):
    group = {int(f): {int(f)} for f in fps}
    for a, b in links:
        if group[a] is not group[b]:
            group[a] |= group[b]
            for x in group[b]:
                group[x] = group[a]
    return {frozenset(g) for g in group.values() if len(g) > 1}


def test_bucket_links_ways_agree():
    rng = np.random.default_rng(3)
    fps = np.unique(np.concatenate([rng.integers(0, 2**16, 6000).astype(np.uint64) << np.uint64(3 * k) for k in range(3)]))
    links = bucket_links(fps, 2)
    assert all((a ^ b).bit_count() <= 64 for a, b in links) and len(fps) > 4096
    slow = []
    rest = fps.copy()
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        root = front[0]
        while front:
            x = front.pop()
            hit = np.bitwise_count(rest ^ x) <= 2
            slow += [(int(root), int(y)) for y in rest[hit]]
            front += list(rest[hit])
            rest = rest[~hit]
    assert components(fps, links) == components(fps, slow)


def test_long_text_is_counted_whole():
    words = [f"t{i % 977}" for i in range(70_000)]
    assert simhash(" ".join(words).encode()) == int(brute([(1, " ".join(words))])[0][1], 16)


def test_keep_first(spark):
    rows = [(1, "a b c d e", "en", "s"), (2, "a b c d e", "en", "s"), (2, "a b c d e", "en", "s"), (3, "q r s t", "en", "s"), (3, "q r s t", "en", "s"), (None, "a b c d e", "en", "s")]
    kept = keep_first(spark.createDataFrame(rows, DOCS))
    assert sorted((str(r.doc_id) for r in kept.collect())) == ["1", "3", "None"] and kept.columns == ["doc_id", "text", "lang", "fp"]


def test_keep_first_by_row(spark):
    """An id that comes first for one text may not keep its other rows; exact repeats stay once, rows without an id all."""
    a, b = "one two three four five six seven", "red green blue black white pink grey"
    rows = [(3, b, "en", "s"), (5, a, "en", "s"), (5, b, "en", "s"), (5, a, "en", "s"), (None, a, "en", "s"), (None, a, "en", "s")]
    kept = sorted(((r.doc_id, r.text) for r in keep_first(spark.createDataFrame(rows, DOCS)).collect()), key=str)
    assert kept == sorted([(3, b), (5, a), (None, a), (None, a)], key=str)
    clashing = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS kept_id", "2 AS component_id", "3 AS row", "4 AS n")
    assert keep_first(clashing).columns == clashing.columns and keep_first(clashing).count() == 4


def test_hub_of_a_component(spark):
    """One root with most of the links: the same components, and no round is given up silently."""
    import pytest

    from abundara.llm.graph import connected

    star = spark.range(1, 4000).selectExpr("id AS a", "0L AS b").unionByName(spark.range(5000, 5100).selectExpr("id AS a", "id + 1 AS b"))
    got = {r.node: r.root for r in connected(star).collect()}
    assert got == {n: 0 for n in range(4000)} | {n: 5000 for n in range(5000, 5101)}
    with pytest.raises(RuntimeError):
        connected(star, max_rounds=1)
