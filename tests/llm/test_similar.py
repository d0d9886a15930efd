"""Near copies of five-word similarity >= 0.8 against every pair of exact sets."""

import random

import corpus_pipeline
from abundara.llm.simhash import keep_first
from abundara.llm.similar import set_links, shingle_set, similar

DOCS = "doc_id long, text string, lang string, source string"


def brute(rows, least=0.8):
    """Components over all pairs, written apart from the operator."""
    sets = []
    for r in rows:
        w = (r[1] or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] == sets[j] or sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= least:
                root[find(i)] = find(j)
    first = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            first[find(i)] = min(first.get(find(i), r[0]), r[0])
    return sorted(((r[0], first.get(find(i))) for i, r in enumerate(rows)), key=str)


def corpus(seed, n):
    rnd = random.Random(seed)
    vocab, rows = [f"w{i}" for i in range(300)], []
    for i in range(n):
        words = (rnd.choice(rows)[1] or "").split() if rows and rnd.random() < 0.7 else rnd.choices(vocab, k=rnd.choice([0, 1, 3, 6, 90, 200]))
        for _ in range(rnd.choice([0, 1, 2, 4])):
            if words:
                words[rnd.randrange(len(words))] = rnd.choice(vocab)
        rows.append((i, rnd.choice([" ", "\n"]).join(words), "en", "s"))
    return rows


def test_against_every_pair(spark):
    rows = corpus(4, 200) + [(900, None, None, None), (901, "", "en", None), (None, "w1 w2", "en", None)]
    got = sorted(((r.doc_id, r.component_id) for r in similar(spark.createDataFrame(rows, DOCS)).collect()), key=str)
    assert got == brute(rows)


def test_crowded_buckets_are_split_without_losing_links(spark):
    rnd = random.Random(3)
    vocab = [f"v{i}" for i in range(400)]
    roots = [rnd.choices(vocab, k=120) for _ in range(3)]
    rows = []
    for i in range(240):  # chains: each copy changes a word or two of the one before, so ends of a chain are far apart
        words = list(roots[i % 3])
        for _ in range(rnd.choice([1, 1, 2])):
            words[rnd.randrange(120)] = rnd.choice(vocab)
        if i % 4 == 0:
            roots[i % 3] = words
        rows.append((i, " ".join(words), "en", "s"))
    docs = spark.createDataFrame(rows, DOCS)
    want = brute(rows)
    assert sorted(((r.doc_id, r.component_id) for r in similar(docs, hot=8, rounds=2).collect()), key=str) == want
    assert sorted(((r.doc_id, r.component_id) for r in similar(docs).collect()), key=str) == want


def test_spanning_links_of_a_crowded_bucket():
    rows = [r for r in corpus(9, 300) if len((r[1] or "").split()) > 80]
    sets = list({shingle_set(r[1].encode()).tobytes(): shingle_set(r[1].encode()) for r in rows}.values())
    links = set_links(sets)
    assert links and len(links) < len(sets)
    sim = lambda a, b: len(set(a.tolist()) & set(b.tolist())) / len(set(a.tolist()) | set(b.tolist()))
    group = list(range(len(sets)))
    for a, b in links:
        assert sim(sets[a], sets[b]) >= 0.8
        group = [group[a] if g == group[b] else g for g in group]
    assert all(group[i] == group[j] for i in range(len(sets)) for j in range(i) if sim(sets[i], sets[j]) >= 0.8)


def test_stage_drops_what_two_bits_keep(spark):
    words = [f"t{i * i % 331}{i}" for i in range(150)]
    rows = [(1, " ".join(words), "en", "s"), (2, " ".join([*words[:40], "other", *words[41:100], "third", *words[101:]]), "en", "s"), (3, " ".join(reversed(words)), "en", "s")]
    docs = spark.createDataFrame(rows, DOCS)
    assert keep_first(docs).count() == 3
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == [1, 3]
