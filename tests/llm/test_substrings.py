import hashlib
import random

from abundara.llm.substrings import repeated_windows

DOCS = "doc_id long, text string, row string, wanted string"


def brute(rows, window=13):
    first = {}
    split = []
    for r in rows:
        text = r[1] or ""
        for c in "\t\n\x0b\x0c\r":
            text = text.replace(c, " ")
        split.append([w for w in text.split(" ") if w])
    for r, words in zip(rows, split):
        if r[0] is not None:
            for i in range(len(words) - window + 1):
                key = tuple(words[i : i + window])
                first[key] = min(first.get(key, r[0]), r[0])
    out = []
    for r, words in zip(rows, split):
        gone = set()
        for i in range(len(words) - window + 1):
            if r[0] is not None and first[tuple(words[i : i + window])] < r[0]:
                gone |= set(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((r[0], len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, **options):
    got = repeated_windows(spark.createDataFrame(rows, DOCS), **options)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()), key=str) == brute(rows)


def test_against_every_window(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(160):
        kind = rnd.random()
        small = rnd.choice([1, 2, 3, 40, 400])
        words = [f"v{rnd.randrange(small)}" for _ in range(rnd.choice([0, 3, 12, 13, 14, 60, 200]))]
        if rows and kind < 0.6:
            other = (rnd.choice(rows)[1] or "").split()
            if len(other) > 14:
                a = rnd.randrange(len(other) - 13)
                words[rnd.randrange(len(words) + 1) : 0] = other[a : a + rnd.choice([12, 13, 14, 40])]
        rows.append((i * 3 % 161, rnd.choice([" ", "\n", "  "]).join(words), None, "x"))
    rows += [(500, None, "a", "b"), (501, "", "a", "b"), (None, rows[3][1], None, None), rows[5], rows[9], rows[9], (502, "é " * 40, "", ""), (503, "é " * 30, "", "")]
    check(spark, rows)


def test_empty_table(spark):
    assert repeated_windows(spark.createDataFrame([], DOCS)).count() == 0


def test_long_text(spark):
    words = [f"u{i * i % 7919}" for i in range(60_000)]
    check(spark, [(1, " ".join(words), "", ""), (2, " ".join(words[20_000:45_000] + ["new"] * 30), "", "")])
