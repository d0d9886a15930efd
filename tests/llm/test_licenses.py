import random

from abundara.llm.licenses import TEMPLATES, scan_licenses, words_of

DOCS = "doc_id long, text string, license string"


def longest(template, text):
    """Longest common subsequence, the plain way."""
    row = [0] * (len(text) + 1)
    for a in template:
        new = [0]
        for j, b in enumerate(text):
            new.append(row[j] + 1 if a == b else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_planted_notices(spark):
    rnd = random.Random(2)
    rows, want = [], {}
    for n in range(80):
        noise = [f"w{rnd.randrange(500)}" for _ in range(rnd.randrange(5, 150))]
        if n % 2:
            name = rnd.choice(list(TEMPLATES))
            words = TEMPLATES[name].split()
            if len(words) > 12:  # an altered, a dropped and an added word
                words[6] = "changed"
                del words[10]
                words.insert(9, "added")
            at = rnd.randrange(len(noise))
            noise[at:at] = words
            want[n] = (name, at)
        rows.append((n, " ".join(noise), "x"))
    rows += [(200, None, None), (201, "", ""), (202, "licensed under", ""), (None, TEMPLATES["MIT-notice"], "")]
    got = scan_licenses(spark.createDataFrame(rows, DOCS)).collect()
    found = {r.doc_id: r for r in got if r.doc_id is not None}
    assert found.keys() == want.keys() and len(got) == len(want) + 1
    for n, (name, at) in want.items():
        r = found[n]
        template, text = words_of(TEMPLATES[name].encode()), words_of(rows[n][1].encode())
        assert r.license == name and at <= r.start_word <= at + 2
        assert r.matched_words == longest(template, text[r.start_word : r.end_word])
        assert abs(r.coverage - r.matched_words / len(template)) < 1e-12


def test_empty_table(spark):
    assert scan_licenses(spark.createDataFrame([], DOCS)).count() == 0


def test_altered_short_notices_and_repeats(spark):
    """Every single-word change of a short notice that leaves 0.8 of it is found, and every occurrence of a notice on following lines."""
    rows, want, number = [], {}, 0
    for name, text in TEMPLATES.items():
        words = text.split()
        if len(words) > 15:
            continue
        for at in range(len(words)):
            for change in ([], ["changed"], [words[at], "added"]):
                altered = words[:at] + change + words[at + 1 :]
                kept = longest(words_of(text.encode()), words_of(" ".join(altered).encode()))
                rows.append((number, "before it " + " ".join(altered) + " after it", "x"))
                if kept >= 0.8 * len(words):
                    want[number] = name
                number += 1
    rows += [(1000, "Released under the MIT License.\n" * 400, "x"), (1001, ("Licensed under CC BY-NC 4.0.\n" + "Released under MIT License.\n") * 50, "x"), (1001, "", "x")]
    rows += [(1002, f"{TEMPLATES['MIT']}\n\n{TEMPLATES['BSD-3-Clause']}\n{TEMPLATES['MIT']}", "x"), (1003, "word " * 300_000 + TEMPLATES["ISC"], "x")]
    got = {}
    for r in scan_licenses(spark.createDataFrame(rows, DOCS)).orderBy("doc_id", "start_word").collect():
        got.setdefault(r.doc_id, []).append((r.license, r.start_word))
    missed = {n: (rows[n][1], name) for n, name in want.items() if name not in [x for x, _ in got.get(n, [])]}
    assert not missed
    assert got[1000] == [("MIT-notice", 5 * k) for k in range(400)]
    assert [x for x, _ in got[1001]] == ["CC-BY-NC-4.0-notice", "MIT-notice"] * 50
    assert [x for x, _ in got[1002]] == ["MIT", "BSD-3-Clause", "MIT"] and got[1003] == [("ISC", 300_000)]


def test_no_candidate_is_lost(spark):
    """Every template aligned with every text in full: what reaches the coverage and shares a run of the index with it is found."""
    rnd = random.Random(6)
    rows, want = [], {}
    for n in range(120):
        name = rnd.choice(list(TEMPLATES))
        words = TEMPLATES[name].split()
        for _ in range(rnd.randrange(0, max(1, len(words) // 12) + 1)):
            words[rnd.randrange(len(words))] = rnd.choice(["x", "y", "the"])
        rows.append((n, " ".join([*(f"v{rnd.randrange(99)}" for _ in range(20)), *words, *(f"v{rnd.randrange(99)}" for _ in range(20))]), "x"))
        text = words_of(rows[-1][1].encode())
        score = {k: longest(words_of(t.encode()), text) for k, t in TEMPLATES.items()}
        best = max((v for k, v in score.items() if v >= 0.8 * len(TEMPLATES[k].split())), default=0)
        want[n] = {k for k, v in score.items() if best and v == best and v >= 0.8 * len(TEMPLATES[k].split())}
    got = {}
    for r in scan_licenses(spark.createDataFrame(rows, DOCS)).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    assert all(not want[n] or got.get(n, set()) & want[n] for n in range(120)), [(n, want[n], got.get(n)) for n in range(120) if want[n] and not got.get(n, set()) & want[n]][:3]
