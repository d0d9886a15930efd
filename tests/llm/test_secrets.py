"""Private keys: the whole block is the finding, its body the value whose owners are counted."""

import pytest

from abundara.llm.secrets import find_secrets, redact

DOCS = "doc_id long, text string, source string, lang string"
BEGIN, END = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"


def body(c):
    return "\n".join((c + "Qk3+/z") * 8 for _ in range(12)) + "\n" + c * 9 + "=="


KEYS = {
    1: f"{BEGIN}\n{body('a')}\n{END}", 2: f"{BEGIN}\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,AB12\n\n{body('b')}\n{END}",
    3: f"{BEGIN}\n{body('c')}", 4: f"{BEGIN}\\n" + body("d").replace("\n", "\\n") + f"\\n{END}",
}
ROWS = [(i, f"é🙂 before {k}\nafter it - a plain line", f"s{i}", "en") for i, k in KEYS.items()]
COPIED = [(10 + i, f"x {BEGIN}{gap}{body('e').replace(chr(10), gap)}{gap}{END} y", f"s{i}", "en") for i, gap in enumerate(["\n", "\r\n", "\n  "])]


def test_keys_of_many_owners_are_found_and_removed(spark):
    docs = spark.createDataFrame(ROWS + COPIED, DOCS)
    found = {r.doc_id: r for r in find_secrets(docs).where("kind = 3").collect()}
    assert set(found) == set(KEYS)  # the copied key counts as one value of three owners
    for i, text, _, _ in ROWS:
        assert text[found[i].start : found[i].end] == KEYS[i] and found[i].owners == 1 and found[i].live
    clean = {r.doc_id: r.text for r in redact(docs).collect()}
    for i, _, _, _ in ROWS:
        assert clean[i] == "é🙂 before <SECRET>\nafter it - a plain line"
    assert all(clean[i] == text for i, text, _, _ in COPIED)


@pytest.mark.parametrize("text", [f"{BEGIN} " + "- item\n" * 20_000, f"{BEGIN}\n" + (("A" * 64) + "\n") * 20_000, BEGIN * 3_000])
def test_headers_without_an_end(spark, text):
    docs = spark.createDataFrame([(1, text, "s", "en")], DOCS)
    assert find_secrets(docs).where("kind = 3").count() == text.count(BEGIN)
