import hashlib
import json

from hypothesis import given
from hypothesis import strategies as st

from abundara.llm.chat import CONTROL, MARK, canonical_table, canonical_turns, digests, escape, format_turns, read_turn, unescape, write_turn

piece = st.lists(st.sampled_from([*CONTROL, MARK, "<", "|", "[", "turn|>", "a", "\n", "é", "🙂", "/s>"]), max_size=12).map("".join)


@given(piece, piece)
def test_round_trip(role, text):
    formatted, a, b = write_turn(role, text)
    assert read_turn(formatted) == (role, text) and unescape(formatted[a:b]) == text
    assert not any(c in escape(text) for c in CONTROL)
    assert sum(formatted.count(c) for c in CONTROL) == 3


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        told = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_conversations(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"{CONTROL[(c + t) % len(CONTROL)]} {c} {MARK * (t % 3)}", "x") for c in range(30) for t in range(c % 7)]
    rows += [(3, None, None, None, "x"), (None, 0, "user", "hi", None), (None, 1, "assistant", "", None), (5, 1, "assistant", "again", "x"), (5, 1, "assistant", "again", "x")]
    rows += [(40, t, "user\n", "long " * 2000, "x") for t in range(50)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = digests(format_turns(table)).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == brute(rows) and len(got) == len(brute(rows))
    assert digests(format_turns(table.limit(0))).count() == 0


def test_layouts(spark):
    records = [
        {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]},
        {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}], "id": 4},
        {"instruction": "a", "input": "", "output": "b"},
        {"prompt": "a", "completion": "b"},
        {"system": "", "prompt": "a", "response": "b"},
        {"question": "a", "answer": "b", "meta": {"x": [1]}},
    ]
    table = [(n, json.dumps(r)) for n, r in enumerate(records)] + [(90, "{}"), (91, None), (92, "[1]"), (93, "{broken")]
    got = canonical_turns(spark.createDataFrame(table, "record_id long, record string")).collect()
    for n in range(len(records)):
        assert [(r.role, r.text) for r in sorted(got, key=lambda r: r.turn) if r.conv_id == n] == [("user", "a"), ("assistant", "b")]
    assert {r.conv_id for r in got if r.layout is None and r.role is None} == {90, 91, 92, 93}


def test_optional_fields_and_unmapped_text(spark):
    """Text that a mapping does not place is either an optional turn or leaves the record unmapped; nothing crashes."""
    said = [("user", "a"), ("assistant", "b")]
    good = [
        ({"system": "s", "conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, [("system", "s"), *said]),
        ({"system": "s", "instruction": "a", "input": None, "output": "b", "history": [["x", "y"]]}, [("system", "s"), ("user", "x"), ("assistant", "y"), *said]),
        ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}]}, {"role": "assistant", "content": [{"type": "text", "text": "b"}]}]}, said),
        ({"prompt": "a", "response": None}, [("user", "a"), ("assistant", "")]),
        ({"prompt": "a", "response": "b", "source": "web", "tags": ["x"], "meta": {"y": {"z": 1}}}, said),
        ({"prompt": 7, "response": "\ud800b"}, [("user", "7"), ("assistant", "\ufffdb")]),
    ]
    bad = [
        {"prompt": "a", "response": "b", "context": "would be lost"}, {"messages": ["a", {"role": "user", "content": "b"}]}, {"messages": [1]},
        {"messages": {"role": "user", "content": "a"}}, {"instruction": "a", "output": "b", "history": "text"}, {"instruction": "a", "output": "b", "history": [["x", "y", "z"]]},
    ]
    rows = [(n, json.dumps(r)) for n, (r, _) in enumerate(good)] + [(100 + n, json.dumps(r)) for n, r in enumerate(bad)]
    rows += [(200, "[" * 100_000 + "]" * 100_000), (201, '{"a":' * 5000 + "1" + "}" * 5000)]
    got = canonical_turns(spark.createDataFrame(rows, "record_id long, record string")).collect()
    for n, (_, want) in enumerate(good):
        assert [(r.role, r.text) for r in sorted(got, key=lambda r: r.turn) if r.conv_id == n] == want
    assert {r.conv_id for r in got if r.layout is None} == {100 + n for n in range(len(bad))} | {200, 201}


def test_tables_by_their_schema(spark):
    import pytest

    rows = spark.createDataFrame([(1, 0, "human", "a"), (1, 1, "gpt", "b")], "conversation_id long, position long, speaker string, content string")
    assert [tuple(r) for r in canonical_table(rows).orderBy("turn").collect()] == [(1, 0, "human", "a"), (1, 1, "gpt", "b")]
    assert canonical_table(rows.selectExpr("conversation_id AS conv_id", "position AS turn", "speaker AS role", "content AS text", "'x' AS layout")).columns == ["conv_id", "turn", "role", "text"]
    with pytest.raises(ValueError):
        canonical_table(rows.drop("speaker"))
