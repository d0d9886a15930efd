"""Chat formatting by schema fingerprints.

The nested field paths of a record (or of a table's schema) are hashed; the fingerprint
selects a declarative mapping that turns prompt, instruction and message layouts into
canonical turns (role, text).  A layout not seen before takes the mapping with most of its
paths, provided that every other path is a known label of the record (``LABELS``) or one of
the mapping's optional fields: text that no mapping places is never dropped, its record is
reported as unmapped.

Turns are written in a template whose control strings are escaped inside roles and texts,
so formatted text can be read back exactly; the loss mask covers assistants' texts.

Conversations are brought together by key, sorted, and streamed turn by turn: memory is
bounded by one turn whatever a conversation's length (its digest is sequential by nature).

Defined results: a null text or role is empty; null turn numbers come first and equal ones
are ordered by role and text; rows with a null id form one conversation; repeated rows are
turns each; labels beside the turns are ignored; an empty table gives an empty result.  A
record that fits no mapping, is no JSON object, is nested too deeply to be read or holds a
turn that is no object gives one row with null layout, role and text.  Content given as a
list of parts is their texts, one a line; lone surrogates become U+FFFD.
"""

from __future__ import annotations

import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The template's control strings; other templates' common ones are kept out of texts too.
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
CONTROL = (TURN, BODY, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
MARK = "␛"
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_MARKED = re.compile(f"{MARK}({MARK}?)")

#: layout, field paths it needs, list of turns (or None), for each turn its role and text (fields, or a fixed role), and optional
#: fields: a system text said first, and a history of (user, assistant) pairs said before.
MAPPINGS = (
    ("messages", ("messages[].content", "messages[].role"), "messages", (("=role", "content"),), {"system": "system"}),
    ("message_parts", ("messages[].content[].text", "messages[].content[].type", "messages[].role"), "messages", (("=role", "content"),), {"system": "system"}),
    ("conversations", ("conversations[].from", "conversations[].value"), "conversations", (("=from", "value"),), {"system": "system"}),
    ("instruction_input", ("input", "instruction", "output"), None, (("user", "instruction+input"), ("assistant", "output")), {"system": "system", "history": "history[][]"}),
    ("instruction", ("instruction", "output"), None, (("user", "instruction"), ("assistant", "output")), {"system": "system", "history": "history[][]"}),
    ("prompt_response", ("prompt", "response"), None, (("user", "prompt"), ("assistant", "response")), {"system": "system", "history": "history[][]"}),
    ("prompt_completion", ("completion", "prompt"), None, (("user", "prompt"), ("assistant", "completion")), {"system": "system"}),
    ("question_answer", ("answer", "question"), None, (("user", "question"), ("assistant", "answer")), {"system": "system"}),
    ("turn_rows", ("conv_id", "role", "text", "turn"), None, (("=role", "text"),), {}),
    ("utterance_rows", ("conversation_id", "content", "position", "speaker"), None, (("=speaker", "content"),), {}),
)
PLACED = {p for m in MAPPINGS for p in m[1]}
#: Where rows-by-turn layouts hold the conversation and the turn's number.
KEYS = {"turn_rows": ("conv_id", "turn"), "utterance_rows": ("conversation_id", "position")}
#: Other names of the canonical roles.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatgpt": "assistant"}
#: Fields that say something about a record and are no part of its turns.
LABELS = re.compile(r"(id|uid|uuid|record_id|source|dataset|lang|language|model|date|created|timestamp|score|quality|toxic|category|topic|license|split|type|tags(\[\])?|(meta|metadata)(\..*)?|.*\[\]\.(id|uid|type|name|weight|timestamp))")


def paths(value) -> set[str]:
    """Nested field paths of a JSON value, lists marked by []; a null counts only where some mapping places the field."""
    out, open_ = set(), [("", value)]
    while open_:
        at, value = open_.pop()
        if isinstance(value, dict):
            open_ += [(f"{at}.{k}" if at else str(k), v) for k, v in value.items()]
        elif isinstance(value, list):
            open_ += [(f"{at}[]", v) for v in value]
        elif value is not None or at in PLACED:
            out.add(at)
    return out


def schema_paths(kind, at: str = "") -> set[str]:
    """The field paths that rows of a Spark type have."""
    if isinstance(kind, T.StructType):
        return set().union(*[schema_paths(f.dataType, f"{at}.{f.name.lower()}" if at else f.name.lower()) for f in kind.fields])
    return schema_paths(kind.elementType, f"{at}[]") if isinstance(kind, T.ArrayType) else {at}


def fingerprint(found) -> str:
    return hashlib.sha256("\n".join(sorted(found)).encode("utf-8", "replace")).hexdigest()[:16]


INDEX = {fingerprint(m[1]): m for m in MAPPINGS}


def mapping_of(found: frozenset, known: dict):
    """The mapping of a fingerprint, or of the most of its paths if the others are optional fields or labels; None if text would be left over."""
    key = fingerprint(found)
    if key not in known:

        def fits(m):
            rest = found.difference(m[1]).difference(m[4].values())
            return found.issuperset(m[1]) and all(LABELS.fullmatch(p) for p in rest)

        known[key] = INDEX.get(key) or max(filter(fits, MAPPINGS), key=lambda m: len(m[1]), default=None)
    return known[key]


def _said(value) -> str:
    """A field as text: parts of a list one a line, other values as they are written."""
    if value is None:
        return ""
    if isinstance(value, list):
        return "\n".join(_said(v.get("text") if isinstance(v, dict) else v) for v in value)
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(record, known: dict) -> tuple[str | None, list[tuple[str, str]]]:
    """Layout and canonical turns of one parsed record."""
    found = mapping_of(frozenset(paths(record)), known) if isinstance(record, dict) else None
    items = record[found[2]] if found and found[2] else [record]
    if found is None or not isinstance(items, list) or not all(isinstance(x, dict) for x in items):
        return None, []
    layout, _, _, parts, more = found
    out = [("system", _said(record[more["system"]]))] if more.get("system") and record.get("system") else []
    for pair in record.get("history") or () if "history" in more else ():
        if not isinstance(pair, list) or len(pair) > 2:
            return None, []
        out += [(role, _said(text)) for role, text in zip(("user", "assistant"), pair, strict=False)]
    for item in items:
        for role, field in parts:
            name = _said(item.get(role[1:])) if role[0] == "=" else role
            text = "\n".join(t for t in (_said(item.get(f)) for f in field.split("+")) if t)
            if role[0] == "=" or text or role == "assistant":
                out.append((ROLES.get(name, name), text))
    return layout, out


def _clean(text: str | None) -> str | None:
    return text if text is None else text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def canonical_turns(records: DataFrame, *, id_col: str = "record_id", json_col: str = "record") -> DataFrame:
    """conv_id, layout, turn (from 0), role and text of JSON records in mixed layouts."""

    def run(batches):
        known: dict = {}
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    layout, turns = turns_of(json.loads(text or ""), known)
                except (ValueError, RecursionError):
                    layout, turns = None, []
                rows += [(key, layout, n, _clean(r), _clean(t)) for n, (r, t) in enumerate(turns)] or [(key, layout, 0, None, None)]
                if len(known) > 100_000:  # fingerprints met so far: a bounded memory, refilled as needed
                    known.clear()
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()), strict=True)], ["conv_id", "layout", "turn", "role", "text"])

    return records.select(F.col(id_col).cast("long").alias("conv_id"), F.col(json_col).cast("string").alias("record")).mapInArrow(run, "conv_id long, layout string, turn long, role string, text string")


def canonical_table(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of a table with one turn a row: its schema's paths are hashed to select the mapping.

    Columns beside the mapping's are ignored only if none of the mapping's names is lost to them: a
    table whose fingerprint is unknown takes the mapping with most of its columns.
    """
    found = schema_paths(rows.schema)
    mapping = INDEX.get(fingerprint(found)) or max((m for m in MAPPINGS if m[0] in KEYS and found.issuperset(m[1])), key=lambda m: len(m[1]), default=None)
    if mapping is None or mapping[0] not in KEYS:
        raise ValueError(f"no mapping of a table of turns fits the columns {sorted(found)}")
    (conv, turn), ((role, text),) = KEYS[mapping[0]], mapping[3]
    spoken = F.coalesce(F.col(role[1:]).cast("string"), F.lit(""))
    return rows.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), spoken.alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def escape(text: str) -> str:
    """A text in which no control string is left; unescape() undoes it."""
    return _CONTROL.sub(lambda m: m[0][0] + MARK + m[0][1:], text.replace(MARK, MARK + MARK))


def unescape(text: str) -> str:
    return _MARKED.sub(r"\1", text)


def write_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where the escaped text starts and ends in it."""
    head = f"{TURN}{escape(role)}{BODY}"
    body = escape(text)
    return f"{head}{body}{END}", len(head), len(head) + len(body)


def read_turn(formatted: str) -> tuple[str, str]:
    if not (formatted.startswith(TURN) and formatted.endswith(END)):
        raise ValueError("not a formatted turn")
    role, _, text = formatted[len(TURN) : -len(END)].partition(BODY)
    return unescape(role), unescape(text)


def format_turns(turns: DataFrame, *, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, turn, formatted, loss_start, loss_end (code points in ``formatted``, null if masked out).

    The rows of a conversation lie in one partition in the order of its turns; laid end to
    end they are the formatted conversation.
    """
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = canonical_table(turns).repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        for batch in batches:
            out = [write_turn(r, t) for r, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            learn = [r in loss_roles for r in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([o[0] for o in out], pa.string()), pa.array([o[1] if k else None for o, k in zip(out, learn, strict=True)], pa.int64()), pa.array([o[2] if k else None for o, k in zip(out, learn, strict=True)], pa.int64())],
                ["conv_id", "turn", "formatted", "loss_start", "loss_end"],
            )

    return rows.mapInArrow(run, "conv_id long, turn long, formatted string, loss_start long, loss_end long")


def digests(formatted: DataFrame) -> DataFrame:
    """What reading the formatted conversations back gives, one row per conversation."""

    def run(batches):
        key, state = None, None

        def row(key, s):
            return key, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4]

        for batch in batches:
            done = []
            for conv, text, a, b in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4)), strict=True):
                if state is None or conv != key:
                    if state is not None:
                        done.append(row(key, state))
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, body = read_turn(text)
                state[0] += 1
                state[1].update(f"{role}\n{body}\n".encode())
                state[4] += len(text)
                if a is not None:
                    learnt = unescape(text[a:b])
                    state[2] += len(learnt)
                    state[3].update(learnt.encode())
            if done:
                yield _table(done)
        if state is not None:
            yield _table([row(key, state)])

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
