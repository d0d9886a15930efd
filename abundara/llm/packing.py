"""Hierarchical multi-length packing.

Documents are tokenised and cut into whole windows plus a remainder, and the remainder is
routed to the smallest context tier that holds it.  Tiers are packed one by one from the
longest: a tier's document opens a window of the tier's size, and the window's gap is filled
from documents of shorter tiers, by one or two that fit exactly if there are such, else by
the largest that fit; documents of the shortest tier fill each other's windows.  Windows left
with a gap are laid end to end and cut, and the last part of a window goes on to the next
tier; after the shortest tier it closes in powers of two, so nothing is padded.  Sequences
are then dealt to step groups of near-equal attention cost.

Every task packs what it reads, in blocks of bounded size: no shuffle, no driver state,
memory bounded by ``block_tokens`` plus one document, and a lost task is simply rerun.
The price is a few short closing sequences a task and block.

Defined results: a null or empty text is one piece holding only the end id; a null id is
kept as null; repeated rows are packed once each; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import array
import json
import re
import zlib
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abundara.llm.common import give_back, lean

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, tier long, step_group long"
)

#: The pre-tokeniser's pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ChunkEncoder(dict):
    """Text to little-endian unsigned 32-bit ids, memoised by the chunk between two spaces.

    The pre-tokeniser may be cut before any space that has a non-space on one side at
    least, so ids of such chunks are independent of their surroundings.  Texts that hold a
    space between white space, or the literal text of a special token, are encoded whole.
    """

    def __init__(self, path: str, max_entries: int = 250_000):
        import tiktoken

        super().__init__()
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        named = set(self.special)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        spare = (b for b in range(256) if b not in set(shown))
        to_byte = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(spare)}
        ranks = {bytes(to_byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in named}
        chunks = tiktoken.Encoding("chunks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.short = chunks.encode_ordinary
        self.letters = chunks._core_bpe.encode_single_piece
        self.marks = {m: array.array("I", chunks.encode_ordinary(m)).tobytes() for m in ".,;:!?"}
        self.odd = re.compile(r"\s \s").search
        self.max_entries = max_entries

    @cached_property
    def whole(self):
        """The tokeniser itself, loaded only where a text needs it: it takes much memory."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def __missing__(self, chunk: str) -> bytes:
        mark = self.marks.get(chunk[-1:], b"")
        body = chunk[:-1] if mark else chunk
        if body.isalpha():  # one piece of letters, then at most one mark
            ids = array.array("I", self.letters(f" {body}".encode())).tobytes() + mark
        else:
            ids = array.array("I", self.short(" " + chunk)).tobytes()
        if len(self) < self.max_entries and len(chunk) <= 64:
            self[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return array.array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        if self.odd(text):
            return array.array("I", self.short(text)).tobytes()
        first, _, rest = text.partition(" ")
        head = array.array("I", self.short(first)).tobytes()
        return head + b"".join(map(self.__getitem__, rest.split(" "))) if _ else head


class Shelf:
    """Pieces (document, start) by their length, shorter than ``size``."""

    def __init__(self, size: int):
        self.pieces: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        self.some = np.zeros(size, bool)

    def put(self, n: int, piece: tuple[int, int]) -> None:
        self.pieces[n].append(piece)
        self.some[n] = True

    def take(self, n: int) -> tuple[int, int, int]:
        d, at = self.pieces[n].pop()
        self.some[n] = bool(self.pieces[n])
        return d, at, n

    def largest(self, most: int) -> int:
        """The longest piece of at most ``most``, 0 if there is none."""
        found = np.flatnonzero(self.some[: most + 1])
        return int(found[-1]) if len(found) else 0

    def fit(self, gap: int) -> int:
        """The piece to put into a gap: the whole of it, or one whose other part is there too, or the largest."""
        if gap < len(self.some) and self.some[gap]:
            return gap
        most = min(gap, len(self.some)) - 1
        first = self.some[gap - most : most + 1] if most >= gap - most > 0 else self.some[:0]
        both = np.flatnonzero(first & first[::-1])  # lengths m with a piece of m and one of gap - m
        for k in both[::-1].tolist():
            m = gap - most + k
            if 2 * m != gap or len(self.pieces[m]) > 1:
                return m
        return self.largest(gap)


def plan(lengths: list[int], window: int, tiers: tuple[int, ...], closing: tuple[int, ...] = ()) -> list[tuple[list[tuple[int, int, int]], int]]:
    """Pieces (document, start, length) of each sequence, and the sequence's tier or closing size; what is left then is one padded window."""
    out: list[tuple[list[tuple[int, int, int]], int]] = []
    shelf = Shelf(window)
    for d in sorted(range(len(lengths)), key=lambda d: (lengths[d], d)):
        n = lengths[d]
        whole = n - n % window
        out += [([(d, at, window)], window) for at in range(0, whole, window)]
        if n > whole:
            shelf.put(n - whole, (d, whole))
    line: list[tuple[int, int, int]] = []  # pieces of windows that were left with a gap

    def lay(size: int) -> None:
        """Whole sequences of ``size`` from the line's start."""
        nonlocal line
        count, k, used = sum(n for _, _, n in line) // size, 0, 0
        for _ in range(count):
            row, gap = [], size
            while gap:
                d, at, n = line[k]
                m = min(gap, n - used)
                row.append((d, at + used, m))
                gap, used = gap - m, used + m
                if used == n:
                    k, used = k + 1, 0
            out.append((row, size))
        if k < len(line) and used:
            d, at, n = line[k]
            line = [(d, at + used, n - used), *line[k + 1 :]]
        else:
            line = line[k:]

    for number, size in enumerate(tiers):
        shorter = tiers[number + 1] if number + 1 < len(tiers) else 0
        while (n := shelf.largest(min(size, window - 1))) > shorter:
            row, gap = [shelf.take(n)], size - n
            while gap and (m := shelf.fit(gap)):
                row.append(shelf.take(m))
                gap -= m
            if gap:
                line += row
            else:
                out.append((row, size))
        lay(size)
    for size in closing:
        lay(size)
    return [*out, (line, window)] if line else out


def step_groups(costs: list[int], per_step: int) -> list[int]:
    """Groups of ``per_step`` sequences, dealt back and forth by falling cost so that steps take alike."""
    steps = max(1, -(-len(costs) // per_step))
    group = [0] * len(costs)
    for rank, s in enumerate(sorted(range(len(costs)), key=lambda s: (-costs[s], s))):
        turn, place = divmod(rank, steps)
        group[s] = place if turn % 2 == 0 else steps - 1 - place
    return group


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 2048,
    tiers: tuple[int, ...] = (2048, 1024, 512),
    closing: tuple[int, ...] = (256, 128, 64, 32, 16, 8, 4, 2, 1),
    end_id: int = 1,
    per_step: int = 8,
    block_tokens: int = 1_000_000,
) -> DataFrame:
    """One row per piece, see the module's text; ``tiers`` are powers of two falling from ``window``, ``closing`` those that end a block."""
    end = array.array("I", [end_id]).tobytes()

    def pack(batches):
        encode = ChunkEncoder(tokenizer_path).encode
        give_back()  # what the vocabulary's reading took
        task = TaskContext.get().partitionId() << 32
        seen = steps = held = 0
        ids, keys = [], []

        def flush():
            nonlocal seen, steps
            rows: list[list] = [[] for _ in range(9)]
            rest = plan([len(x) // 4 for x in ids], window, tiers, closing)
            groups = step_groups([sum(n * n for _, _, n in pieces) for pieces, _ in rest], per_step)
            for (pieces, tier), group in zip(rest, groups, strict=True):
                at = 0
                for d, start, n in pieces:
                    crc = zlib.crc32(ids[d][4 * start : 4 * (start + n)])
                    for column, value in zip(rows, (keys[d], start, n, crc, len(ids[d]) // 4, task + seen, at, tier, task + steps + group), strict=True):
                        column.append(value)
                    at += n
                seen += 1
            steps += max(groups, default=-1) + 1
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names)

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                ids.append(encode(text.as_py()) + end)
                keys.append(key.as_py())
                held += len(ids[-1]) // 4
                if held >= block_tokens:
                    yield flush()
                    ids, keys, held = [], [], 0
        if ids:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(lean(pack), SCHEMA)
