"""Long repeats across documents by recompression.

Each text is a sequence of word symbols.  One round names every run of a word, then
rounds name pairs: every symbol falls on the left or right side by its name, and a left
symbol followed by a right one becomes one symbol of the next level.  Names are 64-bit
digests of what they stand for, so all tasks agree on them without an exchange, and equal
substrings get equal symbols except near their ends.

For each symbol the parse also keeps its support, the stretch of words that decides it.
A window's interior symbols are those whose support lies inside it; equal windows have equal
ones.  Its anchor is ``symbols`` of them in a row, of the highest level that has so many: the
one of the least name and its followers (its predecessors at the window's end), or the window's
own digest if no level has any.  The anchor is a function of the window's words alone, so
looking only at anchors that two texts share loses nothing.  Windows at shared anchors are then
compared by 128-bit digests of their words.  Windows of 13 words leave room for two rounds of
pairs, that is for symbols of up to four runs.

Anchors, windows and texts are joined by key; first occurrences are grouped minima
combined before the shuffle, and a hot anchor's or window's rows are split by adaptive
joins.  Texts equal as wholes are settled by their digest first.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abundara.llm.common import cut, discard, text_bytes

_MIX, _MUL, _ADD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Bytes of text parsed at once; a longer text is parsed alone.
STRETCH = 2 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MUL
    x = (x ^ (x >> np.uint64(27))) * _ADD
    return x ^ (x >> np.uint64(31))


def word_names(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Digests of all words of all texts, and where each text starts (with the end)."""
    digest = xxhash.xxh3_64_intdigest
    split = [t.split() for t in texts]
    starts = np.concatenate(([0], np.cumsum([len(w) for w in split]))).astype(np.int64)
    names = np.fromiter((digest(w) for words in split for w in words), np.uint64, starts[-1])
    return names, starts


def parse(words: np.ndarray, starts: np.ndarray, rounds: int):
    """(name, lo, hi, start) of each level's symbols, lowest first; a support reaching past its text lies in no window."""
    n = len(words)
    first = np.zeros(n, bool)
    first[starts[:-1][starts[:-1] < n]] = True
    new = first.copy()
    new[1:] |= words[1:] != words[:-1]
    s = np.flatnonzero(new)
    e = np.append(s[1:], n)
    name = _mix(words[s] + (e - s).astype(np.uint64) * _MIX)
    lo, hi, head = s - 1, e + 1, first[s]
    levels = [(name, lo, hi, s)]
    for level in range(1, rounds + 1):
        left = (_mix(name + np.uint64(level * int(_ADD) % (1 << 64))) & np.uint64(1)).astype(bool)
        joins = np.zeros(len(name), bool)
        joins[:-1] = left[:-1] & ~left[1:] & ~head[1:]
        second = np.zeros(len(name), bool)
        second[1:] = joins[:-1]
        nlo, nhi = lo.copy(), hi.copy()
        alone_r, alone_l = ~left & ~second, left & ~joins
        back = np.flatnonzero(alone_r[1:]) + 1
        nlo[back] = np.minimum(nlo[back], np.where(head[back], nlo[back], lo[back - 1]))
        fore = np.flatnonzero(alone_l[:-1])
        nhi[fore] = np.maximum(nhi[fore], np.where(head[fore + 1], nhi[fore], hi[fore + 1]))
        j = np.flatnonzero(joins)
        nhi[j] = hi[j + 1]
        name = name.copy()
        name[j] = _mix(_mix(name[j] * _MIX + np.uint64(level)) + name[j + 1])
        keep = ~second
        name, lo, hi, head, s = name[keep], nlo[keep], nhi[keep], head[keep], s[keep]
        levels.append((name, lo, hi, s))
    return levels


def window_starts(starts: np.ndarray, window: int) -> np.ndarray:
    """Which words start a window of one text."""
    ok = np.zeros(starts[-1], bool)
    size = np.diff(starts)
    if len(ok):
        ok[:] = np.repeat(starts[1:], size) - np.arange(starts[-1]) >= window
    return ok


def window_digest(words: np.ndarray, at: np.ndarray, window: int, salt: int) -> np.ndarray:
    total = np.full(len(at), salt, np.uint64)
    for k in range(window):
        total = _mix(total * _MIX + words[at + k])
    return total


def anchors(words: np.ndarray, starts: np.ndarray, window: int, rounds: int, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions that start a window, and each window's anchor."""
    n = len(words)
    at = np.flatnonzero(window_starts(starts, window))
    best = np.zeros(len(at), np.uint64)
    open_ = np.arange(len(at))
    levels = parse(words, starts, rounds) if len(at) else []
    for level, (name, lo, hi, _) in reversed(list(enumerate(levels))):
        if not len(open_):
            break
        before = np.cumsum(np.bincount(lo + 1, minlength=n + 2))
        ends = np.cumsum(np.bincount(np.minimum(hi, n + 1), minlength=n + 2))
        w = at[open_]
        first, last = before[w], ends[np.minimum(w + window, n + 1)] - 1  # the symbols whose support lies in the window
        some = last - first >= (symbols - 1 if level else 0)
        rank = _mix(name + np.uint64((level + 1) * int(_MUL) % (1 << 64)))
        got, first, last = open_[some], first[some], last[some]
        least, where = rank[first], first.copy()
        k = 1
        more = np.flatnonzero(first + k <= last)
        while len(more):
            other = rank[first[more] + k]
            better = more[other < least[more]]
            least[more] = np.minimum(least[more], other)
            where[better] = first[better] + k
            k += 1
            more = more[first[more] + k <= last[more]]
        # the symbol of the least name and those after it, or before it at the window's end
        begin = np.maximum(first, np.minimum(where, last - symbols + 1))
        total = np.full(len(got), level + 1, np.uint64)
        for k in range(symbols):
            there = begin + k <= last
            total = np.where(there, _mix(total * _MIX + name[np.minimum(begin + k, len(name) - 1)]), total)
        best[got] = total
        open_ = open_[~some]
    if len(open_):
        best[open_] = window_digest(words, at[open_], window, 7)
    return at, best


def _stretches(batches, width: int):
    """Lists of rows (tuples) holding about STRETCH bytes of text, the last column."""
    held, size = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held.append(row)
            size += len(row[width])
            if size >= STRETCH:
                yield held
                held, size = [], 0
    if held:
        yield held


def repeated_windows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 13, rounds: int = 2, symbols: int = 3) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 and removed.

    ``removed`` holds the starts (in words, from 0) of windows whose words also start in a
    row of smaller id.  Every word that one covers is removed; the digest is that of the
    other words, joined by one space.  Null and empty texts have no words.  Rows with a
    null id keep everything and remove nothing elsewhere; repeated rows share an id and so
    do not remove each other; other columns are ignored; an empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    source = source.select("doc_id", F.xxhash64("text").alias("row"), "text")

    def scan(batches):
        serial = TaskContext.get().partitionId() << 40
        for rows in _stretches(batches, 2):
            names, starts = word_names([r[2] for r in rows])
            at, best = anchors(names, starts, window, rounds, symbols)
            cuts = np.searchsorted(at, starts)
            out = [np.unique(best[a:b]).view(np.int64) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in out]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(serial, serial + len(rows))),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array(np.diff(starts)),
                    pa.array([hashlib.sha256(b" ".join(r[2].split())).hexdigest() for r in rows]),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(out))),
                ],
                ["rid", "doc_id", "row", "n_words", "whole", "anchors"],
            )
            serial += len(rows)

    def compare(batches):
        for rows in _stretches(batches, 3):
            names, starts = word_names([r[3] for r in rows])
            at, best = anchors(names, starts, window, rounds, symbols)
            cuts = np.searchsorted(at, starts)
            hits = []
            for a, b, r in zip(cuts[:-1], cuts[1:], rows, strict=True):
                hits.append(a + np.flatnonzero(np.isin(best[a:b].view(np.int64), np.array(r[2], np.int64))))
            count = [len(h) for h in hits]
            pos = at[np.concatenate(hits)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array([r[0] for r in rows], np.int64), count)),
                    pa.array(np.repeat(np.array([r[1] for r in rows], np.int64), count)),
                    pa.array(pos - np.repeat(starts[:-1], count)),
                    pa.array(window_digest(names, pos, window, 1).view(np.int64)),
                    pa.array(window_digest(names, pos, window, 2).view(np.int64)),
                ],
                ["rid", "doc_id", "at", "h1", "h2"],
            )

    def keep(batches):
        for rows in _stretches(batches, 2):
            gone, digest = [], []
            for _, removed, text in rows:
                words = text.split()
                depth = np.zeros(len(words) + 1, np.int64)
                starts = np.array(removed, np.int64)
                np.add.at(depth, starts, 1)
                np.add.at(depth, starts + window, -1)
                stay = np.cumsum(depth)[:-1] == 0
                gone.append(int(len(words) - stay.sum()))
                digest.append(hashlib.sha256(b" ".join(w for w, s in zip(words, stay.tolist(), strict=True) if s)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array(gone, pa.int64()), pa.array(digest), pa.array([r[1] for r in rows], pa.list_(pa.int64()))],
                ["rid", "gone", "digest", "removed"],
            )

    scanned = cut(source.mapInArrow(scan, "rid long, doc_id long, row long, n_words long, whole string, anchors array<long>"))
    marked = _copies(scanned)
    wanted = _shared_anchors(scanned, marked)
    discard(scanned)
    windows = cut(
        wanted.join(source, ["doc_id", "row"]).select("rid", "doc_id", "wanted", "text")
        .mapInArrow(compare, "rid long, doc_id long, at long, h1 long, h2 long")
    )
    discard(wanted)
    removed = _repeats(windows, marked)
    discard(windows)
    cleaned = cut(
        removed.join(source, ["doc_id", "row"]).select("rid", "removed", "text")
        .mapInArrow(keep, "rid long, gone long, digest string, removed array<long>").dropDuplicates(["rid"])
    )
    whole_gone = F.col("copy") & (F.col("n_words") >= window)
    nothing = hashlib.sha256(b"").hexdigest()
    return marked.join(cleaned, "rid", "left").select(
        "doc_id",
        "n_words",
        F.when(whole_gone, F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole_gone, F.lit(nothing)).otherwise(F.coalesce("digest", "whole")).alias("kept_sha256"),
        F.when(whole_gone, F.sequence(F.lit(0).cast("long"), F.col("n_words") - window)).otherwise(F.col("removed")).alias("removed"),
    )


def _copies(scanned: DataFrame) -> DataFrame:
    """The rows without their anchors, marking those whose words all stand in a row of smaller id."""
    earliest = cut(scanned.groupBy("whole").agg(F.min("doc_id").alias("first_id")))  # written: a hot text's rows can be split
    rows = scanned.drop("anchors").join(earliest, "whole")
    copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)).alias("copy")
    return cut(rows.select("rid", "doc_id", "row", "n_words", "whole", copy))


def _shared_anchors(scanned: DataFrame, marked: DataFrame) -> DataFrame:
    """(rid, doc_id, row, wanted): the anchors that each row, unless a copy, shares with a row of another id."""
    placed = scanned.where("doc_id is not null").select("rid", F.explode("anchors").alias("anchor"))
    shared = placed.groupBy("anchor").agg(F.count("*").alias("rows")).where("rows > 1").select("anchor")  # a row has an anchor once
    shared = cut(shared)  # both sides of the join are then plain exchanges, which adaptive execution can split
    lists = placed.join(shared, "anchor").groupBy("rid").agg(F.collect_list("anchor").alias("wanted"))
    rows = marked.where("not copy").select("rid", "doc_id", "row")
    return cut(lists.join(rows, "rid").select("rid", "doc_id", "row", "wanted"))


def _repeats(windows: DataFrame, marked: DataFrame) -> DataFrame:
    """(rid, doc_id, row, removed): starts of the windows that a row of smaller id holds too."""
    least = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("lo"), F.count("*").alias("rows")).where("rows > 1").select("h1", "h2", "lo")
    least = cut(least)
    repeats = windows.join(least, ["h1", "h2"]).where("doc_id > lo").select("rid", "at")
    lists = repeats.groupBy("rid").agg(F.sort_array(F.collect_set("at")).alias("removed"))
    return cut(lists.join(marked.select("rid", "doc_id", "row"), "rid").select("rid", "doc_id", "row", "removed"))
