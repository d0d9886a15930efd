"""Toxicity by a subsequence string kernel, a support vector machine and Nystroem landmarks.

The kernel compares words by their subsequences of three letters that span at most five,
each gap costing a factor ``DECAY``, so inserted letters only weaken a match; signs inside
a word are dropped and spelt-out words (single letters in a row) are joined first.  A
word's start and end count as letters.

A bounded sample of labelled texts is cut into sentences that inherit their text's label.
Landmark words are those most tied to toxic texts and as many plain ones.  Which word of a
sentence, and which sentence of a toxic text, carries the label is latent: it is chosen
by the machine of the round before (by log-odds at first).  The surest words are also trained
on with one and two foreign letters put inside, and plain words alike, so that a gapped insult
scores near the plain one while a gap alone says nothing.

In the span of the landmarks the decision is linear in the subsequences, so the fitted
machine is one table of 64**3 weights, and a text's score is a calibrated maximum over all
its words: whole texts, no sampling, one pass, no shuffle.  Values beyond ``GOAL`` count a
tenth, and the highest hundredth of the untoxic training values, where labels err, is left
out of the calibration.

Defined results: null and empty texts, and those without letters, score as a text without
any sign of toxicity; rows with a null id are held out; repeated rows score alike; extra
columns are kept by ``drop_toxic`` and ignored otherwise; an empty table gives an empty
result; without labels of both classes every score is the share of toxic labels.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abundara.llm.common import lean, slices

SIDE = 64  # letters of the reduced alphabet, 0 being a word's edge
DECAY = 0.7
GAPS = ((1, 1), (1, 2), (2, 1), (1, 3), (2, 2), (3, 1))
FLOOR = -3.0  # decision value of a text without letters
GOAL = 2.0  # decision value that toxic words are to reach; what lies beyond counts a tenth
STRETCH = 1 << 20
GROUP = 1 << 18  # characters of short texts that are scored at a time
SPACE = re.compile(r"\s")


def _alphabet() -> np.ndarray:
    table = np.full(0x3000, 255, np.uint8)
    cp = np.arange(0x3000)
    letters = (cp >= 0xC0) & (cp < 0x2000) & (cp != 0xD7) & (cp != 0xF7)
    table[letters] = 27 + cp[letters] % (SIDE - 27)
    table[97:123] = np.arange(1, 27)
    table[[9, 10, 11, 12, 13, 32, 0xA0, 0x85]] = 0
    return table


def stream(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes of all texts, each word between single zeros, and the position where each text starts (with the end)."""
    table = _alphabet()
    joined = "\n".join(["", *[t.lower().replace("\n", " ") + "\n" for t in texts]])
    cp = np.frombuffer(joined.encode("utf-32-le", "replace"), "<u4")
    code = np.where(cp < 0x3000, table[np.minimum(cp, 0x2FFF)], np.where((cp >= 0x3040) & (cp < 0xD800), 27 + cp % (SIDE - 27), 255)).astype(np.uint8)
    mark = np.cumsum(cp == 10)  # the text number: two marks a text, one before and one after
    keep = code != 255
    code, mark = code[keep], mark[keep]
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 0) | (code[:-1] != 0)
    code, mark = code[keep], mark[keep]
    edge = np.flatnonzero(code == 0)
    if len(edge) > 3:  # join runs of at least three one-letter words of a text
        single = np.diff(edge) == 2
        same = mark[edge[1:-1] - 1] == mark[edge[1:-1] + 1] if len(edge) > 2 else np.zeros(0, bool)
        link = single[:-1] & single[1:] & same
        run = np.zeros(len(link) + 2, bool)
        run[1:-1] = link
        strong = run[1:-1] & (run[:-2] | run[2:])
        drop = np.zeros(len(code), bool)
        drop[edge[1:-1][strong]] = True
        code, mark = code[~drop], mark[~drop]
    return code, np.searchsorted(mark, 2 * np.arange(len(texts) + 1) + 1)


def subsequences(code: np.ndarray):
    """For each gap pattern: positions of the middle letter, the subsequence's number and its weight."""
    inner = code != 0
    for a, b in GAPS:
        n = len(code) - a - b
        if n <= 0:
            continue
        ok = inner[a : a + n].copy()
        for k in range(1, a + b):
            if k != a:
                ok &= inner[k : k + n]
        first = np.flatnonzero(ok)
        number = (code[first].astype(np.int32) * SIDE + code[first + a]) * SIDE + code[first + a + b]
        yield first + a, number, DECAY ** (a + b - 2)


def word_values(code: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each word and its kernel value against the weight table, normalised."""
    value, norm = np.zeros(len(code), np.float32), np.zeros(len(code), np.float32)
    for middle, number, w in subsequences(code):
        value[middle] += np.float32(w) * weights[number]  # a middle occurs once a pattern
        norm[middle] += np.float32(w * w)
    start = np.flatnonzero((code[1:] != 0) & (code[:-1] == 0)) + 1
    if not len(start):
        return start, np.zeros(0, np.float32)
    return start, np.add.reduceat(value, start) / np.sqrt(np.maximum(np.add.reduceat(norm, start), 1e-6))


def text_values(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """The largest word value of each text (less than any if it has no words)."""
    code, at = stream(texts)
    start, value = word_values(code, weights)
    first = np.searchsorted(start, at)
    out = np.full(len(texts), -np.inf, np.float32)
    some = np.flatnonzero(first[:-1] < first[1:])
    if len(some):
        out[some] = np.maximum.reduceat(value, first[:-1][some])
    return out


def pieces(text: str):
    """A text in stretches cut at white space."""
    at = 0
    while len(text) - at > STRETCH:
        to = max(text.rfind(" ", at, at + STRETCH), text.rfind("\n", at, at + STRETCH))
        if to <= at:
            found = SPACE.search(text, at + STRETCH)
            to = found.start() if found else len(text)
        yield text[at:to]
        at = to
    yield text[at:]


def bounded(value: np.ndarray) -> np.ndarray:
    """Decision values from FLOOR up, flattened above GOAL: a text is not surer for one very plain insult."""
    value = np.maximum(value, FLOOR)
    return np.minimum(value, GOAL) + 0.1 * np.maximum(value - GOAL, 0)


class Model:
    """A weight table, a bias, and the slope and shift that make a decision value a probability."""

    def __init__(self, weights, bias: float, slope: float, shift: float):
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift

    def scores(self, texts: list[str]) -> np.ndarray:
        best = np.full(len(texts), -np.inf, np.float32)
        held, owner, size = [], [], 0
        for k, text in enumerate([*texts, None]):
            for piece in pieces(text) if text is not None else ():
                held.append(piece)
                owner.append(k)
                size += len(piece)
            if held and (size >= GROUP or text is None):
                np.maximum.at(best, owner, text_values(held, self.weights))
                held, owner, size = [], [], 0
        value = bounded(best.astype(np.float64) + self.bias)
        return 1 / (1 + np.exp(-(self.slope * value + self.shift)))


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, goal: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Primal squared-hinge machine by Newton steps, each row to reach its ``goal``; the last column of x is the constant one."""
    ridge = np.full(x.shape[1], 1.0)
    ridge[-1] = 1e-3

    def margin(w):
        return y * (x @ w.astype(np.float32))

    def loss(w):
        return 0.5 * ridge @ (w * w) + 0.5 * cost @ np.maximum(0, goal - margin(w)) ** 2

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(rounds):
        active = margin(w) < goal
        left, right = np.diag(ridge), np.zeros(x.shape[1])
        for k in range(0, len(x), 2048):  # a few rows at a time: no second copy of x
            some = np.flatnonzero(active[k : k + 2048]) + k
            xa = x[some] * np.sqrt(cost[some])[:, None].astype(np.float32)
            left += xa.T @ xa
            right += xa.T @ (np.sqrt(cost) * y * goal)[some].astype(np.float32)
        step = np.linalg.solve(left, right) - w
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > now:
            size /= 2
        before, w = now, w + size * step
        now = loss(w)
        if before - now < 1e-7 * before:
            break
    return w


def _calibrate(value: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic slope and shift, lightly smoothed targets as usual for this fit."""
    # labels err: the highest hundredth of the untoxic values is left out
    keep = y | (value <= np.quantile(value[~y], 0.99))
    value, y = value[keep], y[keep]
    n1, n0 = y.sum(), (~y).sum()
    target = np.where(y, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([value, np.ones(len(value))], 1)
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (target - p) - 1e-3 * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def _groups(texts: list[str], size: int = 1 << 19):
    """Texts in lists of about ``size`` characters."""
    held, n = [], 0
    for text in texts:
        held.append(text)
        n += len(text)
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def _ends(texts: list[str], words: int) -> np.ndarray:
    """Whether a sentence ends after each word, by evenly spreading a text's sentence ends where words were joined."""
    out = np.zeros(words, np.int32)
    at = 0
    for text in texts:
        code, _ = stream([text])
        n = int(((code[1:] != 0) & (code[:-1] == 0)).sum())
        stops = [bool(re.search(r"[.!?\n]", g)) for g in re.findall(r"[^\w]+", text + ".")]
        if n:
            spot = (np.flatnonzero(stops) * n // max(1, len(stops))).clip(0, n - 1)
            out[at + spot] = 1
        at += n
    return out


def gapped(words: list[bytes], letters: int, times: int, rng: np.random.Generator) -> list[bytes]:
    """Coded words with foreign letters put between their own, ``times`` forms of each word of four letters or more."""
    out = []
    for word in words:
        for _ in range(times if len(word) >= 4 else 0):
            form = word
            for _ in range(letters):
                at = int(rng.integers(1, len(form)))
                form = form[:at] + bytes([int(rng.integers(1, 27))]) + form[at:]
            out.append(form)
    return out


def fit(texts: list[str], toxic: list[bool], *, landmarks: int = 512, rounds: int = 4, hard: int = 6_000, penalty: float = 2000.0, forms: int = 24) -> Model:
    """Train on whole texts with labels; see the module's text."""
    y = np.array(toxic, bool)
    if not len(y) or y.all() or not y.any():
        share = float(np.clip(y.mean() if len(y) else 0.0, 1e-6, 1 - 1e-6))
        return Model(np.zeros(SIDE**3, np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))
    kinds: dict[bytes, int] = {}
    codes, kind, doc, done = [], [], [], 0
    for group in _groups(texts):  # small groups: few temporaries at once
        code, at = stream(group)
        start = np.flatnonzero((code[1:] != 0) & (code[:-1] == 0)) + 1
        end = np.flatnonzero((code[1:] == 0) & (code[:-1] != 0)) + 1
        raw = code.tobytes()
        kind.append(np.fromiter((kinds.setdefault(raw[a:b], len(kinds)) for a, b in zip(start.tolist(), end.tolist(), strict=True)), np.int32, len(start)))
        doc.append((done + np.searchsorted(at, start, side="right") - 1).astype(np.int32))
        codes.append(code)
        done += len(group)
    kind, doc = np.concatenate(kind), np.concatenate(doc)
    pairs = np.unique(kind.astype(np.int64) * len(y) + doc)
    of, where = (pairs // len(y)).astype(np.int32), (pairs % len(y)).astype(np.int32)
    del pairs
    hits, all_ = np.bincount(of, y[where], len(kinds)), np.bincount(of, minlength=len(kinds))
    odds = (np.log((hits + 0.1) / (y.sum() + 1)) - np.log((all_ - hits + 0.1) / ((~y).sum() + 1))).astype(np.float32)
    share = y.mean()
    excess = (hits - share * all_) / np.sqrt(share * (1 - share) * all_)  # in standard deviations
    tied = np.where((excess >= 5.5) & (odds >= 2), excess, 0)
    chosen = np.argsort(-tied, kind="stable")[: landmarks // 2]
    chosen = chosen[tied[chosen] > 0]
    plain = np.argsort(-np.where(odds < 0.5, all_, 0), kind="stable")[: landmarks // 4]
    names = list(kinds)

    def table(ids):
        """Normalised subsequence weights of words, as (row, number, weight)."""
        words = np.frombuffer(b"\0" + b"\0".join(names[i] for i in ids) + b"\0", np.uint8)
        row = np.cumsum(words == 0) - 1
        norm = np.zeros(len(ids))
        parts = [(row[m], n, np.full(len(m), w)) for m, n, w in subsequences(words)]
        r, n, w = (np.concatenate(x) for x in zip(*parts, strict=True))
        np.add.at(norm, r, w * w)
        return r, n, w / np.sqrt(np.maximum(norm, 1e-6))[r]

    def space(ids):
        """The subsequences of the landmarks and, for each, its weight in the landmarks and in their orthonormal span."""
        r, n, w = table(ids)
        used, column = np.unique(n, return_inverse=True)
        phi = np.zeros((len(used), len(ids)), np.float32)
        np.add.at(phi, (column, r), w)
        values, vectors = np.linalg.eigh((phi.T @ phi).astype(np.float64))
        good = values > 1e-5 * values[-1]
        return used, phi @ (vectors[:, good] / np.sqrt(values[good])).astype(np.float32)

    def embed(ids, used, basis):
        """Rows of the words in the span, with a last column of ones."""
        out = np.ones((len(ids), basis.shape[1] + 1), np.float32)
        out[:, :-1] = 0
        for k in range(0, len(ids), 256):
            r, n, w = table(ids[k : k + 256])
            spot = np.minimum(np.searchsorted(used, n), len(used) - 1)
            order = np.argsort(r, kind="stable")
            part = basis[spot[order]] * (w * (used[spot] == n))[order, None].astype(np.float32)
            out[k : k + 256, :-1][r[order][np.append(True, np.diff(r[order]) > 0)]] = np.add.reduceat(part, np.flatnonzero(np.append(True, np.diff(r[order]) > 0)))
        return out

    # a sentence ends at a line end or full stop; it inherits its text's label, and which of its words carry it is latent
    sentence = (np.concatenate([[0], np.cumsum(_ends(texts, len(kind)))])[:-1] + doc).astype(np.int32)
    del of, where
    plain_words = np.unique(plain[odds[plain] < 0.5])
    value, weights, bias = odds[kind], np.zeros(SIDE**3, np.float32), 0.0
    pool = np.zeros(0, np.int64)
    tied_kinds = np.flatnonzero(tied > 0)
    # gapped forms of the surest words are trained on too, and of plain words: a gap alone is no sign of toxicity
    rng, sure = np.random.default_rng(5), chosen[tied[chosen] >= 0.5 * tied.max(initial=0)][:64]
    forms_toxic, forms_plain = ([v for n in (1, 2) for v in gapped([names[i] for i in some], n, n * times, rng) if v not in kinds] for some, times in ((sure, forms), (plain, max(1, forms // 8))))
    gaps_toxic, gaps_plain = len(names) + np.arange(len(forms_toxic)), len(names) + len(forms_toxic) + np.arange(len(forms_plain))
    names += forms_toxic + forms_plain
    for turn in range(rounds):
        best = np.full(len(y), -np.inf)
        np.maximum.at(best, doc, value)
        order = np.lexsort((odds[kind], value, doc))
        witness = order[np.append(doc[order][1:] != doc[order][:-1], True)]
        lost = witness[y[doc[witness]] & (best[doc[witness]] <= (0 if turn else 2)) & (hits[kind[witness]] >= 2) & (odds[kind[witness]] >= 3)]
        positive = np.union1d(tied_kinds, kind[lost])
        order = np.lexsort((value, sentence))
        of_sentence = order[np.append(sentence[order][1:] != sentence[order][:-1], True)]
        rest = of_sentence[~y[doc[of_sentence]]]
        rest = kind[rest[np.argsort(-value[rest], kind="stable")[:hard]]]
        pool = np.concatenate([pool, rest])
        negative, times = np.unique(np.concatenate([pool, plain_words]), return_counts=True)
        keep = ~np.isin(negative, positive)
        negative, times = negative[keep], times[keep]
        ids = np.concatenate([positive, gaps_toxic, negative, gaps_plain])
        mistaken = rest[: 4 * landmarks]
        mistaken = mistaken[np.sort(np.unique(mistaken, return_index=True)[1])][: landmarks // 2]
        used, basis = space(np.unique(np.concatenate([chosen, plain, kind[lost], mistaken, gaps_toxic[::4]])))
        x = embed(ids, used, basis)
        worth = np.sqrt(np.maximum(hits[positive], 1))
        gap_cost = (np.full(len(g), 2 / max(1, len(g))) for g in (gaps_toxic, gaps_plain))
        cost = np.concatenate([worth / worth.sum(), next(gap_cost), np.sqrt(times) / np.sqrt(times).sum(), next(gap_cost)]) * penalty
        sides = [len(positive) + len(gaps_toxic), len(negative) + len(gaps_plain)]
        solved = _svm(x, np.repeat([1.0, -1.0], sides), cost, np.repeat([GOAL, 1.25 * GOAL, 1.0], [len(positive), len(gaps_toxic), sides[1]]))
        weights = np.zeros(SIDE**3, np.float32)
        weights[used] = basis @ solved[:-1]
        bias = float(solved[-1])
        value = np.concatenate([word_values(code, weights)[1] for code in codes]) + bias
    best = np.full(len(y), FLOOR)
    np.maximum.at(best, doc, np.maximum(value, FLOOR))
    return Model(weights, bias, *_calibrate(bounded(best), y))


def held_out(id_):
    """Rows that never train: crc32 of the id's text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(id_.cast("long").cast("string")) % 3 == 1, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 4000, max_chars: int = 20_000, **options) -> Model:
    """Fit on at most ``max_rows`` labelled texts (the least digests of their ids) of at most ``max_chars`` characters."""
    marks = labels.where("toxic is not null").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.max("toxic").alias("toxic"))
    marks = marks.where(~held_out(F.col("label_id"))).withColumn("lot", F.md5(F.col("label_id").cast("string"))).orderBy("lot").limit(2 * max_rows)
    texts = docs.where(F.length(text_col) <= max_chars).select(F.col(id_col).cast("long").alias("label_id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(marks), "label_id").orderBy("lot", "text").limit(max_rows).select("text", "toxic").collect()
    return fit([r.text for r in rows], [r.toxic == 1 for r in rows], **options)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""

    def run(batches):
        for batch in slices(batches):
            s = model.scores(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.coalesce(text_col, F.lit("")).alias("text"))
    return rows.mapInArrow(lean(run), "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` without the rows scoring ``threshold`` or more."""
    place = [c.lower() for c in docs.columns].index(text_col.lower())

    def run(batches):
        for batch in slices(batches):
            keep = model.scores([t or "" for t in batch.column(place).to_pylist()]) < threshold
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(lean(run), docs.schema)
