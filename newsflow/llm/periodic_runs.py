"""Runs (maximal repetitions) of words in whole texts, by Lyndon roots.

A run of smallest period q holds a word of q symbols that is the longest Lyndon word at its place, under one of the two
orders of the alphabet (an order and its reverse); so the longest Lyndon words of all places, under both, name every run.
They come from the first phase of Baier's suffix sorting: suffixes are grouped by their first symbol; groups are taken
from the highest to the lowest; each suffix of a group counts for the nearest earlier suffix of a lower group, and a
suffix counted k times moves to a new group right above its own, its prefix longer by k times the group's.  When a group's
turn comes, the prefix of its suffixes is their longest Lyndon word: the Lyndon array, without sorting the suffixes.
Candidates (place, length) are then extended to both sides as far as symbols a period apart agree (longest common
extensions, by hashes of prefixes and bisection); every extension is compared symbol by symbol before it counts.

Only runs of an exponent of at least ``min_exponent`` are kept, so a word that occurs less often in its stretch is in
none of them and cuts the text; what is left between such words, in all texts of a batch, is sorted at once.

Defined results: null text has no words; rows are independent, so repeated rows give equal results; other columns are
ignored.  A map over the rows without a shuffle; a text's words are held with it, and a few texts together.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import map_batches

MIN_EXPONENT, MIN_LENGTH = 4, 6
_ROWS, _CHARS = 256, 1 << 20


# ---- Lyndon arrays ---------------------------------------------------------------------------------------------------


def lyndon_array(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon word at every place of a symbol > 0; symbol 0 separates texts, its places get 0."""
    n = len(symbols)
    places: dict[int, list[int]] = {}
    for i, s in enumerate(symbols):
        if s:
            places.setdefault(s, []).append(i)
    # groups form a list from low to high; group 0 is its end, and that of the separators
    members: list[list[int]] = [[]] + [places[s] for s in sorted(places)]
    length = [0] + [1] * (len(members) - 1)
    below = [0, *range(len(members) - 1)]
    above = [*range(1, len(members)), 0]
    top = len(members) - 1
    group = [0] * n
    for g in range(1, len(members)):
        for i in members[g]:
            group[i] = g
    lower = list(range(-1, n - 1))  # of a suffix whose group was taken: the nearest earlier one of a lower group
    taken = bytearray(n)
    g = top
    while g:
        here = [i for i in members[g] if group[i] == g]
        members[g] = []
        if here:
            here.sort()
            for i in here:
                taken[i] = 1
            size = length[g]
            times: dict[int, int] = {}
            for i in here:
                p = i - 1
                while p >= 0 and taken[p]:
                    p = lower[p]
                lower[i] = p
                if p >= 0 and symbols[p]:
                    times[p] = times.get(p, 0) + 1
            if times:
                made: dict[tuple[int, int], int] = {}
                for p, k in times.items() if len(times) == 1 else sorted(times.items(), key=lambda x: -x[1]):
                    old = group[p]
                    new = made.get((old, k))
                    if new is None:
                        new = made[(old, k)] = len(members)
                        members.append([])
                        length.append(length[old] + k * size)
                        up = above[old]
                        below.append(old)
                        above.append(up)
                        above[old] = new
                        if up:
                            below[up] = new
                    members[new].append(p)
                    group[p] = new
        g = below[g]
    return [length[x] for x in group]


# ---- extension -------------------------------------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)


class _Extension:
    """How far two places of a sequence agree, forward and backward, by hashes of its prefixes."""

    BASE = 0xD1342543DE82EF95

    def __init__(self, x: np.ndarray):
        self.n = len(x)
        one = np.ones(1, np.uint64)
        self.power = np.concatenate([one, np.cumprod(np.full(self.n, self.BASE, np.uint64))])
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(x) * self.power[: self.n])])

    def _agree(self, i, j, size):
        """[i, i + size) and [j, j + size) with i < j hash alike."""
        return (self.sums[i + size] - self.sums[i]) * self.power[j - i] == self.sums[j + size] - self.sums[j]

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        low, high = np.zeros(len(i), np.int64), self.n - j
        while (open_ := low < high).any():
            mid = (low + high + 1) >> 1
            ok = self._agree(i, j, mid)
            low, high = np.where(open_ & ok, mid, low), np.where(open_ & ~ok, mid - 1, high)
        return low

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols before i and before j agree."""
        low, high = np.zeros(len(i), np.int64), i.copy()
        while (open_ := low < high).any():
            mid = (low + high + 1) >> 1
            ok = self._agree(i - mid, j - mid, mid)
            low, high = np.where(open_ & ok, mid, low), np.where(open_ & ~ok, mid - 1, high)
        return low


def _plain_run(x: np.ndarray, i: int, p: int) -> tuple[int, int]:
    """The stretch around [i, i + p) in which symbols p apart agree, symbol by symbol."""
    s, e = i, i + p
    while e < len(x) and x[e] == x[e - p]:
        e += 1
    while s > 0 and x[s - 1] == x[s - 1 + p]:
        s -= 1
    return s, e


def runs_of(x: np.ndarray, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> np.ndarray:
    """(start, length, period) of the runs of ``x``, by start and period; symbols are > 0, 0 separates texts.

    ``min_exponent`` must be at least 2.
    """
    if min_exponent < 2:
        raise ValueError("a run repeats its period at least twice")
    if not len(x):
        return np.empty((0, 3), np.int64)
    x = x.astype(np.int64)
    high = int(x.max()) + 1
    apart = x.copy()
    apart[x == 0] = -1 - np.arange(int((x == 0).sum()))  # a separator agrees with nothing
    extension = _Extension(apart)
    found: dict[tuple[int, int, int], list[int]] = {}
    for order in (x, np.where(x > 0, high - x, 0)):
        size = np.array(lyndon_array(order.tolist()), np.int64)
        i = np.nonzero(size)[0]
        # a root of a run of exponent e stands at least e - 1 times in a row
        for k in range(1, min_exponent - 1):
            at = i + k * size[i]
            i = i[(at < len(x)) & (size[np.minimum(at, len(x) - 1)] == size[i])]
        i = i[i + size[i] < len(x)]
        p = size[i]
        start = i - extension.backward(i, i + p)
        end = i + p + extension.forward(i, i + p)
        some = end - start >= np.maximum(min_length, min_exponent * p)
        for key in zip(start[some].tolist(), end[some].tolist(), p[some].tolist(), i[some].tolist(), strict=True):
            found.setdefault(key[:3], []).append(key[3])
    runs = set()
    for (s, e, p), roots in found.items():
        if np.array_equal(apart[s : e - p], apart[s + p : e]):
            runs.add((s, e - s, p))
            continue
        for i in roots:  # hashes of different strings agreed
            s, e = _plain_run(apart, i, p)
            if e - s >= max(min_length, min_exponent * p):
                runs.add((s, e - s, p))
    return np.array(sorted((s, n, p) for s, n, p in runs), np.int64).reshape(-1, 3)


def frequent_stretches(ids: np.ndarray, text: np.ndarray, min_exponent: int, min_length: int) -> np.ndarray:
    """Which words can be in a run: words that occur ``min_exponent`` times in their stretch, stretches long enough.

    ``text`` numbers the texts, in order; the rest cuts a text into shorter stretches, until nothing changes.
    """
    stretch, at = text.astype(np.int64), np.arange(len(ids))
    while len(at):
        key = stretch * (int(ids.max()) + 1) + ids[at]
        _, inverse, n = np.unique(key, return_inverse=True, return_counts=True)
        keep = n[inverse] >= min_exponent
        stretch = np.cumsum(np.append(True, (np.diff(stretch) != 0) | ~keep[:-1]))  # what follows a word that goes is another stretch
        stretch, kept = stretch[keep], at[keep]
        _, inverse, n = np.unique(stretch, return_inverse=True, return_counts=True)
        enough = n[inverse] >= min_length
        stretch, kept = stretch[enough], kept[enough]
        if len(kept) == len(at):
            break
        at = kept
    return at


def text_runs(texts: list[np.ndarray], min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> list[np.ndarray]:
    """For every sequence of numbers >= 0 the (start, length, period) of its runs, by start and period."""
    lengths = np.array([len(t) for t in texts], np.int64)
    ids = np.concatenate([*texts, np.empty(0, np.int64)]).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), lengths)
    at = frequent_stretches(ids, text, min_exponent, min_length)
    out = [np.empty((0, 3), np.int64)] * len(texts)
    if not len(at):
        return out
    first = np.cumsum(lengths) - lengths
    new = np.append(True, (np.diff(at) != 1) | (np.diff(text[at]) != 0))
    place = np.arange(len(at)) + np.cumsum(new)  # a separator before every stretch
    x = np.zeros(place[-1] + 2, np.int64)
    x[place] = ids[at] + 1
    origin = np.full(len(x), -1)
    origin[place] = at
    runs = runs_of(x, min_exponent, min_length)
    owner = text[origin[runs[:, 0]]]
    runs[:, 0] = origin[runs[:, 0]] - first[owner]
    for t in np.unique(owner).tolist():
        out[t] = runs[owner == t]
    return out


# ---- documents -------------------------------------------------------------------------------------------------------


def planted(words: list[bytes], doc_id) -> list[bytes]:
    """The words with the repetition that a tenth of the documents get, by the hash of the id; null ids get none."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a : a + p]
    return (words[:a] + cycle * ((n - a) // p + 1))[:n]


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(edge[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k]


def _best(runs: np.ndarray):
    """The run with the greatest exponent, as an exact fraction; the smallest start, then period, of ties."""
    top = None
    for s, n, p in runs.tolist():
        if top is None or n * top[2] > top[1] * p:
            top = (s, n, p)
    return top


def _groups(batches):
    for b in batches:
        for k in range(0, b.num_rows, _ROWS):
            rows = b.slice(k, _ROWS)
            ids, texts = rows.column(0).to_pylist(), rows.column(1).to_pylist()
            at, size = 0, 0
            for i, t in enumerate(texts):
                size += len(t)
                if size >= _CHARS or i + 1 == len(texts):
                    yield rows.slice(at, i + 1 - at), ids[at : i + 1], texts[at : i + 1]
                    at, size = i + 1, 0


def _run_batches(batches, min_exponent, min_length, plant):
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for rows, ids, texts in _groups(batches):
        words = [t.split() for t in texts]
        if plant:
            words = [planted(w, i) for w, i in zip(words, ids, strict=True)]
        number: dict[bytes, int] = {}
        coded = [np.fromiter((number.setdefault(w, len(number)) for w in ws), np.int64, len(ws)) for ws in words]
        found = text_runs(coded, min_exponent, min_length)
        kept = [b" ".join(collapsed(w, r)) for w, r in zip(words, found, strict=True)]
        best = [_best(r) for r in found]
        yield pa.RecordBatch.from_arrays([
            rows.column(0), pa.array([len(w) for w in words], pa.int64()),
            pa.array([[{"start": s, "length": n, "period": p} for s, n, p in r.tolist()] for r in found], pa.list_(run)),
            pa.array([b and dict(zip(("start", "length", "period"), b, strict=True)) for b in best], run), pa.array(kept, pa.binary())],
            names=["doc_id", "n_words", "runs", "best", "collapsed"])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH, plant: bool = False) -> DataFrame:
    """(doc_id, n_words, runs, best, collapsed): the runs of a document's words by start and period, the run with the
    greatest exponent (null if none), and the text with every run cut to its first period, words joined by one space.

    ``plant`` first repeats words in a tenth of the documents (``planted``), for measuring.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    kind, run = rows.schema["doc_id"].dataType.simpleString(), "struct<start:long,length:long,period:long>"
    return map_batches(rows, partial(_run_batches, min_exponent=min_exponent, min_length=min_length, plant=plant),
                       f"doc_id {kind}, n_words long, runs array<{run}>, best {run}, collapsed binary")


def runs_text(runs):
    """``start,length,period`` and a line feed for every run."""
    return F.concat_ws("", F.transform(runs, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))))
