"""Alignment of two tokenizers' tokens over a corpus, by lockstep merging.

Both tokenizers see a space and the text.  Where a token of A and one of B end at the same byte, both sequences are cut
into groups; every token of A is linked with every token of B of its group.

All texts of a batch are merged at once: one state vector holds, for every lane, the next token of A and of B and the
bytes that each has covered; a step advances, in every lane, the side that is behind (both where they are level, which
cuts a group and emits its links), and lanes that are done leave the vector.  A lane is a text, or a stretch of a long one
between places where neither tokenizer can have a token across (before a single space), so long texts don't run alone.  Words between such places are encoded once while they are remembered.

How many documents hold a pair of ids linked is counted over the whole corpus: each document's distinct pairs, partial
sums in the tasks, sums in a shuffle.  The table of pairs is broadcast if it has at most ``max_broadcast_pairs`` rows, else
the documents' pairs are joined with it by a shuffle; both give the same rows.

Defined results: a text that is null or empty, or whose tokens don't give back a space and the text byte by byte, has no
tokens: zeros and an empty string; repeated rows are documents of their own; other columns are ignored.  The vocabularies'
paths are parameters and must exist on the executors.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import map_batches, stored

#: Before a space between two characters that aren't white space: no token of either tokenizer reaches over it (pre-tokens
#: hold no space but in front, and ``check_boundary`` looks at the pieces).
_BOUNDARY = re.compile(r"(?<=\S)(?= \S)")
_JOINED = 64
LANE_CHARS = 512
MAX_BROADCAST_PAIRS = 4_000_000
_BATCH_CHARS, _BATCH_ROWS = 1 << 20, 1024
_MEMO = 1 << 19
_ID_BITS = 20


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    count = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(count.sum())), count


class TokenizerA:
    """Byte-level BPE of a tokenizer file; special tokens are plain text."""

    def __init__(self, path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path("byte_bpe_50k.json"))
        self.tokenizer.encode_special_tokens = True
        byte_of, vocabulary = _byte_of(), self.tokenizer.get_vocab()
        self.token = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            self.token[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.size = np.array([len(t) for t in self.token], np.int64)

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units one after another, and how many each has.

        Many units are encoded as one text and cut again; units that can't be cut there are encoded one by one.
        """
        ids, _ = self._ids(["".join(units[k : k + _JOINED]) for k in range(0, len(units), _JOINED)])
        covered = np.cumsum(self.size[ids])
        end = np.cumsum(np.fromiter((len(u.encode()) for u in units), np.int64, len(units)))
        at = np.searchsorted(covered, end)
        if at[-1] >= len(covered) or (covered[at] != end).any():
            return self._ids(units)
        return ids, np.diff(at + 1, prepend=0)


class TokenizerB:
    """Piece BPE with byte fallback; it adds the space itself."""

    def __init__(self, path: str | None = None):
        import public_tokenizers
        import sentencepiece

        self.tokenizer = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
        self.token = []
        for i in range(self.tokenizer.vocab_size()):
            piece = self.tokenizer.id_to_piece(i)
            self.token.append(bytes([int(piece[1:-1], 16)]) if self.tokenizer.is_byte(i) else piece.replace("▁", " ").encode())
        self.size = np.array([len(t) for t in self.token], np.int64)

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat(self.tokenizer.encode([u[1:] for u in units], num_threads=1))

    def check_boundary(self) -> None:
        """No piece holds a space after another character, so none reaches over a boundary."""
        if any(re.search("[^▁]▁", self.tokenizer.id_to_piece(i)) for i in range(self.tokenizer.vocab_size())):
            raise ValueError("a piece holds a space after another character")


class _Side:
    """One tokenizer, and the ids of the units that were seen, by their numbers."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.size = tokenizer.size
        self.clear()

    def clear(self):
        self.ids, self.count, self.exact = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def _exact(self, units, ids, count) -> np.ndarray:
        """Which units' tokens give back their bytes."""
        token = self.tokenizer.token.__getitem__
        written = [u.encode() for u in units]
        end = np.append(0, np.cumsum(count))
        covered = np.append(0, np.cumsum(self.size[ids]))[end]
        if np.array_equal(np.diff(covered), np.fromiter(map(len, written), np.int64, len(written))) and b"".join(map(token, ids.tolist())) == b"".join(written):
            return np.ones(len(units), bool)
        return np.array([b"".join(map(token, ids[s:e].tolist())) == w for w, s, e in zip(written, end.tolist(), end[1:].tolist(), strict=False)])

    def add(self, units: list[str]) -> None:
        ids, count = self.tokenizer.encode(units)
        self.ids, self.count = np.append(self.ids, ids), np.append(self.count, count)
        self.exact = np.append(self.exact, self._exact(units, ids, count))

    def tokens(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units one after another, and how many each has."""
        count = self.count[numbers]
        start = (np.cumsum(self.count) - self.count)[numbers]
        at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count - start, count)
        return self.ids[at], count


def _joinable(unit: str) -> bool:
    """One space in front and none behind, so that the next unit begins at a boundary."""
    return not (unit[-1].isspace() or unit[1:2].isspace())


def lockstep(size_a: np.ndarray, start_a: np.ndarray, end_a: np.ndarray, size_b: np.ndarray, start_b: np.ndarray, end_b: np.ndarray):
    """Groups (a0, a1, b0, b1) of all lanes; lane k has tokens [start, end) of either side, and equal bytes on both.

    ``size_*`` are the bytes of tokens.  A token without bytes goes with the group that is open at its place, the next one.
    """
    groups = [[], [], [], []]
    some = (start_a < end_a) & (start_b < end_b)
    a, b, last_a, last_b = start_a[some].copy(), start_b[some].copy(), end_a[some], end_b[some]
    cut_a, cut_b = a.copy(), b.copy()  # where the open group began
    past_a, past_b = size_a[a], size_b[b]  # bytes covered by the tokens up to and with a and b
    a += 1
    b += 1
    while len(a):
        level = past_a == past_b
        if level.any():
            for found, v in zip(groups, (cut_a, a, cut_b, b), strict=True):
                found.append(v[level])
            cut_a, cut_b = np.where(level, a, cut_a), np.where(level, b, cut_b)
        going = ~level | ((a < last_a) & (b < last_b))
        if not going.all():  # finished lanes leave
            a, b, last_a, last_b, cut_a, cut_b, past_a, past_b, level = (v[going] for v in (a, b, last_a, last_b, cut_a, cut_b, past_a, past_b, level))
            if not len(a):
                break
        go_a, go_b = past_a <= past_b, past_b <= past_a
        past_a += np.where(go_a, size_a[np.minimum(a, len(size_a) - 1)], 0)
        past_b += np.where(go_b, size_b[np.minimum(b, len(size_b) - 1)], 0)
        a += go_a
        b += go_b
    found = np.array([np.concatenate([*v, np.empty(0, np.int64)]) for v in groups])
    return found[:, np.argsort(found[0], kind="stable")]


def group_links(groups: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, owner: np.ndarray):
    """(owner, pair, n): distinct pairs of ids linked in each owner's groups, and how many links of occurrences each has."""
    m, n = groups[1] - groups[0], groups[3] - groups[2]
    wide = m * n > 4096
    parts = []
    if wide.any():  # a group of very many tokens has few distinct ones
        for g in np.nonzero(wide)[0].tolist():
            x, nx = np.unique(ids_a[groups[0, g] : groups[1, g]], return_counts=True)
            y, ny = np.unique(ids_b[groups[2, g] : groups[3, g]], return_counts=True)
            parts.append((np.full(len(x) * len(y), owner[g]), ((x[:, None] << _ID_BITS) | y[None, :]).ravel(), (nx[:, None] * ny[None, :]).ravel()))
    m, n, a0, b0, who = m[~wide], n[~wide], groups[0, ~wide], groups[2, ~wide], owner[~wide]
    size = m * n
    k = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    wide_n = np.repeat(n, size)
    pair = (ids_a[np.repeat(a0, size) + k // np.maximum(wide_n, 1)] << _ID_BITS) | ids_b[np.repeat(b0, size) + k % np.maximum(wide_n, 1)]
    parts.append((np.repeat(who, size), pair, np.ones(len(pair), np.int64)))
    who, pair, times = (np.concatenate(x) for x in zip(*parts, strict=True))
    key = (who << 2 * _ID_BITS) | pair
    if wide.any():
        key, inverse = np.unique(key, return_inverse=True)
        times = np.bincount(inverse, times, len(key)).astype(np.int64)
    else:
        key, times = np.unique(key, return_counts=True)
    return key >> 2 * _ID_BITS, key & ((1 << 2 * _ID_BITS) - 1), times


class Aligner:
    """Aligns the texts of a batch."""

    def __init__(self, path_a: str | None = None, path_b: str | None = None, lane_chars: int = LANE_CHARS):
        self.a, self.b = _Side(TokenizerA(path_a)), _Side(TokenizerB(path_b))
        self.known: dict[str, int] = {}  # unit -> its number on both sides
        self.b.tokenizer.check_boundary()
        self.lane_chars = lane_chars
        n_a, n_b = len(self.a.size), len(self.b.size)
        if max(n_a, n_b) > 1 << _ID_BITS:
            raise ValueError("a vocabulary has too many ids")
        self.written = [f"{i}{end}" for end in ",|" for i in range(n_a)] + [f"{i}{end}" for end in ",;" for i in range(n_b)]

    def look_up(self, units: list[str]) -> np.ndarray:
        """Numbers of units; new ones are encoded by both tokenizers."""
        if len(self.known) > _MEMO:
            self.known.clear()
            self.a.clear()
            self.b.clear()
        new = set(units).difference(self.known)
        for some in ([u for u in new if _joinable(u)], [u for u in new if not _joinable(u)]):
            if some:
                self.known.update(zip(some, range(len(self.known), len(self.known) + len(some)), strict=True))
                self.a.add(some)
                self.b.add(some)
        return np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))

    def align(self, texts: list[str | None]) -> list[dict]:
        """Per text n_a, n_b, n_groups, n_links, groups (text), pairs and their numbers of links."""
        none = {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups": "", "pairs": np.empty(0, np.int64), "times": np.empty(0, np.int64)}
        out = [none] * len(texts)
        units: list[str] = []
        first_unit, lane_unit, lane_text = [], [], []
        where = [i for i, t in enumerate(texts) if t]
        for i in where:
            first_unit.append(len(units))
            words = _BOUNDARY.split(" " + texts[i])
            at = -self.lane_chars
            place = 0
            for k, w in enumerate(words):
                if place - at >= self.lane_chars:
                    at = place
                    lane_unit.append(len(units) + k)
                    lane_text.append(i)
                place += len(w)
            units += words
        if not units:
            return out
        number = self.look_up(units)
        exact = self.a.exact[number] & self.b.exact[number]
        good = np.logical_and.reduceat(exact, first_unit)
        ids_a, count_a = self.a.tokens(number)
        ids_b, count_b = self.b.tokens(number)
        place_a, place_b = np.append(0, np.cumsum(count_a)), np.append(0, np.cumsum(count_b))
        good_of = np.zeros(len(texts), bool)
        for i, first, last, ok in zip(where, first_unit, [*first_unit[1:], len(units)], good.tolist(), strict=True):
            if not ok:  # bytes that one unit lacks might be found in another
                whole = (" " + texts[i]).encode()
                sides = ((self.a, ids_a, place_a), (self.b, ids_b, place_b))
                ok = all(b"".join([s.tokenizer.token[k] for k in ids[p[first] : p[last]].tolist()]) == whole for s, ids, p in sides)
                if ok:  # units don't hold the same bytes on both sides then: the text is one lane
                    keep = [k for k in range(len(lane_text)) if lane_text[k] != i or lane_unit[k] == first]
                    lane_text, lane_unit = [lane_text[k] for k in keep], [lane_unit[k] for k in keep]
            good_of[i] = ok
        lane_text, lane_unit = np.array(lane_text), np.array([*lane_unit, len(units)])
        kept = good_of[lane_text]
        start, end = lane_unit[:-1][kept], lane_unit[1:][kept]
        groups = lockstep(self.a.size[ids_a], place_a[start], place_a[end], self.b.size[ids_b], place_b[start], place_b[end])
        unit_text = np.repeat(where, np.diff([*first_unit, len(units)]))
        owner = unit_text[np.searchsorted(place_a, groups[0], side="right") - 1]
        who, pair, times = group_links(groups, ids_a, ids_b, owner)

        # a group's ids of A, then its ids of B
        n_a, n_b = len(self.a.size), len(self.b.size)
        m, n = groups[1] - groups[0], groups[3] - groups[2]
        begin = np.append(0, np.cumsum(m + n))
        code = np.empty(begin[-1], np.int64)
        at_a = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
        at_b = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        code[at_a + np.repeat(begin[:-1], m)] = ids_a[at_a + np.repeat(groups[0], m)]
        code[at_b + np.repeat(begin[:-1] + m, n)] = ids_b[at_b + np.repeat(groups[2], n)] + 2 * n_a
        code[begin[:-1] + m - 1] += n_a
        code[begin[1:] - 1] += n_b
        edge_group = np.searchsorted(owner, np.arange(len(texts) + 1))
        edge_pair = np.searchsorted(who, np.arange(len(texts) + 1))
        total = [np.append(0, np.cumsum(x)) for x in (m, n, m * n)]
        written = self.written.__getitem__
        for i in np.nonzero(good_of)[0].tolist():
            g0, g1, p0, p1 = edge_group[i], edge_group[i + 1], edge_pair[i], edge_pair[i + 1]
            sums = [int(x[g1] - x[g0]) for x in total]
            out[i] = {"n_a": sums[0], "n_b": sums[1], "n_groups": int(g1 - g0), "n_links": sums[2], "groups": "".join(map(written, code[begin[g0] : begin[g1]].tolist()))[:-1],
                      "pairs": pair[p0:p1], "times": times[p0:p1]}
        return out


_aligner = cache(Aligner)
_NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]


def _groups_of_rows(b, text_column):
    """Slices of a batch of about ``_BATCH_CHARS`` characters."""
    at, size = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(b.column(text_column)), 0).to_pylist()):
        size += n
        if size >= _BATCH_CHARS or i + 1 - at >= _BATCH_ROWS or i + 1 == b.num_rows:
            yield b.slice(at, i + 1 - at)
            at, size = i + 1, 0


def _align_batches(batches, path_a, path_b, lane_chars):
    aligner = _aligner(path_a, path_b, lane_chars)
    for whole in batches:
        for b in _groups_of_rows(whole, 1):
            found = aligner.align(b.column(1).to_pylist())
            columns = [pa.array([f[c] for f in found], pa.int64()) for c in _NAMES[1:5]]
            digest = pa.array([hashlib.sha256(f["groups"].encode()).hexdigest() if f["n_a"] else "" for f in found])
            pairs = pa.array([f["pairs"].astype("<i8").tobytes() for f in found], pa.binary())
            times = pa.array([f["times"].astype("<i8").tobytes() for f in found], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), *columns, digest, pairs, times], names=_NAMES)


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None, lane_chars: int = LANE_CHARS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times), one row a document.

    ``pairs`` and ``times`` are little-endian 64-bit: id of A << 20 | id of B, ascending, and its links in the document.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, partial(_align_batches, path_a=path_a, path_b=path_b, lane_chars=lane_chars),
                       f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary")


def _count_batches(batches):
    """(pair, n) over the documents of a task; memory holds the distinct pairs."""
    pair, n = np.empty(0, np.int64), np.empty(0, np.int64)
    held, size = [], 0

    def merged():
        every, inverse = np.unique(np.concatenate([pair, *held]), return_inverse=True)
        total = np.bincount(inverse, np.concatenate([n, np.ones(len(inverse) - len(n), np.int64)]), len(every))
        return every, total.astype(np.int64)

    for b in batches:
        for x in b.column("pairs").to_pylist():
            held.append(np.frombuffer(x, "<i8"))
            size += len(held[-1])
            if size > max(1 << 20, len(pair)):
                pair, n = merged()
                held, size = [], 0
    pair, n = merged()
    for k in range(0, len(pair), 1 << 16):
        yield pa.RecordBatch.from_pydict({"pair": pa.array(pair[k : k + (1 << 16)]), "n": pa.array(n[k : k + (1 << 16)])})


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): how many documents hold a pair linked, and whether that is the most of its id of A."""
    counts = map_batches(aligned.select("pairs"), _count_batches, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    a = F.shiftright("pair", _ID_BITS)
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return counts.withColumn("a", a).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _sum_batches(batches, shared):
    pair, n, best = shared.value
    for b in batches:
        n_best, total = [], []
        for x, t in zip(b.column("pairs").to_pylist(), b.column("times").to_pylist(), strict=True):
            at, t = np.searchsorted(pair, np.frombuffer(x, "<i8")), np.frombuffer(t, "<i8")
            n_best.append(int(t[best[at]].sum()))
            total.append(int((t * n[at]).sum()))
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in _NAMES[:6]), pa.array(n_best, pa.int64()), pa.array(total, pa.int64())], names=[*_NAMES[:6], "n_best", "count_sum"])


def _exploded_batches(batches):
    """(row, pair, times) of every document."""
    for b in batches:
        for row, x, t in zip(*(b.column(c).to_pylist() for c in ("row", "pairs", "times")), strict=True):
            pair = np.frombuffer(x, "<i8")
            for k in range(0, len(pair), 1 << 16):
                some = pair[k : k + (1 << 16)]
                yield pa.RecordBatch.from_pydict({"row": pa.array(np.full(len(some), row)), "pair": pa.array(some), "times": pa.array(np.frombuffer(t, "<i8")[k : k + (1 << 16)])})


def align_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None, lane_chars: int = LANE_CHARS,
                 max_broadcast_pairs: int = MAX_BROADCAST_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum), one row a document.

    n_best: links whose pair is in the most documents of those of its id of A; count_sum: the sum of those numbers over all
    links.
    """
    spark = docs.sparkSession
    aligned = stored(align(docs, id_col, text_col, path_a, path_b, lane_chars), "aligned")
    counts = stored(pair_counts(aligned), "pair-counts")
    kind = aligned.schema["doc_id"].dataType.simpleString()
    if counts.count() <= max_broadcast_pairs:
        table = counts.toArrow()  # the bound holds
        order = np.argsort(table.column("pair").to_numpy())
        shared = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy()[order] for c in ("pair", "n", "best")))
        return map_batches(aligned, partial(_sum_batches, shared=shared), f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")
    numbered = stored(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned-rows")  # written, so numbers stay
    pairs = map_batches(numbered.select("row", "pairs", "times"), _exploded_batches, "row long, pair long, times long")
    sums = pairs.join(counts, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return numbered.join(sums, "row", "left").select(*_NAMES[:6], F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"))
