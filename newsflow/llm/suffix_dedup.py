"""Removal of byte strings of at least ``min_bytes`` that occur more than once in a corpus.

Which positions start a repeated string is found by suffix structures: the Burrows-Wheeler transform of a batch of texts,
and on it a breadth-first backward extension of intervals, which derives the common prefixes of neighbouring suffixes by
increasing value and stops at ``min_bytes``; neighbours left without a value share that many bytes.

The corpus is dealt to batches so that equal strings of ``min_bytes`` meet.  Every window of ``min_bytes`` has an anchor,
the leftmost smallest of the hashes of its ``gram``-byte substrings; equal windows have equal anchors at equal places.  The
windows of one anchor form a region of a document (about 175 windows).  Regions whose anchor occurs once in the corpus
hold no repeated window and are dropped after one shuffle of anchor rows without text; regions with equal contents are one
region with a count; groups of different regions with one anchor get their bytes and are put whole into batches.  A group
of more than ``max_regions`` different regions (the rim of a passage that very many documents share) isn't put into one
batch: its windows are compared by 128-bit hashes in an ordinary aggregation, however many there are.

Defined results: null text is empty; texts shorter than ``min_bytes`` are unchanged; strings never cross documents; rows
with equal id and text are different documents with equal contents (all of it repeated if long enough); other columns are
ignored.  Intervals of a document are gathered with that document only.
"""

from __future__ import annotations

import hashlib
from functools import cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import cut, map_batches

MIN_BYTES, GRAM, MAX_REGIONS = 400, 48, 4096
#: Shorter repeats that are noted, not removed: about fifty words.
NOTE_BYTES = 250
_PIECE = 1 << 17
_BATCH_BYTES = 800_000
_BASE = 0x9E3779B97F4A7C15


# ---- anchors ---------------------------------------------------------------------------------------------------------


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    one = np.ones(1, np.uint64)
    return tuple(np.concatenate([one, np.cumprod(np.full(n, b, np.uint64))]) for b in (_BASE, pow(_BASE, -1, 1 << 64)))


def _window_anchors(x: np.ndarray, min_bytes: int, gram: int) -> np.ndarray:
    """For every window start the place of its anchor: the leftmost smallest gram hash in the window."""
    up, down = _powers(4 * _PIECE)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((x.astype(np.uint64) + np.uint64(1)) * up[: len(x)])])
    h = (sums[gram:] - sums[:-gram]) * down[: len(x) - gram + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    low = (h & np.uint64(0xFFFFFFFFFFF00000)) | np.arange(len(h), dtype=np.uint64)  # places are below 2**20
    width, reach = min_bytes - gram + 1, 1
    while 2 * reach <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    n = len(h) - width + 1
    return (np.minimum(low[:n], low[width - reach : width - reach + n]) & np.uint64(0xFFFFF)).astype(np.int64)


def _chunks(texts, min_bytes):
    """Lists of (row, offset, bytes): pieces of texts that hold every window once, about a quarter megabyte together."""
    held, size = [], 0
    for row, t in enumerate(texts):
        for at in range(0, len(t) - min_bytes + 1 if t else 0, _PIECE):
            piece = t[at : at + _PIECE - 1 + min_bytes]
            held.append((row, at, piece))
            size += len(piece)
            if size >= 2 * _PIECE:
                yield held
                held, size = [], 0
    if held:
        yield held


def text_regions(texts: list[bytes], min_bytes: int, gram: int):
    """Arrays (row, anchor, content, start, end): the regions of texts; anchor and content are 64-bit hashes."""
    out = []
    for held in _chunks(texts, min_bytes):
        joined = b"".join(p for _, _, p in held)
        lengths = np.array([len(p) for _, _, p in held])
        first = np.cumsum(lengths) - lengths
        anchors = _window_anchors(np.frombuffer(joined, np.uint8), min_bytes, gram)
        windows = lengths - min_bytes + 1
        piece = np.repeat(np.arange(len(held)), windows)
        at = np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows) + first[piece]
        anchor = anchors[at]
        new = np.append(True, (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1]))
        starts = np.nonzero(new)[0]
        ends = at[np.append(starts[1:], len(at)) - 1] + min_bytes
        begin, mid, piece = at[starts], anchor[starts], piece[starts]
        view = memoryview(joined)
        digest = xxhash.xxh64_intdigest
        a = [digest(view[m : m + gram]) for m in mid.tolist()]
        c = [digest(view[s:e], m - s) for s, e, m in zip(begin.tolist(), ends.tolist(), mid.tolist(), strict=True)]
        shift = np.array([o for _, o, _ in held])[piece] - first[piece]
        out.append((np.array([r for r, _, _ in held])[piece], np.array(a, np.uint64).view(np.int64), np.array(c, np.uint64).view(np.int64), begin + shift, ends + shift))
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 5


def _region_batches(batches, min_bytes, gram):
    for b in batches:
        row, anchor, content, start, end = text_regions(b.column("bytes").to_pylist(), min_bytes, gram)
        anchor &= -2
        # of the rows of one anchor in this batch the first meets those of other batches; the others are known to be
        # repeated and are dealt anywhere, so that an anchor with very many rows fills no partition
        _, first, group, n = np.unique(anchor, return_index=True, return_inverse=True, return_counts=True)
        known = n[group] > 1
        other = known.copy()
        other[first] = False
        row = pa.array(row)
        key = b.column("key").take(row)
        spread = (key.to_numpy() + start).view(np.uint64) * np.uint64(_BASE)
        slot = np.where(other, spread.view(np.int64), anchor) & -2 | known
        yield pa.RecordBatch.from_pydict({"slot": pa.array(slot), "key": key, "key2": b.column("key2").take(row), "anchor": pa.array(anchor), "content": pa.array(content),
                                          "start": pa.array(start.astype(np.int32)), "end": pa.array(end.astype(np.int32))})


def _repeated_batches(batches):
    """The rows, sorted by slot, that are known to be repeated or share their slot with another row."""
    held, before = None, None  # the last row isn't decided before the next is seen
    for b in batches:
        if not b.num_rows:
            continue
        table = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
        slot = table.column("slot").to_numpy()
        place, last = slot >> 1, len(slot) - 1
        same = place[1:] == place[:-1]
        keep = np.append(before is not None and before == place[0], same) | (slot & 1 == 1)
        keep[:-1] |= same
        held, before = table.slice(last), place[-2] if last else before
        yield table.slice(0, last).filter(pa.array(keep[:-1])).drop_columns("slot")
    if held is not None:
        slot = held.column("slot")[0].as_py()
        if slot & 1 or before is not None and slot >> 1 == before:
            yield held.drop_columns("slot")


# ---- Burrows-Wheeler transform ---------------------------------------------------------------------------------------


def _sorted_with_places(head: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``head`` in order, and the places it came from."""
    if int(head.max(initial=0)) >> (64 - bits) == 0:  # a plain sort of (head, place) is several times faster
        mask = np.uint64((1 << bits) - 1)
        key = (head << np.uint64(bits)) | np.arange(len(head), dtype=np.uint64)
        key.sort()
        return key >> np.uint64(bits), (key & mask).astype(np.int64)
    order = np.argsort(head, kind="stable")
    return head[order], order


def suffix_order(t: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``t`` (symbols under 2**10, the last smallest) ordered by ``depth`` symbols or more."""
    n = len(t)
    bits = n.bit_length()
    head = np.zeros(n, np.uint64)
    for k in range(min(4, n)):
        head[: n - k] |= t[k:].astype(np.uint64) << np.uint64(10 * (3 - k))
    reach = 4
    while True:
        head, order = _sorted_with_places(head, bits)
        new = np.append(True, head[1:] != head[:-1])
        if reach >= depth or new.all():
            return order
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(new).astype(np.uint64)
        head = rank << np.uint64(bits)
        head[: max(0, n - reach)] |= rank[reach:]
        reach *= 2


def prefix_classes(t: np.ndarray, depth: int, wide: int = 512, shorter: int | None = None):
    """(order, class): suffixes in order, and numbers that are equal for neighbours with ``depth`` equal first symbols.

    With ``shorter`` also the classes of that many equal symbols, as they stand when the extension passes that value.

    Interval [lo, hi) of a string w is extended backward by every symbol c before its suffixes to the interval of cw.  The
    end of that interval gets |w| as its common prefix unless it has a value; only then is the interval extended further.
    """
    n = len(t)
    bits = n.bit_length()
    order = suffix_order(t, depth)
    head = t[order]  # first symbols
    before = t[order - 1].astype(np.int64)  # the transform; the first suffix has the last symbol before it
    by_symbol = np.argsort(before, kind="stable")
    back = np.empty(n, np.int64)
    back[by_symbol] = np.arange(n)  # from a suffix to the one a symbol longer
    keyed = before[by_symbol] * (n + 1) + by_symbol
    symbols = np.unique(before)
    known = np.zeros(n + 1, bool)  # ends with a common prefix under the current value
    known[n] = True
    lo, hi = np.zeros(1, np.int64), np.full(1, n, np.int64)
    early = None
    for value in range(depth):
        if value == shorter:
            early = known.copy()
        size = hi - lo
        parts = []
        one = size == 1
        if one.any():
            s = back[lo[one]]
            parts.append((s, s + 1))
        two = size == 2
        if two.any():
            s = back[lo[two]]
            s1 = back[lo[two] + 1]
            together = head[s] == head[s1]
            parts.append((s, s + 1 + together))
            s1 = s1[~together]
            parts.append((s1, s1 + 1))
        big = size > wide
        if big.any():
            c = symbols[None, :] * (n + 1)
            a = np.searchsorted(keyed, (c + lo[big][:, None]).ravel())
            b = np.searchsorted(keyed, (c + hi[big][:, None]).ravel())
            some = b > a
            parts.append((a[some], b[some]))
        few = (size > 2) & ~big
        if few.any():
            m = size[few]
            at = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m - lo[few], m)
            s = back[at]
            # within an interval the suffixes before a symbol lead to consecutive places, in order
            s = np.sort((np.repeat(np.arange(len(m)), m) << bits) | s)
            place = s & ((1 << bits) - 1)
            start = np.nonzero(np.append(True, (s[1:] != s[:-1] + 1) | (head[place[1:]] != head[place[:-1]])))[0]
            parts.append((place[start], place[np.append(start[1:], len(s)) - 1] + 1))
        a, b = (np.concatenate(p) for p in zip(*parts, strict=True))
        fresh = ~known[b]
        a, b = a[fresh], b[fresh]
        if not len(b):
            break
        # several intervals of one length end at different places, so no end comes twice
        known[b] = True
        lo, hi = a, b
    classes = order, np.cumsum(np.append(0, known[1:n]))
    if shorter is None:
        return classes
    return *classes, np.cumsum(np.append(0, (known if early is None else early)[1:n]))


def repeated_windows(regions: list[bytes], counts: list[int], min_bytes: int, groups: list[int] | None = None, note_bytes: int = NOTE_BYTES) -> list[list[tuple[int, int]]]:
    """Per region the byte intervals covered by windows that occur again, in another region or in this one.

    ``counts`` says how often a region as a whole occurs.  With ``groups`` (the anchors), a region without such a window that
    shares a string of ``note_bytes`` with another region of its group gets the empty interval (0, 0).
    """
    lengths = np.array([len(r) for r in regions])
    first = np.cumsum(lengths + 1) - lengths - 1
    t = np.ones(int((lengths + 1).sum()) + 1, np.uint16)  # 0 ends the text, 1 ends a region
    t[-1] = 0
    inside = np.ones(len(t), bool)
    inside[first + lengths] = inside[-1] = False
    t[inside] = np.frombuffer(b"".join(regions), np.uint8).astype(np.uint16) + 2
    owner = np.repeat(np.arange(len(regions)), lengths + 1)
    start = np.arange(len(owner)) - first[owner]
    valid = np.append(start <= lengths[owner] - min_bytes, False)
    order, cls, near = prefix_classes(t, min_bytes, shorter=min(note_bytes, min_bytes))
    weight = np.where(valid[:-1], np.minimum(np.array(counts), 2)[owner], 0)
    weight = np.append(weight, 0)[order]
    total = np.bincount(cls, weight)
    hit = np.zeros(len(t), bool)
    hit[order] = (total[cls] >= 2) & (weight > 0)
    noted = _shares_with_group(order, near, owner, start <= lengths[owner] - note_bytes, groups) if groups is not None and note_bytes < min_bytes else np.zeros(len(regions), bool)
    out = []
    for k, (f, n) in enumerate(zip(first.tolist(), lengths.tolist(), strict=True)):
        out.append(_runs(hit[f : f + max(0, n - min_bytes + 1)], min_bytes) or ([(0, 0)] if noted[k] else []))
    return out


def _shares_with_group(order, near, owner, fits, groups) -> np.ndarray:
    """Regions with a suffix in one class with a suffix of another region of their group."""
    group = np.unique(np.array(groups, np.int64), return_inverse=True)[1]
    inside = order < len(owner)
    place, cls = order[inside], near[inside]
    ok = fits[place]
    region = owner[place[ok]]
    pair = np.unique((cls[ok].astype(np.int64) * (int(group.max(initial=0)) + 1) + group[region]) * len(groups) + region)
    key = pair // len(groups)
    _, inverse, n = np.unique(key, return_inverse=True, return_counts=True)
    out = np.zeros(len(groups), bool)
    out[(pair % len(groups))[n[inverse] > 1]] = True
    return out


def _runs(hit: np.ndarray, min_bytes: int) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return list(zip(np.nonzero(edge == 1)[0].tolist(), (np.nonzero(edge == -1)[0] - 1 + min_bytes).tolist(), strict=True))


def _batch_intervals(batches, min_bytes):
    """(anchor, content, from, to): repeated intervals of regions; rows come sorted by anchor, groups stay together."""
    schema = ["anchor", "content", "from", "to"]
    held: list = []

    def done(rows):
        found = repeated_windows([r[2] for r in rows], [r[3] for r in rows], min_bytes, [r[0] for r in rows])
        out = [(r[0], r[1], s, e) for r, spans in zip(rows, found, strict=True) for s, e in spans]
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64() if i < 2 else pa.int32()) for i in range(4)], names=schema)

    size = 0
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("anchor", "content", "bytes", "n")), strict=True):
            if size >= _BATCH_BYTES and row[0] != held[-1][0]:
                yield done(held)
                held, size = [], 0
            held.append(row)
            size += len(row[2])
    if held:
        yield done(held)


def _window_batches(batches, min_bytes):
    """(h1, h2, n, anchor, content, at): 128-bit hashes of the windows of regions of oversize groups."""
    for b in batches:
        for anchor, content, data, n in zip(*(b.column(c).to_pylist() for c in ("anchor", "content", "bytes", "n")), strict=True):
            view = memoryview(data)
            h = np.frombuffer(b"".join(xxhash.xxh3_128_digest(view[i : i + min_bytes]) for i in range(len(data) - min_bytes + 1)), ">i8").astype(np.int64).reshape(-1, 2)
            k = len(h)
            yield pa.RecordBatch.from_pydict({"h1": pa.array(h[:, 0].copy()), "h2": pa.array(h[:, 1].copy()), "n": pa.array(np.full(k, min(n, 2), np.int64)),
                                              "anchor": pa.array(np.full(k, anchor)), "content": pa.array(np.full(k, content)), "at": pa.array(np.arange(k, dtype=np.int32))})


# ---- corpus ----------------------------------------------------------------------------------------------------------


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key: list[Column] = [F.xxhash64(F.col(id_col), text).alias("key"), F.xxhash64(text, F.col(id_col), F.lit(1)).alias("key2")]
    return docs.select(F.col(id_col).alias("doc_id"), *key, text.cast("binary").alias("bytes"))


def repeated_intervals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES, gram: int = GRAM, max_regions: int = MAX_REGIONS) -> DataFrame:
    """(key, key2, from, to): byte intervals of documents covered by repeated strings; they may overlap.

    An empty interval notes a region that shares a shorter string with another region of its anchor.
    """
    keyed = _keyed(docs, id_col, text_col)
    region = "key long, key2 long, anchor long, content long, start int, end int"
    regions = map_batches(keyed.select("key", "key2", "bytes").where(F.octet_length("bytes") >= min_bytes), partial(_region_batches, min_bytes=min_bytes, gram=gram), f"slot long, {region}")
    rows = cut(map_batches(regions.repartition(F.shiftright("slot", 1)).sortWithinPartitions("slot"), _repeated_batches, region))

    example = F.min(F.struct("key", "key2", "start", "end"))
    contents = rows.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("n"), example.alias("x"))
    contents = cut(contents.select("anchor", "content", "n", "x.*"))
    kinds = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"))
    contents = contents.join(kinds, "anchor")
    # one content only: each of its places is repeated as a whole
    whole = contents.where("kinds = 1 and n > 1").select("anchor", "content", F.lit(0).alias("from"), (F.col("end") - F.col("start")).alias("to"))

    mixed = contents.where("kinds > 1")
    wanted = mixed.groupBy("key", "key2").agg(F.collect_list(F.struct("anchor", "content", "n", "kinds", "start", "end")).alias("w"))
    texts = keyed.join(wanted, ["key", "key2"])
    data = texts.select(F.explode("w").alias("w"), "bytes").select("w.*", F.substring("bytes", F.col("w.start") + 1, F.col("w.end") - F.col("w.start")).alias("bytes"))
    data = data.dropDuplicates(["anchor", "content"])  # documents with equal id and text have one key and give the same rows
    usual = data.where(F.col("kinds") <= max_regions).select("anchor", "content", "bytes", "n")
    interval = "anchor long, content long, from int, to int"
    found = map_batches(usual.repartition("anchor").sortWithinPartitions("anchor"), partial(_batch_intervals, min_bytes=min_bytes), interval)

    large = data.where(F.col("kinds") > max_regions).select("anchor", "content", "bytes", "n")
    windows = map_batches(large, partial(_window_batches, min_bytes=min_bytes), "h1 long, h2 long, n long, anchor long, content long, at int")
    twice = windows.groupBy("h1", "h2").agg(F.sum("n").alias("total")).where("total > 1").select("h1", "h2")
    rest = windows.join(twice, ["h1", "h2"]).select("anchor", "content", F.col("at").alias("from"), (F.col("at") + min_bytes).cast("int").alias("to"))

    covered = cut(whole.union(found).union(rest))
    return rows.join(covered, ["anchor", "content"]).select("key", "key2", (F.col("start") + F.col("from")).alias("from"), (F.col("start") + F.col("to")).alias("to"))


def _kept_batches(batches):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_bytes", "kept_sha256", "repeat_level"]
    for b in batches:
        n_bytes, removed, n_spans, kept, level = [], [], [], [], []
        for data, spans in zip(b.column("bytes").to_pylist(), b.column("spans").to_pylist(), strict=True):
            parts, at, gone, runs = [], 0, 0, 0
            level.append(0 if not spans else 2 if any(s["to"] > s["from"] for s in spans) else 1)
            for start, end in sorted((s["from"], s["to"]) for s in spans or [] if s["to"] > s["from"]):
                if start > at or not runs:
                    parts.append(data[at:start])
                    runs += 1
                    at = start
                if end > at:
                    gone += end - at
                    at = end
            parts.append(data[at:])
            n_bytes.append(len(data))
            removed.append(gone)
            n_spans.append(runs)
            kept.append(b"".join(parts))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary()),
                                          pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array(level, pa.int64())], names=names)


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES, gram: int = GRAM, max_regions: int = MAX_REGIONS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_bytes, kept_sha256, repeat_level), one row a document.

    ``repeat_level``: 2 if bytes were removed; 1 if only a shorter repeat, of ``NOTE_BYTES`` at least, was met while the common
    prefixes grew (a note, not a promise: only strings under one anchor are compared); else 0.
    """
    found = repeated_intervals(docs, id_col, text_col, min_bytes, gram, max_regions)
    spans = found.groupBy("key", "key2").agg(F.collect_set(F.struct("from", "to")).alias("spans"))
    rows = _keyed(docs, id_col, text_col).join(spans, ["key", "key2"], "left").select("doc_id", "bytes", "spans")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, _kept_batches, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_bytes binary, kept_sha256 string, repeat_level long")
