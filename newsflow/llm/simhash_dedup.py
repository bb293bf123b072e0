"""Near-duplicate documents by SimHash fingerprints.

A fingerprint is mapped to the bit counts of its 32 two-bit segments.  The Manhattan distance of two such count
vectors is never above the Hamming distance of the fingerprints, so a range join of the vectors keeps every pair.
The range join runs on the grid of count vectors: two vectors at distance d meet in a grid cell that is at most
half of d away from either, so each fingerprint goes to its own cell and the cells around it (49 on average for two
bits) and pairs are looked for within a cell only.  Pairs are verified on the fingerprints themselves.

Only distinct fingerprints take part, so copies cost nothing, and of the verified links within a cell only a spanning
forest leaves the task.  A cell with more than ``run_max`` fingerprints isn't held in memory: its members go through an
exact path of their own, in which fingerprints meet at the 64-bit values within reach of both.

Defined results: null or empty text has fingerprint zero and is linked like any other; rows with a null id take part
but can't give a component its name (a component of such rows only has a null id); repeated rows are copies; an empty
table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import cut, map_batches
from newsflow.llm.components import connected_components

BITS = 64
_CHUNK = 1 << 16


def simhash(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit fingerprint of a text; a bit is 1 if set in over half the shingle hashes."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, _CHUNK):
        end = min(n, at + _CHUNK)
        grams = zip(*(words[at + k : end + k] for k in range(shingle)), strict=True) if len(words) >= shingle else [words]
        h = np.array([digest(join(g), seed) for g in grams], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _fingerprint_batches(batches, shingle):
    for b in batches:
        fp = np.array([simhash(t, shingle) for t in b.column(b.num_columns - 1).to_pylist()], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fp.view(np.int64))], names=[*b.schema.names[:-1], "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, text_key long, fp long) for every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), _text_key(F.col(text_col)).alias("text_key"), F.col(text_col).cast("binary").alias("text"))
    return map_batches(rows, partial(_fingerprint_batches, shingle=shingle), "id long, text_key long, fp long")


def _segment_counts(fp: Column) -> Column:
    """Bit counts of the 32 two-bit segments, packed into two bits each."""
    low, shifted = F.lit(0x5555555555555555), F.shiftrightunsigned(fp, 1)
    return fp.bitwiseXOR(shifted).bitwiseAND(low).bitwiseOR(F.shiftleft(fp.bitwiseAND(shifted).bitwiseAND(low), 1))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _around(cell: Column) -> Column:
    """The cells at Manhattan distance one: one segment's count is one less or one more."""
    moves = [(1 << 2 * k, 2 << 2 * k, 0) for k in range(32)] + [(3 << 2 * k, 0, 3 << 2 * k) for k in range(32)]
    near = [F.when((cell.bitwiseAND(F.lit(_signed(clear))) == 0) & (F.lit(some == 0) | (cell.bitwiseAND(F.lit(_signed(some))) != 0)),
                   cell.bitwiseXOR(F.lit(_signed(flip)))) for flip, clear, some in moves]
    return F.array_compact(F.array(cell, *near))


def _flips(value: Column) -> Column:
    return F.array(value, *[value.bitwiseXOR(F.lit(_signed(1 << k))) for k in range(BITS)])


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of 0..n-1 over the links (a, b)."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        if (ra == rb).all():
            return root
        lo = np.minimum(ra, rb)
        np.minimum.at(root, ra, lo)
        np.minimum.at(root, rb, lo)
        while (root[root] != root).any():
            root = root[root]


def _cell_links(cell: np.ndarray, fp: np.ndarray, max_bits: int):
    """Spanning forests of the verified links within cells; rows are sorted by cell."""
    found, pending, n = [], 0, len(cell)
    for k in range(1, n):
        i = np.nonzero(cell[k:] == cell[:-k])[0]
        if not len(i):
            break
        i = i[np.bitwise_count(fp[i] ^ fp[i + k]) <= max_bits]
        if len(i):
            found.append((i, i + k))
            pending += len(i)
            if pending > 8 * n + 1000:
                root = _forest(n, *map(np.concatenate, zip(*found, strict=True)))
                i = np.nonzero(root != np.arange(n))[0]
                found, pending = [(i, root[i])], len(i)
    if not found:
        return fp[:0], fp[:0]
    root = _forest(n, *map(np.concatenate, zip(*found, strict=True)))
    i = np.nonzero(root != np.arange(n))[0]
    return fp[i], fp[root[i]]


def _link_batches(batches, max_bits, run_max):
    """(a, b) links of one partition sorted by cell; members of an oversize cell come out as (fp, null)."""
    cell, fp, oversize = np.empty(0, np.int64), np.empty(0, np.uint64), None

    def out(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), b if isinstance(b, pa.Array) else pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        c, f = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
        if oversize is not None:
            k = int(np.searchsorted(c != oversize, True)) if len(c) and c[0] == oversize else 0
            if k:
                yield out(f[:k].copy(), pa.nulls(k, pa.int64()))
            c, f = c[k:], f[k:]
            oversize = oversize if not len(c) else None
        cell, fp = np.concatenate([cell, c]), np.concatenate([fp, f])
        if not len(cell):
            continue
        last = int(np.nonzero(cell != cell[-1])[0].max(initial=-1)) + 1
        if last:
            yield out(*_cell_links(cell[:last], fp[:last], max_bits))
        cell, fp = cell[last:], fp[last:]
        if len(cell) > run_max:
            yield out(fp, pa.nulls(len(fp), pa.int64()))
            oversize, cell, fp = cell[0], cell[:0], fp[:0]
    if len(cell):
        yield out(*_cell_links(cell, fp, max_bits))


def fingerprint_links(fps: DataFrame, max_bits: int = 2, run_max: int = 4096) -> DataFrame:
    """Links (a, b) that connect exactly what pairs of distinct ``fp`` at ``max_bits`` or fewer differing bits connect."""
    cells = fps.select("fp", F.explode(F.array(_segment_counts(F.col("fp")))).alias("cell"))
    for _ in range((max_bits + 1) // 2):
        cells = cells.select("fp", F.explode(_around(F.col("cell"))).alias("cell"))
    if max_bits > 2:
        cells = cells.distinct()
    found = map_batches(cells.select("cell", "fp").repartition("cell").sortWithinPartitions("cell", "fp"), 
        partial(_link_batches, max_bits=max_bits, run_max=run_max), "a long, b long")
    found = cut(found.distinct())
    # oversize cells: fingerprints meet at the values within reach of both, each value has one hub
    near, far = max_bits // 2, max_bits - max_bits // 2
    reach = found.where("b is null").select(F.col("a").alias("fp"), F.col("a").alias("mid"))
    for _ in range(far):
        reach = reach.select("fp", F.explode(_flips(F.col("mid"))).alias("mid"))
    reach = reach.distinct()
    hub = reach.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("mid"))) <= near).groupBy("mid").agg(F.min("fp").alias("hub"))
    rest = reach.join(hub, "mid").select(F.col("fp").alias("a"), F.col("hub").alias("b"))
    return found.where("b is not null").union(rest)


def _rooted(docs, id_col, text_col, shingle, max_bits):
    """(id, text_key, fp) of every row, and (fp, root, component_id) of every fingerprint; root names the component."""
    fps = cut(fingerprints(docs, id_col, text_col, shingle))
    distinct = cut(fps.groupBy("fp").agg(F.min("id").alias("first_id")))
    roots = connected_components(fingerprint_links(distinct, max_bits), "a", "b")
    named = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    first = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return fps, cut(named.join(first, "root").select("fp", "root", "component_id"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """(id, fp, component_id) for every row: component_id is the smallest id among the documents reachable by links."""
    fps, of_fp = _rooted(docs, id_col, text_col, shingle, max_bits)
    return fps.join(of_fp, "fp").select("id", "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first_of_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs``, one of each group of linked documents: the one with the smallest id (null ids last).

    Only ids and text hashes are grouped; a left semi join picks the rows.  Rows that repeat both id and text of a kept
    row are reduced to one in a step that sees no other rows.
    """
    fps, of_fp = _rooted(docs, id_col, text_col, shingle, max_bits)
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")
    copies = fps.groupBy("fp", "id", "text_key").agg(F.count(F.lit(1)).alias("copies"))
    best = copies.join(of_fp, "fp").groupBy("root").agg(F.min(F.struct(order.alias("o"), "copies")).alias("best"))
    best = cut(best.select(F.col("best.o.id").alias("id"), F.col("best.o.text_key").alias("text_key"), "best.copies"))

    def picked(keys):
        return docs.join(keys, docs[id_col].cast("long").eqNullSafe(keys.id) & (_text_key(docs[text_col]) == keys.text_key), "left_semi")

    key = "__kept_text_key"
    repeated = picked(best.where("copies > 1")).withColumn(key, _text_key(F.col(f"`{text_col}`")))
    return picked(best.where("copies = 1")).unionByName(repeated.dropDuplicates([id_col, key]).drop(key))
