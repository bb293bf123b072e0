"""Near-duplicate vectors by sorted projection passes.

In every pass a vector gets a key of 64 signs of random hyperplanes, fresh ones for each pass; the vectors of a label and
length are ordered by the key and each is compared with its next ``window`` neighbours by exact cosine; pairs at the
threshold or above are united over all passes.  After ``passes`` passes their number is doubled until
that adds at most ``tolerance`` of what was found.  The work is passes x rows x window.  Order is made by one range sort of (pass,
label, length, key); numbered places are cut into blocks of ``block`` rows with a margin of one window, so a task compares
a bounded number of rows whatever the label sizes are.  Keys travel without vectors; a vector is sent to its blocks once a pass.

Runs that are denser than a window have an exact way: a vector with more links than half a window holds, within a pass or
over all of them, is dense, and dense vectors are compared with all vectors of their label in tiles of two blocks, whose centres and radii
leave out pairs of blocks that can't reach the threshold.  A tile doesn't give its links but, for each of its vectors,
their number and one edge of a spanning forest, so a dense group of n vectors makes about n * n / block rows, not n * n.
Links between two vectors that aren't dense come from the passes, all others from the tiles: each is counted once.

Equal vectors of a label are one class with a count; links between different vectors are found as above, those within a
class follow.  Defined results: a vector that is null, empty, zero or has null or non-finite components, a null label or
a null id links with nothing (n_links 0, component_id its own id, kept true); vectors of unequal length don't link; rows
that repeat an id and its vector are copies of each other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import partial
from itertools import groupby
from math import acos

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import cut, map_batches
from newsflow.llm.components import connected_components
from newsflow.llm.simhash_dedup import _forest

THRESHOLD, PASSES, TOLERANCE, WINDOW, BLOCK, BITS = 0.98, 4, 0.001, 64, 4096, 64
#: Rows of a block that are compared at a time.
STEP = 256
#: Components a block at most, and tiles a task on average.
BLOCK_VALUES, TASK_TILES = 1 << 20, 16
PACKED = "block long, label int, dim int, dense boolean, centre array<double>, radius double, ids binary, copies binary, data binary"


def _vectors(column) -> list[np.ndarray]:
    values, offsets = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b] - 0.0 for a, b in zip(offsets[:-1] - offsets[0], offsets[1:] - offsets[0], strict=True)]


def _unit(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _sign_keys(vectors: list[np.ndarray], dims: np.ndarray, passes: list[int], seed: int, planes: dict) -> np.ndarray:
    """Keys of the vectors (rows) in the passes (columns): hyperplane signs as longs in the order of the bits."""
    keys = np.zeros((len(vectors), len(passes)), np.uint64)
    for d in np.unique(dims).tolist():
        if d not in planes:
            planes[d] = np.concatenate([np.random.default_rng([seed, d, p]).standard_normal((d, BITS)) for p in passes], axis=1)
        at = np.nonzero(dims == d)[0]
        signs = (np.stack([vectors[i] for i in at]).astype(np.float64) @ planes[d]) > 0
        keys[at] = np.packbits(signs.reshape(len(at), len(passes), BITS), axis=2).view(">u8")[:, :, 0]
    return (keys ^ np.uint64(1 << 63)).view(np.int64)


def _pass_batches(batches, passes, seed):
    """(pass, label, dim, key, class_id), one row a vector and pass."""
    planes: dict[int, np.ndarray] = {}
    for b in batches:
        vectors, n = _vectors(b.column("v")), b.num_rows
        dims, each = np.array([len(v) for v in vectors], np.int32), np.repeat(np.arange(n), len(passes))
        yield pa.RecordBatch.from_pydict({
            "pass": pa.array(np.tile(np.array(passes, np.int32), n)), "label": b.column("label").take(pa.array(each)), "dim": pa.array(dims[each]),
            "key": pa.array(_sign_keys(vectors, dims, passes, seed, planes).reshape(-1)), "class_id": b.column("class_id").take(pa.array(each))})


def _numbered_batches(batches):
    """Rows with the number of their partition and their place in it."""
    from pyspark import TaskContext

    part, at = TaskContext.get().partitionId(), 0
    for b in batches:
        yield pa.RecordBatch.from_pydict({"pass": b.column("pass"), "class_id": b.column("class_id"), "part": pa.array(np.full(b.num_rows, part, np.int32)), "at": pa.array(np.arange(at, at + b.num_rows))})
        at += b.num_rows


def window_links(x: np.ndarray, label: np.ndarray, threshold: float, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (i < j) of rows in order, at most ``window`` apart, that link, without the dense rows' pairs, and which rows are dense."""
    n, found, dense = len(x), [], np.zeros(len(x), bool)
    for at in range(0, n, STEP):
        rows, cols = slice(at, min(n, at + STEP)), slice(at + 1, min(n, at + STEP + window))
        ahead = np.arange(cols.start, cols.stop)[None, :] - np.arange(rows.start, rows.stop)[:, None]
        near = (x[rows] @ x[cols].T >= threshold) & (ahead >= 1) & (ahead <= window) & (label[rows][:, None] == label[cols][None, :])
        dense[rows] = near.sum(axis=1) > window // 2
        i, j = np.nonzero(near)
        found.append((i + at, j + at + 1))
    i, j = map(np.concatenate, zip(*found, strict=True))
    sparse = ~(dense[i] | dense[j])
    return i[sparse], j[sparse], dense


def _block_batches(batches, threshold, window):
    """(a, b): links between classes a < b, and (a, null) for dense classes, from rows sorted by block and place."""
    def links(label, ids, vectors):
        dims, out, thick = np.array([len(v) for v in vectors]), [], []
        for d in np.unique(dims):
            at = np.nonzero(dims == d)[0]
            i, j, dense = window_links(_unit(np.stack([vectors[k] for k in at])), label[at], threshold, window)
            out.append(np.sort(np.stack([ids[at[i]], ids[at[j]]], axis=1), axis=1))
            thick.append(ids[at[dense]])
        pairs, thick = np.unique(np.concatenate(out), axis=0), np.concatenate(thick)
        return pa.RecordBatch.from_pydict({"a": pa.array(np.append(pairs[:, 0], thick)), "b": pa.concat_arrays([pa.array(pairs[:, 1]), pa.nulls(len(thick), pa.int64())])})

    held = None
    for b in batches:
        new = (b.column("block").to_numpy(), b.column("label").to_numpy(), b.column("class_id").to_numpy(), _vectors(b.column("v")))
        held = new if held is None else (*(np.concatenate([h, x]) for h, x in zip(held[:3], new[:3], strict=True)), held[3] + new[3])
        cuts = np.append(0, np.nonzero(np.diff(held[0]))[0] + 1)
        for a, e in zip(cuts[:-1], cuts[1:], strict=True):
            yield links(*(h[a:e] for h in held[1:]))
        held = tuple(h[cuts[-1] :] for h in held)
    if held is not None and len(held[0]):
        yield links(*held[1:])


def pass_links(classes: DataFrame, passes: list[int], threshold: float, window: int, block: int, seed: int) -> DataFrame:
    """(a, b) links between classes (class_id, label, v) that the passes find, (a, null) for those dense in one of them."""
    keys = map_batches(classes.select("class_id", "label", "v"), partial(_pass_batches, passes=passes, seed=seed), "pass int, label int, dim int, key long, class_id long")
    order = ["pass", "label", "dim", "key", "class_id"]
    numbered = cut(map_batches(keys.repartitionByRange(*order).sortWithinPartitions(*order), _numbered_batches, "pass int, class_id long, part int, at long"))
    before, total = [], 0
    for part, n in sorted((r["part"], r["count"]) for r in numbered.groupBy("part").count().collect()):  # one row a partition
        before.append((part, total))
        total += n
    offsets = classes.sparkSession.createDataFrame(before, "part int, before long")
    shift = F.pmod(F.col("pass") * 1597, F.lit(block))  # block limits fall elsewhere in each pass
    placed = numbered.join(F.broadcast(offsets), "part").select("pass", "class_id", (F.col("before") + F.col("at")).alias("place"), shift.alias("shift"))
    own = F.shiftleft(F.col("pass").cast("long"), 40) + F.floor((F.col("place") + F.col("shift")) / block)  # never shared by passes
    margin = F.when((F.col("place") + F.col("shift")) % block < window, own - 1)
    blocks = placed.select("class_id", "place", F.explode(F.array_compact(F.array(own, margin))).alias("block"))
    rows = blocks.join(classes.select("class_id", "label", "v"), "class_id").select("block", "place", "label", "class_id", "v")
    found = map_batches(rows.repartition("block").sortWithinPartitions("block", "place"), partial(_block_batches, threshold=threshold, window=window), "a long, b long")
    return found.distinct()


def _key_batches(batches, seed):
    planes: dict[int, np.ndarray] = {}
    for b in batches:
        vectors = _vectors(b.column("v"))
        dims = np.array([len(v) for v in vectors], np.int32)
        keys = _sign_keys(vectors, dims, [0], seed, planes)[:, 0]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(dims), pa.array(keys)], names=[*b.schema.names, "dim", "key"])


def _pack_batches(batches, block):
    """Blocks of rows of one label and length, dense or not, one row a block, from rows in order."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 33

    def packed():
        data = np.stack([v for _, _, v in rows]).astype(np.float32)
        x = _unit(data)
        centre = x.sum(axis=0)
        centre = centre / np.linalg.norm(centre) if np.linalg.norm(centre) > 1e-6 else x[0]
        radius = float(np.arccos(np.clip(x @ centre, -1, 1)).max())
        ids, copies = (np.array([r[k] for r in rows], np.int64).tobytes() for k in (0, 1))
        return pa.RecordBatch.from_pydict({
            "block": pa.array([number]), "label": pa.array([group[0]], pa.int32()), "dim": pa.array([group[1]], pa.int32()), "dense": pa.array([group[2]]), "centre": pa.array([centre.tolist()], pa.list_(pa.float64())),
            "radius": pa.array([radius]), "ids": pa.array([ids], pa.binary()), "copies": pa.array([copies], pa.binary()), "data": pa.array([data.tobytes()], pa.binary())})

    rows, group = [], None
    for b in batches:
        for label, class_id, copies, dense, v in zip(*(b.column(c).to_pylist() for c in ("label", "class_id", "copies", "dense")), _vectors(b.column("v")), strict=True):
            if rows and ((label, len(v), dense) != group or len(rows) >= min(block, max(1, BLOCK_VALUES // len(v)))):
                yield packed()
                rows, number = [], number + 1
            group = (label, len(v), dense)
            rows.append((class_id, copies, v))
    if rows:
        yield packed()


def tile_links(x: np.ndarray, y: np.ndarray, threshold: float, window: int):
    """Pairs of row numbers (of x, of y) with cosine at the threshold or above, ``window`` rows of x at a time; rows are of unit length."""
    for at in range(0, len(x), window):
        i, j = np.nonzero(x[at : at + window] @ y.T >= threshold)
        yield i + at, j


def _tile_batches(batches, threshold, window):
    """(class_id, linked, other): copies of the vectors linked to a class within a tile, and an edge of the tile's spanning forest."""
    rows = (r for b in batches for k in range(b.num_rows) for r in b.slice(k, 1).to_pylist())
    for _, sides in groupby(rows, key=lambda r: r["tile"]):
        sides = [(np.frombuffer(r["ids"], np.int64), np.frombuffer(r["copies"], np.int64), _unit(np.frombuffer(r["data"], np.float32).reshape(-1, r["dim"]))) for r in sides]
        ids, copies = (np.concatenate([s[k] for s in sides]) for k in (0, 1))
        n, x, y = len(ids), sides[0][2], sides[-1][2]
        linked, edges = np.zeros(n, np.int64), []
        for i, j in tile_links(x, y, threshold, window):
            i, j = (i[i < j], j[i < j]) if len(sides) == 1 else (i, j + len(x))  # each pair once
            if len(i):
                linked += (np.bincount(i, copies[j], n) + np.bincount(j, copies[i], n)).astype(np.int64)
                root = _forest(n, i, j)
                at = np.nonzero(root != np.arange(n))[0]
                edges.append((at, root[at]))
        if edges:
            at = np.nonzero(linked)[0]
            root = _forest(n, *map(np.concatenate, zip(*edges, strict=True)))
            yield pa.RecordBatch.from_pydict({"class_id": pa.array(ids[at]), "linked": pa.array(linked[at]), "other": pa.array(ids[root[at]])})


def dense_links(classes: DataFrame, dense: DataFrame, threshold: float, step: int, block: int, seed: int) -> DataFrame:
    """(class_id, linked, other) of every tile of dense (class_id) classes with all of their label: links counted, and edges that connect what is linked."""
    marked = classes.join(dense.withColumn("dense", F.lit(True)), "class_id", "left").withColumn("dense", F.coalesce("dense", F.lit(False)))
    marked = marked.join(marked.where("dense").select("label").distinct(), "label", "left_semi")
    keyed = map_batches(marked.select("class_id", "label", "copies", "dense", "v"), partial(_key_batches, seed=seed), "class_id long, label int, copies long, dense boolean, v array<float>, dim int, key long")
    order = ["label", "dim", "dense", "key", "class_id"]
    blocks = cut(map_batches(keyed.repartitionByRange(*order).sortWithinPartitions(*order), partial(_pack_batches, block=block), PACKED))
    one = blocks.where("dense").select("label", "dim", "block", "centre", "radius")
    two = blocks.select("label", "dim", F.col("block").alias("other"), F.col("dense").alias("o_dense"), F.col("centre").alias("o_centre"), F.col("radius").alias("o_radius"))
    cosine = F.aggregate(F.zip_with("centre", "o_centre", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))
    reach = F.col("radius") + F.col("o_radius") + F.lit(acos(min(1.0, max(-1.0, threshold))) + 1e-5)  # beyond rounding
    pairs = one.join(two, ["label", "dim"]).where((F.col("block") == F.col("other")) | ((~F.col("o_dense") | (F.col("block") < F.col("other"))) & (angle <= reach)))
    tiles = cut(pairs.select("block", "other").withColumn("tile", F.monotonically_increasing_id()))
    n_tasks = max(-(-tiles.count() // TASK_TILES), 4 * classes.sparkSession.sparkContext.defaultParallelism)
    sides = tiles.select("tile", F.explode(F.array_distinct(F.array("block", "other"))).alias("block"))
    rows = sides.join(blocks.select("block", "dim", "ids", "copies", "data"), "block").repartition(n_tasks, "tile").sortWithinPartitions("tile", "block")
    return map_batches(rows, partial(_tile_batches, threshold=threshold, window=step), "class_id long, linked long, other long")


def settled(found: DataFrame, window: int) -> DataFrame:
    """(a, null) for the dense classes, also those with more links than half a window, and (a, b) for links between all others."""
    pairs = cut(found)
    ends = pairs.where("b is not null").select(F.explode(F.array("a", "b")).alias("a"))
    heavy = ends.groupBy("a").count().where(F.col("count") > window // 2).select("a")
    dense = cut(pairs.where("b is null").select("a").union(heavy).distinct())
    sparse = pairs.where("b is not null").join(dense, "a", "left_anti").join(dense.select(F.col("a").alias("b")), "b", "left_anti")
    return cut(sparse.select("a", "b").union(dense.select("a", F.lit(None).cast("long").alias("b"))))


def class_links(classes: DataFrame, threshold: float, passes: int, tolerance: float, window: int, block: int, seed: int) -> DataFrame:
    """(class_id, linked, other) of classes (class_id, label, v, copies): links counted once, and edges that connect what is linked."""
    found = settled(pass_links(classes, list(range(passes)), threshold, window, block, seed), window)
    n, made = found.count(), passes
    while n:
        wider = settled(found.union(pass_links(classes, list(range(made, 2 * made)), threshold, window, block, seed)).distinct(), window)
        new = wider.alias("w").join(found.alias("f"), (F.col("w.a") == F.col("f.a")) & F.col("w.b").eqNullSafe(F.col("f.b")), "left_anti").count()
        found, n, made = wider, wider.count(), 2 * made
        if new <= tolerance * n:
            break
    dense = found.where("b is null").select(F.col("a").alias("class_id"))
    pairs, sizes = found.where("b is not null"), classes.select(F.col("class_id").alias("other"), "copies")
    both = pairs.select(F.col("a").alias("class_id"), F.col("b").alias("other")).union(pairs.select("b", "a"))
    links = both.join(sizes, "other").select("class_id", F.col("copies").alias("linked"), "other")
    return links.union(dense_links(classes, dense, threshold, STEP, block, seed)) if dense.limit(1).count() else links


def embedding_components(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD,
                         passes: int = PASSES, tolerance: float = TOLERANCE, window: int = WINDOW, block: int = BLOCK, seed: int = 7) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row a vector."""
    v = F.col(vector_col).cast("array<float>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), F.col(label_col).cast("int").alias("label"))
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite, F.lit(False))
    grouped = rows.where(usable).groupBy("label", "v").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id"))
    classes = cut(grouped.withColumn("class_id", F.monotonically_increasing_id()))  # the ids are fixed by the checkpoint
    links = cut(class_links(classes, threshold, passes, tolerance, window, block, seed))
    n_links = links.groupBy("class_id").agg(F.sum("linked").alias("linked"))
    roots = connected_components(links, "class_id", "other")
    named = classes.join(roots, classes.class_id == roots.node, "left").select("class_id", "label", "v", "copies", "first_id", F.coalesce("root", "class_id").alias("root"))
    first = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = cut(named.join(first, "root").join(n_links, "class_id", "left").select(
        F.col("label").alias("c_label"), F.col("v").alias("c_v"), (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id"))
    found = rows.where(usable).join(known, (F.col("label") == F.col("c_label")) & (F.col("v") == F.col("c_v"))).select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
