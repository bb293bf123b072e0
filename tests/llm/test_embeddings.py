import numpy as np

from newsflow.llm import embedding_dedup as E
from newsflow.llm.simhash_dedup import _forest

SCHEMA = "vec_id long, embedding array<float>, label int, copies long, v string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def brute(rows):
    x = np.array([r[1] for r in rows], np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (x @ x.T >= 0.98) & (label[:, None] == label[None, :])
    root = _forest(len(rows), *np.nonzero(near))
    return {r[0]: (int(near[i].sum()) - 1, rows[root[i]][0]) for i, r in enumerate(rows)}


def clustered(seed, n=600, dim=24, noise=0.08, clusters=60):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((clusters, dim))
    weights = np.append(0.3, np.full(clusters - 1, 0.7 / (clusters - 1)))
    at = rng.choice(clusters, n, p=weights)
    x = centres[at] + noise * rng.standard_normal((n, dim))
    x[::50] = x[0]
    return [(i, x[i].astype(np.float32).tolist(), int(at[i]) % 3) for i in range(n)]


def test_recall_against_brute_force(spark):
    rows = clustered(1)
    want = brute(rows)
    got = {r.vec_id: r for r in E.embedding_components(frame(spark, rows), block=256, window=16).collect()}
    assert got.keys() == want.keys()
    true, links = sum(n for n, _ in want.values()), sum(r.n_links for r in got.values())
    assert true > 4000 and 0.9 * true <= links <= true
    assert all(r.n_links <= want[i][0] for i, r in got.items())
    assert sum(r.component_id == want[i][1] for i, r in got.items()) >= 0.95 * len(got)
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_rows_of_a_dense_run_are_marked():
    x = np.append(np.ones((1000, 4)) / 2, np.eye(4) - 0.0, axis=0)
    i, j, dense = E.window_links(x, np.zeros(len(x), int), 0.98, 16)
    assert dense[:990].all() and not dense[1000:].any() and (i < j).all() and not (dense[i] | dense[j]).any()
    i, j, dense = E.window_links(x, np.arange(len(x)), 0.98, 16)  # labels of their own
    assert not len(i) and not dense.any()


def test_passes_alone_find_pairs_of_a_sparse_table(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((2000, 24))
    x = np.concatenate([x, x[:400] + 0.02 * rng.standard_normal((400, 24))])
    rows = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(x)]
    classes = spark.createDataFrame([(i, v, label) for i, v, label in rows], "class_id long, v array<float>, label int")
    got = {(r.a, r.b) for r in E.pass_links(classes, list(range(8)), 0.98, 16, 256, 7).collect()}
    assert got <= {(i, 2000 + i) for i in range(400)} and len(got) >= 392  # none is dense


def test_awkward_rows(spark):
    v, nan, inf = [1.0, 0.0], float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0), (6, [None, 1.0], 0), (7, v, None), (8, v, 1), (9, [2.0, 0.0], 1), (10, v, 1), (11, v, 2),
            (12, [1.0, 0.0, 0.0], 1), (None, v, 1), (13, v, 3), (13, v, 3), (14, [-0.0, 1.0], 4), (15, [0.0, 1.0], 4)]
    got = E.embedding_components(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    assert all(by[i] == (0, i, True) for i in (1, 2, 3, 4, 5, 6, 7, 11, 12)) and by[None][0] == 0
    assert by[8] == (2, 8, True) and by[9] == (2, 8, False) and by[10] == (2, 8, False)
    assert by[13] == (1, 13, True) and by[14] == (1, 14, True) and by[15] == (1, 14, False)


def test_empty_table(spark):
    assert E.embedding_components(frame(spark, [(1, [1.0], 0)]).where("false")).count() == 0


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_a_dense_run_of_several_blocks_is_counted_in_full(spark):
    x = unit(1 + 0.02 * np.random.default_rng(2).standard_normal((3000, 16)))  # any two are linked, in about 12 blocks
    rows = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(x)]
    got = E.embedding_components(frame(spark, rows), block=256, window=16).collect()
    assert len(got) == 3000 and {r.n_links for r in got} == {2999} and {r.component_id for r in got} == {0}


def test_every_link_of_a_dense_skewed_label(spark):
    rng = np.random.default_rng(3)
    noise = lambda n, size: size * rng.standard_normal((n, 64)) / 8
    topic = unit(unit(rng.standard_normal((1, 64))) + noise(3000, 0.23))  # cosine about 0.95 to each other
    near = unit(topic[:300] + noise(300, 0.17))  # about 0.985 to their partners
    x = np.concatenate([topic, near, unit(rng.standard_normal((100, 64)))])
    rows = [(i, v.astype(np.float32).tolist(), int(i >= 3300)) for i, v in enumerate(x)]
    want = brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.embedding_components(frame(spark, rows), block=256, window=16).collect()}
    assert got == want and sum(n for n, _ in want.values()) >= 500
