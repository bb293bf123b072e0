import numpy as np
import pytest
import xxhash

from newsflow.llm import simhash_dedup as S
from tests.llm.data import AWKWARD, docs, table


def plain(text):
    """The fingerprint as its contract says it, without arrays."""
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({c: 32 for c in range(9, 14)}).split(" ")
    words = [w for w in words if w]
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps):
    ids = sorted(fps)
    comp = {i: i for i in ids}
    for _ in ids:
        new = {i: min(comp[j] for j in ids if bin(fps[i] ^ fps[j]).count("1") <= 2) for i in ids}
        if new == comp:
            return comp
        comp = new
    return comp


def test_table_against_brute_force(spark):
    rows = table(spark, "documents").collect()
    fps = {r.doc_id: plain(r.text) for r in rows}
    got = S.simhash_components(table(spark, "documents")).collect()
    assert {r.id: r.fp & (1 << 64) - 1 for r in got} == fps
    assert {r.id: r.component_id for r in got} == components(fps)


def test_awkward_rows(spark):
    got = S.simhash_components(docs(spark, AWKWARD)).collect()
    assert len(got) == len(AWKWARD)
    zero = {r.id: r for r in got if r.id in (1, 2, 3)}
    assert all(r.fp == 0 and r.component_id == 1 for r in zero.values())
    assert next(r for r in got if r.id is None).component_id is None
    kept = S.keep_first_of_group(docs(spark, AWKWARD)).collect()
    assert sorted((r.doc_id or -1) for r in kept) == [-1, 1, 4, 5, 6, 7, 8]
    assert kept[0].asDict().keys() == docs(spark, AWKWARD).limit(0).toPandas().to_dict().keys()


def test_same_id_with_other_text(spark):
    rows = [(1, "one two three four five"), (1, "quite another text that stands here"), (2, "one two three four five")]
    kept = S.keep_first_of_group(docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted(rows[:2])


def test_empty_table(spark):
    none = docs(spark, AWKWARD).where("false")
    assert S.simhash_components(none).count() == 0
    assert S.keep_first_of_group(none).count() == 0


@pytest.mark.parametrize("run_max", [4096, 3])
@pytest.mark.parametrize("max_bits", [1, 2, 3])
def test_links_connect_what_pairs_connect(spark, max_bits, run_max):
    """Random fingerprints in dense clusters; with run_max 3 nearly all go through the path for oversize cells."""
    rng = np.random.default_rng(max_bits)
    base = rng.integers(0, 1 << 63, 6).tolist()
    values = {int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 5), replace=False)) for b in base for _ in range(25)}
    fps = sorted((v - (1 << 64) if v >> 63 else v) for v in values)
    found = S.fingerprint_links(spark.createDataFrame([(v,) for v in fps], "fp long"), max_bits, run_max).collect()
    a = np.array(fps, np.int64).view(np.uint64)
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= max_bits
    index = {v: i for i, v in enumerate(fps)}
    i, j = np.nonzero(near)
    x, y = (np.array([index[r[c]] for r in found], int) for c in "ab")
    assert (S._forest(len(fps), i, j) == S._forest(len(fps), x, y)).all()
