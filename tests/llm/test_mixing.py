import re
from collections import Counter, defaultdict

from newsflow.llm import mixing as M
from tests.llm.data import AWKWARD, SF, docs


def water_fill(sizes, weights=(5, 2, 1)):
    """Targets as the contract says: the excess over three times a source is reshared until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in above}


def check(spark, frame, block_words=M.BLOCK_WORDS):
    rows = frame.collect()
    got = M.mix(frame, block_words=block_words).collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r.source, count(r.text)) for r in rows) == Counter((r.doc_id, r.source, r.size) for r in got)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    want = water_fill(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, r.target)
    assert all(abs(taken[s] - want[s]) <= max(1, min(block_words, sizes[s] / M.MIN_BLOCKS)) / 2 + 1 for s in sizes)
    assert sorted(map(str, got)) == sorted(map(str, M.mix(frame, block_words=block_words).collect()))


def test_table(spark):
    check(spark, spark.read.parquet(f"{SF}/documents.parquet"))


def test_full_sources_and_awkward_rows(spark):
    rows = [(i, "w " * 40, "en", "big") for i in range(50)] + [(100 + i, "x y z", "en", "a") for i in range(4)] + [(200, "q", "en", None), (201, None, "en", None), (202, "", "en", "void")]
    check(spark, docs(spark, rows), 4)
    check(spark, docs(spark, AWKWARD), 4)


def test_empty_tables(spark):
    none = docs(spark, AWKWARD).where("false")
    assert M.mix(none).count() == 0
    blank = docs(spark, [(1, None), (2, "")])
    assert [(r.size, r.taken) for r in M.mix(blank).collect()] == [(0, 0), (0, 0)]


def test_small_sources_meet_their_targets(spark):
    rows = [(10_000 + i, "w " * 500, "en", "big") for i in range(40)]
    for size in (*range(1, 101), 150, 333):
        rows += [(100 * size + k, "x " * (size // 2 + k * (size % 2)), "en", f"s{size:03d}") for k in range(2)]
    check(spark, docs(spark, rows))


def test_slots_are_ranked_without_gaps(spark):
    due = {0: 20_001, 1: 0, 2: 9_999, 3: 1, 4: 10_000}
    blocks = spark.createDataFrame(list(due.items()), "source_no int, n_slots long")
    rows = sorted(M.slot_schedule(spark, blocks, sum(due.values())).collect(), key=lambda r: r.slot)
    by = defaultdict(list)
    for r in rows:
        by[r.source_no].append(r["rank"])
    assert all(v == list(range(due[k])) for k, v in by.items()) and [len(by[k]) for k in due] == list(due.values())
    # low discrepancy: every prefix holds the sources in about their shares
    at = Counter()
    for n, r in enumerate(rows, 1):
        at[r.source_no] += 1
        assert abs(at[0] - n * due[0] / len(rows)) < 12 and abs(at[2] - n * due[2] / len(rows)) < 12


def test_points_of_a_long_schedule():
    for n in (1, 2, 3, 4, 97, 1 << 31, (1 << 42) - 2):
        g = M.lattice_step(n)
        assert M.gcd(g, n) == 1 and (n < 100 or abs(g - n * M.GOLDEN) < 100)
        half = 1 << M.HALF_BITS
        for slot in {0, n // 2, n - 1}:
            parts = (slot // half * g, slot // half * g % n * half, slot % half * g)
            assert max(parts) < 1 << 63 and (parts[1] % n + parts[2] % n) % n == slot * g % n
