import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsflow.llm import periodic_runs as R
from newsflow.llm import queries
from tests.llm.data import AWKWARD, SF, docs, table


def longest_lyndon(x):
    out = []
    for i in range(len(x)):
        end = next(k for k in range(i, len(x)) if not x[k])
        out.append(next((j for j in range(i + 1, end) if x[j:end] < x[i:end]), end) - i if x[i] else 0)
    return out


def plain_runs(x, min_exponent=4, min_length=6):
    out, n = [], len(x)
    for q in range(1, n):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(min_length, min_exponent * q) and not any(q % d == 0 and all(x[t] == x[t + d] for t in range(i, i + size - d)) for d in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40))
def test_lyndon_array(x):
    assert R.lyndon_array([*x, 0]) == longest_lyndon([*x, 0])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=25), st.integers(1, 6), st.integers(0, 3)), max_size=4), st.sampled_from([(4, 6), (2, 2), (3, 1), (2, 6)]))
def test_runs_against_every_period(parts, least):
    texts = [np.array(w * n + w[:tail], np.int64) for w, n, tail in parts]
    got = [[tuple(r) for r in a.tolist()] for a in R.text_runs(texts, *least)]
    assert got == [plain_runs(t.tolist(), *least) for t in texts]


def test_hashes_that_agree_by_chance(monkeypatch):
    """Extensions are compared symbol by symbol: with hashes that are always equal the runs are the same."""
    x = np.array([1, 2, 3] * 6 + [1, 1, 2] * 5 + [3] * 8)
    monkeypatch.setattr(R._Extension, "_agree", lambda self, i, j, size: np.ones(len(i), bool))
    assert [tuple(r) for r in R.runs_of(x).tolist()] == plain_runs(x.tolist())


def test_long_texts_take_linear_time():
    for x in (np.ones(200_000, np.int64), np.tile(np.arange(1, 20_001), 10)):
        assert len(R.runs_of(x)) == 1
    with pytest.raises(ValueError):
        R.runs_of(np.ones(3, np.int64), min_exponent=1)


def expected(doc_id, text, plant):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    runs = plain_runs([number[w] for w in words])
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else None
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    return (-1 if doc_id is None else doc_id, len(runs), best, best and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_table(spark):
    """The registered query on all documents of a small table, against every period of every text."""
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    got = sorted((r.doc_id, r.n_runs, (r.start, r.length, r.period) if r.n_runs else None, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
                 for r in queries.op13_periodic_runs(spark, SF).collect())
    want = sorted(expected(i, t, True) for i, t in rows)
    assert got == want and any(r[1] for r in want) and any(not r[1] for r in want)


def test_awkward_rows(spark):
    r = random.Random(2)
    rows = [*AWKWARD, (9, "a b " * 20 + "c"), (9, "a b " * 20 + "c"), (10, "x x " * 7), (11, "\x0b".join("k" * 6)), (12, " ".join(r.choice("ab") for _ in range(400))), (13, "p q r s " * 3)]
    found = R.find_runs(docs(spark, rows)).collect()
    got = [(-1 if f.doc_id is None else f.doc_id, len(f.runs), f.best and tuple(f.best), hashlib.sha256(f.collapsed).hexdigest()) for f in found]
    short = [(i, t) for i, t in rows if t != "w " * 30_000]
    want = [expected(i, t, False) for i, t in short]
    want = [(w[0], w[1], w[2], w[5]) for w in want] + [(7, 1, (0, 30_000, 1), hashlib.sha256(b"w").hexdigest())]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert R.find_runs(docs(spark, rows).where("false")).count() == 0
