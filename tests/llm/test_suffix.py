import hashlib
from collections import Counter

import numpy as np
import pytest

from newsflow.llm import queries
from newsflow.llm import suffix_dedup as S
from tests.llm.data import AWKWARD, SF, docs


def brute(texts, n):
    """Per text (bytes, removed, spans, digest of the rest), by counting every window."""
    count = Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - n + 1):
            if count[t[i : i + n]] > 1:
                gone[i : i + n] = True
        edge = np.diff(np.concatenate([[0], gone.astype(np.int8)]))
        out.append((len(t), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return out


def rows_of(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def want_of(rows, n):
    return Counter((r[0], *b) for r, b in zip(rows, brute([(r[1] or "").encode() for r in rows], n), strict=True))


@pytest.mark.parametrize("sigma", [1, 2, 4])
def test_windows_by_backward_extension(sigma):
    rng = np.random.default_rng(sigma)
    for _ in range(60):
        n = int(rng.integers(1, 12))
        regions = [bytes(rng.integers(0, sigma, int(rng.integers(0, 40))).astype(np.uint8)) for _ in range(int(rng.integers(1, 8)))]
        counts = [int(c) for c in rng.integers(1, 3, len(regions))]
        total = Counter()
        for r, c in zip(regions, counts, strict=True):
            for i in range(len(r) - n + 1):
                total[r[i : i + n]] += c
        want = [S._runs(np.array([total[r[i : i + n]] > 1 for i in range(max(0, len(r) - n + 1))], bool), n) for r in regions]
        assert S.repeated_windows(regions, counts, n) == want


def test_common_prefixes_stop_at_the_depth():
    t = np.frombuffer(b"banana bandana banana\x00", np.uint8).astype(np.uint16)
    order, cls = S.prefix_classes(t, 3, wide=4)
    suffix = [bytes(t[i:].astype(np.uint8)) for i in order]
    assert suffix == sorted(suffix) or [s[:3] for s in suffix] == sorted(s[:3] for s in suffix)
    for i in range(1, len(suffix)):
        assert (cls[i] == cls[i - 1]) == (suffix[i][:3] == suffix[i - 1][:3] and len(suffix[i]) >= 3)


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(5)
    shared = bytes(rng.integers(97, 101, 900).astype(np.uint8))
    texts = [bytes(rng.integers(97, 123, k).astype(np.uint8)) + shared + bytes(rng.integers(97, 123, 700).astype(np.uint8)) for k in (0, 3, 200_000, 131_000)]
    row, anchor, _, start, end = S.text_regions(texts, 100, 16)
    keys = [{(t[i : i + 100]): a for r, a, s, e in zip(row, anchor, start, end, strict=True) if r == k for i in range(s, e - 99)} for k, t in enumerate(texts)]
    for t, k in zip(texts, keys, strict=True):
        assert len(k) == len({t[i : i + 100] for i in range(len(t) - 99)})
    common = set.intersection(*(set(k) for k in keys))
    assert len(common) >= 800 and all(len({k[w] for k in keys}) == 1 for w in common)


def test_table_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert rows_of(queries.op9_suffix_dedup(spark, SF)) == want_of(rows, 400)


@pytest.mark.parametrize("max_regions", [S.MAX_REGIONS, 2])
def test_passages_and_awkward_rows(spark, max_regions):
    rng = np.random.default_rng(9)
    word = lambda: "".join(chr(c) for c in rng.integers(97, 123, 5))
    passage = " ".join(word() for _ in range(30))
    texts = [" ".join(word() for _ in range(20)) + passage[k : len(passage) - k] + " ".join(word() for _ in range(20)) for k in range(12)]
    rows = AWKWARD + [(100 + i, t) for i, t in enumerate(texts)] + [(200, texts[0]), (201, "abc" * 100), (202, "é" * 70), (203, "é" * 20)]
    got = rows_of(S.remove_repeated(docs(spark, rows), min_bytes=60, gram=12, max_regions=max_regions))
    assert got == want_of(rows, 60)


def test_empty_table(spark):
    assert S.remove_repeated(docs(spark, AWKWARD).where("false")).count() == 0


def test_shorter_repeats_are_noted_and_stay(spark):
    """Passages of over fifty words under 400 bytes: nothing goes, most documents that share one are noted, others never."""
    import random

    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    rows, shares = [], set()
    for k in range(60):
        passage = text(58)[:340]
        for j in range(2):
            rows.append((2 * k + j, f"{text(150)} {passage} {text(150)}"))
            shares.add(2 * k + j)
    rows += [(1000 + k, text(360)) for k in range(60)]
    long_ = text(120)
    rows += [(2000, f"{text(90)} {long_} {text(90)}"), (2001, f"{text(50)} {long_}")]
    got = {x.doc_id: x for x in S.remove_repeated(docs(spark, rows)).collect()}
    assert all(got[i].n_removed == 0 for i in got if i < 2000)
    assert {i for i, x in got.items() if x.repeat_level == 2} == {2000, 2001}
    noted = {i for i, x in got.items() if x.repeat_level == 1}
    assert noted <= shares and len(noted) >= 0.75 * len(shares)
