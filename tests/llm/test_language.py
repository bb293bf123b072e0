import math
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsflow.llm import language_id as L
from tests.llm.data import AWKWARD, docs


def plain_length(text, train, order):
    """Code length by the definition of PPM (method C, no exclusions), byte by byte."""
    counts = defaultdict(Counter)
    for t in train:
        for i in range(len(t)):
            for d in range(min(order, i) + 1):
                counts[t[i - d : i]][t[i]] += 1
    bits = 0.0
    for i, x in enumerate(text):
        p = 1.0
        for d in range(min(order, i), -1, -1):
            c = counts.get(text[i - d : i])
            if not c:
                continue
            total, kinds = sum(c.values()), len(c)
            if x in c:
                p *= c[x] / (total + kinds)
                break
            p *= kinds / (total + kinds)
        else:
            p /= 256
        bits -= math.log2(p)
    return bits


def model_of(train, order):
    rows = [r for lang, texts in train.items() for b in L._count_batches([batch(lang, texts)], order) for r in b.to_pylist()]
    frame = pd.DataFrame(rows).groupby(["lang", "depth", "context", "symbol"], as_index=False)["n"].sum()
    return L.compile_model(frame, order)


def batch(lang, texts):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({"lang": [lang] * len(texts), "text": pa.array(texts, pa.binary())})


@pytest.mark.parametrize("order", [0, 1, 2, 3])
def test_code_lengths_are_exact(order):
    train = {"a": [b"abracadabra abra", b"cadabra"], "b": [b"bananas and bandanas", "äöü".encode()]}
    model = model_of(train, order)
    texts = [b"abracadabra", b"banana split", b"", b"\xff\x00z", "äbra".encode(), b"a" * 50]
    got = L.code_lengths(model, texts)
    for k, lang in enumerate(model.languages):
        # one tree for all languages: a language that hasn't seen a context goes on without an escape, as here
        np.testing.assert_allclose(got[:, k], [plain_length(t, train[lang], order) for t in texts], rtol=1e-5)


def test_long_text_in_pieces(monkeypatch):
    model = model_of({"a": [b"abracadabra"], "b": [b"bananas"]}, 3)
    text = b"abracadabananas " * 40
    whole = L.code_lengths(model, [text])
    monkeypatch.setattr(L, "_PIECE", 37)
    np.testing.assert_allclose(L.code_lengths(model, [text, b"x"])[:1], whole, rtol=1e-6)


def test_held_out_accuracy(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = L.fit(rows, sample_rows=200)
    held = L.predict(rows, model, keep=[F.col("lang"), L.learnable().alias("seen")]).where("not seen").collect()
    assert len(held) > 250 and sum(r.lang == r["__lang_pred"] for r in held) / len(held) >= 0.97
    assert all(0 <= r["__lang_score"] <= 1 for r in held)


def test_awkward_rows(spark):
    rows = docs(spark, [*AWKWARD, (20, "the cat sat on the mat", "en"), (21, "el gato se sienta", "es"), (22, "12 34 !?", "es"), (23, "text", None)])
    model = L.fit(rows)
    got = {r.doc_id: r for r in L.predict(rows, model).collect()}
    for i in (1, 2, 3, 22):
        assert got[i]["__lang_pred"] == "und" and got[i]["__lang_score"] == 0
    assert set(model.languages) <= {"en", "es"} and got[7]["__lang_pred"] in model.languages
    assert L.predict(rows.where("false"), model).count() == 0
    nothing = L.fit(rows.where("false"))
    assert {r["__lang_pred"] for r in L.predict(rows, nothing).collect()} == {"und"}


def test_training_leaves_out_held_rows_and_bounds_the_rest(spark):
    rows = docs(spark, [(i, f"text {i}", "en") for i in range(60)])
    sample = L.training_sample(rows, "doc_id", "text", "lang", L.learnable(), 10).collect()
    import zlib

    assert len(sample) == 10 and all(zlib.crc32(r.text.split()[1].encode()) % 3 != 1 for r in sample)


def test_a_rare_language_keeps_its_whole_tree(spark):
    rng = np.random.default_rng(5)
    large = bytes(rng.choice(np.frombuffer(b"abcdefghijklmnopqrst", np.uint8), 60_000)).decode()  # over 12,000 contexts, often seen
    rare = "the quick brown fox jumps over the lazy dog and the lazy dog sleeps"
    model = L.train(spark.createDataFrame([("big", large), ("big", large), ("rare", rare)], "lang string, text string"))
    texts = [b"the lazy fox jumps", rare.encode()]
    want = [plain_length(t, [rare.encode()], L.ORDER) for t in texts]
    np.testing.assert_allclose(L.code_lengths(model, texts)[:, model.languages.index("rare")], want, rtol=1e-5)
