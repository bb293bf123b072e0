import itertools
import random

import pytest

from newsflow.llm import decontaminate as D
from tests.llm.data import AWKWARD, docs, table

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def bench(spark, *texts):
    return spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "item_id long, text string, doc_id string")


def found(spark, rows, *texts, **more):
    return sorted((r.doc_id, tuple(r.item_ids)) for r in D.contaminated(docs(spark, rows), bench(spark, *texts), **more).collect())


@pytest.mark.parametrize("n", range(1, 14))
def test_masks_hit_whatever_is_substituted(n):
    """Every way to substitute as many words of an n-word item as the threshold admits leaves a mask's words whole."""
    masks = D.MASKS if n >= 8 else D.short_masks(n)
    allowed = n - next(k for k in range(n + 1) if k >= n * 0.8 - 1e-9)
    for gone in itertools.combinations(range(n), allowed):
        assert any(all(m[o] == "0" or at + o not in gone for o in range(len(m))) for m in masks for at in range(n - len(m) + 1))


@pytest.mark.parametrize("max_broadcast", [D.MAX_BROADCAST, 0])
def test_passages_and_substitutions(spark, max_broadcast):
    words, rng = ITEM.split(), random.Random(3)
    filler = [f"w{i}" for i in range(200)]

    def planted(text):
        return " ".join(rng.sample(filler, 40)) + ". " + text + ", " + " ".join(rng.sample(filler, 40))

    two_of_13 = words[:2] + ["x"] + words[3:9] + ["y"] + words[10:13]
    three_of_13 = words[:2] + ["x"] + words[3:6] + ["z"] + words[7:9] + ["y"] + words[10:13]
    rows = [(1, planted(ITEM)), (2, planted(ITEM.upper())), (3, planted(" ".join(two_of_13))), (4, planted(" ".join(three_of_13))), (5, planted("")), (6, " ".join(words[4:18])),
            (7, planted(" ".join(reversed(words)))), (8, planted(" ".join(words[:9])))]
    assert [d for d, _ in found(spark, rows, ITEM, max_broadcast=max_broadcast)] == [1, 2, 3, 6]


def test_short_items(spark):
    rows = [(1, "it says one two three here"), (2, "one x three"), (3, "a b c d e and more"), (4, "a b X d e and more"), (5, "a b X d Y")]
    assert found(spark, rows, "one two three", "a b c d e") == [(1, (0,)), (3, (1,)), (4, (1,))]


def test_awkward_rows_and_empty_tables(spark):
    assert found(spark, AWKWARD, None, "", "...") == []
    assert found(spark, AWKWARD, "word two three four") == [(None, (0,))]
    assert found(spark, AWKWARD) == []
    none = docs(spark, AWKWARD).where("false")
    assert D.contaminated(none, bench(spark, ITEM)).count() == 0
    rows = AWKWARD + [(9, ITEM), (9, ITEM), (9, "clean")]
    kept = D.clean_documents(docs(spark, rows), bench(spark, ITEM)).collect()
    assert len(kept) == len(AWKWARD) + 1 and (9, "clean") in [(r.doc_id, r.text) for r in kept]


def test_no_python_and_no_cross_join(spark, capsys):
    D.contaminated(table(spark, "documents"), table(spark, "benchmark")).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("max_broadcast", [D.MAX_BROADCAST, 0])
def test_long_document_full_of_passages(spark, max_broadcast):
    """120 000 hits in a text of 40 000 words: with the whole text beside each of them they took 38 GB of a task."""
    rows = [(1, f"{ITEM} " * 2_000), (2, "x " * 40_000), (3, "y " * 40_000 + ITEM)]
    assert found(spark, rows, ITEM, max_broadcast=max_broadcast) == [(1, (0,)), (3, (0,))]


@pytest.mark.parametrize("at", [0, 1, D.PIECE - 21, D.PIECE - 13, D.PIECE - 5, D.PIECE - 1, D.PIECE, D.PIECE + D.REACH, 2 * D.PIECE - 7, 3 * D.PIECE])
def test_passages_across_pieces(spark, at):
    words = ITEM.split()
    passage = [*words[3:6], "x", *words[7:14], "y", words[15]]
    rows = [(k, " ".join([f"w{i}" for i in range(at)] + passage[:13 - k] + [f"v{i}" for i in range(200)])) for k in range(3)]
    got = D.contaminated(docs(spark, rows), bench(spark, ITEM)).collect()
    assert [(r.doc_id, r.item_ids, r.best) for r in got] == [(0, [0], 11 / 13)]


def test_items_of_one_text_are_compared_once_and_all_listed(spark):
    rows = [(1, f"so {ITEM} it is"), (2, "clean")]
    assert found(spark, rows, ITEM, "other words here", ITEM.upper(), ITEM) == [(1, (0, 2, 3))]
