import hashlib
import re

import pytest
from pyspark.sql import functions as F

from newsflow.llm import pii as P
from newsflow.llm import queries
from tests.llm.data import AWKWARD, SF, docs

RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain(text):
    """Base spans by the contract's own patterns."""
    out = []
    for k, (kind, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) or kind == "card" and 12 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15:
                out.append((m.start(), k, m.end()))
    return ",".join(f"{P.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


TRICKY = [
    "a@b.c", "a@b.c_d@e.f", "x..y%+-@h-1.co.uk.", "a@b", "@b.c", "a@@b.c", "é@b.c a@é.c", "a@b.c@d.e", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.256", "0000255.1.2.3", "1.2.3", "4111 1111 1111 1111", "4111-1111 11111111",
    "41111111111111112", "4111  1111 1111 1111", "+1 (743) 555-3824", "+1 2", "+49 30 1234567890123456", "++1 234 567 890 1", "+1 (((((", "+12-34.56 78 90)", "9" * 400, "1 " * 300, "a@" * 200, "1." * 200, "漢字 a@b.cd 漢 1.2.3.4 \U0001f600 +1 743 555 3824",
    "a@1.2.3.4", "x" * 3000 + "@y.z", "a@" + "b." * 5000 + "c"]


@pytest.fixture(scope="module")
def found(spark):
    rows = docs(spark, [*AWKWARD, *[(100 + i, t) for i, t in enumerate(TRICKY)]])
    return P.find_pii(rows, [F.col("doc_id"), F.col("text")]).select("*", P.spans_text(F.col("base")).alias("b"), P.spans_text(F.col("spans")).alias("s"), P.masked(F.col("text"), F.col("spans")).alias("m")).collect()


def test_base_spans_of_tricky_texts(found):
    assert len(found) == len(AWKWARD) + len(TRICKY)
    for r in found:
        assert r.b == plain(r.text), r.text[:80]
        assert set(filter(None, r.b.split(","))) <= set(r.s.split(","))


def test_masking(found):
    by = {r.text: r.m for r in found}
    assert by["漢字 a@b.cd 漢 1.2.3.4 \U0001f600 +1 743 555 3824"] == "漢字 <email> 漢 <ip> \U0001f600 <phone>"
    assert by["a@1.2.3.4"] == "<email>" and by["a@b"] == "a@b" and by[None] is None


def test_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op10_pii(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        base = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        kinds = [x.split(":")[0] for x in base.split(",") if x]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds.count(k) for k in RULES]


def test_many_matches_in_one_text(spark):
    text = " ".join(f"u{i}@h.example 10.0.{i % 256}.{i % 7}" for i in range(1500))
    r = P.find_pii(docs(spark, [(1, text)]), [F.col("doc_id")]).select(P.spans_text(F.col("base")).alias("b")).first()
    assert r.b == plain(text)


def test_expectation_maximisation_orders_patterns():
    # two good labelers that agree, one that votes at random
    rows = [(0, 1, 1, 1, 400), (0, 1, 1, -1, 380), (0, -1, -1, 1, 290), (0, -1, -1, -1, 310), (0, 1, -1, 1, 20), (0, -1, 1, -1, 20), (0, 1, 0, 0, 50)]
    p = P.fit_label_model(rows)
    assert p[0, 1, 1, 1] > 0.95 and p[0, 1, 1, -1] > 0.9 and p[0, -1, -1, 1] < 0.1 and p[0, 1, 0, 0] > 0.5
    assert P.fit_label_model([]) == {}


def test_secrets_are_added(spark):
    rows = [(i, f'some words token = "{hashlib.sha1(str(i).encode()).hexdigest()}" and more') for i in range(20)] + [(50, "averyveryverylongwordindeed without digits")]
    got = {r.doc_id: r.s for r in P.find_pii(docs(spark, rows), [F.col("doc_id")]).select("doc_id", P.spans_text(F.col("spans")).alias("s")).collect()}
    assert all("secret:20:60" in got[i] for i in range(20)) and got[50] == ""


def test_native_plan_and_empty_table(spark, capsys):
    none = docs(spark, AWKWARD).where("false")
    assert P.find_pii(none, [F.col("doc_id")]).count() == 0
    P.candidate_spans(docs(spark, AWKWARD), [F.col("doc_id")]).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan
