import random
import re

import pytest

from newsflow.llm import license_scan as Q
from newsflow.llm import queries
from newsflow.llm.license_rules import TRIGGERS, rules
from tests.llm.data import AWKWARD, SF, docs


def plain(text):
    """Base columns word by word."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, label) for phrase, label in Q.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_base_columns_against_plain_words(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op4_license_scan(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


@pytest.mark.parametrize("text", ["MIT License", "the mit  --\n license, MIT LICENSE.", "permit license", "mité license", "mit licenses", "Apache License 2", "general public license general public license", "x mit", "general public mit license"])
def test_base_phrases(text):
    n, places, labels, _ = Q.scan_text(text.encode())
    assert (n, len(places), places[0] if places else None, places[-1] if places else None, ",".join(sorted(labels))) == plain(text)


@pytest.mark.parametrize(("text", "labels"), [
    ("SPDX-License-Identifier: Apache-2.0", {"apache-2.0"}), ("Licensed under the Apache License, Version 2.0.", {"apache-2.0"}), ("Released under the MIT License.", {"mit"}),
    ("GNU General Public License, version 3", {"gpl-3.0"}), ("GNU Lesser General Public License", {"lgpl"}), ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0"}), ("BSD 3-Clause License", {"bsd-3-clause"}),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy", {"mit"}), ("licensed under terms unknown", {"unknown-licence"}), ("a license to kill", set()), ("submit licenses", set())])
def test_rules(text, labels):
    assert {d[1] for d in Q.detections(text.lower().encode())} == labels


def test_rules_are_gated_rightly():
    assert len(rules()) >= 300
    sample = [b"spdx-license-identifier: mit", b"zlib license", b"creative commons by-sa 3.0", b"www.gnu.org/licenses/gpl", b"this is free and unencumbered software", b"all rights reserved"]
    for text in sample:
        found = [r for r in rules() if r.pattern.search(text)]
        assert found and all(all(k in text for k in r.keywords) for r in found) and any(t.encode() in text for t in TRIGGERS)


def test_containment_keeps_the_earlier_rule():
    kept = Q.detections(b"licensed under the apache license, version 2.0 and the mit license")
    assert [d[1] for d in kept] == ["apache-2.0", "mit"]
    assert all(not (a[2] <= b[2] and b[3] <= a[3]) for a in kept for b in kept if a is not b)


def test_awkward_rows(spark):
    got = Q.scan_licenses(docs(spark, AWKWARD)).collect()
    assert len(got) == len(AWKWARD)
    by = {r.id: r for r in got}
    assert by[1].n_words == 0 and by[1].first_word is None and by[7].n_words == 30_000 and by[6].n_words == 1
    assert Q.scan_licenses(docs(spark, AWKWARD).where("false")).count() == 0


def written(tree, pick):
    """A text that matches a parsed pattern; ``pick`` chooses among characters, branches and counts."""
    out = ""
    for op, arg in tree:
        op = str(op)
        if op == "LITERAL":
            out += chr(arg)
        elif op == "IN":
            kinds = [k for k, _ in arg]
            assert "NEGATE" not in map(str, kinds)
            out += pick([c for k, x in arg for c in ([chr(x)] if str(k) == "LITERAL" else map(chr, range(x[0], x[1] + 1)) if str(k) == "RANGE" else "\n\t " if str(x) == "CATEGORY_SPACE" else "0123456789")])
        elif op == "BRANCH":
            out += written(pick(arg[1]), pick)
        elif op == "SUBPATTERN":
            out += written(arg[-1], pick)
        elif op == "MAX_REPEAT":
            out += "".join(written(arg[2], pick) for _ in range(pick(range(arg[0], min(int(arg[1]), arg[0] + 3) + 1))))
        else:
            assert op == "ASSERT_NOT"
    return out


def test_every_match_of_every_rule_passes_its_gate():
    draw = random.Random(1)
    for r in rules():
        tree = re._parser.parse(r.pattern.pattern.decode("latin-1"))
        for k in range(20):
            text = written(tree, draw.choice if k else lambda x: list(x)[0]).encode("latin-1")
            if r.pattern.search(text):  # an optional part may run into the end of a word
                assert all(w in text for w in r.keywords) and r.keywords and any(t.encode() in text for t in TRIGGERS), (r, text)
                assert Q.detections(text)


@pytest.mark.parametrize(("text", "label"), [
    ("licensed under the GNU Free Documentation License", "gfdl"), ("Creative Commons Zero", "cc0-1.0"), ("Microsoft Public License", "ms-pl"), ("Microsoft Reciprocal License", "ms-rl"),
    ("Open Database License", "odbl-1.0"), ("Permission is\nhereby granted, free of charge, to any person obtaining a copy", "mit"), ("Redistribution and\n# use in source and binary forms", "bsd"),
    ("All rights\nreserved", "all-rights-reserved"), ("in the public\ndomain", "public-domain"), ("CC\nBY", "cc-by"), ("cc_by", "cc-by"), ("permission to\nuse, copy, modify, and distribute this software", "isc")])
def test_alternatives_and_separators_are_found(text, label):
    assert label in {d[1] for d in Q.detections(text.lower().encode())}


def test_all_places_of_last_resort_rules_are_kept():
    assert [d[1:4] for d in Q.detections(b"licensed under terms a, distributed under terms b")] == [("unknown-licence", 0, 14), ("unknown-licence", 24, 41)]
    assert [d[1] for d in Q.detections(b"licensed under terms a, mit license")] == ["mit"]
