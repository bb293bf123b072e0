"""Licence detection by ordered signature rules.

Rules (see ``license_rules``) are gated by a keyword prefilter: a text without any trigger word isn't looked at, and a
pattern is only tried when all its keywords occur.  Detections are taken by priority, then length, then place; one whose
interval lies inside that of an earlier one is suppressed, and rules of last resort only count where no
other rule was kept, then at all their places.  Beside the rules, three base phrases are counted at every
place where their words stand consecutively; their labels always stay.

Texts are scanned as lower-cased UTF-8 bytes (A-Z only), a map over the rows without any shuffle.  Defined results: null
or empty text has no words, no labels and score 0; first and last word of a text without a base phrase are null; repeated
rows give repeated results; other columns are kept out of the result.
"""

from __future__ import annotations

import re
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import map_batches
from newsflow.llm.license_rules import TRIGGERS, rules

#: Base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
LAST_RESORT = 90
DETECTION = "array<struct<rule:string,label:string,start:long,end:long,confidence:double>>"

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_SEPARATOR = rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"


@cache
def _base_patterns():
    word = rb"[0-9a-z\x80-\xff]"
    return [(re.compile(rb"(?<!" + word + rb")" + _SEPARATOR.join(p.encode().split()) + rb"(?!" + word + rb")"), label) for p, label in BASE]


@cache
def _triggers():
    return tuple(t.encode() for t in TRIGGERS)


def detections(low: bytes) -> list[tuple[str, str, int, int, float]]:
    """Kept detections (rule, label, start, end, confidence) in a lower-cased text, byte offsets, by place."""
    if not any(t in low for t in _triggers()):
        return []
    has: dict[bytes, bool] = {}
    found = []
    for r in rules():
        for k in r.keywords:
            if k not in has:
                has[k] = k in low
            if not has[k]:
                break
        else:
            found += [(r.priority, m.start() - m.end(), m.start(), r) for m in r.pattern.finditer(low)]
    kept: list[tuple[int, int, object]] = []
    starts = np.zeros(0, np.int64)
    reach = np.zeros(0, np.int64)
    for _, length, start, r in sorted(found, key=lambda x: (x[0], x[1], x[2], x[3].rule_id)):
        end = start - length
        if kept and r.priority >= LAST_RESORT > kept[0][2].priority:  # kept in the order of priority
            break
        # of the kept intervals starting at or before this one, does one reach its end?
        at = int(np.searchsorted(starts, start, side="right"))
        if at and reach[at - 1] >= end:
            continue
        kept.append((start, end, r))
        starts = np.insert(starts, at, start)
        reach = np.maximum.accumulate(np.insert(reach, at, end)) if at == len(reach) else _reach(kept)
    return [(r.rule_id, r.label, s, e, r.confidence) for s, e, r in sorted(kept, key=lambda k: (k[0], k[1]))]


def _reach(kept):
    return np.maximum.accumulate(np.array([e for _, e, _ in sorted(kept, key=lambda k: (k[0], k[1]))]))


def scan_text(text: bytes | None):
    """(n_words, base places as word numbers, base labels, detections) of a text."""
    if not text:
        return 0, [], set(), []
    low = text.lower()
    w = _WORD[np.frombuffer(low, np.uint8)]
    starts = w.copy()
    starts[1:] &= ~w[:-1]
    places, labels = [], set()
    if b"license" in low:
        for pattern, label in _base_patterns():
            for m in pattern.finditer(low):
                places.append(m.start())
                labels.add(label)
    if places:
        number = np.cumsum(starts)
        places = [int(number[p]) - 1 for p in sorted(places)]
    return int(np.count_nonzero(starts)), places, labels, detections(low)


def _scan_batches(batches, n_keep):
    for b in batches:
        scanned = [scan_text(t) for t in b.column(n_keep).to_pylist()]
        out = {
            "n_words": [s[0] for s in scanned], "n_base": [len(s[1]) for s in scanned],
            "first_word": [s[1][0] if s[1] else None for s in scanned], "last_word": [s[1][-1] if s[1] else None for s in scanned],
            "base_labels": [sorted(s[2]) for s in scanned],
            "detections": [[dict(zip(("rule", "label", "start", "end", "confidence"), d, strict=True)) for d in s[3]] for s in scanned]}
        types = [pa.int64()] * 4 + [pa.list_(pa.string()), pa.list_(pa.struct([("rule", pa.string()), ("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("confidence", pa.float64())]))]
        yield pa.RecordBatch.from_arrays([*b.columns[:n_keep], *(pa.array(v, t) for v, t in zip(out.values(), types, strict=True))], names=[*b.schema.names[:n_keep], *out])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, detections) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return map_batches(rows, partial(_scan_batches, n_keep=1), f"id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, detections {DETECTION}")
