"""Personal data in texts by weak supervision (DataFrame functions only).

Candidates come from one pattern per kind.  Three labelers vote on each (yes, no or abstain): a validator of its shape
(digits, ranges, checksums), a gazetteer of cue words and reserved names, and the context before it.  Expectation
maximisation over the counts of vote patterns estimates how often each labeler is right and, for each pattern, the
probability that the candidate is personal data.  With these soft labels a naive Bayes classifier over features of the
span (kind, length, characters, what stands before it) is trained, which decides on the candidates that the base rules
leave open.  Spans of the base rules (email, ip, card, phone) always stay.

Matches and their places are found by splitting a text at its matches, so the work is linear in the text.  Candidates are
kept per document in one checkpoint; the statistics of both models are sums over all documents, one small row per vote
pattern (at most 27 a kind) or feature value, and only those reach the driver.

Defined results: null text is empty and has no spans; repeated rows give repeated results; without any candidate nothing
is trained and only base spans remain; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import cut

#: Kinds in their order; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "secret", "ssn", "iban", "local_phone", "name")
N_BASE = 4
#: Patterns.  Possessive quantifiers and look-behinds only avoid repeated attempts; \G admits a match right after another.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{16,}+",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}+(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "local_phone": r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "name": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.? \p{Lu}\p{Ll}++(?: \p{Lu}\p{Ll}++)?",
}
#: A text can only match a kind's pattern if it matches this, which is quicker to see.
HINTS = {"email": "@", "phone": "+", "ip": ".", "ssn": "-"}
#: Cue words before a span, by kind, and reserved or placeholder values.
CUES = {
    "email": r"e-?mail|mail|contact|write|@", "ip": r"\bip\b|address|host|server|from|client", "card": r"card|visa|master|amex|credit|payment|carte|karte|tarjeta",
    "phone": r"phone|tel|call|mobile|fax|fon|tél|llama", "secret": r"token|key|secret|passw|pwd|auth|bearer|credential|api", "ssn": r"ssn|social|security|tax",
    "iban": r"iban|account|konto|compte|cuenta|bank", "local_phone": r"phone|tel|call|mobile|fax", "name": r"dear|from|signed|by|sincerely|author|name",
}
RESERVED = {
    "email": r"@(?:localhost|invalid|test)\b|^(?:noreply|no-reply)@", "ip": r"^(?:0|127|255)\.", "card": r"^(?:0+|1+|9+)$", "phone": r"^\+0", "secret": r"^(?:0+|x+|[A-Za-z]+-[A-Za-z-]+[0-9]{0,4})$",
    "ssn": r"^(?:000|666|9)|-00-|-0000$", "iban": r"^[A-Z]{2}00", "local_phone": r"^\(?[01]", "name": r"^\w+\.? (?:The|And|Of|President|Chairman|Speaker)",
}
CONTEXT_CHARS = 24
_BLOCK = 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)


def _sums_before(a: Column) -> Column:
    """For every element of an array the sum of those before it, by blocks, so that long arrays stay cheap."""
    def by_block(a):
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / _BLOCK).cast("int")), lambda b: _total(F.slice(a, b * _BLOCK + 1, _BLOCK)))
        return let(blocks, lambda s: let(F.transform(s, lambda _, b: _total(F.slice(s, F.lit(1), b))), lambda before: F.transform(
            a, lambda _, i: F.element_at(before, F.floor(i / _BLOCK).cast("int") + 1) + _total(F.slice(a, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK)))))
    return F.when(F.size(a) > 0, let(a, by_block)).otherwise(F.array().cast("array<bigint>"))


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, s, left>>: matches from the left, their places in code points, the text before them."""
    rx = F.lit(pattern)

    def placed(found):
        def with_pieces(pieces):
            widths = F.transform(found, lambda s, i: (F.length(F.get(pieces, i)) + F.length(s)).cast("long"))
            return let(_sums_before(widths), lambda before: F.transform(found, lambda s, i: F.struct(
                (F.get(before, i) + F.length(F.get(pieces, i))).alias("start"), s.alias("s"), F.right(F.get(pieces, i), F.lit(CONTEXT_CHARS)).alias("left"))))
        return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), with_pieces)).otherwise(F.array().cast("array<struct<start:bigint,s:string,left:string>>"))

    return let(F.regexp_extract_all(text, rx, F.lit(0)), placed)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total, i):
        x = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, x).when(x < 5, x * 2).otherwise(x * 2 - 9)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _valid(kind: str, s: Column) -> Column:
    """The validator of a kind; for the base kinds the rule that decides."""
    if kind == "ip":
        part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return s.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return let(_digits(s), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(s)).between(9, 15)
    if kind == "secret":
        return s.rlike("^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$") | (s.rlike("[a-z]") & s.rlike("[A-Z]") & (F.length(_digits(s)) >= 3))
    if kind == "ssn":
        return ~s.rlike("^(?:000|666|9)|-00-|-0000$")
    if kind == "iban":
        return F.length(F.regexp_replace(s, " ", "")).between(15, 34)
    if kind == "local_phone":
        return s.rlike(r"^\(?[2-9]")
    return F.lit(True)


CANDIDATE = "array<struct<kind:int,start:bigint,end:bigint,valid:boolean,listed:int,cued:int,long:int,chars:int,before:int>>"


def _candidates(text: Column, k: int) -> Column:
    kind = KINDS[k]

    def one(m):
        s, left = m["s"], m["left"]
        cued, reserved = F.lower(left).rlike(CUES[kind]), s.rlike(RESERVED[kind])
        chars = (F.when(s.rlike("[0-9]"), 1).otherwise(0) + F.when(s.rlike("[a-z]"), 2).otherwise(0) + F.when(s.rlike("[A-Z]"), 4).otherwise(0)
                 + F.when(s.rlike("[^A-Za-z0-9]"), 8).otherwise(0))
        before = F.when(left == "", 0).when(left.rlike(r"[=:]\s*[\"']?$"), 1).when(left.rlike(r"\s$"), 2).when(left.rlike(r"[A-Za-z0-9]$"), 3).otherwise(4)
        return F.struct(F.lit(k).alias("kind"), m["start"].alias("start"), (m["start"] + F.length(s)).alias("end"), _valid(kind, s).alias("valid"),
                        F.when(reserved, -1).when(F.lower(s).rlike(r"example|[0-9]{3}") & ~reserved, 1).otherwise(0).alias("listed"),
                        F.when(cued, 1).when(left == "", 0).otherwise(0).alias("cued"), F.least(F.floor(F.length(s) / 8), F.lit(6)).cast("int").alias("long"),
                        chars.cast("int").alias("chars"), before.cast("int").alias("before"))

    found = F.transform(matches(text, PATTERNS[kind]), one)
    empty = F.array().cast(CANDIDATE)
    return F.when(text.contains(HINTS[kind]) if kind in HINTS else F.lit(True), found.cast(CANDIDATE)).otherwise(empty)


def candidate_spans(docs: DataFrame, keep: list[Column], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns and ``found``: all candidates of all kinds, those overlapping a base span left out unless base."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(*keep, F.array(*[_candidates(text, k) for k in range(len(KINDS))]).alias("_kinds"))
    base = F.filter(F.flatten(F.slice("_kinds", 1, N_BASE)), lambda c: c["valid"])
    # candidates beside the base ones matter only where no base span is; a base candidate that failed stays one to vote on
    free = let(base, lambda b: F.filter(F.flatten(F.col("_kinds")), lambda c: ((c["kind"] < N_BASE) & c["valid"]) | ~F.exists(b, lambda x: (x["start"] < c["end"]) & (c["start"] < x["end"]))))
    return rows.select(*[c for c in rows.columns if c != "_kinds"], free.alias("found"))


def fit_label_model(patterns: list[tuple[int, int, int, int, int]], rounds: int = 50) -> dict[tuple[int, int, int, int], float]:
    """Expectation maximisation over (kind, vote, vote, vote, count) rows: probability of personal data by pattern.

    Votes are 1, 0 (abstain) or -1; every labeler has a rate of being right per kind, smoothed towards 0.7.
    """
    out: dict = {}
    for kind in sorted({p[0] for p in patterns}):
        rows = [(p[1:4], p[4]) for p in patterns if p[0] == kind]
        right, prior = [0.8, 0.7, 0.7], 0.5
        post: dict = {}
        for _ in range(rounds):
            for votes, _n in rows:
                yes, no = math.log(prior), math.log(1 - prior)
                for r, v in zip(right, votes, strict=True):
                    if v:
                        yes += math.log(r if v > 0 else 1 - r)
                        no += math.log(1 - r if v > 0 else r)
                post[votes] = 1 / (1 + math.exp(no - yes))
            total = sum(n for _, n in rows)
            prior = (sum(post[v] * n for v, n in rows) + 1) / (total + 2)
            for j in range(3):
                agree = sum((post[v] if v[j] > 0 else 1 - post[v]) * n for v, n in rows if v[j])
                voted = sum(n for v, n in rows if v[j])
                right[j] = min(0.99, max(0.55, (agree + 7) / (voted + 10)))
        out |= {(kind, *v): p for v, p in post.items()}
    return out


def _votes(c: Column) -> list[Column]:
    return [F.when(c["valid"], 1).otherwise(-1), c["listed"], c["cued"]]


FEATURES = ("long", "chars", "before")


def train(spans: DataFrame) -> Callable[[Column], Column]:
    """The span classifier: candidate struct to probability, trained on the label model's soft labels."""
    c = F.col("c")
    rows = spans.select(F.explode("found").alias("c")).select(c["kind"].alias("kind"), *[v.alias(f"v{i}") for i, v in enumerate(_votes(c))], *[c[f].alias(f) for f in FEATURES])
    counts = cut(rows.groupBy("kind", "v0", "v1", "v2", *FEATURES).agg(F.count(F.lit(1)).alias("n")))  # few distinct rows
    patterns = counts.groupBy("kind", "v0", "v1", "v2").agg(F.sum("n").alias("n")).collect()  # at most 27 a kind
    label = fit_label_model([tuple(r) for r in patterns])
    if not label:
        return lambda _: F.lit(0.0)
    key = F.concat_ws(",", "kind", "v0", "v1", "v2")
    soft = F.element_at(F.create_map(*[x for k, p in label.items() for x in (F.lit(",".join(map(str, k))), F.lit(p))]), key)
    marked = counts.withColumn("p", soft)
    by_kind = {r[0]: (r[1], r[2]) for r in marked.groupBy("kind").agg(F.sum(F.col("n") * F.col("p")), F.sum(F.col("n") * (1 - F.col("p")))).collect()}
    by_feature = marked.select("kind", "n", "p", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).cast("int").alias("x")) for f in FEATURES])).alias("e"))
    weights: dict[str, float] = {}
    for r in by_feature.groupBy("kind", "e").agg(F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no")).collect():  # at most 7, 16 and 5 values a kind
        yes, no = by_kind[r["kind"]]
        weights[f"{r['kind']},{r['e']['f']},{r['e']['x']}"] = math.log((r["yes"] + 1) / (yes + 16)) - math.log((r["no"] + 1) / (no + 16))
    prior = {str(k): math.log((yes + 1) / (no + 1)) for k, (yes, no) in by_kind.items()}

    def lookup(table, key):
        return F.coalesce(F.element_at(F.create_map(*[x for k, w in table.items() for x in (F.lit(k), F.lit(w))]), key), F.lit(0.0))

    def classify(c: Column) -> Column:
        votes = lookup({",".join(map(str, k)): math.log((p + 1e-9) / (1 - p + 1e-9)) for k, p in label.items()}, F.concat_ws(",", c["kind"].cast("string"), *[v.cast("string") for v in _votes(c)]))
        shape = reduce(lambda a, b: a + b, [lookup(weights, F.concat_ws(",", c["kind"].cast("string"), F.lit(f), c[f].cast("string"))) for f in FEATURES], lookup(prior, c["kind"].cast("string")))
        return 1 / (1 + F.exp(-(votes + shape) / 2))

    return classify


def find_pii(docs: DataFrame, keep: list[Column], text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The ``keep`` columns, ``base`` and ``spans``: sorted arrays of struct<start, kind (its number in KINDS), end>."""
    found = cut(candidate_spans(docs, keep, text_col))
    classify = train(found)
    is_base = lambda c: (c["kind"] < N_BASE) & c["valid"]
    span = lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))
    base = F.array_sort(F.transform(F.filter("found", is_base), span))
    spans = F.array_sort(F.transform(F.filter("found", lambda c: is_base(c) | ((c["kind"] >= N_BASE) & (classify(c) >= threshold))), span))
    return found.select(*[c for c in found.columns if c != "found"], base.alias("base"), spans.alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; overlapping spans are replaced as one."""
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, s):
        before = F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(before, F.element_at(names, s["kind"] + 1))).alias("out"))).otherwise(
            F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))

    def finish(acc):
        return F.array_join(F.concat(acc["out"], F.array(F.substr(text, (acc["at"] + 1).cast("int")))), "")

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)
