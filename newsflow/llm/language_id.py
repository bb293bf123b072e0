"""Language identification by prediction by partial matching (PPM) over bytes.

Each language has a variable-order byte context tree, its statistics frozen after training.  A symbol not seen in a
context is reached by an escape (method C: probability ``distinct / (total + distinct)``) to the next shorter context,
down to 1/256 for every byte.  A text's exact code length under each language's tree is the sum over all its bytes;
the shortest wins.  For scoring, the tasks compile the tree of each language into an automaton over its contexts: from a
context and a byte to the longest known context, and from a context and a byte to a code length.  That is the same
arithmetic done beforehand, so the scores are exact and whole texts are scored at array speed.

Training takes a bounded sample of labelled rows, a documented parameter: ``sample_rows`` rows a language at most, those
with the smallest hash of id and text; whole texts, counted in the tasks and summed by Spark.  All contexts of the sample
are kept, so the tree of a language doesn't depend on the others; what reaches the driver and is broadcast are the sample's
sparse counts (a few bytes a count), and the model grows with the number of languages.

Defined results: null text, and text without any letter, gives ``und`` with score 0; ties go to the smallest language
code; without any labelled row every text is ``und``; repeated rows are scored alike; other columns aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.common import map_batches

UNDETERMINED = "und"
ORDER = 4
SAMPLE_ROWS = 400
_PIECE = 1 << 18
_ROWS = 256


@dataclass
class Tree:
    """The compiled tree of a language: ``step[context, symbol]`` and ``cost[context, symbol]`` in bits."""

    symbols: np.ndarray  # byte -> symbol; bytes never seen share the last symbol
    step: np.ndarray
    cost: np.ndarray


@dataclass
class PpmModel:
    """Languages in order and the counts of their contexts, sparse; the trees are compiled where texts are scored."""

    languages: list[str]
    counts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # depth, context, symbol, n
    order: int

    @cached_property
    def trees(self) -> list[Tree]:
        return [_compile_tree(*c, self.order) for c in self.counts]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "trees"}


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, where: Column, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(lang, text): at most ``sample_rows`` labelled rows a language, by hash of id and text.

    A threshold on the hash first thins the rows of frequent languages to about four times the bound, so that the window
    never sorts a language's whole share of the corpus.
    """
    rows = docs.where(where & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text"), F.xxhash64(F.col(id_col), F.col(text_col).cast("string")).alias("h"))
    counts = rows.groupBy("lang").count().collect()  # one row a language, as in the model
    if not counts:
        return rows.select("lang", "text")
    share = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(4.0 * sample_rows / r["count"]))])
    spread = (F.pmod(F.col("h"), F.lit(1 << 30)) / F.lit(float(1 << 30)))
    some = rows.where(spread < F.element_at(share, F.col("lang")))
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(spread, "h", "text")))
    return ranked.where(F.col("rank") <= sample_rows).select("lang", "text")


def _count_batches(batches, order):
    """(lang, depth, context, symbol, n): contexts of 0..order bytes packed into a number, summed per batch."""
    for b in batches:
        found: dict = {}
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            found.setdefault(lang, []).append(np.frombuffer(text, np.uint8).astype(np.int64))
        for lang, texts in found.items():
            for depth in range(order + 1):
                keys = []
                for x in texts:
                    if len(x) > depth:
                        key = np.zeros(len(x) - depth, np.int64)
                        for k in range(depth + 1):
                            key = key * 256 + x[k : len(x) - depth + k]
                        keys.append(key)
                if keys:
                    key, n = np.unique(np.concatenate(keys), return_counts=True)
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([lang] * len(key)), "depth": pa.array(np.full(len(key), depth, np.int32)),
                        "context": pa.array(key >> 8), "symbol": pa.array((key & 255).astype(np.int32)), "n": pa.array(n.astype(np.int64))})


def train(sample: DataFrame, order: int = ORDER) -> PpmModel:
    """Count the contexts of (lang, text) rows in Spark and compile all of them."""
    rows = sample.select("lang", F.col("text").cast("binary").alias("text"))
    counts = (map_batches(rows, partial(_count_batches, order=order), "lang string, depth int, context long, symbol int, n long")
              .groupBy("lang", "depth", "context", "symbol").agg(F.sum("n").alias("n")))
    return compile_model(counts.toArrow(), order)  # bounded by the sample


def compile_model(counts: pa.Table, order: int) -> PpmModel:
    """The model of (lang, depth, context, symbol, n); counts stay sparse."""
    table = counts if isinstance(counts, pa.Table) else pa.Table.from_pandas(counts)
    languages = sorted(table.column("lang").unique().to_pylist())
    kinds = {"depth": np.uint8, "context": np.uint64 if order > 4 else np.uint32, "symbol": np.uint8, "n": np.int64}
    packed = []
    for lang in languages:
        own = table.filter(pc.equal(table.column("lang"), lang))
        packed.append(tuple(own.column(c).to_numpy().astype(k) for c, k in kinds.items()))
    return PpmModel(languages, packed, order)


def _compile_tree(depth, context, symbol, n, order: int) -> Tree:
    context, symbol = context.astype(np.int64), symbol.astype(np.int64)
    seen = np.unique(symbol)
    symbols = np.full(256, len(seen), np.int32)  # a table has fewer than 2^31 cells, so numbers of cells fit 32 bits
    symbols[seen] = np.arange(len(seen))
    a = len(seen) + 1
    # contexts of a depth in order, numbered after those of lower depths; only ones whose suffix and parent are known
    known, first, suffix, parent = [np.zeros(1, np.int64)], [0], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
    for d in range(1, order + 1):
        c = np.unique(context[depth == d])
        short, whole = c & ((1 << 8 * (d - 1)) - 1), c >> 8
        at = np.minimum(np.searchsorted(known[-1], np.stack([short, whole])), len(known[-1]) - 1)
        ok = ((known[-1][at] == np.stack([short, whole])).all(axis=0) if len(known[-1]) else np.zeros(len(c), bool))
        suffix.append(first[-1] + at[0][ok])
        parent.append(first[-1] + at[1][ok])
        first.append(first[-1] + len(known[-1]))
        known.append(c[ok])
    size = first[-1] + len(known[-1])
    counts = np.zeros((size, a), np.float32)
    for d in range(order + 1):
        here = np.nonzero(depth == d)[0]
        if len(known[d]):
            at = np.minimum(np.searchsorted(known[d], context[here]), len(known[d]) - 1)
            ok = known[d][at] == context[here]
            counts[first[d] + at[ok], symbols[symbol[here[ok]]]] = n[here[ok]]
    total, kinds = counts.sum(axis=1, keepdims=True, dtype=np.float64), (counts > 0).sum(axis=1, keepdims=True)
    cost, step = np.empty((size, a), np.float32), np.zeros((size, a), np.int32)
    below = np.full((1, a), 1 / 256)
    for d in range(order + 1):
        at = slice(first[d], first[d] + len(known[d]))
        p = below[suffix[d] - (first[d - 1] if d else 0)]
        seen_here = np.maximum(total[at] + kinds[at], 1)
        p = np.where(kinds[at] == 0, p, np.where(counts[at] > 0, counts[at] / seen_here, kinds[at] / seen_here * p))
        cost[at] = -np.log2(p)
        below = p
        # a successor that isn't a known context is that of the suffix
        if d:
            step[at] = step[suffix[d]]
        if d < order:
            step[parent[d + 1], symbols[known[d + 1] & 255]] = first[d + 1] + np.arange(len(known[d + 1]))
    return Tree(symbols, step, cost)


def code_lengths(model: PpmModel, texts: list[bytes]) -> np.ndarray:
    """Exact code length in bits of every text under every language."""
    out = np.zeros((len(texts), len(model.languages)))
    if not model.languages:
        return out
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= _PIECE):
            size += len(texts[end])
            end += 1
        joined, lengths = b"".join(texts[at:end]), np.array([len(t) for t in texts[at:end]])
        for j, tree in enumerate(model.trees):
            if end == at + 1 and size > _PIECE:  # a very long text, in pieces that know the bytes before them
                for k in range(0, size, _PIECE):
                    lead = min(k, model.order)
                    out[at, j] += _costs(tree, model.order, joined[k - lead : k + _PIECE], np.array([0]))[lead:].sum(dtype=np.float64)
            elif size:
                starts = np.cumsum(lengths) - lengths
                some = lengths > 0
                out[at:end, j][some] = np.add.reduceat(_costs(tree, model.order, joined, starts[some]), starts[some], dtype=np.float64)
        at = end
    return out


def _costs(tree, order, data, starts):
    """Code length of every byte; contexts don't reach over ``starts``."""
    a, step = tree.step.shape[1], tree.step.reshape(-1)
    s = tree.symbols[np.frombuffer(data, np.uint8)]
    into = np.arange(len(s), dtype=np.int32) - np.repeat(starts.astype(np.int32), np.diff(np.append(starts, len(s))))
    state = np.zeros(len(s), np.int32)  # the context before byte i
    for back in range(order, 0, -1):
        nxt = step[state[back:] * a + s[: len(s) - back]]
        state[:back] = 0
        state[back:] = np.where(into[back:] >= back, nxt, 0)
    return tree.cost.reshape(-1)[state * a + s]


def _score_batches(batches, shared):
    model = shared.value
    for b in (whole.slice(k, _ROWS) for whole in batches for k in range(0, whole.num_rows, _ROWS)):  # few texts at a time as Python objects
        cols = b.columns
        texts, letters = cols[-2].to_pylist(), cols[-1].to_numpy(zero_copy_only=False)
        lengths = code_lengths(model, [t if t and ok else b"" for t, ok in zip(texts, letters, strict=True)])
        if model.languages:
            best = lengths.argmin(axis=1)
            with np.errstate(under="ignore"):
                odds = np.exp2(lengths.min(axis=1, keepdims=True) - lengths)
            score = np.where(letters, 1 / odds.sum(axis=1), 0.0)
            pred = np.where(letters, np.array(model.languages, object)[best], UNDETERMINED)
        else:
            score, pred = np.zeros(len(texts)), np.full(len(texts), UNDETERMINED, object)
        yield pa.RecordBatch.from_arrays([*cols[:-2], pa.array(pred, pa.string()), pa.array(score)], names=[*b.schema.names[:-2], "__lang_pred", "__lang_score"])


def predict(docs: DataFrame, model: PpmModel, text_col: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """The ``keep`` columns and __lang_pred, __lang_score for every row; the score is the posterior of the language."""
    keep = [F.col(f"`{c}`") for c in docs.columns] if keep is None else keep
    text = F.col(text_col).cast("string")
    kept = docs.select(*keep)
    rows = docs.select(*[c.alias(f"kept{i}") for i, c in enumerate(keep)], text.cast("binary").alias("bytes"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-2])
    return map_batches(rows, partial(_score_batches, shared=shared), f"{fields}, __lang_pred string, __lang_score double").toDF(*kept.columns, "__lang_pred", "__lang_score")


def learnable(id_col: str = "doc_id") -> Column:
    """Rows that the model may learn from: crc32 of the id as text, modulo 3, isn't 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 != 1, F.lit(True))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> PpmModel:
    return train(training_sample(docs, id_col, text_col, lang_col, learnable(id_col), sample_rows))
