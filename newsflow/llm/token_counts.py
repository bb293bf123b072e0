"""Token counts that follow edits.

A document is cut into leaves of whole pre-tokens (about ``leaf_chars`` characters, cut only where a letter or digit is
followed by one space and another letter or digit, which is a pre-token boundary whatever surrounds it).  Two segment
trees over the leaves hold characters and tokens.  An edit descends the character tree to the leaves it touches; only
these are encoded again, together with a neighbour where the edit destroyed the boundary between them; then the sums on
the paths to the root are updated.  The root is the document's count, equal to that of encoding the whole text.

Edits of a document apply one after another, each position in code points of the text as it is then: ``n_del`` characters
at ``pos`` go, ``ins`` comes in; positions and lengths beyond the text are clamped, null edits and null fields change
nothing.  Null or empty text has no leaves and no tokens.  A map over the rows, no shuffle; very long words make long
leaves, never wrong ones.  The vocabulary's path is a parameter and must exist on the executors.
"""

from __future__ import annotations

import base64
import re
from functools import cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import map_batches

LEAF_CHARS = 512
EDIT = "struct<pos:long,n_del:long,ins:string>"
_BOUNDARY = re.compile(r"(?<=[^\W_]) (?=[^\W_])")


@cache
def encoder(vocabulary: str | None = None):
    """The byte-level BPE of a rank file; by default the public 50k vocabulary."""
    import public_tokenizers
    import tiktoken

    with open(vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def cut_leaves(text: str, leaf_chars: int = LEAF_CHARS) -> list[str]:
    """Leaves of at least ``leaf_chars`` characters (but for the last)."""
    leaves, at = [], 0
    while len(text) - at > leaf_chars:
        m = _BOUNDARY.search(text, at + leaf_chars)
        if not m:
            break
        leaves.append(text[at : m.start()])
        at = m.start()
    if at < len(text):
        leaves.append(text[at:])
    return leaves


class SegmentTree:
    """Leaves of a document with sums of characters and tokens over a binary tree."""

    def __init__(self, leaves: list[str], tokens: list[int], encode):
        self.leaves, self.encode, self.encoded_chars = list(leaves), encode, 0
        self.base = 1 << max(0, len(leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * 2 * self.base, [0] * 2 * self.base
        for i, (leaf, n) in enumerate(zip(leaves, tokens, strict=True)):
            self.chars[self.base + i], self.tokens[self.base + i] = len(leaf), n
        for i in range(self.base - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]
        self.leaves += [""] * (self.base - len(self.leaves))

    def _leaf_at(self, pos: int) -> tuple[int, int]:
        """The leaf with character ``pos`` (or the last one that ends there) and the place in it."""
        i = 1
        while i < self.base:
            i *= 2
            if pos > self.chars[i] or pos == self.chars[i] and self.chars[i + 1]:
                pos -= self.chars[i]
                i += 1
        return i - self.base, pos

    def _put(self, leaf: int, text: str) -> None:
        self.leaves[leaf] = text
        n, i = len(self.encode(text)) if text else 0, self.base + leaf
        self.encoded_chars += len(text)
        more, tokens = len(text) - self.chars[i], n - self.tokens[i]
        while i:
            self.chars[i] += more
            self.tokens[i] += tokens
            i //= 2

    def _beside(self, leaf: int, by: int) -> int | None:
        leaf += by
        while 0 <= leaf < self.base:
            if self.leaves[leaf]:
                return leaf
            leaf += by
        return None

    def edit(self, pos: int, n_del: int, ins: str) -> None:
        total = self.chars[1]
        pos = max(0, min(pos, total))
        end = pos + max(0, min(n_del, total - pos))
        first, a = self._leaf_at(pos)
        last, b = self._leaf_at(end)
        text = self.leaves[first][:a] + ins + self.leaves[last][b:]
        before, after = self._beside(first, -1), self._beside(last, 1)
        while text and before is not None and not _BOUNDARY.match(self.leaves[before][-1:] + text[:2], 1):
            text, first, before = self.leaves[before] + text, before, self._beside(before, -1)
        while text and after is not None and not _BOUNDARY.match(text[-1:] + self.leaves[after][:2], 1):
            text, last, after = text + self.leaves[after], after, self._beside(after, 1)
        for i in range(first + 1, last + 1):
            if self.leaves[i]:
                self._put(i, "")
        self._put(first, text)

    @property
    def total_tokens(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(self.leaves)


def _build_batches(batches, text, leaf_chars, vocabulary):
    encode = encoder(vocabulary).encode_ordinary
    for b in batches:
        leaves = [cut_leaves(t, leaf_chars) if t else [] for t in b.column(text).to_pylist()]
        tokens = [[len(encode(x)) for x in ls] for ls in leaves]
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array([[len(x) for x in ls] for ls in leaves], pa.list_(pa.int32())), pa.array(tokens, pa.list_(pa.int32())), pa.array([sum(t) for t in tokens], pa.int64())],
            names=[*b.schema.names, "leaf_chars", "leaf_tokens", "n_tokens"])


def build_trees(docs: DataFrame, text_col: str = "text", leaf_chars: int = LEAF_CHARS, vocabulary: str | None = None) -> DataFrame:
    """Adds leaf_chars, leaf_tokens (the leaves of the trees, in order) and n_tokens to the rows, in place of columns so named."""
    docs = docs.drop(*[c for c in ("leaf_chars", "leaf_tokens", "n_tokens") if c in docs.columns and c != text_col])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_batches(docs, partial(_build_batches, text=docs.columns.index(text_col), leaf_chars=leaf_chars, vocabulary=vocabulary),
                           f"{fields}, leaf_chars array<int>, leaf_tokens array<int>, n_tokens long")


def _edit_batches(batches, keep, text, edits, vocabulary):
    encode = encoder(vocabulary).encode_ordinary
    for b in batches:
        out = []
        for t, sizes, tokens, changes in zip(*(b.column(c).to_pylist() for c in (text, "leaf_chars", "leaf_tokens", edits)), strict=True):
            leaves, at = [], 0
            for n in sizes or []:
                leaves.append(t[at : at + n])
                at += n
            tree = SegmentTree(leaves, tokens or [], encode)
            for e in changes or []:
                if e is not None and e["pos"] is not None:
                    tree.edit(e["pos"], e["n_del"] or 0, e["ins"] or "")
            kept = [(len(x), n) for x, n in zip(tree.leaves, tree.tokens[tree.base :], strict=True) if x]
            out.append((tree.text(), [x for x, _ in kept], [n for _, n in kept], tree.total_tokens, tree.encoded_chars))
        types = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int64()]
        names = ["edited_text", "edited_leaf_chars", "edited_leaf_tokens", "edited_tokens", "encoded_chars"]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *(pa.array([r[i] for r in out], k) for i, k in enumerate(types))], names=[*keep, *names])


def apply_edits(trees: DataFrame, edits_col: str, text_col: str = "text", keep: list[str] | None = None, vocabulary: str | None = None) -> DataFrame:
    """The ``keep`` columns, the edited text, its leaves, its token count and how many characters were encoded again.

    ``trees`` comes from ``build_trees``; ``edits_col`` is an array of ``EDIT``.
    """
    keep = [c for c in trees.columns if c not in (text_col, edits_col, "leaf_chars", "leaf_tokens")] if keep is None else keep
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in trees.schema.fields if f.name in keep)
    return map_batches(trees, partial(_edit_batches, keep=[f.name for f in trees.schema.fields if f.name in keep], text=text_col, edits=edits_col, vocabulary=vocabulary),
                            f"{fields}edited_text string, edited_leaf_chars array<int>, edited_leaf_tokens array<int>, edited_tokens long, encoded_chars long")


def edit_column(id_col: str, text_col: str):
    """Three edits that follow from the row itself: a deletion, an insertion of the row's own first characters, a replacement."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    size, h = F.length(text), F.xxhash64(F.col(id_col))

    def at(shift):
        return F.pmod(F.shiftrightunsigned(h, shift), F.greatest(size, F.lit(1))).cast("long")

    def edit(pos, n_del, ins):
        return F.struct(pos.alias("pos"), F.lit(n_del).cast("long").alias("n_del"), ins.alias("ins"))

    return F.array(edit(at(3), 17, F.lit("")), edit(at(17), 0, F.substring(text, 1, 40)), edit(at(31), 9, F.reverse(F.substring(text, 1, 23))))
