"""Byte-level BPE encoding and decoding of whole texts by overlapping chunks.

A text longer than ``chunk`` characters is dealt as chunks that overlap by ``overlap`` characters.  Each chunk is split into
pre-tokens in its own task, from its first character on, wherever that falls.  The scan keeps no state but its place, so
from the first boundary on that the scans of two neighbouring chunks have in common they agree: there the chunks are
stitched.  A boundary counts only if what follows it in the chunk can't change it (contractions look two characters
ahead) and if the character before it isn't white space (a run of white space depends on what follows it).  The pieces
between the stitches are then encoded, every pre-token by the ranks, in tasks of their own.  A document of which two
neighbouring chunks have no such boundary in common (a word longer than the overlap) is one piece.

Decoding looks up the bytes of every id and concatenates them; bytes are never interpreted, so pieces may be joined in order.

Defined results: null text is empty; an empty text has one piece without ids; texts are never normalised, and strings of
special tokens in them are plain text; repeated rows are encoded alike; other columns are ignored.  Ids of a document
arrive in pieces ordered by ``from``, so that a document's ids are never held in one place; short texts need no shuffle.
"""

from __future__ import annotations

import base64
import hashlib
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import map_batches, stored

CHUNK, OVERLAP = 1 << 15, 1 << 10
#: How far a decision of the pattern looks beyond the end of its match.
LOOKAHEAD = 2
_MEMO = 1 << 18
#: A private-use character: neither letter nor number nor white space.
_OTHER = "\ue000"
_ROWS = 64


@cache
def _ranks(vocabulary: str | None) -> dict[bytes, int]:
    import public_tokenizers

    with open(vocabulary or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@cache
def class_changes() -> dict[int, str]:
    """Characters that the library's pattern puts in another class than Python's ``regex``, and one of the right class.

    Both follow Unicode, each its own version of it; asked of the libraries themselves, as they are installed.
    """
    import regex
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([i]): i for i in range(256)}
    changes = {}
    for pattern in (r"\p{L}", r"\p{N}", r"\s"):
        theirs = bytes(tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)).decode()
        ours = regex.findall(pattern, every)
        example = {r"\p{L}": "a", r"\p{N}": "1", r"\s": " "}[pattern]
        changes |= {ord(c): "" for c in set(ours) - set(theirs) if ord(c) not in changes}
        changes |= {ord(c): example for c in set(theirs) - set(ours)}
    return changes


class PreTokenizer:
    """The pattern's matches, with classes as the library has them."""

    def __init__(self, changes: dict[int, str]):
        import public_tokenizers
        import regex

        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.changes = changes
        self.changed = frozenset(map(chr, changes))

    def _plain(self, text: str) -> bool:
        return text.isascii() or self.changed.isdisjoint(set(text))

    def split(self, text: str) -> list[str]:
        if self._plain(text):
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.changes))]

    def boundaries(self, text: str) -> np.ndarray:
        """Ends of the matches."""
        found = self.pattern.findall(text if self._plain(text) else text.translate(self.changes))
        return np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))


class Encoder:
    """Ids of pre-tokens as little-endian 32-bit numbers; those of frequent pre-tokens are remembered."""

    def __init__(self, vocabulary: str | None = None):
        import public_tokenizers
        import tiktoken

        ranks = _ranks(vocabulary)
        self.core = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.memo: dict[str, bytes] = {}
        self.token = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token

    def _ids(self, pre_token: str) -> bytes:
        ids = np.array(self.core.encode_single_piece(pre_token.encode()), "<u4").tobytes()
        if len(pre_token) < 32:
            if len(self.memo) >= _MEMO:
                self.memo.clear()
            self.memo[pre_token] = ids
        return ids

    def encode(self, pre_tokens: list[str]) -> bytes:
        known = self.memo.get
        return b"".join([known(p) or self._ids(p) for p in pre_tokens])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_encoder = cache(Encoder)


def stitches(before: np.ndarray, after: np.ndarray) -> int | None:
    """The first boundary that two scans have in common."""
    both = np.intersect1d(before, after)
    return int(both[0]) if len(both) else None


def seam_boundaries(scan: PreTokenizer, text: str, start: int, low: int, high: int, last: bool) -> np.ndarray:
    """Boundaries in [low, high) that the scan of a chunk, ``text`` from ``start`` on, is sure of."""
    ends = scan.boundaries(text)
    if not last:
        ends = ends[ends <= len(text) - LOOKAHEAD]
    ends = ends[(ends >= low - start) & (ends < high - start)]
    return np.array([e for e in ends.tolist() if e and not text[e - 1].isspace()], np.int64) + start


def _small(batches):
    """Few rows at a time as Python objects."""
    for b in batches:
        for k in range(0, b.num_rows, _ROWS):
            yield b.slice(k, _ROWS)


def _chunk_batches(batches, chunk, overlap):
    for b in _small(batches):
        for key, key2, text in zip(*(b.column(c).to_pylist() for c in ("key", "key2", "text")), strict=True):
            for k, at in enumerate(range(0, len(text), chunk)):
                yield pa.RecordBatch.from_pydict({"key": pa.array([key]), "key2": pa.array([key2]), "k": pa.array([k]), "text": pa.array([text[at : at + chunk + overlap + LOOKAHEAD]]),
                                                  "last": pa.array([at + chunk + overlap + LOOKAHEAD >= len(text)])})


def _seam_batches(batches, chunk, overlap, changes):
    scan = PreTokenizer(changes)
    for b in _small(batches):
        cols = [b.column(c).to_pylist() for c in ("k", "text", "last")]
        head, tail = [], []
        for k, text, last in zip(*cols, strict=True):
            at = k * chunk
            found = seam_boundaries(scan, text, at, at, at + chunk + overlap, last)
            head.append(found[found < at + overlap].tolist())
            tail.append(found[found >= at + chunk].tolist())
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([b.column("key"), b.column("key2"), b.column("k"), pa.array(head, kind), pa.array(tail, kind)], names=["key", "key2", "k", "head", "tail"])


def _piece_batches(batches):
    names = ["doc_id", "key", "key2", "copies", "from", "n_pieces", "text"]
    for b in _small(batches):
        for i, (text, cuts) in enumerate(zip(b.column("text").to_pylist(), b.column("cuts").to_pylist(), strict=True)):
            ends = [0, *sorted(set(cuts or []) - {0, len(text)}), len(text)]
            row = b.slice(i, 1)
            for start, end in zip(ends, ends[1:], strict=False):
                yield pa.RecordBatch.from_arrays([*(row.column(c) for c in names[:4]), pa.array([start]), pa.array([len(ends) - 1]), pa.array([text[start:end]])], names=names)


def _encode_batches(batches, vocabulary, changes):
    scan, encoder = PreTokenizer(changes), _encoder(vocabulary)
    for b in _small(batches):
        ids = [encoder.encode(scan.split(t)) for t in b.column("text").to_pylist()]
        n = pa.array([len(x) // 4 for x in ids], pa.int64())
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], n, pa.array(ids, pa.binary())], names=[*b.schema.names[:-1], "n_tokens", "ids"])


def _decode_batches(batches, vocabulary):
    encoder = _encoder(vocabulary)
    for b in _small(batches):
        decoded = [None if x is None else encoder.decode(x) for x in b.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(decoded, pa.binary())], names=[*b.schema.names, "decoded"])


def _fields(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), text).alias("key"), F.xxhash64(text, F.col(id_col), F.lit(1)).alias("key2"), text.alias("text"))


def _encoded(pieces: DataFrame, vocabulary: str | None) -> DataFrame:
    return map_batches(pieces, partial(_encode_batches, vocabulary=vocabulary, changes=class_changes()), _fields(pieces.drop("text")) + ", n_tokens long, ids binary")


def encode_short(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """The documents of at most ``chunk`` characters, a piece each; a map without a shuffle."""
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    rows = _rows(docs, id_col, text_col).where(F.length("text") <= chunk)
    return _encoded(rows.select("doc_id", "key", "key2", one.alias("copies"), zero.alias("from"), one.alias("n_pieces"), "text"), vocabulary)


def encode_long(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """The documents of over ``chunk`` characters, cut where the scans of overlapping chunks agree."""
    if not 0 < overlap <= chunk:
        raise ValueError("the overlap must be positive and at most a chunk")
    rows = _rows(docs, id_col, text_col).where(F.length("text") > chunk)
    chunks = map_batches(rows.select("key", "key2", "text"), partial(_chunk_batches, chunk=chunk, overlap=overlap), "key long, key2 long, k long, text string, last boolean")
    seams = map_batches(chunks.repartition("key", "key2", "k"), partial(_seam_batches, chunk=chunk, overlap=overlap, changes=class_changes()),
                        "key long, key2 long, k long, head array<long>, tail array<long>")
    seams = stored(seams.dropDuplicates(["key", "key2", "k"]), "seams")  # read for both sides of a seam
    left = seams.select("key", "key2", (F.col("k") + 1).alias("k"), "tail")
    stitch = F.array_min(F.array_intersect("tail", "head"))
    found = left.join(seams.select("key", "key2", "k", "head"), ["key", "key2", "k"]).groupBy("key", "key2").agg(
        F.count(F.lit(1)).alias("n"), F.collect_list(stitch).alias("cuts"))  # one number a chunk
    cuts = found.select("key", "key2", F.when(F.size("cuts") == F.col("n"), F.col("cuts")).alias("cuts"))
    copies = rows.groupBy("key", "key2").agg(F.count(F.lit(1)).alias("copies"))
    whole = rows.dropDuplicates(["key", "key2"]).join(copies.join(cuts, ["key", "key2"], "left"), ["key", "key2"])
    kind = rows.schema["doc_id"].dataType.simpleString()
    pieces = map_batches(whole.select("doc_id", "key", "key2", "copies", "cuts", "text"), _piece_batches, f"doc_id {kind}, key long, key2 long, copies long, from long, n_pieces long, text string")
    return _encoded(pieces.repartition("key", "key2", "from"), vocabulary)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, key, key2, copies, from, n_pieces, n_tokens, ids): the pieces of every document, ids as little-endian 32-bit.

    A document over ``chunk`` characters comes once for all rows of equal id and text, ``copies`` says for how many.
    """
    return encode_short(docs, id_col, text_col, vocabulary, chunk).union(encode_long(docs, id_col, text_col, vocabulary, chunk, overlap))


def decode(pieces: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The pieces and the raw bytes of their ids, ``decoded``; null ids give null."""
    return map_batches(pieces, partial(_decode_batches, vocabulary=vocabulary), _fields(pieces) + ", decoded binary")


def _digest_batches(batches):
    names = ["doc_id", "copies", "n_tokens", "ids_sha256", "decoded_sha256"]
    held, state = None, None

    def done():
        return pa.RecordBatch.from_arrays([held.column("doc_id"), held.column("copies"), pa.array([state[0]], pa.int64()), pa.array([state[1].hexdigest()]), pa.array([state[2].hexdigest()])], names=names)

    before = None
    for b in batches:
        cols = [b.column(c).to_pylist() for c in ("key", "key2", "n_tokens", "ids", "decoded")]
        for i, (key, key2, n, ids, decoded) in enumerate(zip(*cols, strict=True)):
            if (key, key2) != before:
                if before is not None:
                    yield done()
                before, held, state = (key, key2), b.slice(i, 1), [0, hashlib.sha256(), hashlib.sha256()]
            state[0] += n
            state[1].update(ids)
            state[2].update(decoded)
    if before is not None:
        yield done()


_DIGESTS = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def digests(pieces: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row a document, from decoded pieces; streams in order of ``from``."""
    rows = pieces.select("doc_id", "key", "key2", "copies", "from", "n_tokens", "ids", "decoded").repartition("key", "key2").sortWithinPartitions("key", "key2", "from")
    kind = pieces.schema["doc_id"].dataType.simpleString()
    joined = map_batches(rows, _digest_batches, f"doc_id {kind}, copies long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return joined.select(*_DIGESTS, F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).drop("copy")


def document_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``digests`` of all documents, encoded and decoded; only those of several pieces are shuffled."""
    short = decode(encode_short(docs, id_col, text_col, vocabulary, chunk), vocabulary)
    short = short.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
    return short.union(digests(decode(encode_long(docs, id_col, text_col, vocabulary, chunk, overlap), vocabulary)))
