"""Benchmark decontamination by spaced seeds (DataFrame functions only).

Fixed masks select five of five to eight consecutive words and ignore the rest; the hashes of the selected words of every
benchmark item are joined with those of every document.  A hit names a place of the document and one of the item, around
which the words are then compared one by one: a document is contaminated if some window of 13 words of the item (the whole
item if it is shorter) has at least 80 % of its words at their places.  The three masks together hit every such window,
wherever the substituted words are (checked for all patterns by a test), so the join loses none, and it is enough to compare
the windows that hold the hit: 21 words.  Items of under eight words get masks of their own: the whole item, and the item
without each one of its words where the threshold admits a substitution.  Items of the same words are compared once.

Documents are cut into overlapping pieces before their words are hashed, so a task never holds a whole text for each hit.

Benchmark seeds are broadcast up to ``max_broadcast`` rows, counted beforehand (about 50 bytes each); beyond that both
sides are shuffled by hash, only (document key, place, hash) travels, and the texts of documents with hits are joined back.
Hits are reduced to the best window of each document and item in the task that found them.

Defined results: null or empty texts and items without words are never contaminated and contaminate nothing; items with
null id count, but aren't listed; rows with equal id and text share their result, other repeated ids are told apart; an
empty benchmark leaves all documents clean; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import cut

MASKS = ("11111", "111011", "11010011")
WINDOW, SIMILARITY = 13, 0.8
#: Places that a window may begin before a mask that it holds.
REACH = WINDOW - min(len(m) for m in MASKS)
#: Places that a piece of a document has.
PIECE = 128
MAX_BROADCAST = 500_000


def text_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def word_hashes(text: Column) -> Column:
    return _hashed(text_words(text))


def needed(n: Column, window: int = WINDOW, similarity: float = SIMILARITY) -> Column:
    return F.ceil(F.least(n, F.lit(window)) * F.lit(similarity) - F.lit(1e-9)).cast("int")


def short_masks(n: int, similarity: float = SIMILARITY) -> list[str]:
    """Masks of an item with n words, fewer than the longest mask has."""
    own = ["1" * n]
    return own + ["1" * k + "0" + "1" * (n - k - 1) for k in range(n)] if n * similarity <= n - 1 else own


def _pieces(rows: DataFrame, keep: list[str]) -> DataFrame:
    """The hashes of the column words, cut into pieces that overlap: base is the place where a piece begins, first and last are its own places in it.

    A text is exploded piece by piece, so that what a task holds at once doesn't grow with words times hits.
    """
    n, start = F.size("words"), F.col("start")
    cuts = rows.select(*keep, "words", F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(PIECE)))).alias("start"))
    base = F.greatest(start - REACH, F.lit(0))
    own = [base.alias("base"), (start - base).alias("first"), (F.least(start + PIECE, n) - 1 - base).alias("last")]
    pieces = cuts.select(*keep, *own, F.slice("words", base + 1, REACH + PIECE + WINDOW).alias("piece"))
    # read twice, piece stays a column of its own; else the whole text would go along with each of its pieces
    return pieces.select(*keep, "base", "first", "last", F.size("piece").alias("size"), _hashed(F.col("piece")).alias("hashes"))


def _seeds(pieces: DataFrame, masks: list[str], keep: list[str]) -> DataFrame:
    """keep, base, hashes, at, h: the hash of the selected words at every own place of every piece, for every mask."""
    at = pieces.select(*keep, "base", "size", "hashes", F.explode(F.sequence("first", "last")).alias("at"))
    hashes = [F.when(F.col("at") + len(m) <= F.col("size"), F.xxhash64(F.lit(k), *[F.get("hashes", F.col("at") + o) for o, c in enumerate(m) if c == "1"])) for k, m in enumerate(masks)]
    return at.select(*keep, "base", "hashes", "at", F.explode(F.array(*hashes)).alias("h")).where("h is not null")


def _around(words: Column, at: Column) -> Column:
    """The words at and around a place, as many as windows that hold a mask there can reach."""
    return F.transform(F.sequence(at - REACH, at + WINDOW - 1), lambda p: F.get(words, p))


def _best_window(hits: DataFrame, keep: list[str]) -> DataFrame:
    """keep, same: the most words in place in a window of the item that holds the hit; near has a bit for each place around it."""
    bits = [F.when(F.get("around", F.lit(r + REACH)) == F.get("words", F.col("item_at") + r), 1 << (r + REACH)).otherwise(0) for r in range(-REACH, WINDOW)]
    width, whole = F.least("n", F.lit(WINDOW)), (1 << WINDOW) - 1
    windows = [F.when((F.col("item_at") + s >= 0) & (F.col("item_at") + s + width <= F.col("n")), F.bit_count(F.col("near").bitwiseAND(F.lit(whole << (s + REACH))))).otherwise(0) for s in range(-REACH, 1)]
    return hits.select(*keep, "n", "item_at", sum(bits[1:], bits[0]).alias("near")).select(*keep, "n", F.greatest(*windows).alias("same"))


def document_key(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    return [F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text_key")]


def _of(rows: DataFrame, texts: DataFrame, how: str = "inner") -> DataFrame:
    """rows joined with those of the same document in texts."""
    texts = texts.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    return rows.join(texts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), how)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                 item_text_col: str = "text", max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """(doc_id, text_key, item_ids, best): one row per contaminated document; best is the largest share of a window."""
    items = benchmark.select(F.col(item_id_col).alias("item_id"), word_hashes(F.col(item_text_col)).alias("words"))
    items = items.where(F.size("words") > 0).withColumn("item", F.xxhash64("words"))
    items = cut(items.groupBy("item").agg(F.first("words").alias("words"), F.collect_set("item_id").alias("ids")).withColumn("n", F.size("words")))
    longest = max(len(m) for m in MASKS)
    short = sorted(r[0] for r in items.where(F.col("n") < longest).select("n").distinct().collect())  # at most seven numbers
    masks = list(MASKS) + sorted({m for n in short for m in short_masks(n) if m not in MASKS})
    whole = items.select("item", "n", F.lit(0).alias("base"), F.lit(0).alias("first"), (F.col("n") - 1).alias("last"), F.col("n").alias("size"), F.col("words").alias("hashes"))
    seeds = cut(_seeds(whole, masks, ["item", "n"]).select("item", "n", F.col("at").alias("item_at"), "h"))

    keyed = docs.select(*document_key(docs, id_col, text_col), text_words(F.col(text_col)).alias("words"))
    places = _seeds(_pieces(keyed, ["doc_id", "text_key"]), masks, ["doc_id", "text_key"])
    spots, words = ["doc_id", "text_key", "item", "n", "item_at"], items.select("item", "words")
    if seeds.limit(max_broadcast + 1).count() <= max_broadcast:
        hits = places.join(F.broadcast(seeds), "h").select(*spots, _around(F.col("hashes"), F.col("at")).alias("around")).join(F.broadcast(words), "item")
    else:
        hits = places.select("doc_id", "text_key", (F.col("base") + F.col("at")).alias("at"), "h").join(seeds, "h").select(*spots, "at").distinct()
        wanted = hits.select("doc_id", "text_key").distinct()
        texts = _of(docs.select(*document_key(docs, id_col, text_col), F.col(text_col).alias("text")), wanted, "left_semi").dropDuplicates(["doc_id", "text_key"])
        hits = _of(hits, texts.select("doc_id", "text_key", word_hashes(F.col("text")).alias("hashes"))).select(*spots, _around(F.col("hashes"), F.col("at")).alias("around")).join(words, "item")

    # not filtered before it is summed up: the optimizer would move the condition, written out, into the join
    best = _best_window(hits, ["doc_id", "text_key", "item"]).groupBy("doc_id", "text_key", "item", "n").agg(F.max("same").alias("same")).where(F.col("same") >= needed(F.col("n")))
    found = best.select("doc_id", "text_key", "item", (F.col("same") / F.least("n", F.lit(WINDOW))).alias("best")).join(items.select("item", "ids"), "item")
    return found.groupBy("doc_id", "text_key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("item_ids"), F.max("best").alias("best"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, unchanged."""
    bad = cut(contaminated(docs, benchmark, id_col, text_col, **columns).select(F.col("doc_id").alias("_bad_id"), F.col("text_key").alias("_bad_key")))
    key = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    return docs.join(bad, docs[id_col].eqNullSafe(bad._bad_id) & (key == bad._bad_key), "left_anti")
