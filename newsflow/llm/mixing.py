"""Mixing sources to target weights by a low-discrepancy schedule (DataFrame functions only).

Sizes are counted in words.  Sources get weights and targets (water filling: no target above ``max_repeats`` times its
source, the excess reshared by weight).  The documents of a source, shuffled by a hash, stand one after another on the
source's line, which is cut into blocks of equal numbers of words (up to a word): of ``block_words`` at most, and small
sources into ``MIN_BLOCKS`` or as many as they have words.  A source is due as many slots as its target holds of its own
blocks, rounded; so what is taken of it is within half of one of its blocks, and a word, of its target.

The mix is a line of all slots.  Slot j is mapped to a source by the point ``j * g mod n`` on the cumulative slots of the
sources, g next to n over the golden ratio without a common divisor: a rank-1 lattice, so that every stretch of slots
holds the sources in about their shares, and the whole line meets each point once, so that every source gets exactly its
slots, however small its share.  The r-th slot of a source takes its block ``r mod blocks``.  A document takes what the
chosen blocks overlap of it, repeats counted.

Nothing is windowed over a whole source: ranks of slots and places of documents come from two levels, sums over chunks
or hash buckets (one small row each) and a running number within a chunk or bucket.  Documents of size zero take
nothing.  Defined results: null text has size 0; the null source is a source, last in order; an empty table gives an
empty result; equal ids and repeated rows are documents of their own; other columns are ignored unless passed on.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.common import WORDS, cut

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 32
SLOT_CHUNK = 1 << 14
BUCKET_HEX = 3
GRID = 4096
MIN_BLOCKS = 64
GOLDEN = 0.6180339887498949
#: Products of two numbers below 2**42 are taken modulo n in two halves of a slot's bits; 2**42 slots hold 1.4e14 words.
HALF_BITS, MOST_SLOTS = 21, 1 << 42


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_no, source_size, weight, target) from rows of (source, size).  One row a source throughout."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    s = by_source.withColumn("source_no", (F.row_number().over(everything) - 1).cast("int")).withColumn("weight", w)
    s = s.withColumn("most", (F.col("source_size") * max_repeats).cast("double"))
    # water filling: sources by the level at which they are full; those full below the level get all they may
    order = Window.orderBy(F.col("most") / F.col("weight"), "source_no")
    before, all_rows = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left_words = F.sum("source_size").over(all_rows).cast("double") - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    left_weight = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    s = s.withColumn("level", left_words / left_weight)
    # once a source isn't full at its level, that level holds for it and for all after it
    open_level = F.first(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    target = F.when(open_level.isNull(), F.col("most")).otherwise(open_level * F.col("weight"))
    return s.withColumn("target", target).select("source", "source_no", "source_size", "weight", "target")


def source_blocks(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Adds ``n_blocks``, their ``words`` (the first ``longer`` ones have one more) and ``n_slots``, the blocks due.

    A target is so many whole rounds over the source, and then as many first blocks as come nearest to the rest.
    """
    size, longer, words = F.col("source_size"), F.col("longer"), F.col("words")
    n = F.greatest(F.ceil(size / block_words), F.least(size, F.lit(MIN_BLOCKS).cast("long"))).cast("long")
    t = targets.where("source_size > 0").withColumn("n_blocks", n)
    t = t.withColumn("longer", size % F.col("n_blocks")).withColumn("words", F.expr("source_size div n_blocks"))
    rounds = F.floor(F.col("target") / size)
    rest, in_longer = F.col("target") - rounds * size, longer * (words + 1)
    blocks = F.when(rest <= in_longer, F.floor(rest / (words + 1) + 0.5)).otherwise(longer + F.floor((rest - in_longer) / words + 0.5))
    return t.withColumn("n_slots", (rounds * F.col("n_blocks") + blocks).cast("long"))


def lattice_step(n: int) -> int:
    """The number next to n over the golden ratio that has no divisor in common with n."""
    near = round(n * GOLDEN)
    return next(g for d in range(n + 1) for g in (near + d, near - d) if g > 0 and gcd(g, n) == 1)


def slot_schedule(spark, blocks: DataFrame, n_slots: int) -> DataFrame:
    """(slot, source_no, rank): the source of every slot and the slot's number among those of its source.

    ``blocks`` has (source_no, n_slots), ``n_slots`` is their sum.
    """
    if n_slots >= MOST_SLOTS:
        raise ValueError("the mix has too many slots; use larger blocks")
    up_to = F.sum("n_slots").over(Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    bounds = blocks.select("source_no", "n_slots", up_to.alias("hi")).withColumn("lo", F.col("hi") - F.col("n_slots")).where("n_slots > 0")
    # an equi-join on the cells of a grid over the points finds the interval; a source covers as many cells as its share
    n, width = max(n_slots, 1), -(-max(n_slots, 1) // GRID)
    cells = bounds.select("source_no", "lo", "hi", F.explode(F.expr(f"sequence(lo div {width}, (hi - 1) div {width})")).alias("cell"))
    step, half = lattice_step(n), 1 << HALF_BITS
    point = f"((((slot div {half}) * {step}L) % {n}L * {half}L) % {n}L + ((slot % {half}) * {step}L) % {n}L) % {n}L"
    slots = spark.range(n_slots).select(F.col("id").alias("slot")).withColumn("point", F.expr(point)).withColumn("cell", F.expr(f"point div {width}"))
    at = slots.join(cells, "cell").where("point >= lo and point < hi").select("slot", "source_no", F.floor(F.col("slot") / SLOT_CHUNK).alias("chunk"))
    at = cut(at)
    counts = at.groupBy("source_no", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("source_no", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("chunk", "source_no").orderBy("slot")) - 1
    return at.withColumn("within", within).join(counts, ["source_no", "chunk"]).select("slot", "source_no", (F.col("before") + F.col("within")).alias("rank"))


def place_documents(docs: DataFrame, bucket_hex: int = BUCKET_HEX) -> DataFrame:
    """Adds ``start``, the place of a document on its source's line, in the order of the hash ``shuffle``."""
    docs = docs.withColumn("bucket", F.substring("shuffle", 1, bucket_hex))
    sums = docs.groupBy("source_no", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source_no", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("source_no", "bucket").orderBy("shuffle", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = docs.withColumn("within", F.coalesce(F.sum("size").over(own), F.lit(0)))
    return placed.join(sums, ["source_no", "bucket"]).withColumn("start", F.col("before") + F.col("within")).drop("bucket", "before", "within")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
        max_repeats: int = MAX_REPEATS, block_words: int = BLOCK_WORDS, seed: int = 42) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken), one row a document.  Reruns give the same rows."""
    sized = cut(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size")))
    targets = cut(source_targets(sized, weights, max_repeats))
    blocks = cut(source_blocks(targets, block_words))
    n_slots = blocks.agg(F.sum("n_slots")).first()[0] or 0
    shuffle = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")).cast("binary"))
    small = targets.limit(100_001).count() <= 100_000  # one row a source
    known = F.broadcast(targets) if small else targets
    rows = sized.withColumnRenamed("source", "doc_source").join(known, F.col("doc_source").eqNullSafe(F.col("source"))).drop("doc_source")
    placed = cut(place_documents(rows.withColumn("shuffle", shuffle)).drop("shuffle", "weight"))
    cuts = F.broadcast(blocks) if small else blocks
    slots = slot_schedule(docs.sparkSession, blocks, n_slots).join(cuts.select("source_no", "n_blocks"), "source_no")
    times = slots.groupBy("source_no", (F.col("rank") % F.col("n_blocks")).alias("block")).agg(F.count(F.lit(1)).alias("times"))
    placed_in = placed.where("size > 0").select("source_no", "start", "size").join(cuts.select("source_no", "longer", "words"), "source_no")

    def block_of(word):
        return f"IF({word} < longer * (words + 1), {word} div (words + 1), longer + ({word} - longer * (words + 1)) div words)"

    parts = placed_in.withColumn("block", F.explode(F.expr(f"sequence({block_of('start')}, {block_of('(start + size - 1)')})")))
    begin, end = F.expr("block * words + least(block, longer)"), F.expr("(block + 1) * words + least(block + 1, longer)")
    overlap = F.least(F.col("start") + F.col("size"), end) - F.greatest(F.col("start"), begin)
    words = parts.join(times, ["source_no", "block"]).groupBy("source_no", "start").agg(F.sum(overlap * F.col("times")).alias("taken"))
    # a start belongs to one document with words; those without words may share it
    with_words = placed.where("size > 0").join(words, ["source_no", "start"], "left")
    columns = ["doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")]
    return with_words.select(*columns).union(placed.where("size = 0").withColumn("taken", F.lit(0).cast("long")).select(*columns))
