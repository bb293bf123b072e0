"""Dictionary tagger: substring match of category phrases on a capped text.

Semantics
---------
* ``description`` falls back to ``title`` when null, and that fallback is kept.
* The text cap is the half-even rounded mean over sources (null source
  dropped) of the mean description length – computed per input DataFrame.
* ``desc_match = lower(substring(description, 1, cap))`` (cut before lower).
* A phrase (lower-cased) tags an article when it is a substring of
  ``desc_match``; a phrase listed twice in one category keeps its last tag.
* Per category the distinct tags are sorted and joined by ``,``; a category
  without hits is null.  ``tag_concat`` joins the fourteen scored categories,
  ``tag_score`` counts the scored categories with at least one tag (null when
  none).  ``current_issues`` is tagged but not scored.

Plan
----
The phrase table is a dimension table.  Its size is checked; up to
``AUTO_INLINE_PHRASES`` entries it is compiled into the projection itself –
per tag one short-circuiting ``OR`` of ``contains`` tests, all inside
whole-stage codegen.  Beyond that, and up to ``MAX_AUTOMATON_BYTES`` of phrases,
the dictionary becomes one multi-pattern automaton that scans each text once
(``operators.phrase_automaton``); only the text goes to Python, in Arrow batches.
Either way tagging is a narrow map over the articles: no shuffle, no join,
partitioning preserved.  Larger dictionaries use an exact rarest-k-gram
prefilter join (``strategy="kgram"``), which aggregates hits per distinct text
and joins them back by its hash.  All give the same rows.
"""

from __future__ import annotations

import weakref
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.operators.joins import broadcast_if_small
from newsflow.operators.partitioning import posexplode_rows
from newsflow.operators.phrase_automaton import PhraseMatcher
from newsflow.schemas import ALL_CATEGORIES, SCORED_CATEGORIES
from newsflow.session import ship_package

# Inline matching costs (texts × phrases), the automaton costs texts only; far
# larger inline expressions also strain the driver when compiled.
AUTO_INLINE_PHRASES = 60
MAX_INLINE_PHRASES = 600
MAX_AUTOMATON_BYTES = 32 << 20
MAX_VOCABULARY = 200_000


def prepare_dictionary(ref_tags: DataFrame, newsroom_only: bool = True) -> DataFrame:
    """(tag_cat, phrase, tag) with lower-cased phrases; the last duplicate (highest
    ``ref_seq``, then tag) wins – the same rule ``inline_dictionary`` applies."""
    r = ref_tags.where(F.col("phrase").isNotNull())
    if newsroom_only:
        r = r.where(F.col("newsroom") == F.lit("Yes"))
    seq = F.col("ref_seq") if "ref_seq" in r.columns else F.lit(None).cast("int")
    w = Window.partitionBy("tag_cat", "phrase").orderBy(F.col("_seq").desc_nulls_last(), F.col("tag").desc())
    return (
        r.select("tag_cat", "tag", F.lower("phrase").alias("phrase"), seq.alias("_seq"))
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .select("tag_cat", "phrase", "tag")
    )


def with_description_fallback(articles: DataFrame) -> DataFrame:
    return articles.withColumn("description", F.coalesce(F.col("description"), F.col("title")))


def char_limit_frame(articles: DataFrame) -> DataFrame:
    """One row: the text cap and the number of (non-null) sources it averages over."""
    per_source = (
        articles.where(F.col("source").isNotNull())
        .groupBy("source")
        .agg(F.avg(F.length("description")).alias("m"))
    )
    return per_source.agg(
        F.bround(F.avg("m"), 0).cast("int").alias("char_limit"), F.count("*").alias("n_sources")
    )


def char_limit(articles: DataFrame) -> Column:
    """Text cap as a lazy scalar subquery over ``articles`` (after the fallback)."""
    return char_limit_frame(articles).select("char_limit").scalar()


def _sql_str(v: str) -> str:
    """A Spark SQL string literal (backslash escapes are on by default)."""
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _inline_cell_sql(desc_match: str, entries: list[tuple[str, str]]) -> str:
    """Sorted distinct tags whose phrases occur in ``desc_match``, joined by ','; null if none.

    Compiled per category into scalar expressions that stay inside
    whole-stage codegen: one ``OR`` of ``contains`` tests per distinct tag
    (short-circuits on the first hit), tags pre-sorted on the driver, joined
    with ``concat_ws`` (which skips the nulls of tags without a hit).  Built
    as SQL text so the JVM parses it in one call instead of one py4j round
    trip per node.
    """
    if not entries:
        return "CAST(NULL AS STRING)"
    phrases_by_tag: dict[str, list[str]] = defaultdict(list)
    for phrase, tag in entries:
        phrases_by_tag[tag].append(phrase)
    parts = []
    for tag in sorted(phrases_by_tag):
        hit = " OR ".join(f"contains({desc_match}, {_sql_str(p)})" for p in sorted(phrases_by_tag[tag], key=len))
        parts.append(f"CASE WHEN {hit} THEN {_sql_str(tag)} END")
    return f"nullif(concat_ws(',', {', '.join(parts)}), '')"


def _finish(df: DataFrame, prefix: str = "") -> DataFrame:
    scored = [f"`{prefix}{c}`" for _, c in SCORED_CATEGORIES]
    score = " + ".join(f"CAST({c} IS NOT NULL AS INT)" for c in scored)
    return df.withColumns(
        {
            prefix + "tag_concat": F.expr(f"nullif(concat_ws(',', {', '.join(scored)}), '')"),
            prefix + "tag_score": F.expr(f"CAST(nullif({score}, 0) AS INT)"),
        }
    )


_DICTIONARIES: "weakref.WeakKeyDictionary[DataFrame, dict]" = weakref.WeakKeyDictionary()


def inline_dictionary(ref_tags: DataFrame, newsroom_only: bool = True) -> dict[str, list[tuple[str, str]]]:
    """Phrase table grouped by category, size-checked before it is pulled to the driver.

    The last-wins rule for a phrase listed twice in a category is applied on
    the collected rows (the table is bounded by ``MAX_INLINE_PHRASES``).  The
    result is a snapshot kept per DataFrame object, like a broadcast
    variable: re-read the reference table to pick up later changes.
    """
    memo = _DICTIONARIES.setdefault(ref_tags, {})
    if newsroom_only not in memo:
        memo[newsroom_only] = _collect_dictionary(ref_tags, newsroom_only)
    return memo[newsroom_only]


def _collect_dictionary(ref_tags: DataFrame, newsroom_only: bool) -> dict[str, list[tuple[str, str]]]:

    r = ref_tags.where(F.col("phrase").isNotNull())
    r = r.where(F.col("newsroom") == F.lit("Yes")) if newsroom_only else r
    seq = F.col("ref_seq") if "ref_seq" in r.columns else F.lit(0)
    rows = r.select("tag_cat", "tag", F.lower("phrase").alias("phrase"), seq.alias("seq")).limit(MAX_INLINE_PHRASES + 1).collect()
    if len(rows) > MAX_INLINE_PHRASES:
        raise ValueError(f"more than {MAX_INLINE_PHRASES} phrases; use strategy='automaton' or 'kgram'")
    last: dict[tuple[str, str], tuple] = {}
    for row in rows:
        key = (row.tag_cat, row.phrase)
        rank = (row.seq if row.seq is not None else -1, row.tag)
        if key not in last or rank > last[key][0]:
            last[key] = (rank, row.tag)
    by_cat: dict[str, list[tuple[str, str]]] = defaultdict(list)
    for (cat, phrase), (_, tag) in sorted(last.items()):
        by_cat[cat].append((phrase, tag))
    return dict(by_cat)


def tag_columns(
    df: DataFrame, desc_match: Column, by_cat: dict[str, list[tuple[str, str]]], prefix: str = ""
) -> DataFrame:
    """Add ``prefix``-named category columns, ``tag_concat`` and ``tag_score`` (narrow).

    The category cells are emitted through a generator (``inline`` of a
    one-element array).  A later filter on the tag columns therefore stops
    above the ``Generate`` instead of being pushed down with the whole
    matching expression inlined into it (once per reference, below any
    redistribution); matching runs exactly once per row.
    """
    cells = F.expr(
        "struct("
        + ", ".join(f"{_inline_cell_sql('_desc_match', by_cat.get(cat, []))} AS `{prefix + col}`" for cat, col in ALL_CATEGORIES)
        + ")"
    )
    out = df.withColumn("_desc_match", desc_match).select(*[F.col(f"`{c}`") for c in df.columns], F.inline(F.array(cells)))
    return _finish(out, prefix)


def tag_articles(
    articles: DataFrame,
    ref_tags: DataFrame,
    cap: int | Column | None = None,
    strategy: str = "auto",
    newsroom_only: bool = True,
    kgram: int = 4,
) -> DataFrame:
    """Append the fifteen category columns, ``tag_concat`` and ``tag_score``.

    ``strategy``: ``inline`` (chosen by ``auto`` up to ``AUTO_INLINE_PHRASES``
    entries), ``automaton`` (chosen up to ``MAX_AUTOMATON_BYTES`` of phrases) or
    ``kgram`` (exact prefilter join, chosen beyond).  All give the same rows:
    ``kgram`` finds the tags of each distinct text and joins them back by a hash
    of the text, so no row id is needed.  Null phrases match nothing.
    """
    cap_col = char_limit(with_description_fallback(articles)) if cap is None else (F.lit(cap) if isinstance(cap, int) else cap)
    arts = with_description_fallback(articles)
    desc_match = F.lower(F.substring(F.col("description"), F.lit(1), cap_col))
    if strategy not in ("auto", "inline", "automaton", "kgram"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "auto":
        strategy = _strategy_for(ref_tags, newsroom_only)
    if strategy == "inline":
        return tag_columns(arts, desc_match, inline_dictionary(ref_tags, newsroom_only))
    dictionary = prepare_dictionary(ref_tags, newsroom_only)
    if strategy == "automaton":
        return _finish(_automaton_columns(arts, desc_match, dictionary))
    return _finish(_join_back(arts, _hits_by_kgram(_distinct_texts(arts, desc_match), dictionary, kgram), desc_match))


def _strategy_for(ref_tags: DataFrame, newsroom_only: bool) -> str:
    """The plan for a dictionary, by its number of entries and their bytes (one aggregated row)."""
    r = ref_tags.where(F.col("phrase").isNotNull())
    r = r.where(F.col("newsroom") == F.lit("Yes")) if newsroom_only else r
    size = r.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("phrase") + F.octet_length(F.coalesce("tag", F.lit(""))) + 64), F.lit(0)).alias("b")).first()
    if size.n <= min(AUTO_INLINE_PHRASES, MAX_INLINE_PHRASES):
        return "inline"
    return "automaton" if size.b <= MAX_AUTOMATON_BYTES else "kgram"


def _automaton_columns(arts: DataFrame, desc_match: Column, dictionary: DataFrame) -> DataFrame:
    """The category columns by one scan of each text; the dictionary's size was checked, it travels in a broadcast."""
    ship_package(arts.sparkSession)
    entries = [(r.tag_cat, r.phrase, r.tag) for r in dictionary.where(F.col("tag").isNotNull()).collect()]
    shared = arts.sparkSession.sparkContext.broadcast(PhraseMatcher(entries, [c for c, _ in ALL_CATEGORIES]))
    fields = ", ".join(f"c{k} string" for k in range(len(ALL_CATEGORIES)))

    @F.arrow_udf(returnType=f"struct<{fields}>")
    def cells(texts: pa.Array) -> pa.Array:
        return shared.value.cells(texts)

    found = arts.withColumn("_cells", cells(desc_match))
    return found.select(*[F.col(f"`{c}`") for c in arts.columns], *[F.col(f"_cells.c{k}").alias(col) for k, (_, col) in enumerate(ALL_CATEGORIES)])


def _text_key(desc_match: Column) -> Column:
    return F.md5(desc_match.cast("binary"))


def _distinct_texts(arts: DataFrame, desc_match: Column) -> DataFrame:
    """(_id, _dm): every text once, under the hash that joins its tags back."""
    return arts.select(_text_key(desc_match).alias("_id"), desc_match.alias("_dm")).where(F.col("_dm").isNotNull()).distinct()


def _hits_by_kgram(keys: DataFrame, dictionary: DataFrame, k: int) -> DataFrame:
    """Exact hits for dictionaries of any size: rarest-k-gram prefilter equi-join, then ``contains``.

    A phrase of length >= k can only occur in a text that contains every one
    of its k-grams.  Each phrase is therefore keyed on its *rarest* k-gram
    (document frequencies from one map-side-combined aggregation over the
    texts' distinct grams); phrases with a gram that occurs in no text are
    dropped before any pairing.  Candidate (text, phrase) pairs come from an
    equi-join on that gram – a shuffle join whose hot keys AQE splits – and
    are verified with ``contains`` after the text is joined back by id.
    Phrases shorter than k are tested inline, or, if there are more than
    ``MAX_INLINE_PHRASES`` of them, joined with the grams of their own length.
    """
    short_dict = dictionary.where(F.length("phrase") < k)
    short_rows = short_dict.limit(MAX_INLINE_PHRASES + 1).collect()

    # every overlapping k-gram: a zero-width lookahead match at each position
    gram_re = F.lit(f"(?s)(?=(.{{{k}}}))")
    long_ph = dictionary.where(F.length("phrase") >= k)
    phrase_grams = long_ph.select(
        "phrase", "tag_cat", "tag", F.explode(F.array_distinct(F.regexp_extract_all(F.col("phrase"), gram_re, 1))).alias("_g")
    )
    # only grams that occur in some phrase can matter: a semi join drops the
    # others before anything is shuffled; its rows are k characters each, so
    # the bound on rows is one on bytes (about 64 each)
    vocabulary = broadcast_if_small(phrase_grams.select("_g").distinct(), MAX_VOCABULARY)
    all_grams = keys.select("_id", F.explode(F.array_distinct(F.regexp_extract_all(F.col("_dm"), gram_re, 1))).alias("_g"))
    grams = all_grams.join(vocabulary, "_g", "left_semi")
    doc_freq = grams.groupBy("_g").agg(F.count("*").alias("_df"))

    scored = phrase_grams.join(doc_freq, "_g", "left").select(
        "phrase", "tag_cat", "tag", F.struct(F.coalesce("_df", F.lit(0)).alias("df"), F.col("_g").alias("g")).alias("_r")
    )
    rarest = scored.groupBy("phrase", "tag_cat", "tag").agg(F.min("_r").alias("_r"))
    index = rarest.where(F.col("_r.df") > 0).select("phrase", "tag_cat", "tag", F.col("_r.g").alias("_g"))

    candidates = grams.join(index, "_g").select("_id", "phrase", "tag_cat", "tag")
    verified = (
        candidates.join(keys, "_id")
        .where(F.col("_dm").contains(F.col("phrase")))
        .select("_id", "tag_cat", "tag")
    )
    if not short_rows:
        return verified
    if len(short_rows) > MAX_INLINE_PHRASES:
        for n in range(1, k):
            own = F.array_distinct(F.regexp_extract_all(F.col("_dm"), F.lit(f"(?s)(?=(.{{{n}}}))"), 1))
            same = keys.select("_id", F.explode(own).alias("_g")).join(short_dict.where(F.length("phrase") == n), F.col("_g") == F.col("phrase"))
            verified = verified.unionByName(same.select("_id", "tag_cat", "tag"))
        everywhere = short_dict.where(F.length("phrase") == 0)  # one row a category at most
        return verified.unionByName(keys.select("_id").join(F.broadcast(everywhere.limit(len(ALL_CATEGORIES))), F.lit(True)).select("_id", "tag_cat", "tag"))
    tests = [
        F.when(F.col("_dm").contains(F.lit(r.phrase)), F.struct(F.lit(r.tag_cat).alias("tag_cat"), F.lit(r.tag).alias("tag")))
        for r in short_rows
    ]
    short_hits = posexplode_rows(keys, F.array(*tests), ["_id"], "_p", "_h").where(F.col("_h").isNotNull())
    return verified.unionByName(short_hits.select("_id", "_h.tag_cat", "_h.tag"))


def _join_back(arts: DataFrame, hits: DataFrame, desc_match: Column) -> DataFrame:
    """Pivot (text, category, tag) hits to the category columns and attach them by the hash of the text."""
    cats = [n for n, _ in ALL_CATEGORIES]
    sets = hits.groupBy("_id").pivot("tag_cat", cats).agg(F.collect_set("tag"))
    wide = sets.select(
        "_id", *[F.nullif(F.array_join(F.sort_array(F.col(f"`{n}`")), ","), F.lit("")).alias(c) for n, c in ALL_CATEGORIES]
    )
    keyed = arts.withColumn("_text_key", _text_key(desc_match))
    return keyed.join(wide, keyed["_text_key"] == wide["_id"], "left").drop("_id", "_text_key")


def tag_category_hits(articles: DataFrame, ref_tags: DataFrame, id_col: str = "id") -> DataFrame:
    """Long form of the tagger: one row per (article, category, tag) hit."""
    tagged = tag_articles(articles, ref_tags)
    longs = [
        F.struct(F.lit(cat).alias("tag_cat"), F.col(col).alias("tags"))
        for cat, col in ALL_CATEGORIES
    ]
    return (
        tagged.select(F.col(id_col), F.explode(F.array(*longs)).alias("c"))
        .where(F.col("c.tags").isNotNull())
        .select(id_col, F.col("c.tag_cat").alias("tag_cat"), F.explode(F.split("c.tags", ",")).alias("tag"))
    )
