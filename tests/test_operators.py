"""Unit fixtures of FIXTURES.md §3 for the operators, plus invariants."""

from pyspark.sql import functions as F

from newsflow.operators.cooccurrence import content_flags, cooccurrence_ids, subject_ids
from newsflow.operators.dedup import keep_first
from newsflow.operators.load import new_rows, update_by_key
from newsflow.operators.tagging import char_limit_frame, tag_articles
from newsflow.operators.tags_long import active_profiles, attach_guid, attach_programmes, rollup_programmes, to_long
from newsflow.schemas import REF_TAGS, SCORED_CATEGORIES

ART = "id bigint, title string, description string, source string"


def test_char_limit_half_even(spark):
    # group means 2 and 3 → 2.5 → 2 (half-even); a null source is dropped
    arts = spark.createDataFrame([(1, "t", "ab", "s1"), (2, "t", "abc", "s2"), (3, "t", "abcdefgh", None)], ART)
    assert char_limit_frame(arts).first()["char_limit"] == 2


def test_duplicate_phrase_last_wins(spark):
    ref = spark.createDataFrame([(1, "g1", "Sector", "A", "k", "Yes"), (2, "g2", "Sector", "B", "k", "Yes")], REF_TAGS)
    arts = spark.createDataFrame([(1, "t", "kkk", "s")], ART)
    assert tag_articles(arts, ref, cap=10).first()["sector"] == "B"


def test_no_match_gives_nulls(spark):
    ref = spark.createDataFrame([(1, "g1", "Sector", "A", "zz", "Yes")], REF_TAGS)
    row = tag_articles(spark.createDataFrame([(1, "t", "abc", "s")], ART), ref, cap=10).first()
    assert row["tag_score"] is None and row["tag_concat"] is None and row["sector"] is None


def test_cap_before_lower_and_fallback(spark):
    ref = spark.createDataFrame([(1, "g1", "Policy", "P", "late", "Yes"), (2, "g2", "Finance", "F", "TITLE", "Yes")], REF_TAGS)
    arts = spark.createDataFrame([(1, "Title here", None, "s"), (2, "x", "early text ... late", "s")], ART)
    rows = {r.id: r for r in tag_articles(arts, ref, cap=8).collect()}
    assert rows[1]["finance"] == "F" and rows[1]["description"] == "Title here"  # fallback kept
    assert rows[2]["policy"] is None  # 'late' lies beyond the cap


def test_strategies_agree(spark):
    ref = spark.createDataFrame(
        [(1, "g1", "Sector", "A", "ab", "Yes"), (2, "g2", "Sector", "B", "cd", "Yes"), (3, "g3", "Current Issues", "C", "b", "Yes"),
         (4, "g4", "Finance", "X", "a", "No")], REF_TAGS)
    arts = spark.createDataFrame([(1, "t", "abcd", "s"), (2, "t", "zz", "s"), (3, "t", "cd b", None)], ART)
    cols = tag_articles(arts, ref).columns
    a = sorted(map(tuple, tag_articles(arts, ref, strategy="inline").collect()))
    b = sorted(map(tuple, tag_articles(arts, ref, strategy="automaton").select(*cols).collect()))
    c = sorted(map(tuple, tag_articles(arts, ref, strategy="kgram", kgram=2).select(*cols).collect()))
    assert a == b == c


def test_kgram_strategy_matches_inline_on_documents(spark):
    from newsflow.plans import fixtures as fx

    arts = fx.articles(spark, "/root/testdata/sf0.001")
    cols = tag_articles(arts, fx.ref_tags(spark)).columns
    a = sorted(map(tuple, tag_articles(arts, fx.ref_tags(spark)).collect()))
    for k in (3, 5):  # k=5 routes the 4-letter phrases through the short-phrase path
        b = sorted(map(tuple, tag_articles(arts, fx.ref_tags(spark), strategy="kgram", kgram=k).select(*cols).collect()))
        assert a == b


def test_tag_score_counts_categories(spark):
    from newsflow.plans import fixtures as fx

    t = tag_articles(fx.articles(spark, "/root/testdata/sf0.001"), fx.ref_tags(spark))
    n = sum((F.col(c).isNotNull().cast("int") for _, c in SCORED_CATEGORIES), F.lit(0))
    bad = t.where(F.coalesce(F.col("tag_score"), F.lit(0)) != n).count()
    assert bad == 0


def test_tagger_idempotent(spark):
    from newsflow.plans import fixtures as fx

    arts = fx.articles(spark, "/root/testdata/sf0.001")
    once = tag_articles(arts, fx.ref_tags(spark), cap=500)
    twice = tag_articles(once.select(*arts.columns), fx.ref_tags(spark), cap=500)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_keep_first_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, None)], "n int, doi string")
    assert keep_first(df, ["doi"], ["n"]).count() == 2
    assert keep_first(df, ["doi"], ["n"], keep_null_keys=True).count() == 3
    assert sorted(r.n for r in keep_first(df, ["doi"], ["n"]).collect()) == [1, 2]


def test_keep_first_hot_key(spark):
    # a third of all rows share one key
    df = spark.range(3000).select((F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))).alias("k"), F.col("id").alias("v"))
    out = {r.k: r.v for r in keep_first(df, ["k"], ["v"]).collect()}
    assert out[-1] == 0 and len(out) == 2001


def test_null_guid_collapse_and_profile_match(spark):
    longs = spark.createDataFrame([(1, "Sector", 0, 0, "p"), (1, "Sector", 0, 1, "q")], "content_id bigint, tag_cat string, cat_rank int, pos int, tag string")
    ref = spark.createDataFrame([(1, "g1", "Sector", "other", "x", "Yes")], REF_TAGS)
    g = attach_guid(longs, ref)
    assert g.count() == 1 and g.first()["tag"] == "p"  # Q4
    prof = spark.createDataFrame([("Orphans", None), ("House", "g1")], "cost_center string, tag_guid string")
    assert attach_programmes(g, prof, match_null_keys=True).first()["cost_center"] == "Orphans"
    assert attach_programmes(g, prof, match_null_keys=False).first()["cost_center"] == ""


def test_profile_filter_keeps_null(spark):
    prof = spark.createDataFrame([(None, "a"), ("House", "b"), ("x", "c")], "cost_center string, tag_guid string")
    assert sorted((r.tag_guid for r in active_profiles(prof, ["House"]).collect())) == ["a", "c"]


def test_rollup_skips_nulls(spark):
    rows = spark.createDataFrame([(1, "Finance"), (1, ""), (1, "Finance"), (1, "Markets"), (2, "")], "content_id bigint, cost_center string")
    out = {r.content_id: r.profiles for r in rollup_programmes(rows, []).collect()}
    assert out == {1: "Finance, Markets"}


def test_cooccurrence(spark):
    ref = spark.createDataFrame([(1, "g1", "Emissions", "S", "s", "Yes"), (2, "g2", "Current Issues", "I", "i", "Yes")], REF_TAGS)
    prof = spark.createDataFrame([("P", "g1"), ("P", "g2")], "cost_center string, tag_guid string")
    ct = spark.createDataFrame([(1, "S"), (1, "I"), (2, "S"), (3, "I")], "content_id bigint, tag string")
    flags = content_flags(ct, ref, prof, "P")
    assert [r.content_id for r in cooccurrence_ids(flags).collect()] == [1]
    assert sorted(r.content_id for r in subject_ids(flags).collect()) == [1, 2]


def test_update_by_key_matched_null_overwrites(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    u = spark.createDataFrame([(1, None), (9, "z")], "id bigint, v string")
    assert sorted(map(tuple, update_by_key(t, u, "id", ["v"]).collect())) == [(1, None), (2, "b")]


def test_load_twice_inserts_nothing(spark):
    existing = spark.createDataFrame([(1, "A title")], "id bigint, title string")
    incoming = spark.createDataFrame([(2, "a TITLE"), (3, "New")], "id bigint, title string")
    first = new_rows(incoming, existing, ["title"], case_insensitive=True)
    assert [r.id for r in first.collect()] == [3]
    assert new_rows(first, existing.unionByName(first), ["title"], case_insensitive=True).count() == 0


def test_unpivot_pivot_round_trip(spark):
    from newsflow.plans import fixtures as fx
    from newsflow.schemas import CATEGORY_COLUMNS, COLUMN_TO_CATEGORY

    t = tag_articles(fx.articles(spark, "/root/testdata/sf0.001"), fx.ref_tags(spark)).where("tag_concat is not null")
    longs = to_long(t)
    sets = longs.groupBy("content_id").pivot("tag_cat", [COLUMN_TO_CATEGORY[c] for c in CATEGORY_COLUMNS]).agg(F.collect_list("tag"))
    back = sets.select(
        "content_id",
        *[F.nullif(F.array_join(F.sort_array(F.col(f"`{COLUMN_TO_CATEGORY[c]}`")), ","), F.lit("")).alias(c) for c in CATEGORY_COLUMNS],
    )
    a = sorted(map(tuple, t.select(F.col("id").alias("content_id"), *CATEGORY_COLUMNS).collect()))
    b = sorted(map(tuple, back.select("content_id", *CATEGORY_COLUMNS).collect()))
    assert a == b


def test_phrases_with_quotes_and_backslashes(spark):
    ref = spark.createDataFrame(
        [(1, "g1", "Sector", "O'Neil \\ Co", "o'neil", "Yes"), (2, "g2", "Policy", "Path", "a\\b", "Yes"), (3, "g3", "Finance", "Pct", "50%", "Yes")],
        REF_TAGS,
    )
    arts = spark.createDataFrame([(1, "t", "Met O'Neil at a\\b for 50%", "s"), (2, "t", "nothing", "s")], ART)
    rows = {r.id: r for r in tag_articles(arts, ref, cap=100).collect()}
    assert (rows[1].sector, rows[1].policy, rows[1].finance) == ("O'Neil \\ Co", "Path", "Pct")
    assert rows[2].tag_concat is None


def test_select_programme_matches_queries(spark):
    import __spark_entry__ as E
    from newsflow.plans import q_select as Q
    from newsflow.plans.selection import select_programme
    from newsflow.schemas import ALL_CATEGORY_COLUMNS

    sf = "/root/testdata/sf0.001"
    content = Q._content(spark, sf)
    full = tag_articles(fx_articles(spark, sf), fx_ref(spark)).where(F.col("tag_concat").isNotNull() | F.col("current_issues").isNotNull())
    ct = to_long(full, categories=ALL_CATEGORY_COLUMNS).select("content_id", "tag")
    sel = select_programme(content, ct, fx_ref(spark), fx_prof(spark), Q.PROGRAMME, "2024-07-01")
    q = E.queries()
    assert sorted(map(tuple, sel.cooccurrence_report.collect())) == sorted(map(tuple, q["cooccurrence_report"](spark, sf).collect()))
    assert sorted(map(tuple, sel.recent_subject_report.collect())) == sorted(map(tuple, q["recent_subject_report"](spark, sf).collect()))


def fx_articles(spark, sf):
    from newsflow.plans import fixtures as fx

    return fx.articles(spark, sf)


def fx_ref(spark):
    from newsflow.plans import fixtures as fx

    return fx.ref_tags(spark)


def fx_prof(spark):
    from newsflow.plans import fixtures as fx

    return fx.profiles(spark)


def test_selector_null_guid_profile_counts_as_subject(spark):
    # Q8: the programme's null-guid profile row gets a null category, counts as a
    # subject tag and matches content tags that resolved to no guid
    ref = spark.createDataFrame([(1, "g2", "Current Issues", "I", "i", "Yes")], REF_TAGS)
    prof = spark.createDataFrame([("P", None), ("P", "g2")], "cost_center string, tag_guid string")
    ct = spark.createDataFrame([(1, "Unknown"), (1, "I"), (2, "Unknown"), (3, "I")], "content_id bigint, tag string")
    flags = content_flags(ct, ref, prof, "P")
    assert [r.content_id for r in cooccurrence_ids(flags).collect()] == [1]
    assert sorted(r.content_id for r in subject_ids(flags).collect()) == [1, 2]


def test_same_tag_in_two_categories_fans_out(spark):
    # Q5: one tag name under two categories has two guids → one row per guid survives D3
    ref = spark.createDataFrame(
        [(1, "g1", "Sector", "Grid", "grid", "Yes"), (2, "g1", "Sector", "Grid", "power grid", "Yes"), (3, "g2", "Technology", "Grid", "grids", "Yes")],
        REF_TAGS,
    )
    longs = spark.createDataFrame([(1, "Sector", 0, 0, "Grid")], "content_id bigint, tag_cat string, cat_rank int, pos int, tag string")
    got = sorted((r.tag_cat, r.tag_guid) for r in attach_guid(longs, ref).collect())
    assert got == [("Sector", "g1"), ("Technology", "g2")]


def test_auto_switches_to_kgram_and_many_short_phrases(spark, monkeypatch):
    import newsflow.operators.tagging as T
    from newsflow.plans import fixtures as fx

    arts = fx.articles(spark, "/root/testdata/sf0.001")
    ref = fx.ref_tags(spark)
    want = sorted(map(tuple, tag_articles(arts, ref).collect()))
    cols = tag_articles(arts, ref).columns
    monkeypatch.setattr(T, "MAX_INLINE_PHRASES", 1)
    monkeypatch.setattr(T, "_DICTIONARIES", __import__("weakref").WeakKeyDictionary())
    auto = sorted(map(tuple, T.tag_articles(arts, ref).select(*cols).collect()))  # too big to inline → kgram
    short = sorted(map(tuple, T.tag_articles(arts, ref, strategy="kgram", kgram=5).select(*cols).collect()))  # >1 short → broadcast
    assert auto == want and short == want


def test_retag_falls_back_for_large_dictionaries(spark, monkeypatch):
    import newsflow.operators.tagging as T
    from newsflow.operators.maintenance import RETAG_COLUMNS, retag
    from newsflow.plans import fixtures as fx

    arts = fx.articles(spark, "/root/testdata/sf0.001")
    old = tag_articles(arts, fx.ref_tags(spark).where("ref_seq <= 12"))
    want = sorted(map(tuple, retag(old, fx.ref_tags(spark), "2024-03-01").select("id", *RETAG_COLUMNS).collect()))
    monkeypatch.setattr(T, "MAX_INLINE_PHRASES", 1)
    monkeypatch.setattr(T, "_DICTIONARIES", __import__("weakref").WeakKeyDictionary())
    got = sorted(map(tuple, retag(old, fx.ref_tags(spark), "2024-03-01").select("id", *RETAG_COLUMNS).collect()))
    assert got == want


def test_anti_join_hot_key_without_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        incoming = spark.range(3000).select(
            F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("title")
        )
        existing = spark.createDataFrame([("hot",), ("t1",)], "title string")
        out = new_rows(incoming, existing, ["title"], case_insensitive=True)
        assert out.count() == 3000 - 1000 - 1 and out.where("title = 'HOT'").count() == 0
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
