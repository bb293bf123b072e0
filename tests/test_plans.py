"""Physical-plan properties the operators are designed for."""

from pyspark.sql import functions as F

from newsflow.operators.dedup import keep_first
from newsflow.operators.tagging import tag_articles
from newsflow.plans import fixtures as fx


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_slice_predicates_reach_the_scan(spark, tmp_path):
    arts = fx.articles(spark, "/root/testdata/sf0.001").withColumn("tag_score", (F.col("id") % 3).cast("int"))
    arts.write.partitionBy("source").parquet(str(tmp_path / "content"))
    c = spark.read.parquet(str(tmp_path / "content"))
    s = c.where(F.col("tag_score").isNotNull() & (F.col("pubDate") > F.lit("2024-03-01").cast("date"))).select("id", "title")
    p = plan(s)
    assert "PushedFilters: [IsNotNull(tag_score), IsNotNull(pubDate), GreaterThan(pubDate,2024-03-01)]" in p or (
        "GreaterThan(pubDate,2024-03-01)" in p and "IsNotNull(tag_score)" in p
    )
    assert "ReadSchema: struct<id:bigint,title:string,pubDate:date,tag_score:int>" in p
    q = plan(c.where(F.col("source") == "src3").select("id"))
    assert "PartitionFilters: [isnotnull(source" in q and "(source" in q


def test_tagging_is_narrow(spark):
    t = tag_articles(fx.articles(spark, "/root/testdata/sf0.001"), fx.ref_tags(spark)).where(F.col("tag_concat").isNotNull())
    t.collect()
    p = plan(t)
    main = p.split("Subquery")[0]
    assert "NestedLoopJoin" not in p and "HashJoin" not in main and "SortMergeJoin" not in main
    assert "hashpartitioning" not in main  # only the optional round-robin spread before the Generate
    assert "Generate inline" in main


def test_keep_first_combines_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    out = keep_first(df, ["k"], ["v"])
    out.collect()
    p = plan(out)
    assert "partial_min" in p and p.index("Exchange hashpartitioning") < p.index("partial_min")


def test_ensure_parallelism_leaves_shuffled_inputs_alone(spark):
    from newsflow.operators.partitioning import ensure_parallelism

    scan = fx.table(spark, "/root/testdata/sf0.001", "documents")
    spread = ensure_parallelism(scan, 4)
    assert spread.rdd.getNumPartitions() == 4
    agg = scan.groupBy("source").count()
    sc = spark.sparkContext
    sc.setJobGroup("ensure-par-check", "x")
    assert ensure_parallelism(agg, 10_000) is agg
    assert list(sc.statusTracker().getJobIdsForGroup("ensure-par-check")) == []  # nothing executed


def test_payload_tasks_grow_with_the_table(spark, tmp_path, monkeypatch):
    """The map-side combine sorts its task's records: a task gets a bounded number of rows, also of repeated and null ones."""
    from newsflow.plans import q_sources as Q

    n = F.col("id")
    unlike = F.when(n >= 2000, n)  # half of the rows are alike
    spark.range(4000).select(
        F.when(n < 1000, F.lit(7)).otherwise(unlike).alias("o_orderkey"),
        (unlike % 50).alias("o_custkey"),
        F.when(n >= 2000, F.element_at(F.array(F.lit("F"), F.lit("O"), F.lit("P")), (n % 3 + 1).cast("int"))).alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"),
        F.when(n % 40 != 39, F.to_timestamp_ntz(F.lit("1998-02-06 00:00:00"))).alias("o_orderdate"),
        F.lit("5-LOW").alias("o_orderpriority"),
    ).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")

    def most(df) -> int:
        return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

    def rows(df) -> list:
        return sorted(map(repr, df.collect()))

    got = {}
    for bound in (100, 10**9):
        monkeypatch.setattr(Q, "PAYLOAD_ROWS", bound, raising=False)
        got[bound] = rows(Q.q_json_records(spark, str(tmp_path))), rows(Q.q_scopus_flatten(spark, str(tmp_path)))
        if bound == 100:
            assert most(Q._records_payloads(spark, str(tmp_path))) <= 200
            assert most(Q._scopus_items(spark, str(tmp_path))) <= 200
    assert got[100] == got[10**9] and all(got[100])


def test_bound_task_rows_leaves_enough_tasks_alone(spark, tmp_path):
    from newsflow.operators.partitioning import bound_task_rows

    spark.range(1000).write.parquet(f"{tmp_path}/few")
    dealt = bound_task_rows(spark.read.parquet(f"{tmp_path}/few"), 10)
    assert dealt.columns == ["id"] and dealt.rdd.getNumPartitions() == 100
    assert sorted(r.id for r in dealt.collect()) == list(range(1000))
    enough = spark.range(1000, numPartitions=64)
    assert bound_task_rows(enough, 100) is enough


def test_card_tags_are_not_dealt_by_tag(spark, tmp_path):
    """All rows have one tag: the join leaves them in their tasks, which hold a bounded number of pages."""
    from newsflow.plans import q_sources as Q

    n = F.col("id")
    spark.range(3000).select(
        n.alias("event_id"), (n % 9).alias("user_id"), F.lit("click").alias("event_type"), F.lit(1.5).alias("value"),
        F.to_timestamp_ntz(F.lit("2024-01-02 03:04:05")).alias("ts"), F.lit('{"k": 1}').alias("props"),
    ).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    assert Q.card_pages(spark, str(tmp_path), max_rows=100).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] <= 200
    tags = Q.q_card_tags(spark, str(tmp_path))
    assert "SortMergeJoin" not in plan(tags) and "BroadcastHashJoin" in plan(tags)
    want = sorted([(f"Card {k}", "Water", "g05") for k in range(9)] + [(f"Brief {k}", "Water", "g05") for k in range(50)])
    assert sorted(map(tuple, tags.collect())) == want


#: No side can be broadcast, and small partitions count as skewed: the shape of a large run.
SKEW = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def test_daily_compile_splits_a_hot_title_and_tags_only_new_articles(spark):
    """80 % of the rows have one title: its partition is split in the anti join, and matching stands above the dedup."""
    from newsflow.plans.daily import compile_new_articles

    old = {k: spark.conf.get(k, None) for k in SKEW}
    try:
        for k, v in SKEW.items():
            spark.conf.set(k, v)
        body = F.concat(F.sha2(F.col("id").cast("string"), 256), F.lit(" solar"))
        incoming = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 5 > 0, " Hot ").otherwise(F.col("id").cast("string")).alias("title"), body.alias("description"), F.lit("s").alias("source"), F.col("id").alias("seq"))
        stored = spark.range(0, 20_000, 1, 4).select(F.col("id").cast("string").alias("title"))
        df = compile_new_articles(incoming, stored, fx.ref_tags(spark), order=["seq"])
        rows = df.collect()
        assert len(rows) == 12_000 - 4_000 + 1
        assert [r.description for r in rows if r.title == "Hot"] == [spark.range(1, 2).select(body.alias("b")).first().b]
        p = plan(df)
        assert "skew=true" in p
        assert p.index("Generate inline") < p.index("LeftAnti")  # printed from the top down
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_title_is_split_in_the_anti_join(spark):
    """80 % of the rows have one title: AQE splits its partition, which an aggregate on the stored side would prevent."""
    from newsflow.operators.load import new_rows

    old = {k: spark.conf.get(k, None) for k in SKEW}
    try:
        for k, v in SKEW.items():
            spark.conf.set(k, v)
        incoming = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 5 > 0, "hot").otherwise(F.col("id").cast("string")).alias("title"), F.sha2(F.col("id").cast("string"), 256).alias("body"))
        stored = spark.range(0, 20_000, 1, 4).select(F.col("id").cast("string").alias("title"))
        df = new_rows(incoming, stored, ["title"], case_insensitive=True)
        assert len(df.collect()) == 60_000 - 4_000
        assert "skew=true" in plan(df)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_kgram_filters_grams_before_shuffling(spark):
    import re

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        t = tag_articles(fx.articles(spark, "/root/testdata/sf0.001"), fx.ref_tags(spark), strategy="kgram")
        t.collect()
        p = plan(t).split("Subquery")[0]
        # the vocabulary semi join is a broadcast (explicit, size-checked) – not a shuffle of every text gram
        assert re.search(r"BroadcastHashJoin .*LeftSemi", plan(t))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
