"""The streaming wrapper reproduces the batch compile on landed files."""

from pyspark.sql import functions as F

from newsflow.plans import fixtures as fx
from newsflow.plans.daily import compile_new_articles
from newsflow.streaming.landing import landing_stream, start_daily_stream


def test_stream_matches_batch(spark, tmp_path):
    arts = fx.articles(spark, "/root/testdata/sf0.001")
    incoming = arts.where(F.col("id") % 2 == 1)
    content = arts.where(F.col("id") % 2 == 0)
    landing = str(tmp_path / "landing")
    incoming.write.parquet(landing)

    out = str(tmp_path / "out")
    stream = landing_stream(spark, landing, incoming.schema)
    q = start_daily_stream(
        spark, stream, content, fx.ref_tags(spark), out, order=["id"], keep=["id"], checkpoint=str(tmp_path / "ckpt")
    )
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    want = compile_new_articles(incoming, content, fx.ref_tags(spark), order=["id"], keep=["id"])
    assert got.count() == want.count() > 0
    assert sorted(r.id for r in got.select("id").collect()) == sorted(r.id for r in want.select("id").collect())

    # a second run over the same landing directory consumes nothing new
    q2 = start_daily_stream(
        spark, landing_stream(spark, landing, incoming.schema), content, fx.ref_tags(spark), out,
        order=["id"], keep=["id"], checkpoint=str(tmp_path / "ckpt"),
    )
    q2.awaitTermination(300)
    assert spark.read.parquet(out).count() == want.count()


def test_run_daily_writes_consistent_ids(spark, tmp_path):
    from newsflow.operators.tagging import tag_articles
    from newsflow.plans.daily import run_daily

    arts = fx.articles(spark, "/root/testdata/sf0.001")
    content = tag_articles(arts.where(F.col("id") % 2 == 0), fx.ref_tags(spark))
    content.write.parquet(str(tmp_path / "content"))
    spark.createDataFrame([], "content_id bigint, tag_cat string, tag string, tag_guid string, cost_center string").write.parquet(
        str(tmp_path / "tags")
    )
    incoming = arts.where(F.col("id") % 2 == 1).withColumnRenamed("id", "src_id")
    res = run_daily(incoming, str(tmp_path / "content"), str(tmp_path / "tags"), str(tmp_path / "staging"),
                    fx.ref_tags(spark), fx.profiles(spark), order=["src_id"])
    new = res.new_articles
    n_new = new.count()
    assert n_new > 0 and new.select("id").distinct().count() == n_new
    assert new.agg(F.min("id")).first()[0] > content.agg(F.max("id")).first()[0]
    tags = spark.read.parquet(str(tmp_path / "tags"))
    assert tags.count() > 0
    stored = spark.read.parquet(str(tmp_path / "content"))
    assert tags.join(stored, tags.content_id == stored.id, "left_anti").count() == 0  # every tag row points at a stored article
    assert stored.where("tag_concat is not null").join(tags, stored.id == tags.content_id, "left_anti").count() == 0
    assert stored.count() == content.count() + n_new
    assert res.profile_updates.count() > 0


def test_run_daily_makes_up_for_a_stop_before_the_tags(spark, tmp_path):
    """Stopped after the content append: the next run finds no new title but writes the missing tag rows."""
    from newsflow.operators.tagging import tag_articles
    from newsflow.plans.daily import run_daily

    arts = fx.articles(spark, "/root/testdata/sf0.001")
    ddl = "content_id bigint, tag_cat string, tag string, tag_guid string, cost_center string"
    tables = {}
    for name in ("whole", "stopped"):
        path = lambda t, name=name: str(tmp_path / name / t)
        tag_articles(arts.where(F.col("id") % 2 == 0), fx.ref_tags(spark)).write.parquet(path("content"))
        spark.createDataFrame([], ddl).write.parquet(path("tags"))
        incoming = arts.where(F.col("id") % 2 == 1).withColumnRenamed("id", "src_id")
        args = (incoming, path("content"), path("tags"), path("staging"), fx.ref_tags(spark), fx.profiles(spark))
        run_daily(*args, order=["src_id"])
        if name == "stopped":
            spark.createDataFrame([], ddl).write.mode("overwrite").parquet(path("tags"))
            run_daily(*args, order=["src_id"])
        tables[name] = sorted(map(str, spark.read.parquet(path("tags")).collect()))
    assert tables["whole"] == tables["stopped"] != []


def test_stream_dedups_titles_within_watermark(spark, tmp_path):
    import json

    from newsflow.streaming.landing import dedup_titles_within

    landing = tmp_path / "json"
    landing.mkdir()
    rows = [{"id": 1, "title": "Grid news", "description": "a", "source": "s"},
            {"id": 2, "title": "GRID NEWS", "description": "b", "source": "s"},
            {"id": 3, "title": "Other", "description": "c", "source": "s"}]
    for i, r in enumerate(rows):
        (landing / f"f{i}.json").write_text(json.dumps(r))
    schema = "id long, title string, description string, source string"
    stream = dedup_titles_within(landing_stream(spark, str(landing), schema, fmt="json"), "1 hour")
    out = str(tmp_path / "out")
    content = spark.createDataFrame([], "title string")
    q = start_daily_stream(spark, stream, content, fx.ref_tags(spark), out, order=["id"], keep=["id"], checkpoint=str(tmp_path / "ck"))
    q.awaitTermination(300)
    titles = sorted(r.title.lower() for r in spark.read.parquet(out).collect())
    assert titles == ["grid news", "other"]


def test_assign_ids_independent_of_input_partitioning(spark):
    from newsflow.plans.daily import assign_ids

    arts = fx.articles(spark, "/root/testdata/sf0.001").dropDuplicates(["title"]).drop("id")
    content = spark.createDataFrame([(41,)], "id long")
    a = {r.title: r.id for r in assign_ids(arts.repartition(3), content).collect()}
    b = {r.title: r.id for r in assign_ids(arts.repartition(7).orderBy(F.rand(5)), content).collect()}
    assert a == b and len(set(a.values())) == len(a) and min(a.values()) > 41
