import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsflow.operators import monthly
from newsflow.operators.cap_state import CapState
from newsflow.operators.cooccurrence import report
from newsflow.operators.load import missing_from_backup as by_join
from newsflow.operators.load import restore_range
from newsflow.operators.reconcile import DigestedTable, missing_from_backup, reconcile
from newsflow.operators.tagging import char_limit_frame, with_description_fallback
from newsflow.plans import fixtures as fx
from newsflow.plans.daily import compile_new_articles, stored_titles
from newsflow.streaming.landing import landing_stream, start_cap_stream, start_daily_stream

SF = "/root/testdata/sf0.001"
ARTICLE = "id long, title string, description string, source string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---------------------------------------------------------------- cap state


def test_epochs_merge_to_the_cap_of_all(spark, tmp_path):
    data = [(1, "t", "four", "a"), (2, "title", None, "a"), (3, None, None, "b"), (4, "x", "y" * 90, None), (5, "q", "z" * 11, "c"), (6, "q", "", "c")]
    a = spark.createDataFrame(data, ARTICLE)
    state = CapState(spark, f"file://{tmp_path}/s")
    assert rows(state.frame()) == [(None, 0)] and state.fixed() is None
    for epoch in (0, 1, 0):
        state.add(a.where(F.col("id") % 2 == epoch), epoch)
    want = rows(char_limit_frame(with_description_fallback(a)))
    assert rows(state.frame()) == want == [(5, 3)]  # means 4.5, none and 5.5
    assert rows(state.compact(f"file://{tmp_path}/c").frame()) == want
    state.add(a.where("false"), 2)
    assert rows(state.frame()) == want and rows(state.frame(0)) == [(2, 2)]  # means 5 and 0


def test_triggers_don_t_matter(spark, tmp_path):
    arts = fx.articles(spark, SF)
    incoming, content = arts.where(F.col("id") % 2 == 1), arts.where(F.col("id") % 2 == 0)
    landing = str(tmp_path / "landing")
    incoming.repartition(10, "id").write.parquet(landing)
    n_files = len(list((tmp_path / "landing").glob("*.parquet")))
    want = None
    for triggers in (1, 3, 10):
        path = lambda t, n=triggers: str(tmp_path / f"run{n}" / t)
        stream = lambda n=triggers: landing_stream(spark, landing, incoming.schema, max_files_per_trigger=-(-n_files // n))
        state = CapState(spark, path("caps"))
        start_cap_stream(spark, stream(), state, checkpoint=path("ckpt-caps")).awaitTermination(300)
        index = stored_titles(spark, f"stored_titles_{triggers}", f"file://{path('index')}", content, buckets=4)
        start_daily_stream(spark, stream(), content, fx.ref_tags(spark), path("out"), order=["id"], keep=["id"], checkpoint=path("ckpt"),
                           cap_state=state, index=index).awaitTermination(300)
        out = spark.read.parquet(path("out"))
        assert out.select("epoch").distinct().count() == min(triggers, n_files)
        got = rows(out.select("title", "tag_concat", "tag_score"))
        want = want or rows(compile_new_articles(incoming, content, fx.ref_tags(spark), order=["id"], keep=["id"]).select("title", "tag_concat", "tag_score"))
        assert got == want and any(r[1] for r in got)
        assert rows(state.frame()) == rows(char_limit_frame(with_description_fallback(incoming)))


def test_a_later_batch_finds_titles_of_an_earlier_one(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    content = spark.createDataFrame([("Stored",)], "title string")
    index = stored_titles(spark, "stored_titles_later", f"file://{tmp_path}/index", content, buckets=2)

    def run(data):
        spark.createDataFrame(data, ARTICLE).coalesce(1).write.mode("append").parquet(str(landing))
        stream = landing_stream(spark, str(landing), spark.createDataFrame([], ARTICLE).schema)
        start_daily_stream(spark, stream, content, fx.ref_tags(spark), out, order=["id"], keep=["id"], checkpoint=str(tmp_path / "ck"), cap=100, index=index).awaitTermination(300)
        return sorted(r.id for r in spark.read.parquet(out).collect())

    assert run([(1, "One", "a", "s"), (2, "STORED", "b", "s"), (3, None, "c", "s")]) == [1]
    assert run([(4, "one ", "a", "s"), (5, "Two", "b", "s"), (6, "stored", "b", "s")]) == [1, 5]


# ---------------------------------------------------------------- reconciliation


def pair(spark, tmp_path, current, backup, buckets):
    out = []
    for name, df in (("current", current), ("backup", backup)):
        t = DigestedTable(spark, f"file://{tmp_path}/{name}", "id", buckets)
        t.table.overwrite(df)
        out.append(t)
    return out


def test_one_bucket_of_many_is_read(spark, tmp_path):
    o = fx.table(spark, SF, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("date_added"))
    gone = o.agg(F.min("id")).first()[0]
    mine, theirs = pair(spark, tmp_path, o, o.where(F.col("id") != gone), 1024)
    found = reconcile(mine, theirs)
    assert len(found.buckets) == 1 and found.of == 1024 and found.rows == 2 * o.count() - 1
    assert found.rows_read < 40 and rows(found.missing.select("id")) == [(gone,)]
    assert {f.rsplit("_bucket=")[1].split("/")[0] for f in found.missing.inputFiles()} == {str(found.buckets[0])}
    assert rows(found.extra) == rows(found.changed) == []
    late = F.lit("2100-01-01").cast("timestamp")
    assert rows(missing_from_backup(found, "id", "date_added", late)) == rows(by_join(o, theirs.table.read(), "id", "date_added", late))


def test_kinds_of_differences(spark, tmp_path):
    ddl = "id long, a string, b string"
    left = [(1, "x", None), (2, None, "x"), (3, "s", "t"), (4, "r", "r"), (4, "r", "r"), (None, "n", "n"), (7, "only", "here")]
    right = [(1, "x", None), (2, "x", None), (3, "s", "t"), (4, "r", "r"), (None, "n", "m"), (8, "only", "there")]
    mine, theirs = pair(spark, tmp_path, spark.createDataFrame(left, ddl), spark.createDataFrame(right, ddl), 8)
    found = reconcile(mine, theirs)
    assert rows(found.missing) == [(7, "only", "here")] and rows(found.extra) == [(8, "only", "there")]
    assert rows(found.changed) == sorted([(2,), (4,), (None,)], key=str)
    theirs.table.overwrite(mine.table.read().select("b", "id", "a"))  # columns in another order
    same = reconcile(mine, theirs)
    assert same.buckets == [] and same.rows_read == 0 and rows(same.missing) == rows(same.changed) == []


def test_digests_follow_versions(spark, tmp_path):
    ddl = "id long, a string"
    data = [(k, f"v{k}") for k in range(60)]
    mine, theirs = pair(spark, tmp_path, spark.createDataFrame(data, ddl), spark.createDataFrame(data, ddl), 16)
    before = rows(mine.digests())
    mine.table.upsert(spark.createDataFrame([(5, "other")], ddl))
    after = rows(mine.digests())  # from the touched bucket and the digests before
    assert len(set(before) - set(after)) == 1 and len(before) == len(after)
    assert rows(reconcile(mine, theirs).changed) == [(5,)]
    fresh = DigestedTable(spark, f"file://{tmp_path}/fresh", "id", 16)
    fresh.table.overwrite(mine.table.read())
    assert rows(fresh.digests()) == after and rows(mine.digests(0)) == before


def test_empty_sides_and_unlike_tables(spark, tmp_path):
    ddl = "id long, a string"
    some, none = spark.createDataFrame([(1, "a")], ddl), spark.createDataFrame([], ddl)
    mine, theirs = pair(spark, tmp_path, some, none, 4)
    assert rows(reconcile(mine, theirs).missing) == [(1, "a")] and rows(reconcile(theirs, mine).extra) == [(1, "a")]
    assert reconcile(theirs, theirs).rows == 0
    theirs.table.overwrite(some.withColumn("b", F.lit(1)))
    with pytest.raises(ValueError):
        reconcile(mine, theirs)


# ---------------------------------------------------------------- content by month

DATED = [(1, "2024-01-31", "a"), (2, "2024-02-01", "b"), (3, "2024-02-10", "c"), (4, "2024-02-11", "d"), (5, "2024-03-01", "e"), (6, None, "f"), (7, "2023-12-31", "g")]


def dated(spark, data):
    return spark.createDataFrame(data, "id long, day string, v string").withColumn("day", F.to_date("day"))


def months_read(df):
    return {f.split(f"{monthly.MONTH}=")[1].split("/")[0] for f in df.inputFiles()}


@pytest.fixture
def by_month(spark, tmp_path):
    path = f"file://{tmp_path}/m"
    monthly.write_monthly(dated(spark, DATED), path, "day")
    return path


def files(tmp_path):
    return {str(f): f.stat().st_mtime_ns for f in tmp_path.glob("m/*/*.parquet")}


def test_windows_read_their_months(spark, by_month):
    content = monthly.read_monthly(spark, by_month)
    late = monthly.since(content, "day", "2024-02-10")
    assert rows(late.select("id")) == [(4,), (5,)] and "PartitionFilters: [isnotnull(_month" in late._jdf.queryExecution().executedPlan().toString()
    assert rows(monthly.before(content, "day", dt.date(2024, 2, 1)).select("id")) == [(1,), (7,)]
    with pytest.raises((TypeError, ValueError)):
        monthly.since(content, "day", dt.datetime(2024, 2, 1, 5))


def test_a_report_reads_the_months_of_its_ids(spark, tmp_path, by_month):
    content = monthly.read_monthly(spark, by_month)
    monthly.write_months(content, f"{by_month}-months")
    months = spark.read.parquet(f"{by_month}-months")
    described = content.withColumn("description", F.col("v"))
    for wanted, read in (([1, 6, 99], {"2024-01-01", "__HIVE_DEFAULT_PARTITION__"}), ([3, 3], {"2024-02-01"}), ([], set())):
        ids = spark.createDataFrame([(i,) for i in wanted], "content_id long")
        got = monthly.report_by_months(described, ids, months, columns=["id", "description"])
        assert rows(got) == rows(report(described, ids, ["id", "description"]))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert all(m in plan for m in read if m[0] == "2")


def test_a_restore_leaves_later_months(spark, tmp_path, by_month):
    before = files(tmp_path)
    backup = dated(spark, [(2, "2024-02-01", "B"), (8, "2023-11-05", "B"), (9, "2024-03-05", "B"), (6, None, "B")])
    want = rows(restore_range(dated(spark, DATED), backup, "day", dt.date(2024, 2, 11)))
    replaced = monthly.restore_months(spark, by_month, backup, "day", "2024-02-11", f"{by_month}-staging")
    assert [str(d) for d in replaced] == ["2023-11-01", "2023-12-01", "2024-01-01", "2024-02-01"]
    assert rows(monthly.read_monthly(spark, by_month).drop(monthly.MONTH)) == want
    after = files(tmp_path)
    untouched = [f for f in before if "2024-03" in f or "HIVE" in f]
    assert len(untouched) == 2 and all(after[f] == before[f] for f in untouched) and not any("2024-01" in f for f in after)
    assert not (tmp_path / "m-staging").exists()


def test_a_restore_that_died_while_it_replaced_months(spark, tmp_path, by_month, monkeypatch):
    backup = dated(spark, [(2, "2024-02-01", "B")])
    want = rows(restore_range(dated(spark, DATED), backup, "day", dt.date(2024, 2, 11)))
    args = (spark, by_month, backup, "day", "2024-02-11", f"{by_month}-staging")

    def dies(*_):
        for f in tmp_path.glob("m/_month=2024-02-01/*.parquet"):
            f.unlink()  # the month is gone, its new files aren't there yet
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(monthly, "_publish_months", dies)
        with pytest.raises(RuntimeError):
            monthly.restore_months(*args)
    monthly.restore_months(*args)
    assert rows(monthly.read_monthly(spark, by_month).drop(monthly.MONTH)) == want


def test_an_empty_monthly_table(spark, tmp_path):
    empty = dated(spark, DATED).where("false")
    monthly.write_monthly(empty, f"file://{tmp_path}/e", "day")
    got = monthly.read_monthly(spark, f"file://{tmp_path}/e", empty.schema)
    assert got.columns == ["id", "day", "v", "_month"] and monthly.since(got, "day", "2024-01-01").count() == 0
