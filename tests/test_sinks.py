"""Sinks, metrics and small helpers."""

from pyspark.sql import functions as F

from newsflow.operators.load import restore_range, upsert, write_snapshot
from newsflow.operators.metrics import observed, preview, sample_rows
from newsflow.sources.readers import require_columns


def test_snapshot_partitioned_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "s1"), (2, "b", "s2"), (3, "c", "s1")], "id long, title string, source string")
    path = str(tmp_path / "extract")
    write_snapshot(df, path, partition_by=["source"])
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.select("id", "title", "source").collect())) == sorted(map(tuple, df.collect()))
    write_snapshot(df.limit(1), path, partition_by=["source"], mode="append")
    assert spark.read.parquet(path).count() == 4


def test_upsert_inserts_and_updates(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    u = spark.createDataFrame([(2, "B"), (3, "c")], "id long, v string")
    assert sorted(map(tuple, upsert(t, u, "id").collect())) == [(1, "a"), (2, "B"), (3, "c")]


def test_restore_keeps_null_dates(spark):
    cur = spark.createDataFrame([(1, "2020-01-01"), (2, None), (3, "2024-01-01")], "id long, d string").withColumn("d", F.col("d").cast("date"))
    bak = spark.createDataFrame([(9, "2019-01-01"), (8, "2024-06-01")], "id long, d string").withColumn("d", F.col("d").cast("date"))
    got = sorted(r.id for r in restore_range(cur, bak, "d", F.lit("2023-01-01").cast("date")).collect())
    assert got == [2, 3, 9]


def test_observed_metrics_same_pass(spark):
    df = spark.range(100)
    out, obs = observed(df, "m", rows=F.count(F.lit(1)), even=F.count_if(F.col("id") % 2 == 0))
    out.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 100, "even": 50}


def test_preview_and_sample(spark):
    df = spark.range(1000)
    assert preview(df).count() == 5
    s1 = [r.id for r in sample_rows(df, "id", 5, seed=7).collect()]
    assert len(set(s1)) == 5
    assert s1 == [r.id for r in sample_rows(df.repartition(7), "id", 5, seed=7).collect()]


def test_require_columns(spark):
    df = spark.range(3)
    assert require_columns(df, ["id"]) is df
    try:
        require_columns(df, ["id", "title"], "content")
    except ValueError as e:
        assert "title" in str(e)
    else:
        raise AssertionError("expected a ValueError")


def test_window_landing_gaps(spark):
    import datetime as dt

    from newsflow.operators.load import landing_gaps, window_landing_gaps

    landed = spark.createDataFrame(
        [("world", dt.date(2024, 3, 1)), ("world", dt.date(2024, 3, 3)), ("business", dt.date(2024, 3, 5))], "section string, day date"
    )
    sections = spark.createDataFrame([("world",), ("business",), ("environment",)], "section string")
    gaps = {(r.section, r.day.day) for r in window_landing_gaps(landed, sections, "2024-03-05", 2).collect()}
    assert gaps == {("world", 4), ("world", 5), ("business", 3), ("business", 4)} | {("environment", d) for d in (3, 4, 5)}
    assert [(r.section, r.day.day) for r in landing_gaps(landed).collect()] == [("world", 2)]
