from pyspark.sql import types as T

from newsflow.operators import landing
from newsflow.sources import quarantine as Q


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_landing_replaces_its_own_partitions(spark, tmp_path):
    path = f"file://{tmp_path}/l"
    make = lambda data: spark.createDataFrame(data, "section string, day string, id long").selectExpr("section", "CAST(day AS DATE) AS day", "id")
    assert landing.landed_partitions(spark, path, "section string, day date").count() == 0
    landing.land(make([("a/b", "2024-03-01", 1), ("a/b", "2024-03-02", 2), ("c", "2024-03-01", 3), (None, "2024-03-01", 9)]), path, ["section", "day"])
    landing.land(make([("a/b", "2024-03-02", 7), ("c", "2024-03-03", 8)]), path, ["section", "day"])
    landing.land(make([]), path, ["section", "day"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 3, 7, 8, 9]
    found = landing.landed_partitions(spark, path, "section string, day date")
    assert [(a, str(b)) for a, b in rows(found)] == [("a/b", "2024-03-01"), ("a/b", "2024-03-02"), ("c", "2024-03-01"), ("c", "2024-03-03"), (None, "2024-03-01")]
    sections = spark.createDataFrame([("a/b",), ("c",)], "section string")
    gaps = landing.to_poll(spark, path, sections, "2024-03-03", 2)
    assert [(a, str(b)) for a, b in rows(gaps)] == [("a/b", "2024-03-03"), ("c", "2024-03-02")]
    assert "FileScan" not in gaps._jdf.queryExecution().executedPlan().toString()


def test_nothing_is_lost_to_drift(spark, tmp_path):
    (tmp_path / "x").mkdir()
    lines = ['{"id": 1, "price": 2}', '{"id": 2, "price": 2.5, "note": "n"}', '{"id": 3, "price": null, "new": [1]}', '{"id": 4, "price": "dear"}', '{"id": "x", "price": {"a": 1}}', '{"id": 5, "pr', "[1]", "7", "", "{}"]
    (tmp_path / "x" / "a.json").write_text("\n".join(lines[:5]))
    (tmp_path / "x" / "b.json").write_text("\n".join(lines[5:]))
    wanted = T.StructType([T.StructField("id", T.LongType()), T.StructField("price", T.DoubleType()), T.StructField("note", T.StringType())])
    read = Q.read_lines(spark, f"file://{tmp_path}/x")
    good, held = Q.split_records(read, wanted)
    assert sorted(((r.id, r.price, r.note, r.extra) for r in good.collect()), key=str) == sorted(
        [(1, 2.0, None, None), (2, 2.5, "n", None), (3, None, None, '{"new":[1]}'), (None, None, None, None)], key=str)
    assert {(r.value, r.reason, r.file[-6:]) for r in held.collect()} == {
        ('{"id": 4, "price": "dear"}', "price is not double", "a.json"), ('{"id": "x", "price": {"a": 1}}', "id is not bigint; price is not double", "a.json"),
        ('{"id": 5, "pr', "not JSON", "b.json"), ("[1]", "not an object", "b.json"), ("7", "not an object", "b.json")}
    merged = Q.landed_schema(read).first().schema
    assert merged is not None
    assert "price: D" in Q.landed_schema(read.where("value LIKE '%: 2%}'")).first().schema  # a whole number and a decimal
    none, empty = Q.split_records(read.where("false"), wanted)
    assert none.count() == 0 and empty.count() == 0
