import re

import pytest
from pyspark.sql import functions as F

from newsflow.operators.key_index import KeyIndex
from newsflow.operators.load import new_rows
from newsflow.operators.versioned import CommitConflict, VersionedTable
from newsflow.plans import q_load, q_tables

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def people(spark, data):
    return spark.createDataFrame(data, "id long, name string, day int")


@pytest.fixture
def table(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t", "id", buckets=8)
    t.overwrite(people(spark, [(k, f"n{k}", k % 10) for k in range(100)] + [(None, "nobody", None)]))
    return t


def test_versions_stay_readable(spark, table):
    before = rows(table.read())
    assert table.update(people(spark, [(3, None, 3), (1000, "x", 1)]), ["name"]) == 1
    assert table.upsert(people(spark, [(3, "three", 33), (200, "new", 0)])) == 2
    assert table.append(people(spark, [(300, "late", 1)])) == 3
    assert rows(table.read(0)) == before and len(before) == 101
    assert dict((r[0], r[1]) for r in rows(table.read(1)))[3] is None and len(rows(table.read(1))) == 101
    last = {r[0]: r for r in rows(table.read())}
    assert last[3] == (3, "three", 33) and last[200] == (200, "new", 0) and last[300][1] == "late" and len(last) == 103
    with pytest.raises(FileNotFoundError):
        table.read(9)


def test_only_touched_buckets_are_written(spark, table):
    first = table.manifest()["folders"]
    table.update(people(spark, [(7, "seven", 7)]), ["name"])
    second = table.manifest()["folders"]
    assert sum(first[b] != second[b] for b in first) == 1 and set(first) == set(second)
    table.overwrite(table.read().where("day < 5"))  # reads itself
    assert table.read().count() == 50 and table.read(1).count() == 101


def test_restore_leaves_other_buckets(spark, table):
    table.restore(people(spark, [(5, "from backup", 0)]), "day", 1)
    got = {r[0]: r for r in rows(table.read())}
    assert 10 not in got and got[5] == (5, "from backup", 0) or got[5][1] in ("n5", "from backup")
    want = [r for r in rows(table.read(0)) if r[2] is None or r[2] >= 1] + [(5, "from backup", 0)]
    assert rows(table.read()) == sorted(want, key=str)


def test_a_write_that_dies_before_the_swap(spark, table, monkeypatch):
    before = rows(table.read())
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            table.update(people(spark, [(1, "lost", 1)]), ["name"])
    assert rows(table.read()) == before and table.versions() == [0]
    assert table.update(people(spark, [(1, "kept", 1)]), ["name"]) == 1
    assert table.expire(keep=1) >= 1  # the folder that no version names
    assert table.versions() == [1] and ("kept" in {r[1] for r in rows(table.read())}) and len(rows(table.read())) == len(before)


def test_two_writers_of_one_version(spark, table):
    base = table.manifest()
    table.update(people(spark, [(1, "first", 1)]), ["name"])
    with pytest.raises(CommitConflict):
        table._commit(base, people(spark, []), [0])
    assert table.read().count() == 101


def test_empty_tables(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/e", "id", buckets=4)
    with pytest.raises(FileNotFoundError):
        t.read()
    t.overwrite(people(spark, []))
    assert t.read().count() == 0 and t.read().columns == ["id", "name", "day"]
    t.update(people(spark, []), ["name"])
    t.upsert(people(spark, [(1, "a", 1)]))
    assert rows(t.read()) == [(1, "a", 1)] and t.read(1).count() == 0


def exchanges_of(df, part):
    """Exchanges between the join and the scan of files whose path holds ``part``."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    plan = [line for line in plan if re.match(r"[ :]*[+:]- ", line)]  # texts in expressions may hold line feeds
    at = next(k for k, line in enumerate(plan) if "FileScan" in line and part in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    out, d = 0, depth(plan[at])
    for line in reversed(plan[:at]):
        if depth(line) < d:
            d = depth(line)
            if "Join" in line:
                return out
            out += "Exchange" in line
    raise AssertionError("no join above the scan")


def test_index_isn_t_shuffled(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        content, incoming = q_load._content_incoming(spark, SF)
        index = q_tables.title_index(spark, content, True)
        index.append(incoming.limit(0))  # a second run's files
        found = index.new_rows(incoming)
        assert exchanges_of(found, "titles_") == 0
        assert rows(found) == rows(new_rows(incoming, content, ["title"], case_insensitive=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("null_safe", [True, False])
def test_keys_of_several_columns(spark, tmp_path, null_safe):
    ddl = "a string, b string"
    stored = spark.createDataFrame([("x", None), ("1:", "y"), ("Q", "z"), ("", "")], ddl)
    incoming = spark.createDataFrame([("x", None), ("1", ":y"), ("1:", "y"), ("q", "Z"), (None, "x"), ("", ""), ("", None)], ddl)
    index = KeyIndex(spark, f"several_{null_safe}".lower(), f"file://{tmp_path}/k", ["a", "b"], case_insensitive=True, null_safe=null_safe, buckets=4)
    index.append(stored)
    assert rows(index.new_rows(incoming)) == rows(new_rows(incoming, stored, ["a", "b"], case_insensitive=True, null_safe=null_safe))


def test_a_retried_epoch_finds_what_it_found(spark, tmp_path):
    index = KeyIndex(spark, "epochs", f"file://{tmp_path}/k", ["title"], buckets=4)
    index.append(spark.createDataFrame([("a",)], "title string"))
    batch = spark.createDataFrame([("a",), ("b",), (None,)], "title string")
    first = rows(index.new_rows(batch, before_epoch=5))
    index.append(batch, epoch=5)
    assert rows(index.new_rows(batch, before_epoch=5)) == first == [("b",), (None,)]
    assert rows(index.new_rows(batch, before_epoch=6)) == [(None,)]
    spark.sql("DROP TABLE epochs")  # external: the files stay
    index.attach()
    assert index.stored().count() == 3
    assert index.stored().where(F.col("epoch") == 5).count() == 2
