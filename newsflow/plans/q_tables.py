"""Named queries that go through written tables: versions, the key index, landed partitions and drifting files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.operators import landing
from newsflow.operators.key_index import KeyIndex
from newsflow.operators.versioned import VersionedTable
from newsflow.plans import q_load
from newsflow.plans.q_load import _CONTENT_SQL, _ORDERS_CONTENT_SQL, BOUNDARY
from newsflow.plans.registry import query
from newsflow.session import checkpoint_dir
from newsflow.sources import quarantine

_CONTENT = "SELECT id, status, priority, request_date, url_full_txt FROM"


@query(
    "versioned_content",
    f"""WITH {_ORDERS_CONTENT_SQL},
updated AS (
  SELECT c.id, CASE WHEN s.id IS NOT NULL THEN s.status ELSE c.status END AS status, c.priority,
         CASE WHEN s.id IS NOT NULL THEN s.request_date ELSE c.request_date END AS request_date,
         CASE WHEN s.id IS NOT NULL THEN s.url_full_txt ELSE c.url_full_txt END AS url_full_txt
  FROM content c LEFT JOIN staging s ON c.id = s.id),
restored AS (
  SELECT * FROM updated WHERE NOT (request_date < TIMESTAMP '{BOUNDARY}') OR request_date IS NULL
  UNION ALL SELECT * FROM content WHERE request_date < TIMESTAMP '{BOUNDARY}' AND id % 3 <> 0)
SELECT 0 AS version, * FROM ({_CONTENT} content)
UNION ALL SELECT 1, * FROM ({_CONTENT} updated)
UNION ALL SELECT 2, * FROM ({_CONTENT} restored)""",
)
def q_versioned_content(spark, sf_dir):
    """Overwrite, update by key and restore of a range; every version is read back at the end."""
    content, staging = q_load._orders_content(spark, sf_dir)
    table = VersionedTable(spark, f"{checkpoint_dir(spark)}/versioned-{uuid.uuid4().hex}", "id", buckets=16)
    table.overwrite(content)
    table.update(staging, ["status", "request_date", "url_full_txt"])
    table.restore(content.where(F.col("id") % 3 != 0), "request_date", F.lit(BOUNDARY).cast("timestamp"))
    frames = [table.read(v).select(F.lit(v).alias("version"), "*") for v in (0, 1, 2)]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def title_index(spark, content, case_insensitive):
    name = f"titles_{uuid.uuid4().hex}"
    index = KeyIndex(spark, name, f"{checkpoint_dir(spark)}/{name}", ["title"], case_insensitive=case_insensitive)
    index.append(content)
    return index


@query(
    "load_new_titles_indexed",
    f"""WITH {_CONTENT_SQL}
SELECT i.id, i.title, i.is_copy FROM incoming i
WHERE NOT EXISTS (SELECT 1 FROM content c WHERE lower(c.title) = lower(i.title))""",
)
def q_load_new_titles_indexed(spark, sf_dir):
    """The case-insensitive load against a key index of what is stored."""
    content, incoming = q_load._content_incoming(spark, sf_dir)
    return title_index(spark, content, True).new_rows(incoming)


# ---------------------------------------------------------------- landing by partition

_WINDOW_DAYS, _AS_OF = 40, "1996-03-01"
_LANDED_SQL = f"""src AS (SELECT o_orderpriority AS section, CAST(o_orderdate AS DATE) AS day, o_orderkey AS id FROM orders
  WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{_AS_OF}' - {_WINDOW_DAYS + 20} AND DATE '{_AS_OF}'),
landed AS (SELECT DISTINCT section, day FROM src WHERE id % 3 <> 0)"""


@query(
    "landing_to_poll",
    f"""WITH {_LANDED_SQL},
expected AS (SELECT s.section, DATE '{_AS_OF}' - CAST(d.k AS INTEGER) AS day
  FROM (SELECT DISTINCT o_orderpriority AS section FROM orders) s, range(0, {_WINDOW_DAYS + 1}) AS d(k))
SELECT section, CAST(day AS DATE) AS day FROM expected e WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.section = e.section AND l.day = e.day)""",
)
def q_landing_to_poll(spark, sf_dir):
    """Two polls, the second of which replaces some days; the gaps of the window from the folders' names."""
    o = q_load.fx.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("section"), F.to_date("o_orderdate").alias("day"), F.col("o_orderkey").alias("id"))
    end = F.lit(_AS_OF).cast("date")
    rows = o.where(F.col("day").between(F.date_sub(end, _WINDOW_DAYS + 20), end) & (F.col("id") % 3 != 0))
    path = f"{checkpoint_dir(spark)}/landing-{uuid.uuid4().hex}"
    landing.land(rows.where("id % 2 = 0"), path, ["section", "day"])
    later = rows.where("id % 2 = 1").select("section", "day").distinct()
    landing.land(rows.join(later, ["section", "day"]), path, ["section", "day"])
    return landing.to_poll(spark, path, o.select("section").distinct(), _AS_OF, _WINDOW_DAYS)


# ---------------------------------------------------------------- drifting files

_WANTED = T.StructType([T.StructField("id", T.LongType()), T.StructField("price", T.DoubleType()), T.StructField("note", T.StringType())])


@query(
    "drifting_records",
    """WITH o AS (SELECT o_orderkey AS id, o_orderkey % 5 AS d, CAST(floor(o_totalprice) AS BIGINT) AS whole, o_totalprice AS price, o_orderpriority AS note, o_orderstatus AS st FROM orders)
SELECT id, CAST(CASE WHEN d = 0 THEN whole WHEN d = 1 THEN price WHEN d = 2 THEN NULL END AS DOUBLE) AS price,
       CASE WHEN d >= 1 AND d <= 2 THEN note END AS note, CASE WHEN d = 2 THEN '{"status":"' || st || '"}' END AS extra, CAST(NULL AS VARCHAR) AS reason FROM o WHERE d <= 2
UNION ALL SELECT NULL, NULL, NULL, '{"id":' || CAST(id AS VARCHAR) || ',"price":"on request"}', 'price is not double' FROM o WHERE d = 3
UNION ALL SELECT NULL, NULL, NULL, '{"id":' || CAST(id AS VARCHAR) || ',"pri', 'not JSON' FROM o WHERE d = 4""",
)
def q_drifting_records(spark, sf_dir):
    """Five days' files: whole prices, then decimals and notes, then another column without prices, wrong types, cut lines."""
    o = q_load.fx.table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", "o_totalprice AS price", "o_orderpriority AS note", "o_orderstatus AS status")
    day = F.col("id") % 5
    line = (F.when(day == 0, F.to_json(F.struct("id", F.floor("price").alias("price")))).when(day == 1, F.to_json(F.struct("id", "price", "note")))
            .when(day == 2, F.to_json(F.struct("id", "note", "status"))).when(day == 3, F.to_json(F.struct("id", F.lit("on request").alias("price"))))
            .otherwise(F.concat(F.lit('{"id":'), F.col("id").cast("string"), F.lit(',"pri'))))
    folder = f"{checkpoint_dir(spark)}/drift-{uuid.uuid4().hex}"
    o.select(line.alias("value"), F.concat(F.lit("day"), day.cast("string")).alias("day")).write.partitionBy("day").text(folder)
    good, held = quarantine.split_records(quarantine.read_lines(spark, folder), _WANTED)
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in _WANTED]
    return good.select("id", "price", "note", "extra", F.lit(None).cast("string").alias("reason")).unionByName(held.select(*none, F.col("value").alias("extra"), "reason"))
