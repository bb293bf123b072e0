"""Named queries over what jobs keep between runs: cap sums by epoch, bucket digests and content by month."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from newsflow.operators import monthly
from newsflow.operators.cap_state import CapState
from newsflow.operators.cooccurrence import cooccurrence_ids, subject_ids
from newsflow.operators.reconcile import DigestedTable, missing_from_backup, reconcile
from newsflow.plans import fixtures as fx
from newsflow.plans import q_load, q_select
from newsflow.plans.q_load import _RECOVERY_SQL, BOUNDARY
from newsflow.plans.q_select import SELECT_CTES
from newsflow.plans.registry import query
from newsflow.plans.sql_tagging import TAGGED_CTES
from newsflow.session import checkpoint_dir


def scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("cap_from_epochs", f"WITH {TAGGED_CTES} SELECT char_limit, n_sources FROM cap")
def q_cap_from_epochs(spark, sf_dir):
    """The text cap from the sums of three epochs, one of them retried, folded into one state."""
    articles = fx.articles(spark, sf_dir).select("id", "title", "description", "source")
    state = CapState(spark, scratch(spark, "caps"))
    for epoch in (0, 1, 2, 1):
        state.add(articles.where(F.col("id") % 3 == epoch), epoch)
    return state.compact(scratch(spark, "caps-compact")).frame()


# ---------------------------------------------------------------- reconciliation


def _pair(spark, current, backup, buckets=64):
    mine, theirs = (DigestedTable(spark, scratch(spark, name), "id", buckets) for name in ("current", "backup"))
    mine.table.overwrite(current)
    theirs.table.overwrite(backup)
    return mine, theirs


@query(
    "recovery_missing_by_digests",
    f"""WITH {_RECOVERY_SQL}
SELECT id FROM cur WHERE date_added < TIMESTAMP '{BOUNDARY}' AND id NOT IN (SELECT id FROM bak)""",
)
def q_recovery_missing_by_digests(spark, sf_dir):
    """Ids that the backup lacks, from the buckets whose digests differ."""
    cur, bak, boundary = q_load._recovery(spark, sf_dir)
    old = cur.where(F.col("date_added") < boundary).select("id", "date_added")
    mine, theirs = _pair(spark, old, bak.select("id", "date_added"))
    return missing_from_backup(reconcile(mine, theirs), "id", "date_added", boundary)


@query(
    "reconcile_tables",
    """SELECT CAST('missing' AS VARCHAR) AS kind, o_orderkey AS id FROM orders WHERE o_orderkey % 499 = 3
UNION ALL SELECT 'extra', -o_orderkey FROM orders WHERE o_orderkey % 997 = 4
UNION ALL SELECT 'changed', o_orderkey FROM orders WHERE o_orderkey % 251 = 5 AND o_orderkey % 499 <> 3 AND o_orderstatus <> 'F'""",
)
def q_reconcile_tables(spark, sf_dir):
    """What a backup lacks, has beyond the table, and holds with other values, after the table took two versions to get there."""
    o = fx.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("date_added"))
    # the contents agree at first; digests of the second version are taken from the changed buckets alone
    mine, theirs = _pair(spark, o.where("id % 499 <> 3"), o.where("id % 499 <> 3"))
    for side in (mine, theirs):
        side.digests()
    mine.table.append(o.where("id % 499 = 3"))
    theirs.table.upsert(o.where("id % 251 = 5 AND id % 499 <> 3").withColumn("status", F.lit("F")))
    theirs.table.append(o.where("id % 997 = 4").withColumn("id", -F.col("id")))
    found = reconcile(mine, theirs)
    frames = [(found.missing, "missing"), (found.extra, "extra"), (found.changed, "changed")]
    kinds = [df.select(F.lit(kind).alias("kind"), "id") for df, kind in frames]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


# ---------------------------------------------------------------- content by month (S13f, F8, K7)


def _monthly_content(spark, sf_dir):
    path = scratch(spark, "monthly")
    monthly.write_monthly(q_select._content(spark, sf_dir), path, "pubDate")
    content = monthly.read_monthly(spark, path)
    monthly.write_months(content, f"{path}-months")
    return content, spark.read.parquet(f"{path}-months")


@query(
    "recent_subject_report_monthly",
    f"""WITH {SELECT_CTES}
SELECT id, title, source, pubDate, substring(description, 1, 500) || '...' AS description, tag_concat,
       url_request, tag_score
FROM content
WHERE tag_score > 1 AND pubDate > DATE '{fx.AS_OF}' - INTERVAL 90 DAY
  AND id IN (SELECT content_id FROM flags WHERE has_subject)""",
)
def q_recent_subject_report_monthly(spark, sf_dir):
    """The report from the files of the window's months."""
    content, _ = _monthly_content(spark, sf_dir)
    return monthly.recent_report(content, subject_ids(q_select._flags(spark, sf_dir)), fx.AS_OF)


@query(
    "cooccurrence_report_monthly",
    f"""WITH {SELECT_CTES}
SELECT id, title, source, pubDate, substring(description, 1, 500) || '...' AS description, tag_concat, url_request
FROM content WHERE id IN (SELECT content_id FROM flags WHERE has_subject AND has_issue)""",
)
def q_cooccurrence_report_monthly(spark, sf_dir):
    """The report from the files of the months that hold a selected id."""
    content, months = _monthly_content(spark, sf_dir)
    return monthly.report_by_months(content, cooccurrence_ids(q_select._flags(spark, sf_dir)), months)


@query("restore_range_monthly", f"WITH {_RECOVERY_SQL} SELECT id, date_added, status FROM restored")
def q_restore_range_monthly(spark, sf_dir):
    """The restore in place: only months up to the boundary's are written."""
    cur, bak, _ = q_load._recovery(spark, sf_dir)
    path = scratch(spark, "restored")
    monthly.write_monthly(cur, path, "date_added")
    monthly.restore_months(spark, path, bak, "date_added", dt.date.fromisoformat(BOUNDARY), f"{path}-staging")
    return monthly.read_monthly(spark, path).drop(monthly.MONTH)
