"""End-to-end jobs over table paths – the counterparts of the reference's entry scripts.

Each job reads its inputs with explicit schemas, runs the lazy operators and
performs its writes as the only actions.  Tables are Parquet directories; an
"overwrite" target is never read by the same plan, appends are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.operators.cards import card_tags, flatten_cards
from newsflow.operators.deals import DEAL_COLUMNS, new_deals, parse_deals
from newsflow.operators.load import write_snapshot
from newsflow.operators.metrics import observed
from newsflow.plans.daily import union_sources
from newsflow.plans.selection import Selection, select_programme
from newsflow.sources import readers as R
from newsflow.sources.json_sources import explode_records, guardian_articles, scopus_articles, springer_articles
from newsflow.sources.profiles import PROFILES, normalise, rss_items


def _read_or_empty(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """The stored table, or an empty one on the first run; any other read error rises."""
    return spark.read.parquet(path) if R.path_exists(spark, path) else spark.createDataFrame([], ddl)


def _landed_articles(spark: SparkSession, family: str, folder: str, before: str | None) -> DataFrame:
    if family == "records":
        return springer_articles(explode_records(R.read_records_payloads(spark, folder), ["_file"]), ["_file", "rec_pos"])
    if family == "guardian":
        return guardian_articles(R.read_guardian_items(spark, folder))
    if family == "scopus":
        if before is None:
            raise ValueError("scopus payloads need the day before which they count")
        return scopus_articles(R.read_scopus_items(spark, folder), ["_file", "item_seq"], before)
    return normalise(rss_items(R.read_feeds(spark, folder)), PROFILES[family], order=["feed_file", "item_seq"])


def extract_feeds(spark: SparkSession, landed: dict[str, str], extract_path: str, before: str | None = None) -> DataFrame:
    """Landed files per family → one article extract partitioned by source (K1).

    ``landed`` maps a feed profile's name to the folder of its RSS or Atom
    files, or ``records``, ``guardian`` and ``scopus`` to their JSON payloads.
    The first of equal titles is the first by file name and place in the file.
    """
    frames = [_landed_articles(spark, family, folder, before) for family, folder in landed.items()]
    articles = union_sources(frames)
    write_snapshot(articles, extract_path, partition_by=["source"])
    return spark.read.parquet(extract_path)


def load_deals(spark: SparkSession, csv_dir: str, deals_path: str, compat: bool = False, fill_missing: bool = False) -> int:
    """Deal exports → rows not stored yet (company, date, size; nulls match) appended (K3)."""
    incoming = parse_deals(R.read_deals_csv(spark, csv_dir), compat=compat, fill_missing=fill_missing).select(*DEAL_COLUMNS)
    existing = _read_or_empty(
        spark, deals_path,
        "pubDate date, company string, investors string, deal_size string, type string, series_round string, "
        "deal_currency string, deal_value decimal(20,2)",
    )
    new, obs = observed(new_deals(incoming, existing), "new_deals", rows=F.count(F.lit(1)))
    new.write.mode("append").parquet(deals_path)  # the count is observed during this write
    return obs.get["rows"]


def refresh_cards(spark: SparkSession, pages_dir: str, ref_tags: DataFrame, cards_path: str, card_tags_path: str) -> None:
    """Board pages → cards table and card-tag table, both replaced (K4)."""
    pages = R.read_card_pages(spark, pages_dir)
    cards = flatten_cards(pages, keep=["_file"])
    cards.drop("_file", "item_pos").write.mode("overwrite").parquet(cards_path)
    card_tags(cards, ref_tags, ["_file", "item_pos"]).write.mode("overwrite").parquet(card_tags_path)


def research(
    spark: SparkSession, content_path: str, content_tags_path: str, ref_tags: DataFrame, profiles: DataFrame,
    programme: str, as_of: str, out_path: str | None = None,
) -> Selection:
    """Both programme reports from the stored content and content-tag tables."""
    sel = select_programme(
        spark.read.parquet(content_path), spark.read.parquet(content_tags_path).select("content_id", "tag"),
        ref_tags, profiles, programme, as_of,
    )
    if out_path:
        day = F.lit(as_of)
        sel.cooccurrence_report.withColumn("report_day", day).write.mode("overwrite").parquet(f"{out_path}/cooccurrence")
        sel.recent_subject_report.withColumn("report_day", day).write.mode("overwrite").parquet(f"{out_path}/recent_subject")
    return sel
