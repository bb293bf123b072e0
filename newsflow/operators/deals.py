"""Deals: raw CSV rows → typed deal rows with currency and value; incremental load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.functions import deals as DF
from newsflow.functions.dates import any_date
from newsflow.operators.load import new_rows
from newsflow.schemas import DEALS_RENAME

DEAL_COLUMNS = ["pubDate", "company", "investors", "deal_size", "type", "series_round", "deal_currency", "deal_value"]
DEAL_KEY = ["company", "pubDate", "deal_size"]


def parse_deals(raw: DataFrame, compat: bool = False, fill_missing: bool = False) -> DataFrame:
    """Rename the CSV headers, parse the date, derive currency and value.

    ``fill_missing`` stores a missing size as the text ``None``, as tables filled that way need for the load's key to match.
    """
    df = raw.withColumnsRenamed({k: v for k, v in DEALS_RENAME.items() if k in raw.columns})
    if dict(df.dtypes).get("pubDate") == "string":
        df = df.withColumn("pubDate", any_date("pubDate"))
    value = DF.deal_value_compat("deal_size") if compat else DF.deal_value("deal_size")
    df = df.withColumns({"deal_currency": DF.deal_currency("deal_size"), "deal_value": value})
    return df.withColumn("deal_size", F.coalesce("deal_size", F.lit("None"))) if fill_missing else df


def new_deals(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Deals whose (company, pubDate, deal_size) is not stored yet; nulls match nulls (Q18)."""
    return new_rows(incoming, existing.select(*DEAL_KEY), DEAL_KEY, null_safe=True).select(*DEAL_COLUMNS)
