"""newsflow: a PySpark-native engine for curated news and document collections.

Every operator takes and returns a lazy ``DataFrame`` built from
``pyspark.sql.functions``; nothing is collected except tiny, size-checked
dimension tables.  The main entry points are re-exported here.
"""

from newsflow.operators.clean import clean_articles
from newsflow.operators.cooccurrence import content_flags, cooccurrence_ids, subject_ids
from newsflow.operators.dedup import keep_first
from newsflow.operators.load import new_rows, restore_range, update_by_key, upsert
from newsflow.operators.tagging import tag_articles
from newsflow.operators.tags_long import tag_transform
from newsflow.plans.daily import compile_new_articles, run_daily
from newsflow.plans.selection import select_programme

__version__ = "0.1.0"

__all__ = [
    "clean_articles",
    "compile_new_articles",
    "content_flags",
    "cooccurrence_ids",
    "keep_first",
    "new_rows",
    "restore_range",
    "run_daily",
    "select_programme",
    "subject_ids",
    "tag_articles",
    "tag_transform",
    "update_by_key",
    "upsert",
]
