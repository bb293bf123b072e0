"""Import every query module so the registry is complete."""

from newsflow.plans import q_clean, q_daily, q_deals, q_feeds, q_files, q_load, q_maint, q_select, q_sources, q_state, q_tables, q_tagging, q_tags  # noqa: F401
from newsflow.plans.registry import ORACLE, QUERIES  # noqa: F401
