"""Plan-level helpers: join chains, skew-safe joins, lineage cuts, plan inspection."""

from customer360.plans.inspect import plan_summary, plan_text, pushed_filters
from customer360.plans.joins import left_join_all, null_safe_left_join, suffix_overlaps
from customer360.plans.lineage import checkpoint_dir, cut_lineage, release_unreachable, remove_stored
from customer360.plans.settings import tune_session

__all__ = [
    "checkpoint_dir",
    "cut_lineage",
    "left_join_all",
    "null_safe_left_join",
    "plan_summary",
    "plan_text",
    "pushed_filters",
    "release_unreachable",
    "remove_stored",
    "suffix_overlaps",
    "tune_session",
]
