"""histdim: historical dimensions and clean fact tables on Spark.

Lazy DataFrame pipelines for cumulative entity snapshots, type-2 slowly
changing dimensions (backfill and increment), log deduplication into a fact
table, and the analyses these models answer.
"""

from .operators.analytics import (as_of, bail_rates, cohorts, consistent, fact_with_teams,
                                  transitions, trend, versions_at)
from .operators.cumulative import (cumulate, cumulate_range, debut_load, films_array, films_as_of,
                                   snapshot, with_film_ids, with_film_rows)
from .operators.facts import build_fact, dedup, dedup_details, duplicate_report, to_fact
from .operators.scd2 import (apply_changes, collapse_streaks, open_versions, scd2_backfill,
                             stage_changes, year_feed, yearly_snapshots)

__all__ = [
    "as_of", "versions_at", "bail_rates", "cohorts", "consistent", "fact_with_teams", "transitions", "trend",
    "cumulate", "cumulate_range", "debut_load", "films_array", "films_as_of", "snapshot",
    "with_film_ids", "with_film_rows", "year_feed", "build_fact", "dedup", "dedup_details", "duplicate_report", "to_fact",
    "apply_changes", "collapse_streaks", "open_versions", "scd2_backfill", "stage_changes",
    "yearly_snapshots",
]
