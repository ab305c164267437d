"""Reading and writing: landed profiles, messages, the user log, results and chart data."""

from rollcall.sources.changes import (
    add_changes,
    current_users,
    ensure_changes,
    fold_changes,
    publish_current_users,
    read_changes,
)
from rollcall.sources.charts import read_chart_series, write_chart_series
from rollcall.sources.counts import counts_from_changes, read_user_counts, write_user_counts
from rollcall.sources.log import append_user_log, read_refused, read_user_log, written_since
from rollcall.sources.messages import write_user_messages
from rollcall.sources.profiles import read_raw_profiles, read_responses, rejected_responses
from rollcall.sources.results import ensure_results, read_result_days, read_results, write_results
from rollcall.sources.tables import (
    ensure_tables,
    publish_results,
    publish_version,
    read_published,
)
from rollcall.sources.users import (
    Snapshot,
    compact_users,
    latest_users,
    read_snapshot,
    users_by_id,
    write_snapshot,
)

__all__ = [
    "Snapshot",
    "add_changes",
    "append_user_log",
    "compact_users",
    "counts_from_changes",
    "current_users",
    "ensure_changes",
    "ensure_results",
    "ensure_tables",
    "fold_changes",
    "latest_users",
    "publish_current_users",
    "publish_results",
    "publish_version",
    "read_changes",
    "read_chart_series",
    "read_published",
    "read_raw_profiles",
    "read_refused",
    "read_result_days",
    "read_responses",
    "read_results",
    "read_snapshot",
    "read_user_counts",
    "read_user_log",
    "rejected_responses",
    "users_by_id",
    "write_chart_series",
    "write_results",
    "write_snapshot",
    "write_user_counts",
    "write_user_messages",
    "written_since",
]
