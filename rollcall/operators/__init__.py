"""DataFrame -> DataFrame operators. None of them takes a path or calls Python on rows.

Only ``with_places`` and ``chart_arrays`` run a job: they write their input once, in order.
"""

from rollcall.operators.charts import chart_arrays, chart_series
from rollcall.operators.counts import (
    added_counts,
    count_changes,
    distributions_of_counts,
    user_counts,
)
from rollcall.operators.dimensions import (
    reject_counts,
    rejected_for_analysis,
    watch_rejects,
    with_address_part,
    with_age,
    with_bins,
)
from rollcall.operators.distribution import (
    age_distribution,
    city_distribution,
    country_distribution,
    daily_distributions,
    gender_distribution,
    share,
    shares,
    stamp,
)
from rollcall.operators.keyed import latest_by_key, upsert_by_key
from rollcall.operators.messages import classify_users, decode_users, encode_users, split_valid
from rollcall.operators.places import with_places
from rollcall.operators.profiles import classify_profiles, flatten_profiles, split_profiles

__all__ = [
    "added_counts",
    "age_distribution",
    "chart_arrays",
    "chart_series",
    "city_distribution",
    "classify_profiles",
    "classify_users",
    "count_changes",
    "country_distribution",
    "daily_distributions",
    "decode_users",
    "distributions_of_counts",
    "encode_users",
    "flatten_profiles",
    "gender_distribution",
    "latest_by_key",
    "reject_counts",
    "rejected_for_analysis",
    "share",
    "shares",
    "split_profiles",
    "split_valid",
    "stamp",
    "upsert_by_key",
    "user_counts",
    "watch_rejects",
    "with_address_part",
    "with_age",
    "with_bins",
    "with_places",
]
