"""DataFrame -> DataFrame operators (scoping, joins, series windows, aggregates)."""

from pitwall.operators.aggs import avg_if, count_if, dedupe_ordered, negative_sum, positive_sum  # noqa: F401
from pitwall.operators.joins import (  # noqa: F401
    containment_join, join_on_time_bucket, nearest_join, proximity_join,
)
from pitwall.operators.scope import (  # noqa: F401
    as_role, left_join_renamed, one_row_per_driver, race_sessions, scope_keys, scope_to_session, session_drivers,
    sized_broadcast, with_driver,
)
from pitwall.operators.series import (  # noqa: F401
    Series, fill, first, lag, last, lead, ordinal, profile, resolve, rolling, row_number, running, whole,
)
from pitwall.operators.skew import skew_join  # noqa: F401
from pitwall.operators.topn import ranks, top_n  # noqa: F401
