"""DataFrame-level operators."""

from sparkops.operators.aggregate import (  # noqa: F401
    attach_global, basket_summary, count_by, distinct_count, extreme_records, group_extremes, group_state, merge_states,
    mode, numeric_stats, state_stats, top_groups, total_and_mode,
)
from sparkops.operators.bitmaps import bitmap_counts, build_bitmaps, merge_bitmaps  # noqa: F401
from sparkops.operators.heavy import heavy_groups  # noqa: F401
from sparkops.operators.joins import (  # noqa: F401
    band_avg_join, hot_keys, lookup_filter, lookup_key, replicate, salt, salted_join,
    xor_mismatches,
)
from sparkops.operators.ranking import (  # noqa: F401
    rank_rows, top_entity_extremes, top_per_group, word_count, zip_all_ranks, zip_by_rank,
)
from sparkops.operators.shape import (  # noqa: F401
    add_constants, conform, drop_incomplete, fill_text,
)
