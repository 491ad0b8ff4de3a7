"""Column functions: predicates, keys, text helpers, statistics and codecs."""

from afterglow.functions.codec import decode_curve, encode_curve
from afterglow.functions.columns import (
    bucket_of, calendar_page, day_of, excess48, hour_label, hours_between, human_bytes, in_window, is_excluded, is_excluded_bytes,
    percent_encoded, qualifies, search_key, source_url, spike_key, strata,
)
from afterglow.functions.statistics import checksum, exact_median, nearest_rank, ordered_series, upper_median

__all__ = [
    "bucket_of", "calendar_page", "checksum", "day_of", "decode_curve", "encode_curve", "exact_median", "excess48", "hour_label",
    "hours_between", "human_bytes", "in_window", "is_excluded", "is_excluded_bytes", "nearest_rank", "ordered_series",
    "percent_encoded", "qualifies", "search_key", "source_url", "spike_key", "strata", "upper_median",
]
