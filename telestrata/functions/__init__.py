from telestrata.functions.expressions import (
    bucket_of,
    exact_mean,
    exact_mean_sql,
    flag_count,
    outside,
    ratio,
    whole_seconds_between,
)

__all__ = [
    "bucket_of",
    "exact_mean",
    "exact_mean_sql",
    "flag_count",
    "outside",
    "ratio",
    "whole_seconds_between",
]
