from riskloom.functions.columns import (
    average_available,
    best_of,
    bucket_index,
    clip_low,
    f_beta,
    hash_order,
    isclose,
    linspace,
    missing,
    nan_to_null,
    null_if,
    number,
    safe_corr,
    safe_ratio,
    share,
    spread_available,
    sum0,
    sum_available,
)
from riskloom.functions.text import capitalize_label, reason_phrase, slugify, truncate

__all__ = [
    "average_available",
    "best_of",
    "bucket_index",
    "capitalize_label",
    "clip_low",
    "f_beta",
    "hash_order",
    "isclose",
    "linspace",
    "missing",
    "nan_to_null",
    "null_if",
    "number",
    "reason_phrase",
    "safe_corr",
    "safe_ratio",
    "share",
    "slugify",
    "spread_available",
    "sum0",
    "sum_available",
    "truncate",
]
