"""Column expressions: scalar functions, event rules, deterministic hashing."""

from cohortex.functions.rules import CAMPAIGN_RULES, CONVERSION_RULE, Contains, EventRule
from cohortex.functions.scalar import (
    bool_flag,
    bucket_rare,
    concat_pair,
    hash_u32,
    hash_uniform,
    ifnull_zero,
    label_binary,
    local_hour,
    segment_label,
)

__all__ = [
    "CAMPAIGN_RULES",
    "CONVERSION_RULE",
    "Contains",
    "EventRule",
    "bool_flag",
    "bucket_rare",
    "concat_pair",
    "hash_u32",
    "hash_uniform",
    "ifnull_zero",
    "label_binary",
    "local_hour",
    "segment_label",
]
