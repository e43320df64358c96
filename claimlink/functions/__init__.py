"""Column expressions."""

from claimlink.functions.columns import (
    abs_days,
    claim_key,
    completeness_label,
    concat_key,
    final_value,
    null_if_sentinel,
    only_for,
    paid_by_source,
    paid_flag,
    presence,
    presence_flags,
)

__all__ = [
    "abs_days",
    "claim_key",
    "completeness_label",
    "concat_key",
    "final_value",
    "null_if_sentinel",
    "only_for",
    "paid_by_source",
    "paid_flag",
    "presence",
    "presence_flags",
]
