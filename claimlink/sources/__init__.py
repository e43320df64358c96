"""Reading and storing tables."""

from claimlink.sources.tables import (
    Staging,
    conform,
    exact_type,
    load_bridge,
    load_claims,
    load_codes,
    load_table,
    save,
    with_common_numbers,
)

__all__ = [
    "Staging",
    "conform",
    "exact_type",
    "load_bridge",
    "load_claims",
    "load_codes",
    "load_table",
    "save",
    "with_common_numbers",
]
