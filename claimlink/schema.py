"""Layouts, business rules and the tie-break order shared by every step."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Types of a layout that is built by hand; loaded numbers keep the type they come in.
MONEY = T.DecimalType(18, 2)
NUMBERS = ("days_supply", "out_of_pocket", "patient_pay")

# Fixed values that results depend on.
NO_PATIENT_SENTINEL = "XXX - F00000"
PAID_STATUSES = ("1", "PAID")
DAY_TOLERANCE = 5


@dataclass(frozen=True)
class Rules:
    """Vendor labels and business constants; every step takes them as one argument."""

    primary: str = "A"
    secondary: str = "B"
    both: str = "Both"
    sentinel: str = NO_PATIENT_SENTINEL
    paid_statuses: tuple[str, ...] = PAID_STATUSES
    paid_indicator: str = "PAID"
    paid_code: str = "1"
    tolerance: int = DAY_TOLERANCE


DEFAULT_RULES = Rules()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


def raw_schema(kind: str) -> T.StructType:
    """Vendor layout of the ``treatment`` or ``procedure`` table."""
    head = [
        ("datasource", T.StringType()),
        ("source", T.StringType()),
        ("patient_token_1", T.StringType()),
        ("patient_token_2", T.StringType()),
        ("patient_id", T.StringType()),
        (f"{kind}_claim_id", T.StringType()),
        ("provider_id", T.StringType()),
        (f"{kind}_dos", T.DateType()),
    ]
    money = [("out_of_pocket", MONEY), ("patient_pay", MONEY)]
    code = [(f"{kind}_code", T.StringType())]
    if kind == "procedure":
        return _struct(*head, *money, *code)
    if kind == "treatment":
        status = [
            ("treatment_claim_status", T.StringType()),
            ("treatment_final_claim_indicator", T.StringType()),
        ]
        return _struct(*head, ("days_supply", T.IntegerType()), *money, *status, *code)
    raise ValueError(f"unknown claim kind: {kind!r}")


BRIDGE_SCHEMA = _struct(
    ("original_token_1", T.StringType()),
    ("original_token_2", T.StringType()),
    ("token1", T.StringType()),
    ("token2", T.StringType()),
)

CODE_GROUPS = ["code_group1", "code_group2", "code_group3", "code_group4"]

CODES_SCHEMA = _struct(("code", T.StringType()), *[(g, T.StringType()) for g in CODE_GROUPS])

# The 19-column claim layout. Both base tables have it, in this order.
CLAIM_SCHEMA = _struct(
    ("datasource", T.StringType()),
    ("source", T.StringType()),
    ("patient_token_1", T.StringType()),
    ("patient_token_2", T.StringType()),
    ("patient_id", T.StringType()),
    ("claim_id", T.StringType()),
    ("provider_id", T.StringType()),
    ("dos", T.DateType()),
    ("days_supply", T.IntegerType()),
    ("out_of_pocket", MONEY),
    ("patient_pay", MONEY),
    ("treatment_claim_status", T.StringType()),
    ("treatment_final_claim_indicator", T.StringType()),
    ("code", T.StringType()),
    *[(g, T.StringType()) for g in CODE_GROUPS],
    ("paid_flag", T.IntegerType()),
)
CLAIM_COLUMNS = CLAIM_SCHEMA.fieldNames()

# Attributes a linked claim may take over from its partner.
FILL_ATTRIBUTES = ["provider_id", "out_of_pocket", "patient_pay", "days_supply"]

# What a pair keeps of the other vendor's claim.
OTHER_COLUMNS = [
    "other_claim_id",
    "other_dos",
    "other_provider_id",
    "other_out_of_pocket",
    "other_patient_pay",
    "other_days_supply",
]

PATIENT_KEYS = ["patient_token_1", "patient_token_2"]
LINK_KEYS = [*PATIENT_KEYS, "code"]
EXACT_KEYS = [*LINK_KEYS, "provider_id", "out_of_pocket", "patient_pay"]

# One winner per group; claim id and token 1 are deliberately not part of it.
RANK_GROUP = ["patient_token_2", "code", "dos"]

# Total order of the pairs inside a group after the date difference (and, for the
# attribute ranks, after "attribute present"). All ascending, NULLs first: Spark's
# own order, so that sorting and comparing structs agree.
OWN_ORDER = [
    "provider_id",
    "out_of_pocket",
    "patient_pay",
    "source",
    "patient_id",
    "days_supply",
    "treatment_claim_status",
    "treatment_final_claim_indicator",
    *CODE_GROUPS,
]
OTHER_ORDER = [
    "other_dos",
    "other_provider_id",
    "other_out_of_pocket",
    "other_patient_pay",
    "other_days_supply",
]
PAIR_ORDER = [
    "abs_date_diff",
    "claim_id",
    "other_claim_id",
    "patient_token_1",
    *OWN_ORDER,
    *OTHER_ORDER,
]

# The 20-column result.
INTEGRATED_COLUMNS = [
    "data_source",
    "datasource",
    "source",
    "patient_token_1",
    "patient_token_2",
    "patient_id",
    "encounter_key",
    "provider_id",
    "svc_date",
    "days_supply",
    "out_of_pocket",
    "patient_pay",
    "codes",
    *CODE_GROUPS,
    "treatment_claim_status",
    "treatment_final_claim_indicator",
    "paid_flag",
]
