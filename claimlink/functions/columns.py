"""Column expressions of the claims rules; all of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimlink.schema import DEFAULT_RULES, Rules


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_sentinel(value: Column | str, probe: Column | str, sentinel: str) -> Column:
    """``value``, or NULL where ``probe`` holds the sentinel."""
    return F.when(_col(probe) == sentinel, F.lit(None)).otherwise(_col(value))


def only_for(vendor: str, value: Column | str, datasource: Column | str = "datasource") -> Column:
    """``value`` for rows of one vendor, NULL for all others."""
    return F.when(_col(datasource) == vendor, _col(value))


def paid_flag(status: Column | str, paid_statuses: Iterable[str]) -> Column:
    """1 for a paid status, else 0; an unknown (NULL) status counts as not paid."""
    return F.when(_col(status).isin(*paid_statuses), F.lit(1)).otherwise(F.lit(0))


def paid_by_source(rules: Rules = DEFAULT_RULES) -> Column:
    """Stricter paid rule: final indicator for the primary vendor, status for the secondary."""
    own_mark = {
        rules.primary: ("treatment_final_claim_indicator", rules.paid_indicator),
        rules.secondary: ("treatment_claim_status", rules.paid_code),
    }
    paid = [
        (F.col("datasource") == vendor) & (F.col(column) == mark)
        for vendor, (column, mark) in own_mark.items()
    ]
    return paid[0] | paid[1]


def presence(value: Column | str) -> Column:
    """1 if the value is there, else 0."""
    return _col(value).isNotNull().cast("int")


def presence_flags(attributes: Iterable[str], prefix: str = "other_") -> list[Column]:
    """``non_null_<prefix><attribute>`` for each attribute of the other side."""
    return [presence(prefix + a).alias(f"non_null_{prefix}{a}") for a in attributes]


def concat_key(*parts: Column | str) -> Column:
    """Concatenation without separator; NULL as soon as one part is NULL."""
    return F.concat(*[_col(p) for p in parts])


def claim_key(
    claim_id: Column | str = "claim_id", code: Column | str = "code", mode: str = "concat"
) -> Column:
    """Key of a claim line in a ledger.

    ``concat`` glues id and code together, so ('ab', 'c') and ('a', 'bc') share a key;
    ``struct`` keeps the parts apart. Both are NULL when a part is NULL.
    """
    if mode == "concat":
        return concat_key(claim_id, code)
    if mode == "struct":
        cid, cod = _col(claim_id), _col(code)
        return F.when(
            cid.isNotNull() & cod.isNotNull(), F.struct(cid.alias("claim_id"), cod.alias("code"))
        )
    raise ValueError(f"unknown key mode: {mode!r}")


def abs_days(a: Column | str, b: Column | str) -> Column:
    """Calendar days between two dates, without sign."""
    return F.abs(F.datediff(_col(a).cast("date"), _col(b).cast("date")))


def final_value(own: Column | str, matched: Column | str, alternative: Column | str) -> Column:
    """Own value, else the matched claim's, else the best alternative match's."""
    return F.coalesce(_col(own), _col(matched), _col(alternative))


def completeness_label(value: Column | str, name: str) -> Column:
    """``<name>_Complete`` or ``<name>_Missing``."""
    return F.when(_col(value).isNotNull(), F.lit(f"{name}_Complete")).otherwise(
        F.lit(f"{name}_Missing")
    )
