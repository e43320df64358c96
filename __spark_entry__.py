"""

Queries run over the whole claims tables derived from ``lineitem``, ``orders``, ``customer`` and
``part`` (see ``claimlink.sources.fixture``). Both sides return strings, bigint and double only.
"""

from __future__ import annotations

import re
import sys
import tempfile
from collections.abc import Callable
from functools import cached_property, reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from claimlink import oracle  # noqa: E402
from claimlink.functions import (  # noqa: E402
    abs_days,
    claim_key,
    completeness_label,
    concat_key,
    final_value,
)
from claimlink.operators.antijoin import ledger_sieve, not_in  # noqa: E402
from claimlink.operators.base import (  # noqa: E402
    enrich_codes,
    enrich_tokens,
    segment,
    standardize,
    store_base,
)
from claimlink.operators.link import anchor_pairs, exact_pairs, link, with_flag  # noqa: E402
from claimlink.operators.match import best_alternatives, best_matches  # noqa: E402
from claimlink.operators.near import near_sides  # noqa: E402
from claimlink.operators.rank import best_alternative, rank_links, winners  # noqa: E402
from claimlink.plans import integrate as plan  # noqa: E402
from claimlink.plans import quality, scenarios  # noqa: E402
from claimlink.schema import (  # noqa: E402
    CLAIM_COLUMNS,
    CODE_GROUPS,
    DAY_TOLERANCE,
    EXACT_KEYS,
    FILL_ATTRIBUTES,
    INTEGRATED_COLUMNS,
    LINK_KEYS,
    OTHER_COLUMNS,
)
from claimlink.session import configure, input_bytes  # noqa: E402
from claimlink.sources import Staging, save  # noqa: E402
from claimlink.sources.fixture import Inputs, inputs  # noqa: E402

try:
    import corpus_pipeline
    from claimlink.llm import queries as documents
except ModuleNotFoundError as missing:  # the library works without this subpackage
    if missing.name not in ("corpus_pipeline", "claimlink.llm"):
        raise
    corpus_pipeline = documents = None

PAID, NON_PAID = plan.PAID, plan.NON_PAID


def with_folder(run: Callable[[SparkSession, str], DataFrame]):
    """A local session that names no shared folder gets one; a cluster must name its own."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        context = spark.sparkContext
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if not named and re.fullmatch(r"local(\[.*\])?", context.master):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="claimlink-"))
        return run(spark, sf_dir)

    return query


def plain(df: DataFrame) -> DataFrame:
    """Dates as text, amounts as double, whole numbers as bigint; see ``oracle.plain_type``."""
    casts = {c: oracle.plain_type(c) for c in df.columns}
    return df.select(*[F.col(c).cast(t).alias(c) if t else F.col(c) for c, t in casts.items()])


class Context:
    """Tables a query starts from. Steps read more than once are stored first."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    @cached_property
    def staging(self) -> Staging:
        return Staging(self.spark)

    @cached_property
    def inputs(self) -> Inputs:
        found = inputs(self.spark, self.folder)
        configure(self.spark, input_bytes(found.treatment, found.procedure))
        return found

    @cached_property
    def treatment(self) -> DataFrame:
        return self.inputs.base("treatment")

    @cached_property
    def procedure(self) -> DataFrame:
        return self.inputs.base("procedure")

    @cached_property
    def base(self) -> DataFrame:
        """Both kinds, stored in a folder per vendor, anchor and paid flag."""
        return store_base(self.inputs.all_claims(), self.staging)

    @cached_property
    def a(self) -> DataFrame:
        return segment("A", True, self.base)

    @cached_property
    def b(self) -> DataFrame:
        return segment("B", True, self.base)

    @cached_property
    def a_rest(self) -> DataFrame:
        return segment("A", False, self.base)

    @cached_property
    def b_rest(self) -> DataFrame:
        return segment("B", False, self.base)

    def ledgers(self, paid: int = PAID) -> tuple[DataFrame, DataFrame]:
        """Keys used by the two scenarios, stored."""
        return (
            self.staging(scenarios.ledger_scenario_1(self.a, self.b, paid), "ledger_1"),
            self.staging(scenarios.ledger_scenario_3(self.a_rest, self.b_rest, paid), "ledger_3"),
        )

    def integrated(self, runs, **options) -> DataFrame:
        return plan.integrate(self.base, runs, staging=self.staging, **options)



_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None):
    """Register ``build(context)`` and its SQL under ``name``."""

    def register(build: Callable[[Context], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(Context(configure(spark), sf_dir.rstrip("/"))))

        _QUERIES[name] = with_folder(run)
        if sql is not None:
            _ORACLE[name] = sql
        return build

    return register


def _select(expressions: str, step: str, rest: str = "") -> str:
    return oracle.with_steps(f"SELECT {expressions} FROM {step} {rest}")


# ---------------------------------------------------------------- sources and sinks
@_query("scan_treatment", oracle.table("raw_treatment", oracle.RAW_TREATMENT))
def _(c):
    return c.inputs.treatment


@_query("scan_procedure", oracle.table("raw_procedure", oracle.RAW_PROCEDURE))
def _(c):
    return c.inputs.procedure


@_query("scan_token_bridge", oracle.table("bridge", oracle.BRIDGE_COLUMNS))
def _(c):
    return c.inputs.bridge


@_query("scan_code_reference", oracle.table("code_reference", oracle.CODES_COLUMNS))
def _(c):
    return c.inputs.codes


@_query("ctas_sink", oracle.table("base_procedure", CLAIM_COLUMNS))
def _(c):
    name = f"{c.staging.folder}/base_procedure"
    save(c.treatment, name)
    return save(c.procedure, name)  # replaces the table that was there


@_query(
    "staged_reuse",
    _select(
        "datasource, CAST(paid_flag AS BIGINT) AS paid_flag, count(*) AS claims,"
        " count(DISTINCT claim_id) AS claim_ids",
        "base",
        "GROUP BY datasource, paid_flag",
    ),
)
def _(c):
    per_flag = c.base.groupBy("datasource", "paid_flag")
    claims = per_flag.agg(F.count(F.lit(1)).alias("claims"))
    ids = per_flag.agg(F.count_distinct("claim_id").alias("claim_ids"))
    return claims.join(ids, ["datasource", "paid_flag"])


_UNIDENTIFIED = "patient_token_1 IS NULL AND patient_token_2 IS NULL AND patient_id IS NULL"


@_query(
    "named_subquery",
    _select(
        oracle.plain(CLAIM_COLUMNS),
        "(SELECT * FROM base_treatment EXCEPT"
        f" SELECT * FROM base_treatment WHERE {_UNIDENTIFIED}) AS kept",
    ),
)
def _(c):
    t = c.treatment
    return t.subtract(t.filter(_UNIDENTIFIED))


_ALTERNATIVE_COLUMNS = [*LINK_KEYS, "dos", "claim_id", "other_claim_id"]


@_query(
    "inline_derived_table",
    oracle.table(
        "matched_1_paid",
        [
            *_ALTERNATIVE_COLUMNS,
            *[f"{part}{x}" for x in FILL_ATTRIBUTES for part in ("other_", "augment_other_")],
        ],
    ),
)
def _(c):
    ranked = c.staging(rank_links(c.a, c.b), "ranked")
    result = winners(ranked).select(
        *_ALTERNATIVE_COLUMNS, *[f"other_{x}" for x in FILL_ATTRIBUTES]
    )
    for x in FILL_ATTRIBUTES:
        best = best_alternative(ranked, x).select(
            *LINK_KEYS, "dos", F.col(f"other_{x}").alias(f"augment_other_{x}")
        )
        result = result.join(best, [*LINK_KEYS, "dos"], "left")
    return result


# ---------------------------------------------------------------- projections
def _standard(kind: str) -> str:
    """A raw table under the common names, before any lookup."""
    own = kind == "treatment"
    status = "treatment_claim_status" if own else "'1' AS treatment_claim_status"
    indicator = "treatment_final_claim_indicator"
    return (
        "SELECT datasource, source, patient_token_1 AS original_token_1,"
        " patient_token_2 AS original_token_2,"
        " CASE WHEN datasource = 'A' THEN patient_id END AS patient_id,"
        f" {kind}_claim_id AS claim_id, provider_id, CAST({kind}_dos AS VARCHAR) AS dos,"
        f" CAST({'days_supply' if own else 'NULL'} AS DOUBLE) AS days_supply,"
        " CAST(out_of_pocket AS DOUBLE) AS out_of_pocket,"
        f" CAST(patient_pay AS DOUBLE) AS patient_pay, {status},"
        f" {indicator if own else chr(39) + 'PAID' + chr(39) + ' AS ' + indicator},"
        f" {kind}_code AS code, CAST({_PAID_FLAG if own else 1} AS BIGINT) AS paid_flag"
        f" FROM raw_{kind}"
    )


_PAID_FLAG = "CASE WHEN treatment_claim_status IN ('1', 'PAID') THEN 1 ELSE 0 END"


@_query(
    "standardize_columns",
    oracle.with_steps(f"{_standard('treatment')} UNION ALL {_standard('procedure')}"),
)
def _(c):
    return _standardized(c)


@_query(
    "constant_columns",
    oracle.with_steps(
        "SELECT procedure_claim_id AS claim_id, '1' AS treatment_claim_status,"
        " 'PAID' AS treatment_final_claim_indicator, CAST(1 AS BIGINT) AS paid_flag,"
        " CAST(NULL AS VARCHAR) AS data_source FROM raw_procedure UNION ALL"
        " SELECT claim_id, treatment_claim_status, treatment_final_claim_indicator,"
        " CAST(paid_flag AS BIGINT), 'Both' FROM winners_1_paid UNION ALL"
        " SELECT claim_id, treatment_claim_status, treatment_final_claim_indicator,"
        " CAST(paid_flag AS BIGINT), datasource FROM base WHERE code_group1 IS NOT NULL"
        " AND datasource IN ('A', 'B')"
    ),
)
def _(c):
    columns = [
        "claim_id", "treatment_claim_status", "treatment_final_claim_indicator", "paid_flag",
        "data_source",
    ]
    none = F.lit(None).cast("string").alias("data_source")
    literals = standardize(c.inputs.procedure, "procedure").select(*columns[:-1], none)
    linked = scenarios.matched_pass_1(c.a, c.b).select(*columns)
    unlinked = [
        s.select(*columns[:-1], F.lit(vendor).alias("data_source"))
        for s, vendor in ((c.a, "A"), (c.b, "B"))
    ]
    return literals.union(linked).union(unlinked[0]).union(unlinked[1])


@_query("typed_null_column", oracle.table("base", ["claim_id", "code", "dos", "days_supply"]))
def _(c):
    columns = ["claim_id", "code", "dos", "days_supply"]
    return c.treatment.select(*columns).union(c.procedure.select(*columns))


@_query(
    "star_expand",
    _select(oracle.plain(CLAIM_COLUMNS) + ", claim_id || code AS claim_key", "base"),
)
def _(c):
    return c.inputs.all_claims().select("*", claim_key().alias("claim_key"))


def _standardized(c: Context) -> DataFrame:
    """Both kinds under the common names, before any lookup."""
    i = c.inputs
    return standardize(i.treatment, "treatment").union(standardize(i.procedure, "procedure"))


@_query(
    "sentinel_to_null",
    oracle.table("base", ["claim_id", "patient_token_1", "patient_token_2"]),
)
def _(c):
    return enrich_tokens(_standardized(c), c.inputs.bridge).select(
        "claim_id", "patient_token_1", "patient_token_2"
    )


@_query(
    "source_gated_column",
    _select(
        "datasource, treatment_claim_id AS claim_id,"
        " CASE WHEN datasource = 'A' THEN patient_id END AS patient_id",
        "raw_treatment",
    ),
)
def _(c):
    return standardize(c.inputs.treatment, "treatment").select(
        "datasource", "claim_id", "patient_id"
    )


@_query(
    "paid_flag",
    _select(
        f"treatment_claim_id AS claim_id, treatment_claim_status, CAST({_PAID_FLAG} AS BIGINT)"
        " AS paid_flag",
        "raw_treatment",
    ),
)
def _(c):
    return standardize(c.inputs.treatment, "treatment").select(
        "claim_id", "treatment_claim_status", "paid_flag"
    )


_FLAGS = [f"non_null_other_{x}" for x in FILL_ATTRIBUTES]
_PAIR_ID = ["claim_id", "other_claim_id", "patient_token_1", "code", "dos", "other_dos"]


@_query("presence_flags", oracle.table("pairs_1_paid", [*_PAIR_ID, *_FLAGS]))
def _(c):
    return anchor_pairs(c.a, c.b).select(*_PAIR_ID, *_FLAGS)


@_query("claim_code_key", _select("claim_id, code, claim_id || code AS claim_key", "base"))
def _(c):
    return c.inputs.all_claims().select("claim_id", "code", claim_key().alias("claim_key"))


@_query("abs_day_diff", oracle.table("pairs_1_paid", [*_PAIR_ID, "abs_date_diff"]))
def _(c):
    pairs = link(c.a, c.b)
    return pairs.select(*_PAIR_ID, abs_days("other_dos", "dos").alias("abs_date_diff"))


_OWN_VALUE = [
    "claim_id", "code", "dos",
    *[f"{part}{x}" for x in FILL_ATTRIBUTES for part in ("", "other_", "augment_other_", "final_")],
]


@_query("coalesce_priority", oracle.table("matched_1_paid", _OWN_VALUE))
def _(c):
    best = best_matches(c.a.filter("paid_flag = 1"), c.b.filter("paid_flag = 1"))
    final = {
        f"final_{x}": final_value(x, f"other_{x}", f"augment_other_{x}") for x in FILL_ATTRIBUTES
    }
    return best.withColumns(final).select(*_OWN_VALUE)


@_query(
    "multi_concat_null",
    _select(
        "claim_id, patient_token_1 || patient_token_2 || claim_id AS composite_key",
        "base_treatment",
    ),
)
def _(c):
    return c.treatment.select(
        "claim_id",
        concat_key("patient_token_1", "patient_token_2", "claim_id").alias("composite_key"),
    )


_STATUSES = (
    "CASE WHEN provider_id IS NOT NULL THEN 'Provider_Complete' ELSE 'Provider_Missing' END"
    " AS provider_status, CASE WHEN out_of_pocket IS NOT NULL THEN 'Cost_Complete' ELSE"
    " 'Cost_Missing' END AS cost_status"
)


@_query(
    "status_label",
    _select(
        f"claim_id, code, {_STATUSES}",
        "base",
    ),
)
def _(c):
    return c.inputs.all_claims().select(
        "claim_id",
        "code",
        completeness_label("provider_id", "Provider").alias("provider_status"),
        completeness_label("out_of_pocket", "Cost").alias("cost_status"),
    )


@_query(
    "rename_to_encounter",
    _select(
        oracle.plain(INTEGRATED_COLUMNS), f"({oracle.leg('primary_anchor', 'A')}) AS legs"
    ),
)
def _(c):
    anchors = segment("A", True, c.inputs.all_claims())
    return plan.to_integrated(anchors, F.lit("A")).distinct()


# ---------------------------------------------------------------- filters
@_query(
    "filter_anchor",
    _select(oracle.plain(CLAIM_COLUMNS), "base", "WHERE code_group1 IS NOT NULL"),
)
def _(c):
    both = c.treatment, c.procedure
    return segment("A", True, *both).union(segment("B", True, *both))


@_query(
    "filter_non_anchor",
    _select(oracle.plain(CLAIM_COLUMNS), "base", "WHERE code_group1 IS NULL"),
)
def _(c):
    both = c.treatment, c.procedure
    return segment("A", False, *both).union(segment("B", False, *both))


@_query("filter_paid_pair", oracle.table("pairs_1_non_paid", [*_PAIR_ID, "paid_flag"]))
def _(c):
    return link(c.a, c.b, paid=NON_PAID).select(*_PAIR_ID, "paid_flag")


@_query(
    "filter_in_list",
    _select(
        oracle.plain(oracle.RAW_TREATMENT),
        "raw_treatment",
        "WHERE treatment_claim_status IN ('1', 'PAID')",
    ),
)
def _(c):
    return c.inputs.treatment.filter(F.col("treatment_claim_status").isin("1", "PAID"))


@_query(
    "filter_best_rank",
    _select(oracle.plain([*_PAIR_ID, "rn"]), "ranked_1_paid", "WHERE rn = 1"),
)
def _(c):
    paid = [s.filter("paid_flag = 1") for s in (c.a, c.b)]
    return best_matches(*paid, attributes=[]).select(*_PAIR_ID, "rn")


@_query(
    "filter_best_present",
    oracle.with_steps(
        " UNION ALL ".join(
            f"SELECT '{x}' AS attribute, {oracle.plain(_PAIR_ID)}, CAST(other_{x} AS DOUBLE) AS"
            f" value, CAST(rn_other_{x} AS BIGINT) AS place FROM ranked_1_paid"
            f" WHERE rn_other_{x} = 1 AND non_null_other_{x} = 1"
            for x in FILL_ATTRIBUTES
        )
    ),
)
def _(c):
    paid = [s.filter("paid_flag = 1") for s in (c.a, c.b)]
    found = [
        best_alternatives(*paid, x).select(
            F.lit(x).alias("attribute"),
            *_PAIR_ID,
            F.col(f"other_{x}").cast("double").alias("value"),
            F.col(f"rn_other_{x}").cast("bigint").alias("place"),
        )
        for x in FILL_ATTRIBUTES
    ]
    return reduce(DataFrame.union, found)


@_query(
    "not_in_one_ledger",
    _select(
        oracle.plain(CLAIM_COLUMNS),
        "primary_non_anchor",
        "WHERE claim_id || code NOT IN (SELECT claim_key FROM ledger_3_paid)",
    ),
)
def _(c):
    used = c.staging(scenarios.ledger_scenario_3(c.a_rest, c.b_rest), "ledger_3")
    keyed = c.a_rest.withColumn("claim_key", claim_key())
    sieve = ledger_sieve(used, c.staging)
    return not_in(keyed, "claim_key", used, sieve=sieve).drop("claim_key")


@_query(
    "not_in_two_ledgers",
    _select(
        oracle.plain(CLAIM_COLUMNS),
        "base",
        "WHERE claim_id || code NOT IN (SELECT claim_key FROM ledger_1_paid"
        " UNION SELECT claim_key FROM ledger_3_paid)",
    ),
)
def _(c):
    used = reduce(DataFrame.union, c.ledgers())
    keyed = c.base.select(*CLAIM_COLUMNS, claim_key().alias("claim_key"))
    sieve = ledger_sieve(used, c.staging)
    return not_in(keyed, "claim_key", used, sieve=sieve).drop("claim_key")


@_query(
    "not_in_inside_join",
    oracle.table("pairs_2_paid_winners", oracle.PAIR_COLUMNS),
)
def _(c):
    listed = c.staging(scenarios.pass_2_ledger(c.a, c.b, exclude="winners"), "listed")
    return anchor_pairs(c.b, c.a, exclude=listed)


@_query(
    "purge_unidentified",
    _select(
        "datasource, claim_id, code, patient_token_1, patient_token_2, patient_id",
        "base",
        f"WHERE NOT (datasource = 'B' AND {_UNIDENTIFIED})",
    ),
)
def _(c):
    rows = c.inputs.all_claims().withColumn("data_source", F.col("datasource"))
    return plan.purge(rows).select(
        "datasource", "claim_id", "code", "patient_token_1", "patient_token_2", "patient_id"
    )


@_query("paid_rule_by_source", oracle.table("base_paid_by_source", CLAIM_COLUMNS))
def _(c):
    return c.inputs.base("treatment", paid_rule="by_source")


_TRACED = ["base", "primary_anchor", "ranked_1_paid", "scenario_1_paid", "scenario_3_paid"]


@_query(
    "trace_claim",
    oracle.with_steps(
        " UNION ALL ".join(
            f"SELECT '{s}' AS stage, {oracle.plain(CLAIM_COLUMNS)} FROM {s} WHERE claim_id ="
            " (SELECT min(claim_id) FROM winners_1_paid)"
            for s in _TRACED
        )
    ),
)
def _(c):
    # One claim is traced once: tables in order of the claim id (``plans/lookup.py``) pay for many.
    paid = [with_flag(s, PAID) for s in (c.a, c.b)]
    sides = near_sides(*paid, LINK_KEYS, DAY_TOLERANCE, c.staging)
    stages = {
        "base": c.base.select(*CLAIM_COLUMNS),
        "primary_anchor": c.a,
        "ranked_1_paid": scenarios.ranked_pass_1(*sides),
        "scenario_1_paid": c.staging(scenarios.scenario_1(*sides), "scenario_1"),
        "scenario_3_paid": scenarios.scenario_3(c.a_rest, c.b_rest),
    }
    (wanted,) = stages["scenario_1_paid"].agg(F.min("claim_id")).first()
    found = quality.trace({s: stages[s] for s in _TRACED}, F.lit(wanted))  # no linked claim: none
    return found.select("stage", *CLAIM_COLUMNS)


# ---------------------------------------------------------------- joins
@_query(
    "enrich_tokens",
    oracle.table("base", ["claim_id", "code", "patient_token_1", "patient_token_2"]),
)
def _(c):
    return enrich_tokens(_standardized(c), c.inputs.bridge).select(
        "claim_id", "code", "patient_token_1", "patient_token_2"
    )


@_query(
    "enrich_codes",
    _select(
        "r.treatment_claim_id AS claim_id, r.treatment_code AS code, c.code_group1,"
        " c.code_group2, c.code_group3, c.code_group4",
        "(SELECT treatment_claim_id, treatment_code FROM raw_treatment UNION ALL"
        " SELECT procedure_claim_id, procedure_code FROM raw_procedure) AS r",
        "LEFT JOIN code_reference AS c ON r.treatment_code = c.code",
    ),
)
def _(c):
    return enrich_codes(_standardized(c), c.inputs.codes).select("claim_id", "code", *CODE_GROUPS)


_LINK_COLUMNS = [*CLAIM_COLUMNS, *OTHER_COLUMNS, "abs_date_diff"]


@_query("link_primary_to_secondary", oracle.table("pairs_1_paid", _LINK_COLUMNS))
def _(c):
    return link(c.a, c.b)


@_query("link_secondary_to_primary", oracle.table("pairs_2_paid_winners", _LINK_COLUMNS))
def _(c):
    listed = c.staging(scenarios.pass_2_ledger(c.a, c.b, exclude="winners"), "listed")
    return link(c.b, c.a, exclude=listed)


@_query("link_exact_attributes", oracle.table("pairs_3_paid", _LINK_COLUMNS))
def _(c):
    return link(c.a_rest, c.b_rest, EXACT_KEYS, distinct=False)


_AUGMENTED = [
    *LINK_KEYS,
    "dos",
    *[f"augment_other_{x}" for x in FILL_ATTRIBUTES],
    *[f"final_{x}" for x in FILL_ATTRIBUTES],
]


@_query("augment_four", oracle.table("matched_1_paid", _AUGMENTED))
def _(c):
    paid = [s.filter("paid_flag = 1") for s in (c.a, c.b)]
    return best_matches(*paid).select(*_AUGMENTED)


@_query(
    "augment_one",
    oracle.table("scenario_3_paid", [*EXACT_KEYS, "dos", "days_supply", "final_days_supply"]),
)
def _(c):
    paid = [s.filter("paid_flag = 1") for s in (c.a_rest, c.b_rest)]
    return best_matches(*paid, EXACT_KEYS, ["days_supply"]).select(
        *EXACT_KEYS, "dos", "days_supply", "final_days_supply"
    )


# ---------------------------------------------------------------- aggregates and distinct
@_query(
    "count_distinct_claims",
    oracle.with_steps(
        "SELECT 'before' AS stage, count(DISTINCT treatment_claim_id) AS distinct_claims"
        " FROM raw_treatment UNION ALL SELECT 'after', count(DISTINCT claim_id)"
        " FROM base_treatment"
    ),
)
def _(c):
    return quality.reconcile(c.inputs.treatment, c.treatment, "treatment_claim_id")


def _differing_sql(before: str, after: str, keys: str) -> str:
    """Keys with other numbers of rows in one relation than in the other."""
    return oracle.with_steps(
        f"SELECT {keys}, CAST(sum(b) AS BIGINT) AS rows_before, CAST(sum(a) AS BIGINT) AS"
        f" rows_after FROM (SELECT {keys}, 1 AS b, 0 AS a FROM {before} UNION ALL"
        f" SELECT {keys}, 0, 1 FROM {after}) AS both_tables"
        f" GROUP BY {keys} HAVING sum(b) <> sum(a)"
    )


@_query(
    "reconcile_rows",
    _differing_sql(
        "(SELECT treatment_claim_id AS claim_id FROM raw_treatment"
        " UNION ALL SELECT procedure_claim_id FROM raw_procedure) AS raw",
        "base",
        "claim_id",
    ),
)
def _(c):
    raw = c.inputs.treatment.select(F.col("treatment_claim_id").alias("claim_id")).unionAll(
        c.inputs.procedure.select("procedure_claim_id")
    )
    return quality.reconcile_rows(c.staging(raw, "raw_ids"), c.base)


_ENCOUNTER = ["data_source", "encounter_key", "codes"]


@_query(
    "reconcile_rows_final",
    _differing_sql("integrated_paid", "integrated_final", ", ".join(_ENCOUNTER)),
)
def _(c):
    paid = c.staging(c.integrated((PAID,)).select(*_ENCOUNTER), "paid")
    final = c.staging(c.integrated((PAID, NON_PAID)).select(*_ENCOUNTER), "final")
    return quality.reconcile_rows(paid, final, _ENCOUNTER)


@_query(
    "count_distinct_composite",
    _select(
        "count(DISTINCT patient_token_2 || claim_id) AS by_token_2, count(DISTINCT"
        " patient_token_1 || patient_token_2 || claim_id) AS by_both_tokens",
        "base_treatment",
    ),
)
def _(c):
    return quality.reconcile_keys(
        c.treatment,
        {
            "by_token_2": ["patient_token_2", "claim_id"],
            "by_both_tokens": ["patient_token_1", "patient_token_2", "claim_id"],
        },
    )


@_query("distinct_pairs", oracle.table("pairs_1_paid", oracle.PAIR_COLUMNS))
def _(c):
    return anchor_pairs(c.a, c.b)


@_query("distinct_rows", oracle.table("base", CLAIM_COLUMNS, distinct=True))
def _(c):
    return c.inputs.all_claims().distinct()


@_query("distinct_ledger", _select("DISTINCT other_claim_id || code AS claim_key", "pairs_1_paid"))
def _(c):
    return scenarios.pass_2_ledger(c.a, c.b)


@_query("distinct_claim_ids", _select("DISTINCT claim_id", "base_procedure"))
def _(c):
    return quality.claim_ids(c.procedure)


@_query(
    "summary_by_provenance",
    _select(
        "data_source, count(*) AS record_count, count(DISTINCT patient_token_2) AS"
        " unique_patients, count(DISTINCT encounter_key) AS unique_encounters",
        "integrated_paid",
        "GROUP BY data_source",
    ),
)
def _(c):
    return quality.summary(c.integrated((PAID,)))


@_query(
    "duplicate_encounters",
    _select(
        "encounter_key, codes, count(*) AS record_count",
        "integrated_paid",
        "GROUP BY encounter_key, codes HAVING count(*) > 1",
    ),
)
def _(c):
    final = c.integrated((PAID,)).select("encounter_key", "codes")
    return quality.duplicates(c.staging(final, "encounters"), c.staging)


_STATUS_COUNTS = f"{_STATUSES}, count(*) AS record_count"


@_query(
    "completeness_counts",
    _select(_STATUS_COUNTS, "integrated_paid", "GROUP BY provider_status, cost_status"),
)
def _(c):
    return quality.completeness(c.integrated((PAID,)))


# ---------------------------------------------------------------- ranks
def _rank_query(name: str, attribute: str | None) -> None:
    column = "rn" if attribute is None else f"rn_other_{attribute}"

    @_query(name, oracle.table("ranked_1_paid", [*_PAIR_ID, column]))
    def _(c):
        ranked = rank_links(c.a, c.b, attributes=[attribute] if attribute else [])
        return ranked.select(*_PAIR_ID, column)


for _name, _attribute in (
    ("rank_by_date", None),
    ("rank_by_provider", "provider_id"),
    ("rank_by_out_of_pocket", "out_of_pocket"),
    ("rank_by_patient_pay", "patient_pay"),
    ("rank_by_days_supply", "days_supply"),
):
    _rank_query(_name, _attribute)


@_query("top1_per_group", oracle.table("winners_1_paid", _LINK_COLUMNS))
def _(c):
    paid = [s.filter("paid_flag = 1") for s in (c.a, c.b)]
    return best_matches(*paid, attributes=[]).select(*_LINK_COLUMNS)


# ---------------------------------------------------------------- set operations
@_query("union_all_claims", oracle.table("primary_anchor", CLAIM_COLUMNS))
def _(c):
    return segment("A", True, c.treatment, c.procedure)


@_query("union_distinct_passes", oracle.table("scenario_1_paid_winners", oracle.RANKED_COLUMNS))
def _(c):
    first = scenarios.matched_pass_1(c.a, c.b)
    second = scenarios.matched_pass_2(c.a, c.b, exclude="winners")
    return scenarios.consolidated(first.union(second).distinct())


@_query(
    "union_distinct_keys",
    oracle.with_steps("SELECT * FROM ledger_1_paid UNION SELECT * FROM ledger_3_paid"),
)
def _(c):
    first = scenarios.ledger_scenario_1(c.a, c.b)
    return first.union(scenarios.ledger_scenario_3(c.a_rest, c.b_rest)).distinct()


@_query("union_distinct_legs", oracle.table("all_legs_paid", INTEGRATED_COLUMNS))
def _(c):
    first, third = c.ledgers()
    legs = [
        plan.leg_scenario_1(scenarios.scenario_1(c.a, c.b)),
        plan.leg_scenario_3(scenarios.scenario_3(c.a_rest, c.b_rest), first),
        *[
            plan.leg_rest(rows, vendor, first, third, staging=c.staging)
            for rows, vendor in ((c.a, "A"), (c.b, "B"), (c.a_rest, "A"), (c.b_rest, "B"))
        ],
    ]
    return plan.distinct_rows(reduce(DataFrame.union, legs), c.staging)


@_query("union_distinct_final", oracle.table("integrated_final", INTEGRATED_COLUMNS))
def _(c):
    return plan.merge_runs(c.base, staging=c.staging)


@_query("minus_rows", oracle.table("integrated_paid", INTEGRATED_COLUMNS))
def _(c):
    return plan.purge(c.integrated((PAID,), purged=False))


@_query(
    "union_distinct_ids",
    oracle.with_steps(
        "SELECT claim_id FROM base_procedure UNION SELECT claim_id FROM base_treatment"
    ),
)
def _(c):
    return quality.claim_ids(c.procedure, c.treatment)


# ---------------------------------------------------------------- pipeline steps
@_query("base_treatment", oracle.table("base_treatment", CLAIM_COLUMNS))
def _(c):
    return c.treatment


@_query("base_procedure", oracle.table("base_procedure", CLAIM_COLUMNS))
def _(c):
    return c.procedure


def _segment_query(name: str, vendor: str, anchor: bool) -> None:
    @_query(f"segment_{name}", oracle.table(name, CLAIM_COLUMNS))
    def _(c):
        return segment(vendor, anchor, c.treatment, c.procedure)


for _name, _vendor, _anchor in (
    ("primary_anchor", "A", True),
    ("secondary_anchor", "B", True),
    ("primary_non_anchor", "A", False),
    ("secondary_non_anchor", "B", False),
):
    _segment_query(_name, _vendor, _anchor)


def _run_queries(run: str, paid: int) -> None:
    """Steps that exist once per paid flag."""
    suffix = "" if paid else "_non_paid"

    @_query(f"ranked_pass_1{suffix}", oracle.table(f"ranked_1_{run}", oracle.RANKED_COLUMNS))
    def _(c):
        return scenarios.ranked_pass_1(c.a, c.b, paid)

    @_query(f"ranked_pass_2{suffix}", oracle.table(f"ranked_2_{run}", oracle.RANKED_COLUMNS))
    def _(c):
        return scenarios.ranked_pass_2(c.a, c.b, paid)

    @_query(
        f"ranked_pass_2_winners{suffix}",
        oracle.table(f"ranked_2_{run}_winners", oracle.RANKED_COLUMNS),
    )
    def _(c):
        return scenarios.ranked_pass_2(c.a, c.b, paid, "winners")

    @_query(f"consolidated_pass_1{suffix}", oracle.table(f"winners_1_{run}", oracle.RANKED_COLUMNS))
    def _(c):
        return scenarios.consolidated(scenarios.matched_pass_1(c.a, c.b, paid))

    @_query(f"consolidated_pass_2{suffix}", oracle.table(f"winners_2_{run}", oracle.RANKED_COLUMNS))
    def _(c):
        return scenarios.consolidated(scenarios.matched_pass_2(c.a, c.b, paid))

    @_query(f"scenario_1{suffix}", oracle.table(f"scenario_1_{run}", oracle.SCENARIO_1_COLUMNS))
    def _(c):
        return scenarios.scenario_1(c.a, c.b, paid)

    @_query(
        f"scenario_1_winners{suffix}",
        oracle.table(f"scenario_1_{run}_winners", oracle.SCENARIO_1_COLUMNS),
    )
    def _(c):
        return scenarios.scenario_1(c.a, c.b, paid, "winners")

    @_query(f"non_anchor_pairs{suffix}", oracle.table(f"pairs_3_{run}", oracle.EXACT_COLUMNS))
    def _(c):
        return exact_pairs(c.a_rest, c.b_rest, paid)

    @_query(f"scenario_3{suffix}", oracle.table(f"scenario_3_{run}", oracle.SCENARIO_3_COLUMNS))
    def _(c):
        return scenarios.scenario_3(c.a_rest, c.b_rest, paid)

    @_query(f"ledger_scenario_1{suffix}", oracle.table(f"ledger_1_{run}", ["claim_key"]))
    def _(c):
        return scenarios.ledger_scenario_1(c.a, c.b, paid)

    @_query(f"ledger_scenario_3{suffix}", oracle.table(f"ledger_3_{run}", ["claim_key"]))
    def _(c):
        return scenarios.ledger_scenario_3(c.a_rest, c.b_rest, paid)

    @_query(f"leg_scenario_1{suffix}", oracle.table(f"leg_1_{run}", INTEGRATED_COLUMNS))
    def _(c):
        return plan.leg_scenario_1(scenarios.scenario_1(c.a, c.b, paid))

    @_query(f"leg_scenario_3{suffix}", oracle.table(f"leg_3_{run}", INTEGRATED_COLUMNS))
    def _(c):
        first = c.staging(scenarios.ledger_scenario_1(c.a, c.b, paid), "ledger_1")
        return plan.leg_scenario_3(scenarios.scenario_3(c.a_rest, c.b_rest, paid), first)

    def rest(name: str, vendor: str, anchor: bool) -> None:
        @_query(f"leg_{name}_rest{suffix}", oracle.table(f"rest_{name}_{run}", INTEGRATED_COLUMNS))
        def _(c):
            rows = segment(vendor, anchor, c.base)
            return plan.leg_rest(rows, vendor, *c.ledgers(paid), staging=c.staging)

    rest("primary_anchor", "A", True)
    rest("secondary_anchor", "B", True)
    rest("primary_non_anchor", "A", False)
    rest("secondary_non_anchor", "B", False)

    @_query(f"integrated_{run}", oracle.table(f"integrated_{run}", INTEGRATED_COLUMNS))
    def _(c):
        return c.integrated((paid,))

    @_query(f"integrated_{run}_no_purge", oracle.table(f"all_legs_{run}", INTEGRATED_COLUMNS))
    def _(c):
        return c.integrated((paid,), purged=False)


for _run, _paid in oracle.RUNS.items():
    _run_queries(_run, _paid)


@_query("integrated_final", oracle.table("integrated_final", INTEGRATED_COLUMNS))
def _(c):
    i = c.inputs
    return plan.run_pipeline(i.treatment, i.procedure, i.bridge, i.codes)


@_query("integrated_final_own_flag", oracle.table("integrated_own_final", INTEGRATED_COLUMNS))
def _(c):
    return c.integrated((PAID, NON_PAID), leftovers="own_flag")


@_query("integrated_final_winners", oracle.table("integrated_winners_final", INTEGRATED_COLUMNS))
def _(c):
    return c.integrated((PAID, NON_PAID), exclude="winners")


@_query(
    "integrated_final_by_source",
    oracle.table("integrated_final", INTEGRATED_COLUMNS, by_source=True),
)
def _(c):
    i = c.inputs
    return plan.run_pipeline(
        i.treatment, i.procedure, i.bridge, i.codes, paid_rule="by_source"
    )


# ---------------------------------------------------------------- checks
def _lost(scenario: int, run: str) -> str:
    return (
        f"SELECT DISTINCT claim_id || code AS claim_key FROM ranked_{scenario}_{run}"
        " WHERE claim_id || code NOT IN"
        f" (SELECT claim_id || code FROM winners_{scenario}_{run})"
    )


@_query("lost_claims", oracle.with_steps(_lost(1, "paid")))
def _(c):
    return quality.lost_claims(c.a, c.b)


@_query("lost_claims_scenario_3", oracle.with_steps(_lost(3, "paid")))
def _(c):
    return quality.lost_claims(c.a_rest, c.b_rest, keys=EXACT_KEYS)


def report_sql(table: str, runs: tuple[str, ...]) -> str:
    """All checks over a run's final table, without the steps before it."""
    parts = [
        "SELECT 'distinct_claims' AS check_name, 'before' AS item,"
        " count(DISTINCT claim_id) AS amount FROM claim_line",
        "SELECT 'distinct_claims', 'after', count(DISTINCT claim_id) FROM base",
    ]
    for name, amount in (
        ("record_count", "count(*)"),
        ("unique_patients", "count(DISTINCT patient_token_2)"),
        ("unique_encounters", "count(DISTINCT encounter_key)"),
    ):
        parts.append(f"SELECT '{name}', data_source, {amount} FROM {table} GROUP BY data_source")
    parts += [
        "SELECT 'duplicate_encounters', 'all', count(*) FROM (SELECT encounter_key FROM"
        f" {table} GROUP BY encounter_key, codes HAVING count(*) > 1) AS repeated",
        "SELECT 'completeness', provider_status || '/' || cost_status, record_count FROM"
        f" (SELECT {_STATUS_COUNTS} FROM {table} GROUP BY provider_status, cost_status) AS counts",
    ]
    for scenario in (1, 3):
        lost = " UNION ALL ".join(f"SELECT * FROM ({_lost(scenario, r)}) AS l" for r in runs)
        parts.append(
            f"SELECT 'lost_claims', 'scenario_{scenario}', count(*) FROM ({lost}) AS lost"
        )
    return " UNION ALL ".join(parts)


def _report_query(name: str, table: str, flags: tuple[int, ...]) -> None:
    runs = tuple(r for r, flag in oracle.RUNS.items() if flag in flags)

    @_query(name, oracle.with_steps(report_sql(table, runs)))
    def _(c):
        i = c.inputs
        raw_ids = i.treatment.select(F.col("treatment_claim_id").alias("claim_id")).union(
            i.procedure.select("procedure_claim_id")
        )
        run = plan.integrate_run(c.base, flags, staging=c.staging)
        return quality.quality_report(
            raw_ids, c.base, run.result, flags, staging=c.staging, run=run
        )


for _name, _table, _flags in (
    ("quality_report", "integrated_paid", (PAID,)),
    ("quality_report_non_paid", "integrated_non_paid", (NON_PAID,)),
    ("quality_report_final", "integrated_final", (PAID, NON_PAID)),
):
    _report_query(_name, _table, _flags)


# ---------------------------------------------------------------- driver contract
def entry(spark: SparkSession) -> DataFrame:
    """Flagship: both vendors' claims integrated, paid and non-paid."""
    return _QUERIES["integrated_final"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator and step; those over documents and pages if they are there."""
    if documents is None:
        return dict(_QUERIES)
    more = documents.QUERIES | {"pipeline": corpus_pipeline.run}
    return _QUERIES | {name: with_folder(run) for name, run in more.items()}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for every query that SQL can express."""
    if documents is None:
        return dict(_ORACLE)
    more = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
    return _ORACLE | documents.ORACLE | more
