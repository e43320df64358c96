"""Rewritten steps against the plain SQL on small random claims full of ties and NULLs."""

from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

import duckdb
import pyarrow as pa
import pytest
from helpers import duck_rows, rows

from claimlink import oracle
from claimlink.operators.base import segment
from claimlink.operators.link import exact_pairs
from claimlink.plans import scenarios
from claimlink.plans.integrate import NON_PAID, PAID, integrate
from claimlink.schema import CLAIM_SCHEMA, INTEGRATED_COLUMNS

# seed, rows, whether claim ids may be NULL
CASES = [(1, 400, False), (2, 150, True)]


def random_claims(seed: int, size: int, null_ids: bool) -> list[tuple]:
    pick = random.Random(seed)
    ids = [f"{p}{i}" for p in ("x", "y", "zz") for i in range(8)]
    out = []
    for _ in range(size):
        code = pick.choice(["c0", "c1", "c2"])
        # c2 is in a group for some rows only, as with a code that is listed twice
        group = {"c0": "g0", "c1": None, "c2": pick.choice(["g2", None])}[code]
        money = [None, Decimal("0.00"), Decimal("1.50")]
        paid = pick.choice([0, 1, 1])
        out.append(
            (
                pick.choice(["A", "B"]),
                pick.choice(["s", None]),
                pick.choice(["p1", "p2", "p2-alt", None]),
                pick.choice(["q1", "q2", None]),
                pick.choice(["id", None]),
                None if null_ids and pick.random() < 0.03 else pick.choice(ids),
                pick.choice(["0", "1", None]),
                date(2020, 1, 1) + timedelta(days=pick.randrange(25)),
                pick.choice([None, 10, 30]),
                pick.choice(money),
                pick.choice(money),
                "1" if paid else "0",
                pick.choice(["PAID", None]),
                code,
                group,
                None,
                None,
                None,
                paid,
            )
        )
    return out


@pytest.fixture(scope="module", params=CASES, ids=lambda c: f"seed{c[0]}")
def tables(request, spark):
    data = random_claims(*request.param)
    base = spark.createDataFrame(data, CLAIM_SCHEMA).cache()
    types = {
        "date": pa.date32(),
        "int": pa.int32(),
        "decimal(18,2)": pa.decimal128(18, 2),
        "string": pa.string(),
    }
    arrow = pa.table(
        {
            f.name: pa.array([r[i] for r in data], types[f.dataType.simpleString()])
            for i, f in enumerate(CLAIM_SCHEMA)
        }
    )
    connection = duckdb.connect()
    connection.register("base", arrow)
    sides = [
        segment(vendor, anchor, base) for anchor in (True, False) for vendor in ("A", "B")
    ]
    return connection, base, sides


def check(connection, df, step: str, columns) -> None:
    from __spark_entry__ import plain

    sql = oracle.with_steps(f"SELECT {oracle.plain(columns)} FROM {step}", given=["base"])
    names, expected = duck_rows(connection, sql)
    df = plain(df)
    assert sorted(df.columns) == names
    assert rows(df) == expected


@pytest.mark.parametrize(("run", "paid"), list(oracle.RUNS.items()))
def test_ranked_pairs(tables, run, paid):
    connection, _, (a, b, *_rest) = tables
    ranked = scenarios.ranked_pass_1(a, b, paid)
    check(connection, ranked, f"ranked_1_{run}", oracle.RANKED_COLUMNS)


@pytest.mark.parametrize("exclude", ["all", "winners"])
def test_reverse_pass(tables, exclude):
    connection, _, (a, b, *_rest) = tables
    suffix = "_winners" if exclude == "winners" else ""
    ranked = scenarios.ranked_pass_2(a, b, 1, exclude)
    check(connection, ranked, f"ranked_2_paid{suffix}", oracle.RANKED_COLUMNS)


@pytest.mark.parametrize("exclude", ["all", "winners"])
@pytest.mark.parametrize(("run", "paid"), list(oracle.RUNS.items()))
def test_scenario_1(tables, run, paid, exclude):
    connection, _, (a, b, *_rest) = tables
    suffix = "_winners" if exclude == "winners" else ""
    result = scenarios.scenario_1(a, b, paid, exclude)
    check(connection, result, f"scenario_1_{run}{suffix}", oracle.SCENARIO_1_COLUMNS)


@pytest.mark.parametrize(("run", "paid"), list(oracle.RUNS.items()))
def test_scenario_3(tables, run, paid):
    connection, _, (_a, _b, a, b) = tables
    check(connection, exact_pairs(a, b, paid), f"pairs_3_{run}", oracle.EXACT_COLUMNS)
    result = scenarios.scenario_3(a, b, paid)
    check(connection, result, f"scenario_3_{run}", oracle.SCENARIO_3_COLUMNS)


@pytest.mark.parametrize(("run", "paid"), list(oracle.RUNS.items()))
def test_ledgers(tables, run, paid):
    connection, _, (a, b, a_rest, b_rest) = tables
    first = scenarios.ledger_scenario_1(a, b, paid)
    third = scenarios.ledger_scenario_3(a_rest, b_rest, paid)
    check(connection, first, f"ledger_1_{run}", ["claim_key"])
    check(connection, third, f"ledger_3_{run}", ["claim_key"])


@pytest.mark.parametrize(("run", "paid"), list(oracle.RUNS.items()))
def test_integrated_run(tables, run, paid):
    connection, base, _ = tables
    result = integrate(base, (paid,))
    check(connection, result, f"integrated_{run}", INTEGRATED_COLUMNS)
    whole = integrate(base, (paid,), purged=False)
    check(connection, whole, f"all_legs_{run}", INTEGRATED_COLUMNS)


@pytest.mark.parametrize(
    ("step", "options"),
    [
        ("integrated_final", {}),
        ("integrated_own_final", {"leftovers": "own_flag"}),
        ("integrated_winners_final", {"exclude": "winners"}),
    ],
)
def test_integrated_final(tables, step, options):
    connection, base, _ = tables
    result = integrate(base, (PAID, NON_PAID), **options)
    check(connection, result, step, INTEGRATED_COLUMNS)
